"""The batch index: one small row per landed batch, from which bronze is read by partition path.

Choosing what to normalise reads the index and the ledger of processed batches, never bronze itself; the
pages of the chosen batches are then opened by the path of their partition, so no folder of another
batch is listed or scanned, however long the history is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.select import BATCH, FLAG, STAMP
from tidemark.operators.sinks import LEDGER, Store, Written
from tidemark.operators.staging import staged
from tidemark.sources.tables import list_folder, partition_folder

INDEX = "_batches"
COLUMNS = f"{BATCH} string, landed_at timestamp, pages bigint"
#: A table's index is folded into one file once it has more than so many.
FOLD_FILES = 200
LANDED = "landed"


def summary(pages: DataFrame) -> DataFrame:
    """Per batch the newest stamp and the number of its pending pages; a batch with none has 0 and NULL."""
    waits = ~F.col(FLAG)
    return pages.groupBy(BATCH).agg(F.max(F.when(waits, F.col(STAMP))).alias("landed_at"), F.count_if(waits).alias("pages"))


def land(
    store: Store, table: str, pages: DataFrame, batch: str, evolve: bool = True,
    watch: Mapping[str, Column] | None = None,
) -> Written:
    """Append the pages of one batch and enter it. What the entry says comes with the write itself, and so
    does what ``watch`` asks for."""
    waits = ~F.col(FLAG)
    watch = {**(watch or {}), "landed_at": F.max(F.when(waits, F.col(STAMP))), "waiting": F.count_if(waits)}
    done = store.append(table, pages, partition_by=[BATCH], evolve=evolve, watch=watch)
    enter(store, table, store.spark.createDataFrame([(batch, done.seen["landed_at"], done.seen["waiting"])], COLUMNS))
    return done


def enter(store: Store, table: str, found: DataFrame) -> None:
    rows = found.select(F.lit(table).alias("table"), BATCH, "landed_at", "pages")
    store.append(INDEX, rows.coalesce(1), partition_by=["table"])
    if len(list_folder(store.spark, partition_folder(store.path(INDEX), "table", table))) > FOLD_FILES:
        fold(store, table)


def fold(store: Store, table: str) -> None:
    """Rewrite a table's index as one file, one row per batch."""
    rows = staged(_landed(store, table).withColumn("table", F.lit(table)).select("table", BATCH, "landed_at", "pages").coalesce(1))
    store.replace_partitions(INDEX, rows, ["table"])


def recover(store: Store, table: str, names: Sequence[str] | None = None) -> int:
    """Enter batches that have a folder but no entry: landed before there was an index, or by a run that
    ended between the two writes. Only their folders are read. Returns how many there were."""
    prefix = f"{BATCH}="
    if names is None:
        names = [f for f in list_folder(store.spark, store.path(table)) if f.startswith(prefix)]
    known = set()
    if is_kept(store, table):
        known = {partition_folder("", BATCH, r[0])[1:] for r in _landed(store, table).select(BATCH).toLocalIterator()}
    lost = sorted(set(names) - known)
    if lost:
        enter(store, table, summary(_open(store, table, lost)))
    return len(lost)


def _open(store: Store, table: str, names: Sequence[str]) -> DataFrame:
    """Partitions by path. Batch ids are text: of a folder's name alone Spark would make a number."""
    reader = store.spark.read.option("basePath", store.path(table))
    folders = [f"{store.path(table)}/{name}" for name in names]
    kinds = [T.StructField(f.name, T.StringType()) if f.name == BATCH else f for f in reader.parquet(*folders).schema]
    return reader.schema(T.StructType(kinds)).parquet(*folders)


def is_kept(store: Store, table: str) -> bool:
    """Whether the table has an index."""
    return bool(list_folder(store.spark, partition_folder(store.path(INDEX), "table", table)))


def _landed(store: Store, table: str) -> DataFrame:
    """One row per batch; a batch that landed in several writes counts with all of them."""
    folder = partition_folder(store.path(INDEX), "table", table)
    rows = store.spark.read.schema(COLUMNS).parquet(folder)
    return rows.groupBy(BATCH).agg(F.max("landed_at").alias("landed_at"), F.sum("pages").alias("pages"))


def entries(store: Store, table: str) -> DataFrame:
    """(batch, landed_at, pages, state) of every landed batch; state is ``landed`` until the ledger
    says otherwise."""
    landed = _landed(store, table)
    if not store.exists(LEDGER):
        return landed.withColumn("state", F.lit(LANDED))
    marks = store.read(LEDGER).where(F.col("table") == table).groupBy(BATCH).agg(F.max_by("state", "processed_at").alias("state"))
    return landed.join(marks, BATCH, "left").withColumn("state", F.coalesce("state", F.lit(LANDED)))


def newest(found: DataFrame) -> DataFrame:
    """The entry of the batch with the newest pending page, if there is one; of two equal ones the greater id."""
    top = found.where("pages > 0").agg(F.max(F.struct("landed_at", BATCH, "pages", "state")).alias("top"))
    return top.where("top IS NOT NULL").select(f"top.{BATCH}", "top.landed_at", "top.pages", "top.state")


def waiting(found: DataFrame) -> DataFrame:
    return found.where((F.col("pages") > 0) & (F.col("state") == LANDED))


def read_batches(store: Store, table: str, batches: Sequence[str]) -> DataFrame:
    """The pages of the batches named, opened by the paths of their partitions."""
    return _open(store, table, [partition_folder("", BATCH, b)[1:] for b in batches])
