"""Writing audit, bronze and silver tables, and remembering which batches are done.

A table is a folder below the store's root. Append-only tables are plain parquet, bronze and fetched
attempts partitioned by batch id so that reading one batch touches one partition. A replaced table
keeps each version in its own ``run=`` folder: readers take the newest one that carries the success
marker, so a version can be read while the next one is written from it, and a failed write leaves
the last good version in place. Several tables are published as one by ``together``: their versions
carry the number of a group and count from the moment its pointer is there.
"""

from __future__ import annotations

from collections.abc import Collection, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from itertools import islice
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import keyed
from tidemark.operators.nested import union_aligned
from tidemark.operators.select import BATCH, exclude, is_empty
from tidemark.operators.staging import staged
from tidemark.sources.tables import list_folder, put_marker, remove_folder

LEDGER = "_processed_batches"
VERSION = "%Y%m%dT%H%M%S%f"
MARKER = "_SUCCESS"
GROUPS, GROUP = "_groups", "-g"
NO_MARKER = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


@dataclass(frozen=True)
class Written:
    """What a write did: the path, whether anything was written, its row count, and what else was
    watched while it ran."""

    path: str
    wrote: bool
    rows: int
    seen: Mapping[str, object] = field(default_factory=dict, compare=False)


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _current(self, name: str) -> str | None:
        entries = list_folder(self.spark, self.path(name))
        runs = [e for e in entries if e.startswith("run=")]
        return next(self._good(name, runs), self.path(name) if entries and not runs else None)

    def _good(self, name: str, runs: Sequence[str]) -> Iterator[str]:
        """Folders of complete versions, newest first; one of a group needs the group's pointer too."""
        pointers = None
        for run in reversed(runs):
            folder, (_, _, group) = f"{self.path(name)}/{run}", run.partition(GROUP)
            if MARKER not in list_folder(self.spark, folder):
                continue
            if group and pointers is None:
                pointers = self._pointers()
            if not group or group in pointers:
                yield folder

    def _pointers(self) -> Collection[str]:
        return set(list_folder(self.spark, f"{self.root}/{GROUPS}"))

    def snapshot(self) -> Snapshot:
        """A view in which tables of one group are all of the same publication, whatever is published
        while they are read."""
        return Snapshot(self)

    def together(self) -> Together:
        """``with store.together() as group:`` publishes all that ``group.replace`` writes at one moment."""
        return Together(self)

    def expire(self, name: str, keep: int = 2, older_than: timedelta = timedelta(days=7)) -> int:
        """Delete versions of a replaced table that began more than ``older_than`` ago, the newest ``keep``
        complete ones excepted; versions of runs that never ended go too. Returns how many went."""
        if keep < 1:
            raise ValueError("the version in force is kept: keep is at least 1")
        runs = [e for e in list_folder(self.spark, self.path(name)) if e.startswith("run=")]
        stay = {folder.rsplit("/", 1)[1] for folder in islice(self._good(name, runs), keep)}
        limit = f"run={(datetime.now(timezone.utc) - older_than).strftime(VERSION)}"
        gone = [run for run in runs if run not in stay and run < limit]
        for run in gone:
            remove_folder(self.spark, f"{self.path(name)}/{run}")
        return len(gone)

    def exists(self, name: str) -> bool:
        return self._current(name) is not None

    def read(self, name: str, merge_schema: bool = False) -> DataFrame:
        folder = self._current(name)
        if folder is None:
            raise FileNotFoundError(self.path(name))
        reader = self.spark.read.option("mergeSchema", str(merge_schema).lower())
        found = keyed.parse(names := list_folder(self.spark, folder))
        if not found:
            return reader.parquet(folder)
        stale = set(found) - set(keyed.live(found))
        if not stale:
            return reader.parquet(folder).drop(keyed.BUCKET)
        hidden = {keyed.folder_of(b) for b in stale}
        return self._buckets(folder, [n for n in names if n.startswith(f"{keyed.BUCKET}=") and n not in hidden])

    def append(
        self, name: str, df: DataFrame, partition_by: Sequence[str] = (), evolve: bool = False,
        watch: Mapping[str, Column] | None = None,
    ) -> Written:
        """Add rows. Columns the table does not know yet need ``evolve`` and a merging read. ``watch``
        names aggregates of the rows to come back in ``seen``."""
        if not evolve and self.exists(name):
            extra = set(df.columns) - set(self.read(name).columns)
            if extra:
                raise ValueError(f"{name} has no column {sorted(extra)}; pass evolve=True")
        return self._write(df, self.path(name), "append", partition_by, watch)

    def replace_partitions(self, name: str, df: DataFrame, by: Sequence[str]) -> Written:
        """Replace the partitions that ``df`` has rows of; a repeat gives the same table."""
        return self._write(df, self.path(name), "overwrite", by, partitionOverwriteMode="dynamic")

    def replace(
        self, name: str, df: DataFrame, skip_if_empty: bool = False, partition_by: Sequence[str] = (),
        folders: Sequence[str] = (),
    ) -> Written:
        """Publish a new version; with ``skip_if_empty`` a result without rows keeps the old one.
        Partitions named in ``folders`` exist in it even without a row.

        Whether there are rows is known from the write itself: the version is written without its
        marker and only gets it if it is wanted.
        """
        folder = f"{self.path(name)}/run={self._version()}"
        done = self._write(df, folder, "errorifexists", partition_by, **{NO_MARKER: "false"})
        if skip_if_empty and not done.rows:
            return Written(self._current(name) or self.path(name), False, 0)
        if folders:
            self._fill(folder, folders, df)
        put_marker(self.spark, f"{folder}/{MARKER}")
        return done

    def _version(self) -> str:
        return f"{datetime.now(timezone.utc).strftime(VERSION)}-{uuid4().hex[:8]}"

    def merge_slots(
        self, name: str, df: DataFrame, keys: Sequence[str], slots: int = 1024,
        on_duplicate: str = "error", newest_by: Sequence[str] = (),
    ) -> Written:
        """Upsert into a table kept in ``slots`` hash slots of the key, rewriting only those touched.

        The changed slots are at most ``slots`` small numbers. Both sides are staged before the slots
        are replaced, so a repeat after a failure gives the same table.
        """
        slot = f"_slot_of_{slots}"
        number = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(slots))
        rows = distinct_keys(df, keys, on_duplicate, newest_by).withColumn(slot, number.cast("int"))
        if self.exists(name):
            table = self.read(name)
            if slot not in table.columns:
                raise ValueError(f"{name} is not kept in {slots} slots")
            rows = staged(rows)
            touched = [r[0] for r in rows.select(slot).distinct().collect()]
            rows = staged(upsert(table.where(F.col(slot).isin(touched)), rows, keys))
        return self._write(
            rows.hint("rebalance", slot), self.path(name), "overwrite", [slot],
            partitionOverwriteMode="dynamic",
        )

    def merge_keyed(
        self, name: str, df: DataFrame, keys: Sequence[str], capacity: int = keyed.CAPACITY,
        on_duplicate: str = "error", newest_by: Sequence[str] = (), full_refresh: bool = False,
        skip_if_empty: bool = False,
    ) -> Written:
        """Upsert into a table kept in hash partitions of the key (``keyed``), made by the first call.

        Reads and rewrites the buckets that changes fall into and no others; one that has more than
        ``capacity`` rows afterwards is split. ``full_refresh`` publishes a new version instead. ``rows``
        counts what was written. All is staged before a bucket is replaced, so a repeat after a failure
        gives the same table but for rows without a key, which come again whenever they are merged.
        """
        folder = None if full_refresh else self._current(name)
        fresh = staged(distinct_keys(df, keys, on_duplicate, newest_by))
        if folder is None:
            return self._first_keyed(name, fresh, keys, capacity, skip_if_empty)
        names = list_folder(self.spark, folder)
        buckets = keyed.live(keyed.parse(names))
        if not buckets:
            raise ValueError(f"{name} is not kept in partitions of its key; give full_refresh once")
        for stale in set(keyed.parse(names)) - set(buckets):  # of a merge that did not come to its end
            remove_folder(self.spark, f"{folder}/{keyed.folder_of(stale)}")
        known, loose = fresh.dropna(subset=list(keys)), without_key(fresh, keys)
        dealt = staged(keyed.with_bucket(known, keys, buckets))
        touched = {r[0] for r in dealt.select(keyed.BUCKET).distinct().collect()}
        stay = [b for b in buckets if keyed.name_of(b) in touched]
        old = self._buckets(folder, [keyed.folder_of(b) for b in stay] or [keyed.folder_of(b) for b in buckets])
        merged = upsert(old, dealt.drop(keyed.BUCKET), keys)
        if _kinds(merged) != _kinds(old):  # a new column or type: one schema for all files
            return self._first_keyed(name, staged(upsert(self.read(name), fresh, keys)), keys, capacity, skip_if_empty)
        written = 0
        if touched:
            merged = staged(keyed.with_bucket(merged, keys, stay))
            counts = {r[0]: r["count"] for r in merged.groupBy(keyed.BUCKET).count().collect()}
            after, gone = keyed.split(stay, counts, capacity)
            if gone:
                merged = staged(keyed.with_bucket(merged.drop(keyed.BUCKET), keys, after))
            written = self._write(
                merged.hint("rebalance", keyed.BUCKET), folder, "overwrite", [keyed.BUCKET], partitionOverwriteMode="dynamic",
            ).rows
            self._fill(folder, [keyed.folder_of(b) for b in after], merged)
            for bucket in gone:
                remove_folder(self.spark, f"{folder}/{keyed.folder_of(bucket)}")
        if not is_empty(loose):
            rows = loose.select(*old.columns, F.lit(keyed.NO_KEY).alias(keyed.BUCKET))
            written += self._write(rows, folder, "append", [keyed.BUCKET]).rows
        return Written(folder, written > 0, written)

    def _fill(self, folder: str, partitions: Sequence[str], rows: DataFrame) -> None:
        """Partitions without a row have a folder too, so that the list of folders is complete. Where none
        has any, the first one holds the schema."""
        present = {f for f in list_folder(self.spark, folder) if "=" in f}
        for partition in partitions:
            if present:
                if partition not in present:
                    put_marker(self.spark, f"{folder}/{partition}/_EMPTY")
            else:
                rows.limit(0).drop(keyed.BUCKET).write.parquet(f"{folder}/{partition}")
                present.add(partition)

    def _first_keyed(self, name: str, fresh: DataFrame, keys: Sequence[str], capacity: int, skip_if_empty: bool) -> Written:
        buckets = keyed.first_buckets(fresh.count(), capacity)
        known = keyed.with_bucket(fresh.dropna(subset=list(keys)), keys, buckets)
        loose = without_key(fresh, keys).withColumn(keyed.BUCKET, F.lit(keyed.NO_KEY))
        rows = known.unionByName(loose).hint("rebalance", keyed.BUCKET)
        return self.replace(name, rows, skip_if_empty, [keyed.BUCKET], folders=[keyed.folder_of(b) for b in buckets])

    def _buckets(self, folder: str, names: Sequence[str]) -> DataFrame:
        """The named partitions only. Some may hold no file; the schema is that of the first that does."""
        reader = self.spark.read.option("basePath", folder)
        full = next((n for n in names if any(f.endswith(".parquet") for f in list_folder(self.spark, f"{folder}/{n}"))), None)
        schema = reader.parquet(f"{folder}/{full}" if full else folder).schema
        return reader.schema(schema).parquet(*[f"{folder}/{n}" for n in names]).drop(keyed.BUCKET)

    def publish(
        self, name: str, df: DataFrame, mode: str = "overwrite", keys: Sequence[str] = (),
        full_refresh: bool = False, skip_if_empty: bool = False, on_duplicate: str = "error",
        newest_by: Sequence[str] = (), evolve: bool = False, capacity: int = keyed.CAPACITY,
    ) -> Written:
        """Full refresh, append, or ``auto``: merge on ``keys`` unless refreshing or first run."""
        if mode == "append":
            return self.append(name, df, evolve=evolve)
        if mode == "auto":
            return self.merge_keyed(name, df, keys, capacity, on_duplicate, newest_by, full_refresh, skip_if_empty)
        if mode != "overwrite":
            raise ValueError(f"unknown mode {mode!r}")
        return self.replace(name, df, skip_if_empty)

    def _write(
        self, df: DataFrame, folder: str, mode: str, by: Sequence[str],
        watch: Mapping[str, Column] | None = None, **options: str,
    ) -> Written:
        """One job: the row count rides along with the write, and so does what is watched."""
        seen = Observation()
        asked = [c.alias(name) for name, c in (watch or {}).items()]
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *asked)
        writer = counted.write.mode(mode).options(**options)
        (writer.partitionBy(*by) if by else writer).parquet(folder)
        return Written(folder, True, seen.get["rows"], seen.get)

    # -- processed batches -----------------------------------------------------------------------

    def ledger(self, table: str) -> DataFrame:
        """Batches of ``table`` that are normalised."""
        if not self.exists(LEDGER):
            return self.spark.createDataFrame([], f"{BATCH} string")
        return self.read(LEDGER).where(F.col("table") == table).select(BATCH)

    def mark_processed(
        self, table: str, batches: DataFrame, batch: str = BATCH, state: str | Column = "processed"
    ) -> Written:
        """Write down exactly the batches given; bronze itself is never rewritten.

        ``state`` is ``superseded`` for a batch that was passed over because a newer one is in silver.
        """
        how = F.lit(state) if isinstance(state, str) else state
        rows = batches.select(F.lit(table).alias("table"), F.col(batch).alias(BATCH), how.alias("state"))
        stamped = rows.distinct().withColumn("processed_at", F.current_timestamp())
        return self.append(LEDGER, stamped, evolve=True)


class Snapshot(Store):
    """Reads as of its making: groups that are published later are not seen."""

    def __init__(self, store: Store):
        super().__init__(store.spark, store.root)
        self._seen = store._pointers()
        self._upto = f"run={store._version()}"

    def _pointers(self) -> Collection[str]:
        return self._seen

    def _good(self, name: str, runs: Sequence[str]) -> Iterator[str]:
        return super()._good(name, [run for run in runs if run < self._upto])

    def _write(self, *args, **options) -> Written:
        raise TypeError("a snapshot is read only")


class Together(Store):
    """Versions of several tables that come into force at one moment, or not at all.

    Each is written with its success marker and the number of the group in its name. The pointer of the
    group is one small file, made last, when the block ends without an error; until then readers find
    the versions before, and afterwards all the new ones. Inside the block the group reads its own
    versions. What is changed in place (appends, merges) cannot be held back and is refused; a merge
    with ``full_refresh`` is a new version and goes along.
    """

    def __init__(self, store: Store):
        super().__init__(store.spark, store.root)
        self.number = uuid4().hex[:12]

    def __enter__(self) -> Together:
        return self

    def __exit__(self, kind, problem, trace) -> None:
        if kind is None:
            put_marker(self.spark, f"{self.root}/{GROUPS}/{self.number}")

    def _pointers(self) -> Collection[str]:
        return {*super()._pointers(), self.number}

    def _version(self) -> str:
        return f"{super()._version()}{GROUP}{self.number}"

    def _write(self, df: DataFrame, folder: str, mode: str, *args, **options) -> Written:
        if mode != "errorifexists":
            raise TypeError("tables that are changed in place cannot be published together")
        return super()._write(df, folder, mode, *args, **options)


def _kinds(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def one_per_key(
    df: DataFrame, keys: Sequence[str], on_duplicate: str = "error", newest_by: Sequence[str] = ()
) -> DataFrame:
    """At most one row per key: ``error`` fails on a duplicate, ``latest`` keeps the newest.

    A combinable aggregate, so a key with very many copies is reduced before the shuffle.
    """
    if on_duplicate == "latest":
        order = F.struct(*newest_by, *[c for c in df.columns if c not in (*keys, *newest_by)])
        pick = F.max_by(F.struct(*df.columns), order)
    elif on_duplicate == "error":
        why = F.concat(F.lit("duplicate upsert key: "), F.to_json(F.struct(*keys)))
        row = F.first(F.struct(*df.columns))
        pick = F.when(F.count(F.lit(1)) == 1, row).otherwise(F.raise_error(why))
    else:
        raise ValueError(f"unknown on_duplicate {on_duplicate!r}")
    return df.groupBy(*[F.col(k).alias(f"_g_{k}") for k in keys]).agg(pick.alias("_row")).select(
        "_row.*"
    )


def without_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a NULL key: they match nothing, so a merge adds each of them."""
    return df.where(" OR ".join(f"`{k}` IS NULL" for k in keys))


def distinct_keys(
    df: DataFrame, keys: Sequence[str], on_duplicate: str = "error", newest_by: Sequence[str] = ()
) -> DataFrame:
    """At most one row per key, and all rows without one."""
    known = one_per_key(df.dropna(subset=list(keys)), keys, on_duplicate, newest_by)
    return known.unionByName(without_key(df, keys))


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], on_duplicate: str = "error",
    newest_by: Sequence[str] = (),
) -> DataFrame:
    """Merge: rows of the target that match take all source values, new keys are added.

    Rows whose key is NULL match nothing and are added. Written as an update (left join) and an insert
    (anti join); both let adaptive execution split a hot target key. Columns known to one side only are kept and filled with NULL.
    """
    keys = list(keys)
    fresh = distinct_keys(source, keys, on_duplicate, newest_by)
    values = [c for c in source.columns if c not in keys]
    packed = fresh.select(*keys, F.struct(F.lit(1).alias("_"), *values).alias("_new"))
    matched = F.col("_new").isNotNull()
    columns: list[Column] = []
    for c in [*target.columns, *[v for v in values if v not in target.columns]]:
        if c in keys:
            columns.append(F.col(c))
            continue
        old = F.col(c) if c in target.columns else F.lit(None)
        new = F.col(f"_new.{c}") if c in values else old
        columns.append(F.when(matched, new).otherwise(old).alias(c))
    updated = target.join(packed, keys, "left").select(*columns)
    return union_aligned(updated, exclude(fresh, target, keys)).select(*updated.columns)


def mark_flag(df: DataFrame, cond: Column, flag: str = "_is_normalized") -> DataFrame:
    """The flag as it reads once the rows meeting ``cond`` are processed."""
    return df.withColumn(flag, F.when(cond, F.lit(True)).otherwise(F.col(flag)))


def conform(df: DataFrame, schema: str | T.StructType) -> DataFrame:
    """Select and cast to a declared schema, in its order; values that do not fit become NULL."""
    fields = T.StructType.fromDDL(schema).fields if isinstance(schema, str) else schema.fields
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields])
