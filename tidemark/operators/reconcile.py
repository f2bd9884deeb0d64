"""Counts of a batch on its way: announced by the service, landed, parsed, rejected, published.

Each count comes from the write it belongs to, as an aggregate that rides along with it, and is added to
a small table, one row per (table, batch, stage). ``reconcile`` puts the stages of a batch side by side
and says where records were lost. Counts of a stage that ran again for a batch replace the earlier ones,
so what a repeated run writes down twice counts once. Sources that share a table are counted apart and
added up.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.nested import listed_records
from tidemark.operators.rejects import page_reason
from tidemark.operators.select import BATCH, FLAG
from tidemark.operators.sinks import Store

COUNTS = "_counts"
ANNOUNCED, PAGES, LANDED, PARSED, REJECTED, PUBLISHED = STAGES = (
    "announced", "pages", "landed", "parsed", "rejected", "published",
)
ON_LANDING = STAGES[:3]


def page_metrics(
    records_path: str | None = None, total_path: str = "$.totalCount", body: str = "Raw_data",
    meta: str = "Api_metadata",
) -> dict[str, Column]:
    """Aggregates of bronze rows, to watch while they are written. The service announces its total on
    every page, and page 1 counts; pages kept as failures hold no records. A batch in which no page 1
    announces anything has NULL, which is compared with nothing."""
    good = ~F.col(FLAG)
    text = F.col(body) if records_path is None else F.get_json_object(body, records_path)
    first = F.get_json_object(meta, "$.page_no").try_cast("int") == 1
    total = F.get_json_object(body, total_path).try_cast("bigint")
    return {
        ANNOUNCED: F.sum(F.when(good & first & (total >= 0), total)),
        PAGES: F.count_if(good),
        LANDED: F.sum(F.when(good, F.coalesce(F.json_array_length(text), F.lit(0))).cast("bigint")),
    }


def record(store: Store, table: str, batch: str, counts: Mapping[str, int | None], part: str = "") -> None:
    """Add the counts of one batch, or of one part of it, such as a source that shares the table."""
    rows = store.spark.createDataFrame([(batch, s, n) for s, n in counts.items()], f"{BATCH} string, stage string, counted bigint")
    record_all(store, table, rows.withColumn("part", F.lit(part)))


def record_all(store: Store, table: str, counts: DataFrame) -> None:
    """Add counts of many batches: (batch, stage, part, counted)."""
    rows = counts.select(
        F.lit(table).alias("table"), F.col(BATCH).cast("string").alias(BATCH), "stage", "part",
        F.col("counted").cast("bigint").alias("counted"), F.current_timestamp().alias("counted_at"),
    )
    store.append(COUNTS, rows.coalesce(1), partition_by=["table"])


def normalised(checked: DataFrame, published: Mapping[str, DataFrame | None]) -> DataFrame:
    """Counts of checked records (see ``rejects``) and of the tables that hold one row for each of them;
    None stands for a table that was not written because there was nothing for it."""
    bad = F.col("_reason").isNotNull()
    told = checked.groupBy(BATCH).agg(F.count_if(~bad).alias(PARSED), F.count_if(bad).alias(REJECTED))
    rows = told.unpivot([BATCH], [PARSED, REJECTED], "stage", "counted").withColumn("part", F.lit(""))
    for name, table in published.items():
        found = F.lit(0).cast("bigint")
        batch = told.select(BATCH)
        if table is not None:
            held = table.groupBy(F.col(BATCH).cast("string").alias(BATCH)).agg(F.count(F.lit(1)).alias("n"))
            batch, found = batch.join(held, BATCH, "left"), F.coalesce("n", found)
        one = batch.select(BATCH, F.lit(PUBLISHED).alias("stage"), found.alias("counted"), F.lit(name).alias("part"))
        rows = rows.unionByName(one)
    return rows


def listed(pages: DataFrame, path: str | None = None, body: str = "Raw_data") -> DataFrame:
    """Counts of pages of which every record is taken, by page: those with a list, and those without one."""
    records = F.size(listed_records(F.col(body), path))
    told = pages.groupBy(BATCH).agg(
        F.sum(F.when(records > 0, records).otherwise(0)).cast("bigint").alias(PARSED),
        F.count_if(page_reason(F.col(body), path).isNotNull()).alias(REJECTED),
    )
    return told.unpivot([BATCH], [PARSED, REJECTED], "stage", "counted").withColumn("part", F.lit(""))


def reconcile(store: Store, table: str) -> DataFrame:
    """One row per batch of a bronze table: its counts by stage, and a verdict.

    ``pages lost``: fewer records landed than were announced. ``records lost``: parsed and rejected ones
    do not make up those landed (a rejected page counts as one). ``not published``: fewer rows in silver
    than parsed. ``rejects``: all is accounted for, but not all of it is in silver. ``open``: not
    normalised so far. Otherwise ``whole``. A missing count is compared with nothing.
    """
    rows = store.read(COUNTS).where(F.col("table") == table)
    newest = rows.groupBy(F.col(BATCH).cast("string").alias(BATCH), "stage", "part").agg(F.max_by("counted", "counted_at").alias("counted"))
    wide = newest.groupBy(BATCH).agg(*[F.sum(F.when(F.col("stage") == s, F.col("counted"))).alias(s) for s in STAGES])
    return wide.withColumn("verdict", verdict())


def verdict() -> Column:
    c = {s: F.col(s) for s in STAGES}
    rejected = F.coalesce(c[REJECTED], F.lit(0))
    return (
        F.when(c[LANDED] < c[ANNOUNCED], "pages lost")
        .when(c[PARSED].isNull(), "open")
        .when(c[PARSED] + rejected < c[LANDED], "records lost")
        .when(c[PUBLISHED] < c[PARSED], "not published")
        .when(rejected > 0, "rejects")
        .otherwise("whole")
    )
