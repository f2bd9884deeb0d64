"""Registered queries: each runs library operators over whole test tables, most with an SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import use_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

def as_of() -> Column:
    return F.lit("1998-06-01 00:00:00").cast("timestamp")


class Tables:
    """The test tables of one scale factor, read on demand."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name`` with its SQL twin."""

    def register(fn: Callable[[Tables], DataFrame]):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(Tables(use_utc(spark), sf_dir)))

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def plain(df: DataFrame) -> DataFrame:
    """Types both engines hand over alike: zoneless timestamps, doubles, text dates."""
    casts = {
        T.TimestampType: "timestamp_ntz", T.DecimalType: "double", T.FloatType: "double",
        T.DateType: "string", T.ShortType: "int",
    }
    return df.select(
        *[
            F.col(f"`{f.name}`").cast(casts[type(f.dataType)]).alias(f.name)
            if type(f.dataType) in casts else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


#: Rows of a table one task makes documents of, about.
TASK_ROWS = 1_000_000


def dealt(df: DataFrame) -> DataFrame:
    """Rows of a test table over all cores, so that building documents from them is too; over more tasks
    if these would have more than ``TASK_ROWS`` each, so that a task does not grow with the table."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS)))


#: Records of a large page, about.
PAGE_RECORDS = 10_000


def few_pages(landed: DataFrame, member: str | None = None, count: int = 3) -> DataFrame:
    """The records of many one-record pages on few large pages, joined as text: ``count`` pages, or more
    if these would hold more than ``PAGE_RECORDS`` each, so that a page does not grow with the table.
    Rows that know their page (``pages`` with ``by``) lie with it and their text is not moved."""
    head, tail = (f'{{"{member}":[', "]}") if member else ("[", "]")
    inner = F.substring("Raw_data", F.lit(len(head) + 1), F.length("Raw_data") - len(head) - len(tail))
    others = [F.first(c).alias(c) for c in landed.columns if c not in ("Raw_data", "_page")]
    page = F.concat(F.lit(head), F.concat_ws(",", F.collect_list(inner)), F.lit(tail))
    if "_page" not in landed.columns:
        landed = landed.withColumn("_page", F.pmod(F.xxhash64("Raw_data"), F.lit(page_count(landed, count))))
    return landed.groupBy("_page").agg(page.alias("Raw_data"), *others).drop("_page")


def page_count(df: DataFrame, count: int = 3) -> int:
    return max(count, -(-df.count() // PAGE_RECORDS))


def pages(df: DataFrame, doc: Column, *, batch: Column | None = None, ts: Column | None = None, by: tuple[str, ...] = ()):
    """Bronze pages from rows: one JSON document per row, built row by row. With ``by`` rows are first
    dealt to the large page (``_page``) they will be on, by a hash of these columns."""
    if by:
        count = page_count(df)
        rows = df.withColumn("_page", F.pmod(F.xxhash64(*by), F.lit(count)).cast("int")).repartitionById(count, "_page")
    else:
        rows = dealt(df)
    return rows.select(
        F.to_json(doc).alias("Raw_data"),
        (F.lit("batch-1") if batch is None else batch).alias("_Batch_run_id"),
        F.lit(False).alias("_is_normalized"),
        (F.lit("2024-01-31 00:00:00").cast("timestamp") if ts is None else ts).alias("_ingestion_ts"),
        *(["_page"] if by else []),
    )
