"""Choosing which landed pages to normalise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FLAG, BATCH, STAMP = "_is_normalized", "_Batch_run_id", "_ingestion_ts"


def pending(df: DataFrame, flag: str = FLAG) -> DataFrame:
    return df.where(~F.col(flag))


def all_pending(df: DataFrame, ledger: DataFrame | None = None, batch: str = BATCH) -> DataFrame:
    """Every pending row, less the batches already written down in the processed ledger."""
    rows = pending(df)
    return rows if ledger is None else exclude(rows, ledger, [batch])


def latest_row(
    df: DataFrame, ts: str = STAMP, n: int = 1, tie_break: list[str] | None = None
) -> DataFrame:
    """The newest ``n`` rows; plans as a per-task top-n followed by a merge of the winners."""
    order = [F.col(ts).desc(), *[F.col(c).desc() for c in tie_break or []]]
    return df.orderBy(*order).limit(n)


def latest_batch(df: DataFrame, batch: str = BATCH, ts: str = STAMP) -> DataFrame:
    """All rows of the batch that holds the newest row.

    The batch id comes from a one-row aggregate used as a scalar subquery, so nothing is collected
    and a table partitioned by batch is pruned to that one partition. Of two batches with equal
    newest stamps the greater id wins.
    """
    newest = df.agg(F.max(F.struct(F.col(ts), F.col(batch))).alias("top"))
    return df.where(F.col(batch) == newest.select(F.col(f"top.{batch}")).scalar())


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()


def slice_by(df: DataFrame, column: str, *values: str) -> DataFrame:
    return df.where(F.col(column).isin(*values))


def in_force(df: DataFrame, period: Column, start: Column, as_of: Column) -> DataFrame:
    """Keep all past and upcoming rows, and ongoing rows that have started by ``as_of``."""
    return df.where(period.isin("past", "upcoming") | ((period == "ongoing") & (start <= as_of)))


def sort_latest(df: DataFrame, *columns: str, nulls: str = "last") -> DataFrame:
    last = nulls == "last"
    return df.orderBy(
        *[F.desc_nulls_last(c) if last else F.desc_nulls_first(c) for c in columns]
    )


def exclude(df: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are not in ``done`` (rows with NULL keys stay)."""
    return df.join(done.select(*keys).distinct(), keys, "left_anti").select(*df.columns)


def only(df: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(wanted.select(*keys).distinct(), keys, "left_semi").select(*df.columns)


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    return (df.select(*columns) if columns else df).distinct()


def max_where(df: DataFrame, column: str, cond: Column) -> DataFrame:
    return df.where(cond).agg(F.max(column).alias(column))
