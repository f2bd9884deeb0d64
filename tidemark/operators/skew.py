"""Joining a side that may hold hot keys to a side with one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 5_000_000


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows, at most rows / hot_rows of them, and the ``slots`` that
    leave each about ``hot_rows`` rows."""
    counted = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counted.where(F.col("_n") > hot_rows).select(*keys, F.ceil(F.col("_n") / hot_rows).alias("slots"))


def left_join_unique(
    left: DataFrame, right: DataFrame, key: str, hot_rows: int | None = None
) -> DataFrame:
    """Left join to a side with one row per key.

    Plain by default. With ``hot_rows`` the left rows of a hot key are spread over as many shuffle slots
    as its count asks for, by the input split they come from, and only the right rows of hot keys are
    repeated per slot; rows of NULL keys, which match nothing, are spread by split too. There are at
    most rows / hot_rows hot keys, which bounds the broadcast list.
    """
    if hot_rows is None:
        return left.join(right, key, "left")
    hot = F.broadcast(hot_keys(left.select(key), [key], hot_rows).withColumnRenamed("slots", "_slots"))
    slot = F.when(F.col(key).isNull(), F.col("_split")).otherwise(F.coalesce(F.pmod("_split", "_slots"), F.lit(0)))
    salted = (
        left.withColumn("_split", F.spark_partition_id().cast("long")).join(hot, key, "left")
        .withColumn("_slot", slot).drop("_slots", "_split")
    )
    slots = F.sequence(F.lit(0).cast("long"), F.coalesce("_slots", F.lit(1)) - 1)
    repeated = right.join(hot, key, "left").withColumn("_slot", F.explode(slots)).drop("_slots")
    return salted.join(repeated, [key, "_slot"], "left").drop("_slot")
