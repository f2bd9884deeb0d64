"""Normalising bronze as a file stream: the checkpoint takes the place of the processed ledger."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.layers import BRONZE


def normalise_new_pages(
    spark: SparkSession, bronze_path: str, normalise: Callable[[DataFrame, int], None],
    checkpoint: str, schema: str = BRONZE, files_per_batch: int = 1_000,
) -> StreamingQuery:
    """Run ``normalise(pages, epoch)`` over the pages that came in since the last run, then stop.

    A batch that was cut short is given again with the same epoch, so ``normalise`` has to write by
    key (upsert) or by epoch.
    """
    pages = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
        .parquet(bronze_path).where("NOT _is_normalized")
    )
    return (
        pages.writeStream.foreachBatch(normalise).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
