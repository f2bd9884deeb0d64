"""Cutting lineage with a written table."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame

from tidemark.session import shared_folder
from tidemark.sources.tables import remove_folder


def staged(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write a frame once, below the shared folder, and read it back without lineage.

    Everything that follows reads columns instead of parsing again, and a lost executor repeats a
    read rather than the whole way. Rows are written where they are, without a shuffle; a partition
    with very many rows becomes several files if ``spark.sql.files.maxRecordsPerFile`` says so.
    The folder belongs to the run and may be deleted after it.
    """
    path = path or f"{shared_folder(df.sparkSession)}/tidemark-staged/{uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete the folder a staged frame reads, once everything made from it is written elsewhere."""
    spark = df.sparkSession
    for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/tidemark-staged/" in file:
            remove_folder(spark, file)
