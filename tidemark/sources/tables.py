"""Reading and locating tables, by catalog name or as parquet folders below a root."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, ref: str) -> DataFrame:
    return spark.read.parquet(ref) if "/" in ref else spark.table(ref)


def table_exists(spark: SparkSession, ref: str) -> bool:
    return bool(list_folder(spark, ref)) if "/" in ref else spark.catalog.tableExists(ref)


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of whatever file system the path belongs to; empty if there is none."""
    folder, fs = _folder(spark, path)
    if not fs.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(folder))


def partition_folder(root: str, column: str, value: str) -> str:
    """Path of a partition as Spark writes it: characters that a path cannot hold are escaped."""
    spark = SparkSession.getActiveSession()
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    return f"{root}/{escape(column, value)}"


def put_marker(spark: SparkSession, path: str) -> None:
    """Create an empty file."""
    file, fs = _folder(spark, path)
    fs.create(file).close()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds; nothing happens if there is none."""
    folder, fs = _folder(spark, path)
    fs.delete(folder, True)


def rows_to_df(spark: SparkSession, rows: Sequence, schema: str | T.StructType) -> DataFrame:
    """A small driver-side list as a frame: request seeds and test rows, never fetched pages."""
    return spark.createDataFrame(list(rows), schema=schema)
