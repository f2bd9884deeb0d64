"""Tables by name: saved to the session's catalog, appended to, replaced by partition or as a whole.

A replaced table is a view over its newest version, a table of its own. The view is switched when the
version is complete, so a write that fails leaves the last good one, and a version can be computed from
the one before. Tables kept by partition or appended to are plain tables.

Two tables bucketed alike on their join keys are joined without a shuffle, as often as they are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.sinks import VERSION, Written

SUFFIX = "__v"
OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


@dataclass(frozen=True)
class Layout:
    """How a table is laid out: partition columns, and bucket columns with the number of buckets."""

    partition_by: Sequence[str] = ()
    bucket_by: Sequence[str] = ()
    buckets: int = 0

    def __post_init__(self):
        if bool(self.bucket_by) != (self.buckets > 0):
            raise ValueError("bucket columns and their number go together")

    def on(self, df: DataFrame) -> DataFrame:
        """Rows of a bucket come together before the write, so that it has one file, or one of each
        partition, and not one for every task."""
        if not self.bucket_by:
            return df
        return df.repartition(self.buckets, *self.bucket_by)

    def of(self, writer: DataFrameWriter) -> DataFrameWriter:
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        if self.bucket_by:
            writer = writer.bucketBy(self.buckets, *self.bucket_by).sortBy(*self.bucket_by)
        return writer


class Catalog:
    """A database of the session's catalog."""

    def __init__(self, spark: SparkSession, database: str = "default"):
        self.spark, self.database = spark, database
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.database}.{table}")

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def versions(self, table: str) -> list[str]:
        """Versions of a replaced table, oldest first, also those a failed write left."""
        found = self.spark.sql(f"SHOW TABLES IN `{self.database}` LIKE '{table.lower()}{SUFFIX}*'")
        return sorted(r["tableName"] for r in found.collect())

    def replace(self, table: str, df: DataFrame, layout: Layout = Layout(), skip_if_empty: bool = False) -> Written:
        """Publish a new version; with ``skip_if_empty`` a result without rows keeps the old one."""
        if self.exists(table) and self.spark.catalog.getTable(f"{self.database}.{table}").tableType != "VIEW":
            raise ValueError(f"{table} is a plain table, kept in place")
        version = f"{table}{SUFFIX}{datetime.now(timezone.utc).strftime(VERSION)}_{uuid4().hex[:8]}".lower()
        done = self._save(version, df, layout, "errorifexists")
        if skip_if_empty and not done.rows:
            self.spark.sql(f"DROP TABLE {self.name(version)}")
            return Written(self.name(table), False, 0)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(table)} AS SELECT * FROM {self.name(version)}")
        return Written(self.name(table), True, done.rows)

    def expire(self, table: str, keep: int = 2) -> int:
        """Drop all versions but the newest ``keep`` and the one in force. Returns how many went."""
        if keep < 1:
            raise ValueError("the version in force is kept: keep is at least 1")
        text = self.spark.sql(f"SHOW CREATE TABLE {self.name(table)}").first()[0]
        gone = [v for v in self.versions(table)[:-keep] if v not in text]
        for version in gone:
            self.spark.sql(f"DROP TABLE {self.name(version)}")
        return len(gone)

    def append(self, table: str, df: DataFrame, layout: Layout = Layout(), evolve: bool = False) -> Written:
        """Add rows, columns matched by name; those the table has alone are NULL. Columns it does not know
        need ``evolve``. The first call makes the table with ``layout``."""
        if not self.exists(table):
            return self._save(table, df, layout, "errorifexists")
        return self._insert(table, self._fitted(table, df, evolve), "append")

    def replace_partitions(self, table: str, df: DataFrame, layout: Layout, evolve: bool = False) -> Written:
        """Replace the partitions that ``df`` has rows of, and no others; a repeat gives the same table."""
        if not layout.partition_by:
            raise ValueError("replace_partitions needs partition columns")
        if not self.exists(table):
            return self._save(table, df, layout, "errorifexists")
        return self._insert(table, self._fitted(table, layout.on(df), evolve), "overwrite")

    def _fitted(self, table: str, df: DataFrame, evolve: bool) -> DataFrame:
        """Rows with the columns of the table, in its order: an insert goes by position."""
        known = {f.name: f.dataType for f in self.read(table).schema}
        extra = [f for f in df.schema if f.name not in known]
        if extra and not evolve:
            raise ValueError(f"{table} has no column {sorted(f.name for f in extra)}; pass evolve=True")
        if extra:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in extra)
            self.spark.sql(f"ALTER TABLE {self.name(table)} ADD COLUMNS ({columns})")
            known = {f.name: f.dataType for f in self.read(table).schema}
        return df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in known.items()])

    def _save(self, table: str, df: DataFrame, layout: Layout, mode: str) -> Written:
        seen = Observation()
        counted = layout.on(df).observe(seen, F.count(F.lit(1)).alias("rows"))
        layout.of(counted.write.mode(mode).format("parquet")).saveAsTable(self.name(table))
        return Written(self.name(table), True, seen.get["rows"])

    def _insert(self, table: str, df: DataFrame, mode: str) -> Written:
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        # An insert by name knows this setting from the session only; a write option has no effect.
        before = self.spark.conf.get(OVERWRITE)
        self.spark.conf.set(OVERWRITE, "dynamic")
        try:
            counted.write.mode(mode).insertInto(self.name(table))
        finally:
            self.spark.conf.set(OVERWRITE, before)
        return Written(self.name(table), True, seen.get["rows"])
