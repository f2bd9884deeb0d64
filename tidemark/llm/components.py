"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """Columns (node, root) for every node of ``edges`` (u, v: long); root is the smallest node
    reachable.

    Alternates two steps until nothing changes: every node hands its smallest neighbour to its larger
    ones, then to its smaller ones. Both are a combinable minimum and a join that adaptive execution
    can split, so a node with very many edges costs one partial row per task. Each round is written
    to the shared folder; the driver sees one row of counts.
    """
    def tidy(df: DataFrame) -> DataFrame:
        big, small = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
        return staged(df.where("u <> v").select(big, small).distinct())

    def state(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)).cast("decimal(38,0)"))).first())

    current = tidy(edges)
    now = state(current)
    while now[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = tidy(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        current, before = tidy(small.select("e.*")), now
        now = state(current)
        if now == before:
            break
    nodes = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
