"""Parsing landed JSON under fixed schemas and unfolding nested arrays and maps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Records are dealt out anew if a task reads more than so many times a core's share of the pages.
UNEVEN = 2


def parse_object(df: DataFrame, col: str, schema: str, into: str = "_parsed") -> DataFrame:
    """Parse a JSON object; a malformed document gives NULL fields."""
    return df.withColumn(into, F.from_json(F.col(col), schema))


def parse_once(df: DataFrame, col: str, schema: str, into: str = "_parsed") -> DataFrame:
    """``parse_object`` for a frame that is not stored: a filter on members, such as the optimiser infers
    from an explode, stays above the parse instead of parsing every document a second time."""
    return df.select("*", F.explode(F.array(F.from_json(F.col(col), schema))).alias(into))


def parse_array(df: DataFrame, col: str, element: str, into: str = "_parsed") -> DataFrame:
    """Parse a JSON document whose root is an array; an object root gives one element."""
    return df.withColumn(into, F.from_json(F.col(col), f"array<{element}>"))


def parse_text_field(df: DataFrame, path: str, ddl: str, into: str) -> DataFrame:
    """Parse a field which the first parse kept as JSON text."""
    return df.withColumn(into, F.from_json(F.col(path), ddl))


def explode_path(
    df: DataFrame, path: Sequence[str], carry: Sequence[str | Column] = (),
    outer: bool = False, into: str = "item",
) -> DataFrame:
    """Unfold nested arrays level by level.

    ``path[0]`` is an array column and each later step an array inside the element before it.
    ``carry`` are the columns of the starting row to keep. With ``outer`` a parent without children
    stays, with a NULL item; otherwise it disappears.
    """
    unfold = F.explode_outer if outer else F.explode
    rows = df.select(*carry, unfold(path[0]).alias(into))
    kept = rows.columns[:-1]
    for step in path[1:]:
        rows = rows.select(*kept, unfold(F.col(into).getField(step)).alias(into))
    return rows


def explode_parsed(
    df: DataFrame, path: Sequence[str], carry: Sequence[str | Column] = (), into: str = "item"
) -> DataFrame:
    """``explode_path`` for a column that was just parsed from text.

    Over a bare column the optimiser infers ``size(..) > 0`` and pushes it below the parse, so every
    document would be parsed again for the filter and for the null check. Over an expression it does
    not. Stored columns take ``explode_path``, where the inferred filter is cheap and unused members
    of the elements are not read.
    """
    rows = df.select(*carry, F.explode(_as_expression(path[0])).alias(into))
    if len(path) == 1:
        return rows
    return explode_path(rows, [f"{into}.{path[1]}", *path[2:]], rows.columns[:-1], into=into)


def _as_expression(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.when(F.size(c) > 0, c)


def listed_records(text: Column, path: str | None = None) -> Column:
    """The records of a page as an array of JSON texts, NULL if it has no such list.

    ``path`` names the member that holds the array, with dots for members inside members; without it
    the root is the array, and an object root is one record.
    """
    if path is None:
        is_object = F.ltrim(text).startswith("{")
        return F.when(is_object, F.array(text)).otherwise(F.from_json(text, "array<string>"))
    kind = "array<string>"
    for member in reversed(path.split(".")):
        kind = f"struct<`{member}`:{kind}>"
    found = F.from_json(text, kind)
    for member in path.split("."):
        found = found[member]
    return found


def spread_records(records: DataFrame, pages: DataFrame) -> DataFrame:
    """Rows cut from ``pages``, dealt out over all tasks where the pages themselves are not.

    To deal records is to shuffle all their text, so a count of the pages each task reads decides, which
    needs no column. If no task has over ``UNEVEN`` times a core's share of the pages, records stay where
    they were cut. Pages of very different lengths are not told apart: no text in Spark is longer than
    2 GB, so of many pages a long one costs its task the parse of that at most.
    """
    spark = pages.sparkSession
    if not pages.isStreaming:
        tasks = pages.select(F.spark_partition_id().alias("task")).groupBy("task").agg(F.count("*").alias("n"))
        most, total = tasks.agg(F.max("n"), F.sum("n")).first()
        if not total or most * spark.sparkContext.defaultParallelism <= UNEVEN * total:
            return records
    return records.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


def page_records(
    pages: DataFrame, carry: Sequence[str | Column] = (), path: str | None = None,
    col: str = "Raw_data", into: str = "_text",
) -> DataFrame:
    """The records of each page as JSON text, one per row, spread over tasks (``spread_records``).

    ``path`` names the member that holds the array of records; without it the root is the array, and an
    object root is one record. A service may answer with one very large page: its text is only cut
    into records where it was read, and the wide parse that follows runs on rows that are spread
    evenly. Numbers, escapes and nested members keep their text.
    """
    listed = listed_records(F.col(col), path)
    # Over a condition no filter is inferred (``explode_parsed``), and this one does not read the list twice.
    records = pages.select(*carry, F.explode(F.when(F.col(col).isNotNull(), listed)).alias(into))
    return spread_records(records, pages)


def explode_map(
    df: DataFrame, col: str | Column, carry: Sequence[str | Column] = (),
    key: str = "key", value: str = "value",
) -> DataFrame:
    return df.select(*carry, F.explode(_as_expression(col)).alias(key, value))


def link_column(df: DataFrame, key: str, name: str) -> DataFrame:
    """Repeat the parent key under the name of the child table it links to."""
    return df.withColumn(name, F.col(key))


def flatten(df: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    return df.select(
        *[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in mapping.items()]
    )


def null_when(df: DataFrame, cond: Column, columns: Sequence[str]) -> DataFrame:
    """Set the columns to NULL where the condition holds, keeping their types."""
    return df.withColumns({c: F.when(cond, F.lit(None)).otherwise(F.col(c)) for c in columns})


def union_aligned(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


def stamp(df: DataFrame, load_ts: Column | None = None, name: str = "_ingestion_ts") -> DataFrame:
    """Add the load time: a given literal for repeatable output, else the query's start time."""
    return df.withColumn(name, F.current_timestamp() if load_ts is None else load_ts)
