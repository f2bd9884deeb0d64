"""Property lists turned into columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import iso_ts

#: Under this name the schema of a property map lists its field names.
FIELDS = "fields"


def clean_name(name: str) -> str:
    return re.sub(r"[^a-zA-Z0-9_]", "_", name).strip("_")


def clean_names(df: DataFrame) -> DataFrame:
    """Rename every column to letters, digits and underscores; two names must not meet."""
    return df.toDF(*_checked([clean_name(c) for c in df.columns], df.columns))


def _checked(cleaned: list[str], raw: Sequence[str]) -> list[str]:
    seen: dict[str, str] = {}
    for new, old in zip(cleaned, raw):
        if new.lower() in seen:
            raise ValueError(f"columns {seen[new.lower()]!r} and {old!r} both become {new!r}")
        seen[new.lower()] = old
    return cleaned


def map_properties(
    props: DataFrame, mapping: DataFrame, key: str = "property_id", field: str = "crm_field"
) -> DataFrame:
    """Attach the field name; properties without one drop, and so do properties without a title."""
    titled = props.where(F.col("title").isNotNull())
    return titled.join(mapping.select(key, field), key)


def field_names(df: DataFrame, field: str = "crm_field") -> list[str]:
    """The distinct field names, sorted: they become columns, so there are as many as the property map
    names and all of them are kept. This runs a job."""
    found = df.select(field).distinct().where(F.col(field).isNotNull()).collect()
    return sorted(row[0] for row in found)


def with_fields(
    mapping: DataFrame, fields: Sequence[str] | None = None, field: str = "crm_field"
) -> DataFrame:
    """The property map with its field names noted in the schema, beside the column that holds them.

    Parquet keeps the note, so it is made once, when the map is written, and a pivot over the map read
    back knows its columns without looking at a row. Names are read from the map unless given.
    """
    names = field_names(mapping, field) if fields is None else list(fields)
    noted = F.col(field).alias(field, metadata={FIELDS: names})
    return mapping.select(*[noted if c == field else F.col(f"`{c}`") for c in mapping.columns])


def noted_fields(df: DataFrame, field: str = "crm_field") -> list[str] | None:
    """The field names the schema lists; None if it lists none."""
    return df.schema[field].metadata.get(FIELDS)


def _fields(df: DataFrame, field: str, fields: Sequence[str] | None) -> list[str]:
    if fields is None:
        fields = noted_fields(df, field)
    return field_names(df, field) if fields is None else list(fields)


def _clean_fields(fields: Sequence[str]) -> list[str]:
    return _checked([clean_name(f) for f in fields], fields)


def pivot_max(
    df: DataFrame, key: str, field: str, value: str, fields: Sequence[str] | None = None
) -> DataFrame:
    """One row per key, one column per field, holding the greatest value."""
    fields = _fields(df, field, fields)
    return shape(pivot_map(df, key, field, value), key, fields)


def pivot_map(
    df: DataFrame, key: str, field: str, value: str, meta: dict[str, Column] | None = None
) -> DataFrame:
    """One row per key with the map ``_values`` from field to greatest value, and maxima of ``meta``.

    No list of fields is needed. Properties are first folded to one row per key and field, combined
    before the shuffle, so a key with a third of all properties is small by the time its row is put
    together. A property without a field keeps its key and adds no entry, nor does one without a value.
    """
    meta = meta or {}
    cells = df.groupBy(key, field).agg(
        F.max(value).alias("_value"), *[c.alias(n) for n, c in meta.items()]
    )
    some = F.col(field).isNotNull() & F.col("_value").isNotNull()
    entry = F.when(some, F.struct(F.col(field).alias("field"), F.col("_value").alias("value")))
    return cells.groupBy(key).agg(
        F.map_from_entries(F.collect_list(entry)).alias("_values"),
        *[F.max(n).alias(n) for n in meta],
    )


def shape(df: DataFrame, key: str, fields: Sequence[str], *others: Column | str) -> DataFrame:
    """The key, one column per field out of ``_values``, then ``others``.

    Text values pass through JSON, which finds all members of a row in one pass, as a map looks each
    of thousands of fields up from its start.
    """
    kind = df.schema["_values"].dataType.valueType
    if isinstance(kind, T.StringType):
        schema = T.StructType([T.StructField(f, kind) for f in fields])
        values = F.from_json(F.to_json("_values"), schema, {"columnNameOfCorruptRecord": "\0"})
        wide = df.withColumn("_values", values).select(key, "_values.*", *others)
    else:
        wide = df.select(key, *[F.col("_values").getItem(f).alias(f) for f in fields], *others)
    return wide.toDF(key, *_clean_fields(fields), *wide.columns[1 + len(fields):])


def _meta_columns() -> dict[str, Column]:
    """Per-key metadata; each is a maximum, so it can be folded in any number of steps."""
    updated = F.struct(iso_ts("prop_lastUpdated"), F.col("prop_lastUpdated").alias("text"))
    return {
        "uuid": F.max("uuid"),
        "lastUpdated": F.max("lastUpdated"),
        "last_property_updated_at": F.max(updated),
        "any_verified": F.max(F.col("isVerified").try_cast("boolean").cast("int")),
        "_Batch_run_id": F.max("_Batch_run_id"),
    }


def _final_meta(name: str) -> Column:
    return F.col(f"{name}.text").alias(name) if name == "last_property_updated_at" else F.col(name)


def group_meta(df: DataFrame, key: str) -> DataFrame:
    meta = _meta_columns()
    grouped = df.groupBy(key).agg(*[c.alias(n) for n, c in meta.items()])
    return grouped.select(key, *[_final_meta(n) for n in meta])


def attach_meta(pivoted: DataFrame, meta: DataFrame, key: str) -> DataFrame:
    return pivoted.join(meta, key, "left")


def pivot_with_meta(
    df: DataFrame, key: str, field: str, value: str, fields: Sequence[str] | None = None
) -> DataFrame:
    """The pivot and its per-key metadata from one pass over the properties."""
    fields = _fields(df, field, fields)
    meta = _meta_columns()
    folded = pivot_map(df, key, field, value, meta)
    return shape(folded, key, fields, *[_final_meta(n) for n in meta])
