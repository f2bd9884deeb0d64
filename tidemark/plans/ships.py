"""Silver tables of ships and their property lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import iso_ts
from tidemark.functions.json import strings, struct_of
from tidemark.operators.nested import explode_parsed, page_records, parse_object, stamp
from tidemark.operators.pivot import map_properties, noted_fields, pivot_with_meta
from tidemark.operators.select import BATCH
from tidemark.operators.staging import staged

# Members of a ship and of a property list.
SHIP = [
    ("name", "string"), ("imoNr", "bigint"), ("provisionalId", "string"),
    ("profileCompleteness", "int"), ("lastUpdated", "string"), ("isReporting", "boolean"),
    ("own", "boolean"), ("charter", "boolean"), ("shipType", "string"),
]
PROPERTY = "id title value isVerified lastUpdated"

PROPERTY_LIST = struct_of(
    [
        ("uuid", "string"), ("lastUpdated", "string"), ("shipImoNr", "string"),
        ("properties", f"array<{strings(PROPERTY)}>"),
    ]
)


def ships(pages: DataFrame, load_ts: Column | None = None) -> DataFrame:
    rows = parse_object(page_records(pages, [BATCH], "ships"), "_text", struct_of(SHIP), "s")
    columns = [
        iso_ts(f"s.{name}").alias(name) if name == "lastUpdated" else F.col(f"s.{name}")
        for name, _ in SHIP
    ]
    return stamp(rows.select(*columns, BATCH), load_ts)


def ship_properties_long(pages: DataFrame) -> DataFrame:
    """One row per ship and property."""
    parsed = parse_object(pages, "Raw_data", PROPERTY_LIST, "_record")
    rows = explode_parsed(
        parsed, ["_record.properties"],
        ["_record.uuid", iso_ts("_record.lastUpdated").alias("lastUpdated"), "_record.shipImoNr", BATCH],
        into="p",
    )
    return rows.select(
        "uuid", "lastUpdated", "shipImoNr", F.col("p.id").alias("property_id"), "p.title",
        "p.value", "p.isVerified", F.col("p.lastUpdated").alias("prop_lastUpdated"), BATCH,
    )


def ship_properties(
    pages: DataFrame, mapping: DataFrame, fields: Sequence[str] | None = None,
    load_ts: Column | None = None,
) -> DataFrame:
    """One row per ship, one column per mapped field.

    ``mapping`` (property_id, crm_field) names the columns: all that ``fields`` or the map's own schema
    (``pivot.with_fields``) lists. Where neither does, those that occur become columns; the list has to
    be looked up first, so the parsed properties are staged rather than parsed twice.
    """
    base = map_properties(ship_properties_long(pages), mapping)
    if fields is None and noted_fields(mapping) is None:
        base = staged(base)
    return stamp(pivot_with_meta(base, "shipImoNr", "crm_field", "value", fields), load_ts)
