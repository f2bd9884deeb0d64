"""Silver register of vessels, kept by upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars
from tidemark.functions.dates import day_text
from tidemark.functions.json import page_meta, struct_of
from tidemark.operators.lookup import country_lookup
from tidemark.operators.nested import explode_parsed, parse_object, stamp
from tidemark.operators.select import STAMP

STEP = 200

# Silver column, kind and, where there is one, the source member with its type.
FIELDS = """
st text vesselCommercialStatus string
name text vesselName string
teu text vesselTeu int
built text vesselBuiltYear int
dwt text vesselDwt int
flag flag vesselFlag string
at14_t text vesselTeu14 int
plugs text vesselReefPlugsNumber int
speed text vesselSpeedLaden float
cns text vesselConsumption float
c yes vesselCells string
g yes vesselGeared string
ice text vesselIceLevel string
managing_owner text vesselShipowner string
t none
open_position none
dual_fuel text DualFuel string
main_engine engine
open_start none
open_end none
design_class text vesselDesign string
route text vesselRoute string
pos_amend none
operator text vesselOperator string
ship_yard text vesselBuilder string
beam text vesselBeam float
loa text vesselLoa float
draft text vesselDraft float
owned_chartered none
imo text vesselImo int
scrubber yes Scrubbers string
gt text vesselGrt int
"""
ENGINE = [("engineDesign", "string"), ("engineModel", "string")]


def lines() -> list[list[str]]:
    return [line.split() for line in FIELDS.split("\n") if line]


def page_schema() -> str:
    members = [(parts[2], parts[3]) for parts in lines() if len(parts) == 4]
    vessel = struct_of([*members, ("vesselType", "string"), *ENGINE])
    return struct_of([("totalCount", "int"), ("results", f"array<{vessel}>")])


def _column(name: str, kind: str, member: str | None) -> Column:
    if kind == "yes":
        return scalars.yn_flag(f"v.{member}").alias(name)
    if kind == "none":
        return scalars.typed_null("string").alias(name)
    if kind == "engine":
        text = scalars.concat_strict("v.engineDesign", F.lit(" - "), "v.engineModel")
        return text.alias(name)
    return F.col("_flag" if kind == "flag" else f"v.{member}").alias(name)


def vessels(
    pages: DataFrame, country: DataFrame, step: int = STEP, load_ts: Column | None = None,
    mapped: str = "mapped_flag",
) -> DataFrame:
    """Vessels of the given pages. ``country`` holds ``flag`` and the name it maps to."""
    parsed = parse_object(pages, "Raw_data", page_schema())
    label = scalars.concat_skip(
        "-", page_meta("Api_metadata")["page_no"], scalars.page_count("_parsed.totalCount", step)
    )
    rows = explode_parsed(
        parsed, ["_parsed.results"],
        [day_text(STAMP).alias("file_date"), label.alias("APIPageNum")], into="v",
    )
    rows = country_lookup(rows, country, "v.vesselFlag", mapped=mapped, into="_flag")
    columns = [_column(parts[0], parts[1], parts[2] if len(parts) > 2 else None) for parts in lines()]
    out = rows.select(
        "file_date", *columns, F.lit("API").alias("FileName"), "v.vesselType", "APIPageNum"
    )
    return stamp(out, load_ts)
