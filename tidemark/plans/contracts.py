"""Silver tables of contracts: header slices, rates in force and child lists.

Each function takes records, one contract document per row (``c``) with its batch id, as made by
``contract_records``. Parse once, write with ``staged`` and hand that frame to all of them: it is
columnar, so every table reads only its own members.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars
from tidemark.functions.dates import century_fix
from tidemark.functions.json import strings
from tidemark.operators.lookup import composite_lookup, resolve_id
from tidemark.operators.nested import (
    explode_parsed, explode_path, link_column, null_when, page_records, parse_once,
    parse_text_field, stamp, union_aligned,
)
from tidemark.operators.rates import RESULT, active_rate, attach_rate, expected_redelivery
from tidemark.operators.rejects import checked_records
from tidemark.operators.select import BATCH, slice_by
from tidemark.plans import contract_fields as fields

# What the resolution of rates reads of a contract.
RESOLUTION = ("contractId", "period", "deliveryDate", "extensionDate")
# What the lookups of names, vessel numbers and rates read of it.
ASKED = ("contractId", "period", "contractType", "crmd_name", "extensionDate", "Vessel_IMO")
ALL_PARTS = ("header", *fields.CHILDREN)


def contract_records(pages: DataFrame, parts: tuple[str, ...] = ALL_PARTS) -> DataFrame:
    texts = page_records(pages, [BATCH], "contracts")
    return parse_once(texts, "_text", fields.document_schema(parts), "c").select(BATCH, "c")


def checked_contracts(pages: DataFrame, parts: tuple[str, ...] = ALL_PARTS, strict: bool = False) -> DataFrame:
    """``contract_records`` together with the pages and records that do not parse: see ``rejects``."""
    return checked_records(pages, fields.document_schema(parts), "contracts", into="c", strict=strict)


def contract_projection(records: DataFrame, load_ts: Column | None = None) -> DataFrame:
    """The header columns, the same for all three contract types."""
    columns = [fields.column(kind, path).alias(name) for name, kind, path in fields.lines()]
    return stamp(records.select(*columns, BATCH), load_ts)


def _slice(records: DataFrame, kind: str, load_ts: Column | None) -> DataFrame:
    return contract_projection(slice_by(records, "c.contractType", kind), load_ts)


def _id() -> Column:
    return scalars.to_long("c.contractId").alias("contractId")


# -- child lists ---------------------------------------------------------------------------------


def rates(records: DataFrame, load_ts: Column | None = None) -> DataFrame:
    rows = explode_path(records, ["c.rates"], [_id(), "c.rate_review_period", BATCH], into="r")
    linked = link_column(rows, "contractId", "lump_sums")
    out = linked.select(
        "contractId", scalars.to_double("r.rate").alias("rate"), "r.special", "r.currency",
        "r.rate_uuid", "r.valid_from", "lump_sums", "rate_review_period", BATCH,
    )
    return stamp(out, load_ts)


def lump_sums(records: DataFrame, load_ts: Column | None = None) -> DataFrame:
    rows = explode_path(records, ["c.rates", "lump_sums"], [_id(), BATCH], into="ls")
    out = rows.select(
        "contractId", "ls.type", "ls.ls_unit", scalars.to_double("ls.ls_amount").alias("ls_amount"),
        "ls.ls_currency", "ls.rate_number", "ls.lump_sum_uuid", BATCH,
    )
    return stamp(out, load_ts)


def at_cost(records: DataFrame, load_ts: Column | None = None) -> DataFrame:
    parsed = parse_text_field(
        records, "c.atCost", f"array<{strings(fields.AT_COST)}>", "_items"
    )
    rows = explode_parsed(parsed, ["_items"], [_id(), BATCH], into="a")
    out = rows.select(
        "contractId", "a.at_cost_type", "a.at_cost_unit",
        scalars.to_double(scalars.blank_to_null("a.at_cost_amount")).alias("at_cost_amount"),
        "a.at_cost_comment", BATCH,
    )
    return stamp(out, load_ts)


def _child(records: DataFrame, name: str, members: str, load_ts: Column | None) -> DataFrame:
    """A child list whose members all stay text, the contract id included."""
    rows = explode_path(records, [f"c.{name}"], ["c.contractId", BATCH], into="i")
    return stamp(rows.select("contractId", *[f"i.{m}" for m in members.split()], BATCH), load_ts)


def brokerage_commission(records: DataFrame, load_ts: Column | None = None) -> DataFrame:
    return _child(records, "brokerageCommission", fields.COMMISSION, load_ts)


def delivery_notices(records: DataFrame, load_ts: Column | None = None) -> DataFrame:
    return _child(records, "deliveryNotices", fields.NOTICE, load_ts)


def redelivery_notices(records: DataFrame, load_ts: Column | None = None) -> DataFrame:
    return _child(records, "redeliveryNotices", fields.NOTICE, load_ts)


def premiums(records: DataFrame, load_ts: Column | None = None) -> DataFrame:
    return _child(records, "premiums", fields.PREMIUM, load_ts)


# -- contracts -----------------------------------------------------------------------------------


def extensions(records: DataFrame, load_ts: Column | None = None) -> DataFrame:
    return _slice(records, "extension", load_ts)


def options(
    records: DataFrame, rate_rows: DataFrame, as_of: Column, load_ts: Column | None = None, **how
) -> DataFrame:
    own = _slice(records, "option", load_ts)
    active = active_rate(rate_rows, own.select(*RESOLUTION), as_of, **how)
    return attach_rate(own, active).select(*own.columns, *RESULT)


def charterparties(
    records: DataFrame, rate_rows: DataFrame, documents: DataFrame, vessels: DataFrame,
    as_of: Column, load_ts: Column | None = None, **how,
) -> DataFrame:
    """Charter parties and extensions with their vessel number and rate in force.

    ``documents`` (fixture_ID, extension_date, crmd_name) names the fixture of an extension;
    ``vessels`` (Hull_no, imo) turns hull numbers into vessel numbers. Both types go through in one
    pass: what holds for extensions only is decided per row, so that the pages are read once.
    """
    is_extension = F.col("contractType") == "extension"
    both = contract_projection(
        slice_by(records, "c.contractType", "charterparty", "extension"), load_ts
    ).withColumnRenamed("shipImoNr", "Vessel_IMO")
    # Every lookup works on the few columns it needs, one row per combination; the hundred others move
    # once, when the answers are joined to them.
    asked = both.select(*ASKED).distinct()
    own, extended = asked.where(~F.coalesce(is_extension, F.lit(False))), asked.where(is_extension)
    fixtures = composite_lookup(
        extended.withColumn("_name", F.col("crmd_name")), documents,
        [
            (F.col("_name"), F.col("fixture_ID")),
            (F.col("extensionDate").try_cast("date"), century_fix("extension_date")),
        ],
        {"_fixture_name": "crmd_name"},
    ).drop("_name")
    named = own.withColumn("_fixture_name", F.col("crmd_name")).unionByName(fixtures)
    numbered = resolve_id(
        named.withColumn("_number", F.col("Vessel_IMO").cast("string")), vessels, "_number", "Hull_no", "imo"
    )
    active = active_rate(rate_rows, both.select(*RESOLUTION), as_of, **how)
    answers = attach_rate(numbered, active).select(
        *[F.col(c).alias(f"_a_{c}") for c in ASKED], "_fixture_name", "_number", *RESULT
    )
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_a_{c}")) for c in ASKED])
    told = both.join(answers, same).select(
        *[
            F.col("_fixture_name").alias(c) if c == "crmd_name" else F.col("_number").alias(c) if c == "Vessel_IMO" else F.col(c)
            for c in both.columns
        ], *RESULT,
    )
    return with_redelivery(null_when(told, is_extension, fields.EXTERNAL))


def with_redelivery(contracts: DataFrame) -> DataFrame:
    date = expected_redelivery(F.col("toDateIsPlanned"), F.col("redeliveryDate"))
    return contracts.withColumn("expectedRedeliveryDate", date)


def contracts_all(combined: DataFrame, option_rows: DataFrame, vessels: DataFrame) -> DataFrame:
    """Charter parties and extensions, and the options that were declared."""
    declared = with_redelivery(slice_by(option_rows, "declarationType", "declared"))
    declared = resolve_id(declared, vessels, "shipImoNr", "Hull_no", "imo", "string")
    combined = combined.withColumnRenamed("Vessel_IMO", "shipImoNr").withColumn(
        "shipImoNr", F.col("shipImoNr").cast("string")
    )
    both = union_aligned(combined, declared)
    return null_when(both, F.col("contractType") == "extension", fields.EXTERNAL)
