"""Pages and records that do not parse: found while parsing, kept in a table of their own with the reason.

Every record of a page is either parsed or rejected, so counts add up: pages read = pages with a list of
records + rejected pages, and records listed = records parsed + rejected records.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.nested import explode_parsed, listed_records, spread_records
from tidemark.operators.select import BATCH

#: Why a page is rejected ...
EMPTY, NOT_JSON, NO_LIST = "empty page", "not JSON", "no list of records"
#: ... and why a record is.
NULL_RECORD, NOT_OBJECT, MISFIT = "null record", "record is not an object", "value does not fit its type"
CORRUPT = "_corrupt"


def _label(pages: DataFrame, name: str) -> Column:
    """The call's summary, NULL for pages that were landed without one."""
    return (F.col(name) if name in pages.columns else F.lit(None).cast("string")).alias("_page")


def _why_no_list(text: Column) -> Column:
    blank = F.trim(F.coalesce(text, F.lit(""))) == ""
    return F.when(blank, EMPTY).when(F.try_parse_json(text).isNull(), NOT_JSON).otherwise(NO_LIST)


def page_reason(text: Column, path: str | None = None) -> Column:
    """Why the page gives no list of records, NULL for a page that does; an empty list is one.

    Without ``path`` the root is the list, or one record if it is an object.
    """
    why = F.when(listed_records(text, path).isNull(), _why_no_list(text))
    if path is not None:
        return why
    return F.when(F.ltrim(text).startswith("{") & F.try_parse_json(text).isNull(), NOT_JSON).otherwise(why)


def rejected_pages(
    pages: DataFrame, path: str | None = None, carry: Sequence[str | Column] = (BATCH,),
    col: str = "Raw_data", label: str = "Api_metadata",
) -> DataFrame:
    """The pages without a list of records: ``carry``, ``reason``, ``page`` (the call's summary), ``text``."""
    found = pages.select(*carry, page_reason(F.col(col), path).alias("reason"), _label(pages, label).alias("page"), F.col(col).alias("text"))
    return found.where(F.col("reason").isNotNull())


def sound_pages(pages: DataFrame, path: str | None = None, col: str = "Raw_data") -> DataFrame:
    return pages.where(page_reason(F.col(col), path).isNull())


def checked_records(
    pages: DataFrame, schema: str, path: str | None = None, carry: Sequence[str | Column] = (BATCH,),
    into: str = "c", strict: bool = False, col: str = "Raw_data", label: str = "Api_metadata",
) -> DataFrame:
    """Every record of the pages, parsed, and every page or record that does not parse, in one pass.

    Columns: ``carry``, ``into`` (the parsed record, NULL if rejected), ``_reason`` (NULL if parsed),
    ``_page`` and ``_rejected`` (the text of what is rejected). Stage the frame, then take ``accepted``
    and ``rejected`` from it. As in ``page_records``, pages are only cut where they were read; records
    and rejected pages are spread over tasks before the wide parse (``spread_records``).

    The parse is permissive and notes a text that broke it in a column of its own. A member whose value
    does not fit its type is NULL and the record stays; with ``strict`` the record is rejected.
    """
    text = F.col(col)
    cut = pages.select(*carry, _label(pages, label), text.alias("_whole"), listed_records(text, path).alias("_list"))
    kept = cut.columns[:-2]
    null = F.lit(None).cast("string")
    item = lambda body, reason: F.struct(body.alias("text"), reason.alias("reason"))
    record = F.transform("_list", lambda x: item(x, F.when(x.isNull(), NULL_RECORD).when(~F.ltrim(x).startswith("{"), NOT_OBJECT)))
    whole = F.array(item(F.col("_whole"), _why_no_list(F.col("_whole"))))
    items = F.when(F.col("_list").isNull(), whole).otherwise(record)
    rows = explode_parsed(cut.withColumn("_items", items), ["_items"], kept, into="_item")
    rows = spread_records(rows, pages)

    wide = T.StructType.fromDDL(schema)
    wide = T.StructType([*wide.fields, T.StructField(CORRUPT, T.StringType())])
    body, reason = F.col("_item.text"), F.col("_item.reason")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = rows.withColumn(into, F.from_json(F.when(reason.isNull(), body), wide, options))
    broken = F.col(f"{into}.{CORRUPT}").isNotNull()
    late = F.when(broken & F.try_parse_json(body).isNull(), NOT_JSON)
    if strict:
        late = F.when(broken, F.coalesce(late, F.lit(MISFIT)))
    judged = parsed.withColumn("_reason", F.coalesce(reason, late))
    bad = F.col("_reason").isNotNull()
    others = [c for c in kept if c != "_page"]
    return judged.select(
        *others, F.when(~bad, F.col(into)).alias(into), "_reason", F.when(bad, F.col("_page")).alias("_page"),
        F.when(bad, body).otherwise(null).alias("_rejected"),
    )


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("_reason").isNull()).drop("_reason", "_page", "_rejected")


def rejected(checked: DataFrame, carry: Sequence[str | Column] = (BATCH,)) -> DataFrame:
    bad = checked.where(F.col("_reason").isNotNull())
    return bad.select(*carry, F.col("_reason").alias("reason"), F.col("_page").alias("page"), F.col("_rejected").alias("text"))
