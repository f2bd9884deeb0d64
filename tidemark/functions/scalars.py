"""Scalar cleaning rules as Column expressions; everything stays inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ZERO_WIDTH_SPACE = "\u200b"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def label_map(c: Column | str, labels: Mapping[str, str]) -> Column:
    """Replace known values, let every other value pass through."""
    c = _col(c)
    pairs = [F.lit(part) for pair in labels.items() for part in pair]
    return F.coalesce(F.create_map(*pairs)[c], c)


def code_map(c: Column | str, codes: Mapping[str, str], unknown: str = "") -> Column:
    """Replace known codes; an unknown code becomes ``unknown`` and NULL stays NULL."""
    c = _col(c)
    pairs = [F.lit(part) for pair in codes.items() for part in pair]
    return F.when(c.isNotNull(), F.coalesce(F.create_map(*pairs)[c], F.lit(unknown)))


def bool_to_int(c: Column | str) -> Column:
    """true/1 to 1, false/0 to 0, anything else NULL."""
    text = _col(c).cast("string")
    return F.when(text.isin("true", "1"), F.lit(1)).when(text.isin("false", "0"), F.lit(0))


def yn_flag(c: Column | str) -> Column:
    """1 for 'Y', otherwise 0 (NULL included)."""
    return F.coalesce((_col(c) == "Y").cast("int"), F.lit(0))


def blank_to_null(c: Column | str) -> Column:
    c = _col(c)
    return F.when(F.trim(c) != "", c)


def placeholder_to_null(c: Column | str, *placeholders: str) -> Column:
    c = _col(c)
    return F.when(~c.isin(*placeholders), c)


def first_of(arr: Column | str, field: str | None = None) -> Column:
    """First array element, NULL for an empty or missing array."""
    head = F.get(_col(arr), F.lit(0))
    return head.getField(field) if field else head


def first_where(arr: Column | str, keep: Callable[[Column], Column], field: str) -> Column:
    return F.get(F.filter(_col(arr), keep), F.lit(0)).getField(field)


def strip_ws(c: Column | str) -> Column:
    """Remove every whitespace character; NULL becomes the empty string."""
    return F.coalesce(F.regexp_replace(_col(c), r"\s+", ""), F.lit(""))


def strip_zero_width(c: Column | str) -> Column:
    """Drop one trailing zero-width space."""
    return F.regexp_replace(_col(c), ZERO_WIDTH_SPACE + "$", "")


def concat_strict(*cs: Column | str) -> Column:
    return F.concat(*[_col(c) for c in cs])


def concat_skip(sep: str, *cs: Column | str) -> Column:
    return F.concat_ws(sep, *[_col(c).cast("string") for c in cs])


def page_count(total: Column | str, step: int) -> Column:
    return F.ceil(_col(total) / F.lit(step))


def to_double(c: Column | str) -> Column:
    return _col(c).try_cast("double")


def to_decimal(c: Column | str) -> Column:
    return _col(c).try_cast("decimal(38,6)")


def to_long(c: Column | str) -> Column:
    return _col(c).try_cast("bigint")


def to_int(c: Column | str) -> Column:
    return _col(c).try_cast("int")


def typed_null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def key_or_fallback(key: Column | str, fallback: Column | str) -> Column:
    """The key as text, or the fallback where the key is 0."""
    key = _col(key)
    return F.when(key != 0, key.cast("string")).when(key == 0, _col(fallback).cast("string"))


def resolve_flag(api: Column | str, matched: Column | str, mapped: Column | str) -> Column:
    """Mapped name, else the matched flag, else the flag as delivered; a blank flag is NULL."""
    api = _col(api)
    return F.when(F.trim(api) != "", F.coalesce(_col(mapped), _col(matched), api))
