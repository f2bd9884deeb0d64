"""Date and time rules. Text is rendered in the session zone, which the package fixes to UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.scalars import _col

# Defaults and limits that downstream consumers compare against.
NO_DATE = "1900-01-01 00:00:00"
NO_DATE_TEXT = "1900-01-01 00:00:00.0000000"
UNSET_WORD = "unspecified"
NEVER_AFTER = "9900-01-01"
CENTURY_FLOOR = "1990-01-01"


def iso_ts(c: Column | str) -> Column:
    """ISO text to timestamp; blank or unreadable text is NULL instead of an error."""
    return F.try_to_timestamp(_col(c))


def _is_unset(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "") | (F.lower(c) == UNSET_WORD)


def _seven_digits(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit(".0000000"))


def date_or_default(c: Column | str, default: str = NO_DATE_TEXT) -> Column:
    c = _col(c)
    return F.when(_is_unset(c), F.lit(default)).otherwise(_seven_digits(iso_ts(c)))


def zone_minus_minute(
    c: Column | str, zone: str = "America/Los_Angeles", default: str = NO_DATE_TEXT
) -> Column:
    """Wall-clock text in ``zone`` one minute before the instant."""
    c = _col(c)
    local = F.from_utc_timestamp(iso_ts(c), zone) - F.make_dt_interval(mins=F.lit(1))
    return F.when(_is_unset(c), F.lit(default)).otherwise(_seven_digits(local))


def _epoch_millis(c: Column) -> Column:
    return F.regexp_extract(c, r"(-?\d+)", 1).try_cast("bigint")


def _all_digits(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "").try_cast("bigint")


def _or_no_date(c: Column, ts: Column) -> Column:
    missing = c.isNull() | (c == "")
    return F.when(missing, F.lit(NO_DATE).cast("timestamp")).otherwise(ts)


def tick_date(c: Column | str, legacy_sign: bool = False) -> Column:
    """``/Date(millis+0000)/`` to a timestamp in whole seconds.

    ``legacy_sign=True`` joins all digits and cuts the four offset digits, so a date before 1970
    turns positive; by default the sign is kept.
    """
    c = _col(c)
    if legacy_sign:
        seconds = F.floor(F.floor(_all_digits(c) / F.lit(10_000)) / F.lit(1_000))
    else:
        seconds = F.floor(_epoch_millis(c) / F.lit(1_000))
    return _or_no_date(c, F.timestamp_seconds(seconds))


def millis_date(c: Column | str, zone_offset_ms: int = 0, legacy_sign: bool = False) -> Column:
    """``/Date(millis)/`` to a timestamp, optionally shifted by a fixed zone offset."""
    c = _col(c)
    millis = _all_digits(c) if legacy_sign else _epoch_millis(c)
    return _or_no_date(c, F.timestamp_millis(millis - F.lit(zone_offset_ms)))


def iso_midnight(ts: Column | str) -> Column:
    return F.concat(F.date_format(_col(ts), "yyyy-MM-dd"), F.lit("T00:00:00+00:00"))


def iso_or_never(ts: Column | str, limit: str = NEVER_AFTER) -> Column:
    ts = _col(ts)
    return F.when(ts > F.lit(limit).cast("timestamp"), F.lit("Never")).otherwise(iso_midnight(ts))


def century_fix(c: Column | str, floor: str = CENTURY_FLOOR) -> Column:
    """Dates before ``floor`` were keyed with the wrong century: move them 100 years on."""
    day = _col(c).try_cast("date")
    return F.when(day < F.lit(floor).cast("date"), F.add_months(day, 1200)).otherwise(day)


def day_text(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd")
