from datetime import date, datetime

import pytest

from tidemark.functions import dates as D

NONE = datetime(1900, 1, 1)


@pytest.mark.parametrize("text,want", [
    ("2024-05-01T10:00:00Z", datetime(2024, 5, 1, 10)), ("2024-05-01T10:00:00+02:00", datetime(2024, 5, 1, 8)),
    ("2024-05-01", datetime(2024, 5, 1)), ("", None), (" ", None), ("soon", None), (None, None),
])
def test_iso_ts(one, text, want):
    assert one(D.iso_ts("c").cast("timestamp_ntz"), c=text) == want


@pytest.mark.parametrize("text,want", [
    (None, D.NO_DATE_TEXT), ("", D.NO_DATE_TEXT), ("unspecified", D.NO_DATE_TEXT), ("UNSPECIFIED", D.NO_DATE_TEXT),
    ("2024-05-01T10:00:00.123Z", "2024-05-01 10:00:00.0000000"), ("soon", None),
])
def test_date_or_default(one, text, want):
    assert one(D.date_or_default("c"), c=text) == want


@pytest.mark.parametrize("text,want", [
    ("2024-01-01T08:00:00Z", "2023-12-31 23:59:00.0000000"), ("2024-07-01T07:00:00Z", "2024-06-30 23:59:00.0000000"),
    ("Unspecified", D.NO_DATE_TEXT),
])
def test_zone_minus_minute_follows_daylight_saving(one, text, want):
    assert one(D.zone_minus_minute("c"), c=text) == want


@pytest.mark.parametrize("text,want,legacy", [
    ("/Date(0+0000)/", datetime(1970, 1, 1), datetime(1970, 1, 1)),
    ("/Date(1700000000123+0000)/", datetime(2023, 11, 14, 22, 13, 20), datetime(2023, 11, 14, 22, 13, 20)),
    ("/Date(-86400000+0000)/", datetime(1969, 12, 31), datetime(1970, 1, 2)),
    (None, NONE, NONE), ("", NONE, NONE), ("x", None, None),
])
def test_tick_date(one, text, want, legacy):
    assert one(D.tick_date("c").cast("timestamp_ntz"), c=text) == want
    assert one(D.tick_date("c", legacy_sign=True).cast("timestamp_ntz"), c=text) == legacy


@pytest.mark.parametrize("text,day,end", [
    ("/Date(1700000000123)/", "2023-11-14T00:00:00+00:00", "2023-11-14T00:00:00+00:00"),
    ("/Date(253402214400000)/", "9999-12-31T00:00:00+00:00", "Never"),
    ("/Date(-86400000)/", "1969-12-31T00:00:00+00:00", "1969-12-31T00:00:00+00:00"),
    (None, "1900-01-01T00:00:00+00:00", "1900-01-01T00:00:00+00:00"),
])
def test_millis_and_never(one, text, day, end):
    assert one(D.iso_midnight(D.millis_date("c")), c=text) == day
    assert one(D.iso_or_never(D.millis_date("c")), c=text) == end


@pytest.mark.parametrize("text,want", [
    ("1924-05-01", date(2024, 5, 1)), ("2024-05-01", date(2024, 5, 1)), ("1924-02-29", date(2024, 2, 29)),
    ("1990-01-01", date(1990, 1, 1)), ("", None), (None, None),
])
def test_century_fix(one, text, want):
    assert one(D.century_fix("c"), c=text) == want
