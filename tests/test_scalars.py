import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.functions.json import is_json, json_decimal, struct_of, to_json_text


@pytest.mark.parametrize("given,want", [("a", "A"), ("z", "z"), (None, None)])
def test_label_map_passes_unknown(one, given, want):
    assert one(S.label_map("c", {"a": "A"}), c=given) == want


@pytest.mark.parametrize("given,want", [("1260", "P"), ("1263", ""), (None, None)])
def test_code_map(one, given, want):
    assert one(S.code_map("c", {"1260": "P"}), c=given) == want


@pytest.mark.parametrize("given,want", [("true", 1), ("1", 1), ("false", 0), ("0", 0), ("yes", None), (None, None)])
def test_bool_to_int(one, given, want):
    assert one(S.bool_to_int("c"), c=given) == want


@pytest.mark.parametrize("given,want", [("Y", 1), ("y", 0), ("N", 0), (None, 0)])
def test_yn_flag(one, given, want):
    assert one(S.yn_flag("c"), c=given) == want


@pytest.mark.parametrize("given,want", [("", None), ("  ", None), (" x ", " x "), (None, None)])
def test_blank_to_null_keeps_spaces(one, given, want):
    assert one(S.blank_to_null("c"), c=given) == want


@pytest.mark.parametrize("given,want", [('{"rates":[]}', None), ("", None), ("x", "x"), (None, None)])
def test_placeholder(one, given, want):
    assert one(S.placeholder_to_null("c", '{"rates":[]}', ""), c=given) == want


def test_strip(one):
    assert one(S.strip_ws("c"), c=" a\tb\n ") == "ab"
    assert one(S.strip_ws("c"), c=None) == ""
    assert one(S.strip_zero_width("c"), c="a​") == "a"
    assert one(S.strip_zero_width("c"), c="a​b") == "a​b"
    assert one(S.strip_zero_width("c"), c="a​​") == "a​"


def test_first_of_empty_array_is_null(one):
    assert one(S.first_of(F.array().cast("array<string>"))) is None
    assert one(S.first_of(F.lit(None).cast("array<string>"))) is None
    assert one(S.first_of(F.array(F.lit("x"), F.lit("y")))) == "x"


def test_concat_rules(one):
    assert one(S.concat_strict("a", F.lit("-"), "b"), a="x", b=None) is None
    assert one(S.concat_skip("-", "a", "b"), a=None, b="2") == "2"


@pytest.mark.parametrize("text,d,l,i", [("12", 12.0, 12, 12), ("", None, None, None), (" ", None, None, None),
                                        ("99999999999", 99999999999.0, 99999999999, None), ("x", None, None, None)])
def test_casts_never_raise(one, text, d, l, i):
    assert one(S.to_double("c"), c=text) == d
    assert one(S.to_long("c"), c=text) == l
    assert one(S.to_int("c"), c=text) == i
    got = one(S.to_decimal("c"), c=text)
    assert (float(got) if got is not None else None) == d


def test_page_count_and_key(one):
    assert [one(S.page_count("c", 200), c=n) for n in (0, 1, 200, 201)] == [0, 1, 1, 2]
    assert one(S.key_or_fallback("k", "p"), k=0, p="P1") == "P1"
    assert one(S.key_or_fallback("k", "p"), k=7, p="P1") == "7"


@pytest.mark.parametrize("api,matched,mapped,want", [
    (" ", "X", "Y", None), (None, None, None, None), ("A", None, None, "A"), ("A", "A", None, "A"), ("A", "A", "B", "B"),
])
def test_resolve_flag(one, api, matched, mapped, want):
    assert one(S.resolve_flag("a", "m", "n"), a=api, m=matched, n=mapped) == want


def test_json_helpers(one):
    assert float(one(json_decimal("c", "$.amount"), c='{"amount": "1.25"}')) == 1.25
    assert one(json_decimal("c", "$.amount"), c='{"amount": ""}') is None
    assert one(is_json("c"), c="<html>") is False
    assert one(is_json("c"), c='{"a": 1}') is True
    assert one(to_json_text(F.col("a"), F.col("b")), a="x", b=None) == '{"a":"x","b":null}'
    assert struct_of([("a.b", "int"), ("a.c", "string")]) == "struct<`a`:struct<`b`:int,`c`:string>>"


@pytest.mark.parametrize("doc,want", [
    ('{"a": {"x": 1}, "n": 1, "b": true}', ('{"x":1}', 1, True)),
    ('{"a": 5, "n": "1", "b": "true"}', ("5", None, None)),
    ('{"a": true, "n": 1.5, "b": 1}', ("true", None, None)),
    ('{"a": [1], "n": null}', ("[1]", None, None)),
    ("not json", (None, None, None)),
])
def test_parse_semantics_relied_on(one, doc, want):
    got = one(F.from_json("c", "a string, n int, b boolean"), c=doc)
    assert tuple(got) == want
