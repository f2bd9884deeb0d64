"""What does not parse is kept, counted and named; nothing is lost in silence."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import rejects
from tidemark.operators.sinks import LEDGER, Store
from tidemark.plans import normalise
from tidemark.sources import tables

PAGE = "Raw_data string, Api_metadata string, _is_normalized boolean, _Batch_run_id string, _ingestion_ts timestamp"


def pages(spark, *texts, batch="b1", day=1):
    rows = [(t, json.dumps({"page_no": i}), False, batch, datetime(2024, 5, day)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, PAGE)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "lake"))


def reasons(df):
    return sorted((r.text, r.reason) for r in df.collect())


BAD = ['{"r": [{"a": 1}, {"a"', "", "   ", None, "{}", '{"r": 5}', '{"r": null}', "null", "5", '"x"', "not json"]
WHY = [rejects.NOT_JSON, *[rejects.EMPTY] * 3, *[rejects.NO_LIST] * 6, rejects.NOT_JSON]


def test_page_reasons(spark):
    good = ['{"r": []}', '{"r": [{"a": 1}], "more": {}}', ' {"r": [5]}']
    df = pages(spark, *BAD, *good)
    assert {(r.text, r.reason) for r in rejects.rejected_pages(df, "r").collect()} == set(zip(BAD, WHY))
    assert {r.Raw_data for r in rejects.sound_pages(df, "r").collect()} == set(good)
    deep = pages(spark, '{"d": {"r": [1]}}', '{"d": {"r": {}}}', '{"d": 1}', '{"r": [1]}')
    assert rejects.rejected_pages(deep, "d.r").count() == 3
    roots = pages(spark, "[]", '[{"a": 1}]', '{"a": 1}', '{"a": ', '[{"a": 1}', "null", "7")
    assert reasons(rejects.rejected_pages(roots)) == [
        ("7", rejects.NO_LIST), ('[{"a": 1}', rejects.NOT_JSON), ("null", rejects.NO_LIST), ('{"a": ', rejects.NOT_JSON)]


def test_records_in_are_records_parsed_and_rejected(spark):
    text = json.dumps({"r": [{"a": 1, "b": "x"}, None, 5, "text", [1], {"a": "no number", "b": "y"}, {"b": {"deep": 1}}, {}]})
    df = pages(spark, text, *BAD, '{"r": []}')
    checked = rejects.checked_records(df, "struct<a:int,b:string>", "r", into="x")
    assert checked.columns == ["_Batch_run_id", "x", "_reason", "_page", "_rejected"]
    got = rejects.accepted(checked)
    assert got.columns == ["_Batch_run_id", "x"]
    assert sorted((r.x.a, r.x.b) for r in got.select("x").collect() if r.x.a) == [(1, "x")]
    assert {r.b for r in got.select("x.b").collect()} == {"x", "y", '{"deep":1}', None} and got.count() == 4
    bad = rejects.rejected(checked)
    records = {rejects.NULL_RECORD: 1, rejects.NOT_OBJECT: 3}
    counted = {r.reason: r["count"] for r in bad.groupBy("reason").count().collect()}
    assert counted == {**{w: WHY.count(w) for w in WHY}, **records}
    assert bad.where("page is null").count() == 0 and bad.where(F.col("text") == "text").count() + bad.where("text = '\"text\"'").count() == 1
    assert got.count() + bad.count() == 8 + len(BAD)
    strict = rejects.checked_records(df, "struct<a:int,b:string>", "r", strict=True)
    assert rejects.rejected(strict).where(F.col("reason") == rejects.MISFIT).count() == 1
    assert rejects.accepted(strict).count() == 3


def test_object_roots_are_checked_when_parsed(spark):
    checked = rejects.checked_records(pages(spark, '{"a": 1}', '{"a": 1', '[{"a": 2}]'), "struct<a:int>")
    assert sorted(r.a for r in rejects.accepted(checked).select("c.a").collect()) == [1, 2]
    assert reasons(rejects.rejected(checked)) == [('{"a": 1', rejects.NOT_JSON)]
    empty = rejects.checked_records(pages(spark, "x").where("false"), "struct<a:int>")
    assert empty.count() == 0


def test_contract_batch_with_rejects_is_marked_partial(spark, store):
    docs = spark.createDataFrame([], "fixture_ID string, extension_date string, crmd_name string")
    dim = spark.createDataFrame([], "Hull_no string, imo long")
    good = {"contracts": [{"contractId": 1, "contractType": "charterparty", "period": "past", "rates": [{"rate": 5}]}, 7]}
    store.append("cp", pages(spark, json.dumps(good), '{"contracts": [', "<html>"))
    with pytest.raises(ValueError, match="3 page"):
        normalise.normalise_contracts(store, "cp", docs, dim, on_reject="fail")
    assert not store.exists("charterparties") and not store.exists(LEDGER)
    done = normalise.normalise_contracts(store, "cp", docs, dim)
    assert done["charterparties"].rows == 1 and done[normalise.REJECTED].rows == 3
    kept = store.read(normalise.REJECTED)
    assert sorted(r.reason for r in kept.collect()) == [rejects.NOT_JSON, rejects.NOT_JSON, rejects.NOT_OBJECT]  # once, though two runs wrote
    assert [(r["table"], r.state) for r in store.read(LEDGER).collect()] == [("cp", "partial")]
    assert normalise.normalise_contracts(store, "cp", docs, dim) == {}
    with pytest.raises(ValueError, match="on_reject"):
        normalise.keep_rejects(store, "cp", kept, "maybe")


def test_other_tables_reject_pages_too(spark, store):
    store.append("reviews", pages(spark, '[{"id": 1}]', "broken", batch="r1"))
    store.append("oh", pages(spark, '[{"offhire_uuid": "a"}, null]', "[", batch="o1"))
    store.append("ships", pages(spark, '{"ships": [{"name": "s"}]}', batch="s1"))
    assert normalise.normalise_reviews(store, "reviews")[normalise.REJECTED].rows == 1
    assert normalise.normalise_offhires(store, "oh")[normalise.REJECTED].rows == 2
    assert normalise.REJECTED not in normalise.normalise_ships(store, "ships")
    assert store.read("offhires").count() == 1 and store.read("reviews").count() == 1
    assert {r["table"]: r.state for r in store.read(LEDGER).collect()} == {"reviews": "partial", "oh": "partial", "ships": "processed"}


def test_one_parse_of_the_wide_schema(spark):
    plan = rejects.checked_records(pages(spark, "[]"), "struct<a:int,b:string>")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(StructField(a") == 1 and plan.count("from_json(ArrayType") == 1


def test_partition_folder_escapes(spark):
    assert tables.partition_folder("/x", "b", "a/b=c") == "/x/b=a%2Fb%3Dc"
