from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from tidemark.functions.dates import century_fix
from tidemark.operators import audit, lookup, nested, pivot, select, skew


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)


# -- selection -----------------------------------------------------------------------------------

BRONZE = "id int, _is_normalized boolean, _Batch_run_id string, _ingestion_ts timestamp_ntz"


def bronze(spark):
    return spark.sql("""SELECT * FROM VALUES
      (1, false, 'a', timestamp_ntz'2024-01-01'), (2, false, 'b', timestamp_ntz'2024-01-02'),
      (3, false, 'b', timestamp_ntz'2024-01-03'), (4, true, 'c', timestamp_ntz'2024-01-04')
      AS t(id, _is_normalized, _Batch_run_id, _ingestion_ts)""")


def test_selection(spark):
    waiting = select.pending(bronze(spark))
    assert rows(waiting, "id") == [(1,), (2,), (3,)]
    assert rows(select.latest_row(waiting), "id") == [(3,)]
    assert rows(select.latest_batch(waiting), "id") == [(2,), (3,)]
    done = spark.createDataFrame([("b",), ("b",)], "_Batch_run_id string")
    assert rows(select.all_pending(bronze(spark), done), "id") == [(1,)]
    assert select.is_empty(waiting.where("id > 9"))
    assert rows(select.latest_batch(waiting.where("id > 9"))) == []


def test_pending_and_processed_make_up_bronze(spark):
    b = bronze(spark)
    done = spark.createDataFrame([("a",)], "_Batch_run_id string")
    left, gone = select.exclude(b, done, ["_Batch_run_id"]), select.only(b, done, ["_Batch_run_id"])
    assert rows(left.union(gone)) == rows(b)


def test_latest_batch_is_a_scalar_subquery_and_prunes(spark, tmp_path):
    path = str(tmp_path / "b")
    bronze(spark).write.partitionBy("_Batch_run_id").parquet(path)
    picked = select.latest_batch(spark.read.parquet(path))
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "Subquery" in plan and "Join" not in plan
    assert rows(picked, "id") == [(4,)]


def test_in_force_and_sort(spark):
    df = spark.createDataFrame(
        [("past", None), ("ongoing", 1), ("ongoing", 9), ("ongoing", None), ("upcoming", 9), ("x", 1)],
        "period string, start int",
    )
    kept = select.in_force(df, F.col("period"), F.col("start"), F.lit(5))
    assert rows(kept) == [("ongoing", 1), ("past", None), ("upcoming", 9)]
    assert select.sort_latest(df, "start").first().start == 9
    assert select.sort_latest(df, "start", nulls="first").first().start is None


# -- nesting -------------------------------------------------------------------------------------


def parsed(spark):
    doc = [('{"c": [{"k": 1, "r": [{"v": 1, "l": [{"w": 1}, {"w": 2}]}, {"v": 2, "l": []}]}, {"k": 2, "r": []}, {"k": 3}]}',), ("broken",)]
    df = spark.createDataFrame(doc, "raw string")
    return nested.parse_object(df, "raw", "c array<struct<k:int,r:array<struct<v:int,l:array<struct<w:int>>>>>>")


def test_explode_depths(spark):
    one_ = nested.explode_parsed(parsed(spark), ["_parsed.c"], into="c")
    assert rows(one_, "c.k") == [(1,), (2,), (3,)]
    two = nested.explode_path(one_, ["c.r"], ["c.k"], into="r")
    assert rows(two, "k", "r.v") == [(1, 1), (1, 2)]
    three = nested.explode_path(one_, ["c.r", "l"], ["c.k"], into="l")
    assert rows(three, "k", "l.w") == [(1, 1), (1, 2)]
    outer = nested.explode_path(one_, ["c.r"], ["c.k"], outer=True, into="r")
    assert rows(outer, "k", "r.v") == [(1, 1), (1, 2), (2, None), (3, None)]
    deep = nested.explode_parsed(parsed(spark), ["_parsed.c", "r"], into="r")
    assert rows(deep, "r.v") == [(1,), (2,)]


def test_array_root(spark):
    df = spark.createDataFrame([('[{"a": 1}, {"a": 2}]',), ('{"a": 3}',), ("[]",), ("bad",), (None,)], "raw string")
    got = nested.explode_parsed(nested.parse_array(df, "raw", "struct<a:int>"), ["_parsed"], into="x")
    assert [r for r in rows(got, "x.a") if r != (None,)] == [(1,), (2,), (3,)]


def test_documents_are_parsed_once(spark):
    df = spark.createDataFrame([('[{"a": 1}]',)], "raw string")
    got = nested.explode_parsed(nested.parse_array(df, "raw", "struct<a:int>"), ["_parsed"], into="x")
    plan = got.select("x.a")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_staged_records_read_only_what_is_used(spark, tmp_path):
    from tidemark.operators.staging import staged
    from tidemark.plans import contracts

    page = spark.createDataFrame([('{"contracts": [{"contractId": 1, "rates": [{"rate": "5"}]}]}', "b")],
                                 "Raw_data string, _Batch_run_id string")
    records = staged(contracts.contract_records(page), str(tmp_path / "s"))
    plan = contracts.premiums(records)._jdf.queryExecution().executedPlan().toString()
    schema = plan[plan.index("ReadSchema"):]
    assert "premiums" in schema and "rates" not in schema and "shipName" not in schema
    assert contracts.rates(records).first().rate == 5.0


def test_null_when_and_union(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "t string, n int")
    assert rows(nested.null_when(a, F.col("t") == "x", ["n"])) == [("x", None), ("y", 2)]
    b = spark.createDataFrame([(2.5, "z")], "d double, t string")
    both = nested.union_aligned(a, b)
    assert both.columns == ["t", "n", "d"] and both.count() == 3


# -- lookups -------------------------------------------------------------------------------------


def test_duplicate_policies(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "ship string")
    dim = spark.createDataFrame([("a", 2), ("a", 1), ("c", 3)], "Hull_no string, imo int")
    assert lookup.resolve_id(left, dim, "ship", "Hull_no", "imo", "string").count() == 4
    first = lookup.resolve_id(left, dim, "ship", "Hull_no", "imo", "string", on_duplicate="first")
    assert rows(first) == [("1",), ("b",), (None,)]
    with pytest.raises(Exception, match="duplicate lookup key"):
        lookup.resolve_id(left, dim, "ship", "Hull_no", "imo", on_duplicate="error").collect()
    with pytest.raises(ValueError):
        lookup.unique_side(dim, ["Hull_no"], ["imo"], "other")


def test_composite_lookup_replaces_and_keeps_unmatched(spark):
    left = spark.createDataFrame([("f", "2024-05-01"), ("f", "2024-06-01"), (None, "2024-05-01")], "name string, d string")
    docs = spark.createDataFrame([("f", "1924-05-01", "F1")], "fixture_ID string, extension_date string, crmd_name string")
    got = lookup.composite_lookup(
        left, docs,
        [(F.col("name"), F.col("fixture_ID")), (F.col("d").try_cast("date"), century_fix("extension_date"))],
        {"name": "crmd_name"},
    )
    assert got.columns == ["name", "d"]
    assert rows(got) == [("F1", "2024-05-01"), (None, "2024-05-01"), (None, "2024-06-01")]


def test_hot_keys_join_equals_plain_join(spark):
    left = spark.range(1000).select(
        F.when(F.col("id") < 400, 1).when(F.col("id") < 600, None).otherwise(F.col("id")).alias("k"), "id"
    ).repartition(8)
    right = spark.range(900).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plain = skew.left_join_unique(left, right, "k")
    salted = skew.left_join_unique(left, right, "k", hot_rows=100)
    assert rows(plain, "k", "id", "v") == rows(salted, "k", "id", "v")
    assert rows(skew.hot_keys(left, ["k"], 100)) == [(1, 4)]


# -- pivot ---------------------------------------------------------------------------------------

PROPS = "shipImoNr string, property_id string, title string, value string, isVerified string, uuid string, lastUpdated timestamp, prop_lastUpdated string, _Batch_run_id string"


def test_pivot_rules(spark):
    ts = None
    props = spark.createDataFrame([
        ("1", "p1", "t", "a", "true", "u", ts, "2024-01-02", "b"), ("1", "p1", "t", "b", "no", "u", ts, "2024-01-10", "b"),
        ("1", "p2", None, "z", "true", "u", ts, "2025-01-01", "b"), ("2", "p2", "t", "c", None, "v", ts, None, "b"),
        ("2", "p9", "t", "unmapped", "true", "v", ts, None, "b"),
    ], PROPS)
    mapping = spark.createDataFrame([("p1", "Main engine (kW)"), ("p2", "crm.x")], "property_id string, crm_field string")
    base = pivot.map_properties(props, mapping)
    fused = pivot.pivot_with_meta(base, "shipImoNr", "crm_field", "value")
    assert fused.columns[:3] == ["shipImoNr", "Main_engine__kW", "crm_x"]
    got = {r.shipImoNr: r for r in fused.collect()}
    assert got["1"]["Main_engine__kW"] == "b" and got["1"].crm_x is None and got["2"].crm_x == "c"
    assert got["1"].any_verified == 1 and got["2"].any_verified is None
    assert got["1"].last_property_updated_at == "2024-01-10"
    joined = pivot.attach_meta(pivot.pivot_max(base, "shipImoNr", "crm_field", "value"), pivot.group_meta(base, "shipImoNr"), "shipImoNr")
    assert rows(joined.select(fused.columns)) == rows(fused)


def test_names_must_not_meet(spark):
    with pytest.raises(ValueError, match="both become"):
        pivot.clean_names(spark.range(1).selectExpr("1 AS `a b`", "2 AS `a.b`"))
    df = spark.createDataFrame([("x",), ("y",), ("z",)], "crm_field string")
    assert pivot.field_names(df) == ["x", "y", "z"]
    many = spark.range(6000).select(F.concat(F.lit("f"), "id").alias("crm_field"))
    assert len(pivot.field_names(many)) == 6000  # no number of fields is cut or refused


def jobs_of(spark, build):
    """What ``build`` returns and the jobs it ran."""
    group = uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        return build(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_noted_map_needs_no_job(spark, tmp_path):
    """The note survives Parquet and the join with properties; all 6,000 fields become columns."""
    many = spark.range(6000).select(F.col("id").cast("string").alias("property_id"), F.concat(F.lit("f "), "id").alias("crm_field"))
    pivot.with_fields(many).write.parquet(str(tmp_path / "map"))
    mapping = spark.read.parquet(str(tmp_path / "map"))
    assert len(pivot.noted_fields(mapping)) == 6000 and pivot.noted_fields(many) is None
    odd = 'x"\n\u0001é\U0001f600\\'
    long = spark.createDataFrame([("s", "17", "t", "a"), ("s", "17", "t", "b"), ("s", "5999", "t", odd), ("r", "3", "t", None), ("q", "3", "t", "")], "ship string, property_id string, title string, value string")
    wide, ran = jobs_of(spark, lambda: pivot.pivot_max(pivot.map_properties(long, mapping), "ship", "crm_field", "value"))
    assert ran == 0 and len(wide.columns) == 6001
    got = {r.ship: {k: v for k, v in r.asDict().items() if v is not None and k != "ship"} for r in wide.collect()}
    assert got == {"s": {"f_17": "b", "f_5999": odd}, "r": {}, "q": {"f_3": ""}}
    _, ran = jobs_of(spark, lambda: pivot.pivot_max(pivot.map_properties(long, many), "ship", "crm_field", "value"))
    assert ran > 0  # without a note the names are looked up


def test_pivot_of_numbers_and_missing_fields(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "x", 3), ("a", None, 9), (None, "y", 2), ("b", None, 5)], "k string, f string, v int")
    got = pivot.pivot_max(df, "k", "f", "v", ["x", "y"])
    assert got.schema["x"].dataType.typeName() == "integer"
    assert sorted(map(tuple, got.collect()), key=str) == [("a", 3, None), ("b", None, None), (None, None, 2)]
    empty = pivot.pivot_max(df.limit(0), "k", "f", "v", ["x"])
    assert empty.columns == ["k", "x"] and empty.count() == 0


# -- audit ---------------------------------------------------------------------------------------


def test_redaction(spark):
    df = spark.createDataFrame([('{"token": "a\\"b", "Password":"p", "page": 1}', "https://x/p?step=1&token=abc&z=2")], "b string, u string")
    row = audit.redact(df, ["b", "u"]).first()
    assert row.b == '{"token": "***", "Password":"***", "page": 1}' and row.u == "https://x/p?step=1&token=***&z=2"


def test_redaction_comes_before_truncation(spark):
    body = '{"access_token": "' + "s" * 50 + '"}'
    cols = "source string, page_no int, http_method string, api_url string, input_value string, request_body string, attempt_number int, request_timestamp timestamp, response_code int, response_body string, duration_ms bigint, status string, error_message string"
    df = spark.createDataFrame([("s", 1, "GET", "u", None, None, 1, None, 200, body, 5, "SUCCESS", None)], cols)
    row = audit.attempts_to_audit(df, "b1", context="c", body_chars=30).first()
    assert "sss" not in row.response_body and len(row.response_body) <= 30 and row.EventID and row.batch_run_id == "b1"


@pytest.mark.parametrize("body,path,kept", [
    ("[]", None, False), ('{"value": []}', None, False), ('{"value": [1]}', None, True), ("[1]", None, True),
    ('{"a": 1}', None, True), ("plain", None, True), ('{"results": []}', "$.results", False),
    ('{"results": [1]}', "$.results", True), ('{"x": 1}', "$.results", False),
])
def test_non_empty(spark, body, path, kept):
    df = spark.createDataFrame([(body,)], "response_body string")
    assert (audit.non_empty(df, path=path).count() == 1) is kept


@pytest.mark.parametrize("total,body,want", [(-1, "x", True), (-1, "x" * 300, False), (0, "x", False), (-1, None, True)])
def test_sentinel(one, total, body, want):
    assert one(audit.is_sentinel(F.col("t"), F.col("b")), t=total, b=body) is want


def test_high_water_mark_defaults(spark):
    assert str(audit.high_water_mark(spark, None).first()[0]) == "1900-02-09 12:15:03"
    audit_ddl = "batch_run_id string, api_url string, input_value string, request_body string, attempt_number int, request_timestamp timestamp_ntz, status string"
    log = spark.createDataFrame([], audit_ddl)
    assert str(audit.high_water_mark(spark, log).first()[0]) == "1900-02-09 12:15:03"
    log = spark.sql("""SELECT * FROM VALUES ('b1', 'u', 'p1', NULL, 1, timestamp_ntz'2024-01-01', 'SUCCESS'),
      ('b2', 'u', 'p1', NULL, 1, timestamp_ntz'2024-02-01', 'SUCCESS'), ('b2', 'u', 'p2', NULL, 3, timestamp_ntz'2024-02-01', 'FAILED')
      AS t(batch_run_id, api_url, input_value, request_body, attempt_number, request_timestamp, status)""")
    assert str(audit.high_water_mark(spark, log).first()[0]) == "2024-01-01 00:00:00"
    assert str(audit.high_water_mark(spark, log, strict=False).first()[0]) == "2024-02-01 00:00:00"
    assert str(audit.high_water_mark(spark, log, full_refresh=True).first()[0]) == "1900-02-09 12:15:03"
