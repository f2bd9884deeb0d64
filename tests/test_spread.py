"""Records of pages: dealt out only where the pages are not, and parsed once."""

import json

from pyspark.sql import functions as F

from tidemark.checks import registry
from tidemark.checks.registry import few_pages, pages
from tidemark.operators.nested import page_records
from tidemark.plans import contracts, offhires


def landed(spark, n, parts, each=2):
    body = F.to_json(F.transform(F.sequence(F.lit(1), F.lit(each)), lambda i: F.struct(F.concat(F.col("id"), F.lit("-"), i).alias("offhire_uuid"))))
    return spark.range(0, n, 1, parts).select(body.alias("Raw_data"), F.lit("b").alias("_Batch_run_id"))


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def ids(df):
    return sorted(json.loads(r[0])["offhire_uuid"] for r in df.collect())


def test_text_of_many_pages_is_not_shuffled(spark):
    records = page_records(landed(spark, 40, 8))
    assert "Repartition" not in plan(records)
    assert ids(records) == sorted(f"{p}-{i}" for p in range(40) for i in (1, 2))


def test_records_of_few_or_uneven_pages_are_dealt(spark):
    for found in (landed(spark, 1, 1, each=30), landed(spark, 40, 1)):
        records = page_records(found)
        assert "Repartition" in plan(records) and records.count() == sum(len(json.loads(r[0])) for r in found.collect())


def test_null_pages_and_pages_without_records(spark):
    found = spark.createDataFrame([(None, "b"), ("[]", "b"), ("", "b"), ('[{"offhire_uuid": "x"}]', "b"), (' {"offhire_uuid": "y"}', "b")], "Raw_data string, _Batch_run_id string")
    assert ids(page_records(found)) == ["x", "y"]


def test_parsed_once_under_an_explode(spark):
    doc = '{"contracts": [{"contractId": 1, "rates": [{"rate": "2"}, {"rate": "3"}]}, {"contractId": 2, "rates": []}]}'
    found = spark.createDataFrame([(doc, "b")] * 8, "Raw_data string, _Batch_run_id string").repartition(8)
    rows = contracts.rates(contracts.contract_records(found, ("rates",)))
    # once to cut the page into its records, once to parse them
    assert plan(rows).count("from_json") == 2
    assert sorted(r.rate for r in rows.collect()) == [2.0] * 8 + [3.0] * 8
    both = offhires.offhire_records(landed(spark, 8, 8), ("header",))
    assert both.count() == 16


def test_large_pages_are_made_without_moving_their_text(spark):
    rows = spark.range(500)
    doc = F.array(F.struct("id"))
    moved = few_pages(pages(rows, doc, by=("id",)))
    assert "StructsToJson" not in plan(moved).split("Repartition", 1)[1]
    found = [json.loads(r.Raw_data) for r in moved.collect()]
    assert len(found) == 3 and sorted(r["id"] for page in found for r in page) == list(range(500))


def test_a_task_has_no_more_pages_as_the_table_grows(spark, monkeypatch):
    monkeypatch.setattr(registry, "TASK_ROWS", 20, raising=False)
    tasks = lambda n: [r[0] for r in pages(spark.range(n), F.struct("id")).groupBy(F.spark_partition_id()).count().select("count").collect()]
    cores = spark.sparkContext.defaultParallelism
    for n in (20 * cores * 3, 20 * cores * 12):
        assert sum(tasks(n)) == n and max(tasks(n)) < 2 * 20
    assert len(tasks(10 * cores)) <= cores
    assert sum(tasks(0)) == 0
