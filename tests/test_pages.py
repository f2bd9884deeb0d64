"""Large pages of the registered queries."""

import json

from pyspark.sql import functions as F

from tidemark.checks.registry import PAGE_RECORDS, few_pages


def sizes(spark, n):
    rows = spark.range(n).select(F.to_json(F.struct("id")).alias("one"), F.lit("b").alias("batch"))
    pages = few_pages(rows.select(F.concat(F.lit("["), "one", F.lit("]")).alias("Raw_data"), "batch")).collect()
    ids = [[r["id"] for r in json.loads(p.Raw_data)] for p in pages]
    assert sorted(i for page in ids for i in page) == list(range(n))
    return [len(page) for page in ids]


def test_pages_do_not_grow_with_the_table(spark):
    assert len(sizes(spark, 900)) == 3
    found = sizes(spark, 12 * PAGE_RECORDS)
    assert len(found) == 12 and max(found) < 1.1 * PAGE_RECORDS
