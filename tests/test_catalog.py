"""Tables by name in the session's catalog."""

from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from tidemark.checks import QUERIES
from tidemark.operators.catalog import Catalog, Layout


@pytest.fixture
def catalog(spark):
    return Catalog(spark, f"db_{uuid4().hex[:8]}")


def frame(spark, data, ddl="k int, v string"):
    return spark.createDataFrame(data, ddl)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_replace_publishes_versions_behind_one_name(spark, catalog):
    assert not catalog.exists("t")
    done = catalog.replace("t", frame(spark, [(1, "a"), (2, "b")]))
    assert (done.wrote, done.rows) == (True, 2) and catalog.exists("t")
    old = catalog.read("t")
    catalog.replace("t", catalog.read("t").where("k = 1").withColumn("more", F.lit(1)))  # from itself
    assert rows(catalog.read("t")) == [(1, "a", 1)] and old.count() == 2
    kept = catalog.replace("t", frame(spark, []), skip_if_empty=True)
    assert not kept.wrote and rows(catalog.read("t")) == [(1, "a", 1)] and len(catalog.versions("t")) == 2
    catalog.replace("t", frame(spark, []))
    assert catalog.read("t").count() == 0
    assert catalog.expire("t", keep=1) == 2 and catalog.read("t").columns == ["k", "v"]


def test_a_failed_write_leaves_the_last_version(spark, catalog):
    catalog.replace("t", frame(spark, [(1, "a")]))
    with pytest.raises(Exception, match="broken"):
        catalog.replace("t", frame(spark, [(2, "b")]).withColumn("v", F.raise_error(F.lit("broken")).cast("string")))
    assert rows(catalog.read("t")) == [(1, "a")]
    catalog.expire("t", keep=1)
    assert rows(catalog.read("t")) == [(1, "a")]


def test_append_goes_by_name_and_evolves(spark, catalog):
    catalog.append("t", frame(spark, [(1, "a")]))
    catalog.append("t", frame(spark, [("b", 2)], "v string, k int"))
    with pytest.raises(ValueError, match="no column"):
        catalog.append("t", frame(spark, [(3, "c", 1.5)], "k int, v string, w double"))
    catalog.append("t", frame(spark, [(3, 1.5)], "k int, w double"), evolve=True)
    assert rows(catalog.read("t")) == [(1, "a", None), (2, "b", None), (3, None, 1.5)]
    with pytest.raises(ValueError, match="plain table"):
        catalog.replace("t", frame(spark, []))


def test_only_partitions_with_rows_are_replaced(spark, catalog):
    layout, ddl = Layout(partition_by=["p"]), "k int, p string"
    catalog.replace_partitions("t", frame(spark, [(1, "x"), (2, "y"), (3, "z")], ddl), layout)
    for _ in range(2):
        catalog.replace_partitions("t", frame(spark, [("y", 20), ("y", 21), (None, 9)], "p string, k int"), layout)
    assert rows(catalog.read("t")) == [(1, "x"), (20, "y"), (21, "y"), (3, "z"), (9, None)]
    catalog.replace_partitions("t", frame(spark, [], ddl), layout)
    assert catalog.read("t").count() == 5
    with pytest.raises(ValueError):
        catalog.replace_partitions("t", frame(spark, [], ddl), Layout())


@pytest.mark.parametrize("how", ["replace", "append"])
def test_tables_bucketed_alike_join_and_group_without_a_shuffle(spark, catalog, how):
    layout = Layout(bucket_by=["k"], buckets=4)
    getattr(catalog, how)("a", frame(spark, [(i % 50, str(i)) for i in range(400)]), layout)
    getattr(catalog, how)("b", frame(spark, [(i, "w") for i in range(0, 50, 2)], "k int, w string"), layout)
    joined = catalog.read("a").join(catalog.read("b").hint("merge"), "k")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.count() == 200
    counted = catalog.read("a").groupBy("k").count()
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
    files = len(catalog.read("a").inputFiles())
    assert files <= 4  # one a bucket, not one a bucket and task


def test_the_bucketed_query_has_no_shuffle(spark):
    plan = QUERIES["catalog_bucketed_join"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_layouts_are_checked():
    with pytest.raises(ValueError):
        Layout(bucket_by=["k"])
    with pytest.raises(ValueError):
        Layout(buckets=3)
