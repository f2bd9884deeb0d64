import pytest
from pyspark.sql import functions as F

from tidemark.operators import sinks
from tidemark.operators.select import all_pending


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)


@pytest.fixture
def store(spark, tmp_path):
    return sinks.Store(spark, str(tmp_path / "lake"))


def frame(spark, data, ddl="k int, v string"):
    return spark.createDataFrame(data, ddl)


def test_replace_keeps_versions_and_reads_the_newest(spark, store):
    assert not store.exists("t")
    with pytest.raises(FileNotFoundError):
        store.read("t")
    first = store.replace("t", frame(spark, [(1, "a"), (2, "b")]))
    assert (first.wrote, first.rows) == (True, 2)
    old = store.read("t")
    store.replace("t", old.where("k = 1").withColumn("extra", F.lit(1)))
    assert rows(store.read("t")) == [(1, "a", 1)]
    assert old.count() == 2


def test_a_version_without_success_marker_is_not_read(spark, store, tmp_path):
    store.replace("t", frame(spark, [(1, "a")]))
    broken = tmp_path / "lake" / "t" / "run=99999999T000000000000-x"
    broken.mkdir()
    assert rows(store.read("t")) == [(1, "a")]


def test_skip_if_empty_keeps_the_old_table(spark, store):
    store.replace("t", frame(spark, [(1, "a")]))
    kept = store.replace("t", frame(spark, []), skip_if_empty=True)
    assert (kept.wrote, kept.rows) == (False, 0) and store.read("t").count() == 1
    store.replace("t", frame(spark, []))
    assert store.read("t").count() == 0


def test_append_and_evolution(spark, store):
    store.append("t", frame(spark, [(1, "a")]))
    store.append("t", frame(spark, [(2, "b")]))
    wider = frame(spark, [(3, "c", 1.0)], "k int, v string, w double")
    with pytest.raises(ValueError, match="evolve"):
        store.append("t", wider)
    store.append("t", wider, evolve=True)
    assert rows(store.read("t", merge_schema=True)) == [(1, "a", None), (2, "b", None), (3, "c", 1.0)]


def test_publish_modes(spark, store):
    store.publish("t", frame(spark, [(1, "a"), (2, "b")]), mode="auto", keys=["k"])
    store.publish("t", frame(spark, [(2, "B"), (3, "c")]), mode="auto", keys=["k"])
    assert rows(store.read("t")) == [(1, "a"), (2, "B"), (3, "c")]
    store.publish("t", frame(spark, [(9, "z")]), mode="auto", keys=["k"], full_refresh=True)
    assert rows(store.read("t")) == [(9, "z")]
    store.publish("log", frame(spark, [(9, "z")]), mode="append")
    assert store.read("log").count() == 1
    with pytest.raises(ValueError):
        store.publish("t", frame(spark, []), mode="sideways")


def test_skipping_an_empty_result_runs_it_once(spark, store):
    seen = spark.sparkContext.accumulator(0)
    counted = frame(spark, [(1, "a")]).rdd.map(lambda r: (seen.add(1), r)[1]).toDF("k int, v string")
    store.replace("t", counted, skip_if_empty=True)
    assert seen.value == 1


def test_slots_rewrite_only_what_changed(spark, store):
    import pathlib

    data = [(k, f"v{k}") for k in range(200)]
    store.merge_slots("t", frame(spark, data), ["k"], slots=16)
    root = pathlib.Path(store.path("t"))
    before = {f: f.stat().st_mtime_ns for f in root.glob("_slot_of_16=*/*.parquet")}
    change = frame(spark, [(3, "new"), (1000, "added"), (None, "loose")])
    store.merge_slots("t", change, ["k"], slots=16)
    assert rows(store.read("t"), "k", "v") == rows(sinks.upsert(frame(spark, data), change, ["k"]))
    assert store.read("t").where("k is null").count() == 1
    kept = {f.parent.name for f, t in before.items() if f.exists() and f.stat().st_mtime_ns == t}
    assert len(kept) >= 14
    store.merge_slots("t", change, ["k"], slots=16)
    assert store.read("t").count() == 203  # a row without a key matches nothing, so it comes again
    with pytest.raises(ValueError, match="slots"):
        store.merge_slots("t", change, ["k"], slots=8)


def test_upsert_rules(spark):
    target = frame(spark, [(1, "a"), (2, "b"), (2, "b2"), (None, "n")])
    source = frame(spark, [(2, None), (4, "d"), (None, "loose")])
    once = sinks.upsert(target, source, ["k"])
    # every matching target row is updated, also to NULL; rows without a key match nothing and are added
    assert rows(once) == sorted([(1, "a"), (2, None), (2, None), (None, "n"), (4, "d"), (None, "loose")], key=str)
    assert rows(sinks.upsert(once, source.dropna(subset=["k"]), ["k"])) == rows(once)
    assert rows(sinks.without_key(source, ["k"])) == [(None, "loose")]


def test_upsert_duplicates(spark):
    target = frame(spark, [(1, "a")])
    double = frame(spark, [(1, "x", 1), (1, "y", 2)], "k int, v string, version int")
    with pytest.raises(Exception, match="duplicate upsert key"):
        sinks.upsert(target, double, ["k"]).collect()
    newest = sinks.upsert(target, double, ["k"], "latest", ["version"])
    assert rows(newest) == [(1, "y", 2)]
    with pytest.raises(ValueError):
        sinks.one_per_key(double, ["k"], "maybe")


def test_upsert_on_two_keys(spark):
    ddl = "a int, b int, v string"
    got = sinks.upsert(frame(spark, [(1, 1, "x"), (1, 2, "y")], ddl), frame(spark, [(1, 2, "Y"), (2, 2, "z")], ddl), ["a", "b"])
    assert rows(got) == [(1, 1, "x"), (1, 2, "Y"), (2, 2, "z")]


def test_ledger_marks_exactly_the_batches_done(spark, store):
    ddl = "id int, _is_normalized boolean, _Batch_run_id string"
    bronze = frame(spark, [(1, False, "a"), (2, False, "b"), (3, False, "b")], ddl)
    assert all_pending(bronze, store.ledger("x")).count() == 3
    store.mark_processed("x", bronze.where("id = 2"))
    assert rows(all_pending(bronze, store.ledger("x")), "id") == [(1,)]
    assert all_pending(bronze, store.ledger("other")).count() == 3


def test_conform_order_and_bad_values(spark):
    got = sinks.conform(frame(spark, [(1, "x")]), "v int, k string")
    assert got.columns == ["v", "k"] and rows(got) == [(None, "1")]


def test_catalog_tables(spark):
    from tidemark.sources.tables import read_table, rows_to_df, table_exists

    assert not table_exists(spark, "some_table")
    rows_to_df(spark, [(1,)], "k int").write.saveAsTable("some_table")
    assert table_exists(spark, "some_table") and read_table(spark, "some_table").count() == 1
