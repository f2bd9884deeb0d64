"""Tables in hash partitions of their key: only touched ones are rewritten, full ones split."""

import pathlib
import random

import pytest

from tidemark.operators import keyed, sinks


@pytest.fixture
def store(spark, tmp_path):
    return sinks.Store(spark, str(tmp_path / "lake"))


def frame(spark, data, ddl="k long, v string"):
    return spark.createDataFrame(data, ddl)


def files(store, name="t"):
    return {f: f.stat().st_mtime_ns for f in pathlib.Path(store._current(name)).glob("_bucket=*/*.parquet")}


def content(store, name="t"):
    df = store.read(name)
    assert keyed.BUCKET not in df.columns
    return sorted((tuple(r) for r in df.select("k", "v").collect()), key=str)


def names(store):
    return keyed.parse(p.name for p in pathlib.Path(store._current("t")).iterdir())


def test_untouched_files_keep_their_names(spark, store):
    store.merge_keyed("t", frame(spark, [(k, f"v{k}") for k in range(400)]), ["k"], capacity=50)
    before = files(store)
    assert len(names(store)) == 16
    done = store.merge_keyed("t", frame(spark, [(3, "new"), (1000, "added"), (None, "loose")]), ["k"], capacity=50)
    assert 3 <= done.rows < 100
    kept = {f for f, at in before.items() if f.exists() and f.stat().st_mtime_ns == at}
    assert len(kept) >= len(before) - 2
    want = [(k, "new" if k == 3 else f"v{k}") for k in range(400)] + [(1000, "added"), (None, "loose")]
    assert content(store) == sorted(want, key=str)
    untouched = files(store)
    assert store.merge_keyed("t", frame(spark, []), ["k"], capacity=50) == sinks.Written(store._current("t"), False, 0)
    assert files(store) == untouched


def test_full_buckets_double(spark, store):
    rng = random.Random(2)
    want = {}
    for step in range(4):
        rows = {rng.randrange(5000): f"s{step}" for _ in range(150)}
        store.merge_keyed("t", frame(spark, list(rows.items())), ["k"], capacity=40)
        want |= rows
        assert content(store) == sorted(want.items(), key=str)
        held = store.spark.read.parquet(store._current("t")).groupBy("_bucket").count().collect()
        assert all(r["count"] <= 40 for r in held)
    bits = {b for b, _ in names(store)}
    assert len(names(store)) > 8 and sum(2.0 ** -b for b, _ in names(store)) == 1 and max(bits) > 3


def test_a_bucket_is_never_lost_or_counted_twice(spark, store, tmp_path):
    import shutil

    store.merge_keyed("t", frame(spark, [(k, "a") for k in range(60)]), ["k"], capacity=200)
    root = pathlib.Path(store._current("t"))
    assert names(store) == [(0, 0)]
    shutil.copytree(root / "_bucket=d0b0", tmp_path / "old")
    store.merge_keyed("t", frame(spark, [(k, "b") for k in range(40, 100)]), ["k"], capacity=20)
    after = content(store)
    assert len(after) == 100
    shutil.copytree(tmp_path / "old", root / "_bucket=d0b0")  # the old bucket was not removed yet
    assert content(store) == after
    first = min(names(store), key=lambda b: (-b[0], b[1]))
    shutil.rmtree(root / keyed.folder_of(first))  # and not all new ones were written yet
    assert content(store) == [(k, "a") for k in sorted(range(60), key=lambda k: str((k, "a")))]
    store.merge_keyed("t", frame(spark, [(k, "b") for k in range(40, 100)]), ["k"], capacity=20)
    assert content(store) == after and (0, 0) not in names(store)


def test_live_buckets():
    assert keyed.live([]) == []
    assert keyed.live([(0, 0)]) == [(0, 0)]
    assert keyed.live([(0, 0), (1, 0)]) == [(0, 0)]
    assert keyed.live([(0, 0), (1, 0), (1, 1)]) == [(1, 0), (1, 1)]
    assert keyed.live([(1, 0), (1, 1), (30, 1), (2, 1), (2, 3)]) == [(1, 0), (2, 1), (2, 3)]
    assert keyed.live([(1, 0), (1, 1), (3, 1), (3, 5), (3, 3), (3, 7)]) == [(1, 0), (3, 1), (3, 3), (3, 5), (3, 7)]
    assert keyed.split([(1, 0), (1, 1)], {"d1b1": 30}, 10) == ([(1, 0), (4, 1), (4, 3), (4, 5), (4, 7), (4, 9), (4, 11), (4, 13), (4, 15)], [(1, 1)])


def test_new_columns_and_types_rewrite_the_table(spark, store):
    store.merge_keyed("t", frame(spark, [(k, "a") for k in range(50)]), ["k"], capacity=10)
    store.merge_keyed("t", spark.createDataFrame([(3, "b", 1.5)], "k int, v string, w double"), ["k"], capacity=10)
    assert store.read("t").columns == ["k", "v", "w"] and store.read("t").where("w is not null").count() == 1
    assert content(store) == sorted([(k, "b" if k == 3 else "a") for k in range(50)], key=str)
    store.replace("plain", frame(spark, [(1, "a")]))
    with pytest.raises(ValueError, match="full_refresh"):
        store.merge_keyed("plain", frame(spark, [(1, "a")]), ["k"])
    store.publish("plain", frame(spark, [(1, "b")]), mode="auto", keys=["k"], full_refresh=True)
    store.publish("plain", frame(spark, [(1, "c"), (2, "d")]), mode="auto", keys=["k"])
    assert content(store, "plain") == [(1, "c"), (2, "d")]


def test_merges_equal_whole_table_upserts(spark, store):
    rng = random.Random(9)
    whole = None
    for step in range(3):
        rows = [(rng.choice([None, *range(80)]), f"{step}-{i}", i) for i in range(60)]
        df = spark.createDataFrame(rows, "k long, v string, version int")
        store.merge_keyed("t", df, ["k"], 16, "latest", ["version"])
        whole = sinks.distinct_keys(df, ["k"], "latest", ["version"]) if whole is None else sinks.upsert(whole, df, ["k"], "latest", ["version"])
    assert content(store) == sorted((tuple(r) for r in whole.select("k", "v").collect()), key=str)
    assert store.publish("empty", frame(spark, []), mode="auto", keys=["k"], skip_if_empty=True).wrote is False
    store.publish("empty", frame(spark, []), mode="auto", keys=["k"])
    store.publish("empty", frame(spark, [(5, "x")]), mode="auto", keys=["k"])
    assert content(store, "empty") == [(5, "x")]
