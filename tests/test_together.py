"""Tables published as one: what a crash leaves, what readers see, what is kept of old versions."""

from datetime import timedelta

import pytest

from test_plans import DOC, MORE, contract, pages
from tidemark.operators import batches, sinks
from tidemark.operators.sinks import Store, Written
from tidemark.plans import normalise
from tidemark.sources.tables import list_folder

NAMES = ("a", "b", "c")


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "lake"))


def frame(spark, value, rows=2):
    return spark.createDataFrame([(value, i) for i in range(rows)], "v string, i int")


def publish(spark, store, value, fail_at=None):
    with store.together() as group:
        for at, name in enumerate(NAMES):
            if at == fail_at:
                raise OSError("driver lost")
            group.replace(name, frame(spark, value))
            assert {r.v for r in group.read(name).collect()} == {value}
        if fail_at == len(NAMES):
            raise OSError("driver lost")


def seen(store):
    return [{r.v for r in store.read(name).collect()} for name in NAMES]


@pytest.mark.parametrize("fail_at", range(len(NAMES) + 1))
def test_a_crash_between_any_two_tables_shows_the_old_set(spark, store, fail_at):
    with pytest.raises(OSError):
        publish(spark, store, "never", fail_at)
    assert not any(store.exists(n) for n in NAMES)
    publish(spark, store, "old")
    with pytest.raises(OSError):
        publish(spark, store, "new", fail_at)
    assert seen(store) == [{"old"}] * 3
    publish(spark, store, "newer")
    assert seen(store) == [{"newer"}] * 3


def test_readers_see_one_publication(spark, store):
    publish(spark, store, "old")
    view = store.snapshot()
    first = view.read("a")
    with store.together() as group:
        for name in NAMES:
            group.replace(name, frame(spark, "new"))
            assert seen(store) == seen(store.snapshot()) == [{"old"}] * 3
    assert {r.v for r in first.collect()} == {"old"} and seen(view) == [{"old"}] * 3
    store.replace("b", frame(spark, "single"))
    assert seen(view) == [{"old"}] * 3 and seen(store) == [{"new"}, {"single"}, {"new"}]
    with pytest.raises(TypeError, match="read only"):
        view.replace("a", frame(spark, "x"))


def test_an_empty_table_of_a_group_keeps_its_old_version(spark, store):
    publish(spark, store, "old")
    with store.together() as group:
        group.replace("a", frame(spark, "new"))
        assert not group.replace("b", frame(spark, "new", 0), skip_if_empty=True).wrote
        group.replace("c", frame(spark, "new", 0))
    assert seen(store) == [{"new"}, {"old"}, set()]


def test_what_is_changed_in_place_is_refused(spark, store):
    store.append("log", frame(spark, "x"))
    with pytest.raises(TypeError, match="in place"), store.together() as group:
        group.append("log", frame(spark, "y"))
    store.publish("k", frame(spark, "x"), "auto", ["i"])
    with pytest.raises(TypeError, match="in place"), store.together() as group:
        group.publish("k", frame(spark, "y"), "auto", ["i"])
    with store.together() as group:
        group.publish("k", frame(spark, "y", 1), "auto", ["i"], full_refresh=True)
        assert store.read("k").count() == 2
    assert store.read("log").count() == 2 and [r.v for r in store.read("k").collect()] == ["y"]


def test_old_versions_expire(spark, store):
    for value in ("1", "2", "3"):
        publish(spark, store, value)
    with pytest.raises(OSError):
        publish(spark, store, "lost", 3)
    assert store.expire("a") == 0
    old = store.snapshot()
    assert store.expire("a", keep=2, older_than=timedelta(0)) == 2  # the first one, and that without a pointer
    assert seen(store) == seen(old) == [{"3"}] * 3
    assert len(list_folder(spark, store.path("a"))) == 2
    with pytest.raises(ValueError):
        store.expire("a", keep=0)


@pytest.mark.parametrize("at", [1, 10])
def test_a_crash_while_contracts_are_published(spark, store, monkeypatch, at):
    docs = spark.createDataFrame([("FX", "1924-05-01", "Named")], "fixture_ID string, extension_date string, crmd_name string")
    dim = spark.createDataFrame([("H1", 7000001)], "Hull_no string, imo bigint")
    names = ("charterparties_rates", "charterparties_extension", "charterparties", "charterparties_all")
    counts = lambda s: {n: s.read(n).count() for n in names}
    batches.land(store, "bronze", pages(spark, DOC, MORE), "b1")
    normalise.normalise_contracts(store, "bronze", docs, dim)
    before = counts(store)
    batches.land(store, "bronze", pages(spark, {"contracts": [contract(9, "charterparty")]}, batch="b2"), "b2")
    real, made = Store._write, []

    def fails(self, *args, **options) -> Written:
        if isinstance(self, sinks.Together):
            made.append(args[1])
            if len(made) > at:
                raise OSError("driver lost")
        return real(self, *args, **options)

    with monkeypatch.context() as m:
        m.setattr(Store, "_write", fails)
        with pytest.raises(OSError):
            normalise.normalise_contracts(store, "bronze", docs, dim)
    assert counts(store) == before and store.ledger("bronze").count() == 1
    if at == 10:
        normalise.normalise_contracts(store, "bronze", docs, dim)
        after = counts(store)
        assert after["charterparties"] == 1 and after["charterparties_all"] == 2  # with the declared option kept
        assert store.ledger("bronze").count() == 2
