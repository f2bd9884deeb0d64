"""Incremental runs against one full run, and what a failed run leaves behind."""

import json
import sys
from datetime import datetime, timedelta, timezone

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidemark.operators.sinks import Store
from tidemark.plans import normalise
from tidemark.sources import fetch, incremental
from tidemark.sources.fetch import Response

cloudpickle.register_pickle_by_value(sys.modules[__name__])
STEP = 3
SEED = "source string, page_no int, http_method string, api_url string, input_value string, request_body string"


def no_pause(seconds):
    return None


POLICY = fetch.RetryPolicy(sleep=no_pause)


class Register:
    """Vessels with the time they last changed, three to a page, from the asked time on."""

    def __init__(self, vessels, bad_page=None):
        self.vessels, self.bad_page = vessels, bad_page

    def __call__(self, request):
        asked = json.loads(request["request_body"])
        if asked["page"] == self.bad_page:
            return Response(500, "down")
        found = [(i, teu) for i, teu, at in self.vessels if at >= asked["modifiedDate"]]
        part = found[(asked["page"] - 1) * STEP : asked["page"] * STEP]
        return Response(200, json.dumps({"totalCount": len(found), "results": [{"vesselImo": i, "vesselTeu": teu} for i, teu in part]}))


OLD, LATER = "2020-01-01 00:00:00", (datetime.now(timezone.utc) + timedelta(hours=1)).strftime("%Y-%m-%d %H:%M:%S")
BEFORE = [(i, i, OLD) for i in range(1, 9)]
AFTER = [(i, 100 * i if i in (2, 5, 6, 7) else i, LATER if i in (2, 5, 6, 7) else OLD) for i in range(1, 9)] + [(20 + i, 1, LATER) for i in range(5)]


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "lake"))


@pytest.fixture
def go(spark, store):
    seeds = spark.createDataFrame([("v", 1, "GET", "u", None, '{"key": 1}')], SEED)
    country = spark.createDataFrame([], "flag string, mapped_flag string")

    def start(transport, batch, to=None, **how):
        make = lambda s, table: normalise.normalise_vessels(s, table, country, full_refresh=how.get("full_refresh", False))
        return incremental.run(to or store, seeds, transport, {"v": "axs"}, STEP, make, batch, policy=POLICY, **how)

    return start


def register(store):
    return sorted((r.imo, r.teu) for r in store.read("vessel_register").collect())


def marks(store):
    return [r.modified_since for r in incremental.latest_marks(store.read(incremental.MARKS)).collect()]


def asked(store, batch):
    log = store.read("audit").where(F.col("batch_run_id") == batch)
    return {json.loads(r.request_body)["modifiedDate"] for r in log.collect()}, log.count()


def test_two_runs_equal_one_full_run(spark, store, go, tmp_path):
    go(Register(BEFORE), "b1")
    assert register(store) == [(i, i) for i in range(1, 9)] and asked(store, "b1") == ({incremental.SINCE_EVER}, 3)
    first = marks(store)
    go(Register(AFTER), "b2")
    assert asked(store, "b2") == ({first[0].strftime("%Y-%m-%d %H:%M:%S")}, 3)  # nine changes, three pages
    whole = Store(spark, str(tmp_path / "whole"))
    go(Register(AFTER), "full", whole)
    assert register(store) == register(whole)
    assert marks(store) > first
    go(Register(AFTER), "b3", full_refresh=True)
    assert asked(store, "b3") == ({incremental.SINCE_EVER}, 5) and register(store) == register(whole)


def test_a_failed_page_leaves_the_mark_and_is_asked_again(store, go):
    go(Register(BEFORE), "b1")
    before, rows = marks(store), register(store)
    with pytest.raises(RuntimeError, match="1 request"):
        go(Register(AFTER, bad_page=2), "b2")
    assert marks(store) == before and register(store) == rows
    go(Register(AFTER), "b3")
    assert asked(store, "b3")[0] == asked(store, "b2")[0]
    assert register(store) == sorted((i, teu) for i, teu, _ in AFTER)
    states = {r._Batch_run_id: r.state for r in store.read("_processed_batches").collect()}
    assert states == {"b1": "processed", "b2": "superseded", "b3": "processed"}


def test_a_run_that_ends_before_its_mark_is_replayed(store, go, monkeypatch):
    go(Register(BEFORE), "b1")
    before = marks(store)

    def lost(*_):
        raise OSError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(incremental, "batch_marks", lost)
        with pytest.raises(OSError):
            go(Register(AFTER), "b2")
    assert marks(store) == before
    once = register(store)
    go(Register(AFTER), "b3")
    assert register(store) == once and asked(store, "b3") == asked(store, "b2")


def test_nothing_changed_moves_the_mark_only(store, go):
    go(Register(BEFORE), "b1")
    before, rows = marks(store), register(store)
    go(Register(BEFORE), "b2")
    assert marks(store) > before and register(store) == rows


def test_marks_never_go_back(spark):
    rows = spark.createDataFrame([("a", datetime(2024, 1, 2)), ("a", datetime(2024, 1, 1)), ("b", datetime(2023, 1, 1))], "source string, modified_since timestamp")
    assert {r.source: r.modified_since.day for r in incremental.latest_marks(rows).collect()} == {"a": 2, "b": 1}
