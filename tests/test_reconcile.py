"""Counts of a batch from the service's total to the silver table."""

import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidemark.operators import reconcile
from tidemark.operators.sinks import Store
from tidemark.plans import normalise
from tidemark.sources import fetch, ingest
from tidemark.sources.fetch import Response

cloudpickle.register_pickle_by_value(sys.modules[__name__])
SEED = "source string, page_no int, http_method string, api_url string, input_value string, request_body string"


def no_pause(seconds):
    return None


class Service:
    def __init__(self, total, empty=(), bad=()):
        self.total, self.empty, self.bad = total, empty, bad

    def __call__(self, request):
        page = json.loads(request["request_body"])["page"]
        if page in self.bad:
            return Response(500, "down")
        found = [{"vesselImo": i} for i in range(self.total)][(page - 1) * 3 : page * 3]
        return Response(200, json.dumps({"totalCount": self.total, "results": [] if page in self.empty else found}))


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "lake"))


def run(spark, store, batch, service, sources=("v",), **how):
    seeds = spark.createDataFrame([(s, 1, "GET", "u", None, None) for s in sources], SEED)
    return ingest.ingest_paged(store, seeds, service, {s: "axs" for s in sources}, 3, batch, fetch.RetryPolicy(sleep=no_pause), **how)


def told(store):
    rows = reconcile.reconcile(store, "axs").collect()
    return {r[0]: tuple(r)[1:] for r in rows}


def normalised(spark, store):
    normalise.normalise_vessels(store, "axs", spark.createDataFrame([], "flag string, mapped_flag string"), choose="all")


def test_a_lost_page_shows(spark, store):
    run(spark, store, "whole", Service(8))
    run(spark, store, "lost", Service(8, empty=(2,)))
    run(spark, store, "failed", Service(8, bad=(3,)), tolerate=1)
    with pytest.raises(RuntimeError):
        run(spark, store, "stopped", Service(8, bad=(3,)))
    run(spark, store, "none", Service(0))
    assert told(store) == {
        "whole": (8, 3, 8, None, None, None, "open"), "lost": (8, 2, 5, None, None, None, "pages lost"),
        "failed": (8, 2, 6, None, None, None, "pages lost"), "stopped": (8, 2, 6, None, None, None, "pages lost"),
        "none": (None, 0, None, None, None, None, "open"),
    }


def test_sources_of_one_table_add_up(spark, store):
    assert run(spark, store, "b", Service(4), ("v", "w"))["axs"] == 4
    assert told(store)["b"] == (8, 4, 8, None, None, None, "open")


def test_normalised_batches_are_whole(spark, store):
    run(spark, store, "b", Service(7))
    normalised(spark, store)
    assert told(store) == {"b": (7, 3, 7, 7, 0, None, "whole")}
    reconcile.record(store, "axs", "b", {reconcile.PARSED: 6})  # a later count replaces the one before
    assert told(store)["b"][-1] == "records lost"


def test_verdicts(spark):
    rows = [
        (None, 1, 5, 5, 0, 5, "whole"), (5, 1, 5, 5, None, None, "whole"), (5, 1, 5, None, None, None, "open"),
        (6, 1, 5, 5, 0, 5, "pages lost"), (5, 1, 5, 3, 1, 3, "records lost"), (5, 1, 5, 4, 1, 4, "rejects"),
        (5, 1, 5, 5, 0, 4, "not published"), (0, 0, 0, 0, 0, 0, "whole"), (None, None, None, None, None, None, "open"),
    ]
    ddl = ", ".join(f"{s} bigint" for s in reconcile.STAGES) + ", want string"
    got = spark.createDataFrame(rows, ddl).select("want", reconcile.verdict().alias("got")).collect()
    assert all(r.want == r.got for r in got)
    assert spark.createDataFrame([], ddl).select(reconcile.verdict()).count() == 0


def test_counting_takes_no_job_of_its_own(spark, store):
    """Counts of landing come with the write of the pages: no further pass over them."""
    status = spark.sparkContext.statusTracker()
    pages = spark.createDataFrame([('{"totalCount": 1, "results": [1]}', '{"page_no": 1}', False, "b")], "Raw_data string, Api_metadata string, _is_normalized boolean, _Batch_run_id string")
    counts = []
    for watch in (None, reconcile.page_metrics("$.results")):
        spark.sparkContext.setJobGroup(f"watch-{bool(watch)}", "")
        done = store.append(f"t{bool(watch)}", pages.withColumn("x", F.lit(1)), watch=watch)
        counts.append(len(status.getJobIdsForGroup(f"watch-{bool(watch)}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts[0] == counts[1] and (done.seen["announced"], done.seen["landed"]) == (1, 1)
