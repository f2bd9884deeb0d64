"""Paged services as data sources: the same attempts by batch and by stream, and what a restart asks for."""

import json
import sys
from collections import Counter

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidemark.operators import batches
from tidemark.operators.sinks import Store
from tidemark.sources import fetch, ingest, paged
from tidemark.sources.fetch import Response

cloudpickle.register_pickle_by_value(sys.modules[__name__])
STEP = 4
SEEDS = [{"source": s, "api_url": f"http://{s}", "request_body": '{"key":1}'} for s in ("a", "b", "c")]


def no_pause(seconds):
    return None


POLICY = fetch.RetryPolicy(sleep=no_pause)


class Service:
    """Records of each source as a folder of files tells, and a log of the pages asked for."""

    def __init__(self, folder):
        self.folder = str(folder)

    def set(self, bad=None, **records):
        with open(f"{self.folder}/state", "w") as f:
            json.dump({"records": records, "bad": bad}, f)

    def __call__(self, request):
        with open(f"{self.folder}/state") as f:
            state = json.load(f)
        asked, source = json.loads(request["request_body"]), request["source"]
        assert asked["key"] == 1
        total = state["records"][source]
        if asked["step"] == STEP:
            with open(f"{self.folder}/log", "a") as f:
                f.write(f"{source}{asked['page']}\n")
            if state["bad"] == f"{source}{asked['page']}":
                return Response(500, "down")
        rows = [{"id": f"{source}{i}"} for i in range(total)][(asked["page"] - 1) * asked["step"] : asked["page"] * asked["step"]]
        return Response(200, json.dumps({"totalCount": total, "results": rows}))

    def asked(self):
        """Pages asked for since the last call."""
        try:
            with open(f"{self.folder}/log") as f:
                pages = f.read().split()
        except FileNotFoundError:
            pages = []
        open(f"{self.folder}/log", "w").close()
        return dict(Counter(pages))


@pytest.fixture
def service(tmp_path):
    (tmp_path / "service").mkdir()
    return Service(tmp_path / "service")


@pytest.fixture
def source(spark, service, request):
    name = "paged_" + "".join(c if c.isalnum() else "_" for c in request.node.name)
    return paged.paged_source(spark, name, SEEDS, service, STEP, POLICY, in_flight=3)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "lake"))


SHOWN = ("source", "page_no", "http_method", "api_url", "request_body", "attempt_number", "status", "response_code", "response_body")


def attempts(df):
    return sorted(tuple(r) for r in df.select(*SHOWN).collect())


def stream(store, source, tmp_path, **how):
    bronze = {s["source"]: f"bronze_{s['source']}" for s in SEEDS}
    query = paged.land_stream(store, source, bronze, str(tmp_path / "checkpoint"), records_path="$.results", **how)
    query.awaitTermination(120)
    assert not query.isActive


def ids(store, source):
    rows = store.read(f"bronze_{source}").select(F.explode(F.from_json("Raw_data", "results array<struct<id string>>").results.id))
    return sorted(r[0] for r in rows.collect())


def test_batch_and_stream_give_the_same_attempts(spark, store, source, service, tmp_path):
    service.set(a=10, b=0, c=4)
    read = spark.read.format(source).load()
    assert read.rdd.getNumPartitions() == 2  # four pages over at most three tasks, two each
    found = attempts(read)
    assert [(r[0], r[1], r[6]) for r in found] == [("a", 1, "SUCCESS"), ("a", 2, "SUCCESS"), ("a", 3, "SUCCESS"), ("c", 1, "SUCCESS")]
    service.asked()
    stream(store, source, tmp_path)
    assert attempts(store.read(ingest.FETCHED_TABLE)) == found
    assert service.asked() == {"a1": 1, "a2": 1, "a3": 1, "c1": 1}
    # Also those of the table way: page 1 first, then the pages planned from it.
    seeds = spark.createDataFrame([(s["source"], 1, "GET", s["api_url"], None, s["request_body"]) for s in SEEDS],
                                  "source string, page_no int, http_method string, api_url string, input_value string, request_body string")
    ingest.ingest_paged(store, seeds, service, {s["source"]: "x_" + s["source"] for s in SEEDS}, STEP, "table", POLICY, records_path="$.results")
    rows = store.read(ingest.FETCHED_TABLE).where(F.col("_Batch_run_id") == "table")
    assert {(r.source, r.page_no, r.response_body) for r in rows.where("source <> 'b'").collect()} == {(r[0], r[1], r[8]) for r in found}


def test_a_restart_asks_for_no_page_twice(store, source, service, tmp_path):
    service.set(a=8, b=3, c=0)
    stream(store, source, tmp_path)
    assert service.asked() == {"a1": 1, "a2": 1, "b1": 1}
    stream(store, source, tmp_path)
    assert service.asked() == {}
    service.set(a=13, b=3, c=2)
    stream(store, source, tmp_path)
    assert service.asked() == {"a3": 1, "a4": 1, "c1": 1}
    service.set(a=13, b=6, c=1)  # a page that was not full has grown, another source has shrunk
    stream(store, source, tmp_path)
    assert service.asked() == {"b1": 1, "b2": 1}
    assert ids(store, "a") == sorted(f"a{i}" for i in range(13)) and set(ids(store, "b")) == {f"b{i}" for i in range(6)}
    found = batches.entries(store, "bronze_a").collect()
    assert sorted((r._Batch_run_id, r.pages) for r in found) == [("stream-0000000000", 2), ("stream-0000000001", 2)]


def test_a_failed_page_is_asked_again_and_lands_once(store, source, service, tmp_path):
    service.set(bad="a2", a=9, b=1, c=0)
    with pytest.raises(Exception, match="1 request"):
        stream(store, source, tmp_path)
    assert service.asked() == {"a1": 1, "a2": 3, "a3": 1, "b1": 1}
    assert not store.exists("bronze_a") and store.read(paged.STREAM_AUDIT).where("status = 'FAILED'").count() == 1
    service.set(a=9, b=1, c=0)
    stream(store, source, tmp_path)
    assert service.asked() == {"a1": 1, "a2": 1, "a3": 1, "b1": 1}
    assert ids(store, "a") == sorted(f"a{i}" for i in range(9)) and store.read(paged.STREAM_AUDIT).count() == 4


def test_a_micro_batch_that_comes_again_is_not_asked_again(store, source, service, tmp_path, monkeypatch):
    service.set(a=5, b=1, c=0)

    def lost(*_):
        raise OSError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(batches, "recover", lost)
        with pytest.raises(Exception, match="driver lost"):
            stream(store, source, tmp_path)
    assert sum(service.asked().values()) == 3
    stream(store, source, tmp_path)
    assert service.asked() == {}
    assert ids(store, "a") == [f"a{i}" for i in range(5)] and ids(store, "b") == ["b0"]
    assert batches.entries(store, "bronze_a").count() == 1 and store.read(paged.STREAM_AUDIT).count() == 3


def test_a_service_that_does_not_count_ends_the_read(spark):
    broken = [lambda r: Response(500, "down"), lambda r: Response(200, "{}"), lambda r: Response(200, '{"totalCount": -1}')]
    for number, transport in enumerate(broken):
        name = paged.paged_source(spark, f"uncounted_{number}", SEEDS[:1], transport, STEP, POLICY)
        with pytest.raises(Exception, match="no totalCount"):
            spark.read.format(name).load().collect()


def test_nothing_to_read(spark, source, service):
    service.set(a=0, b=0, c=0)
    assert spark.read.format(source).load().count() == 0
    empty = paged.paged_source(spark, "no_seeds", [], service, STEP, POLICY)
    assert spark.read.format(empty).load().count() == 0


def test_seeds_are_checked(spark, service):
    for seeds in ([SEEDS[0], SEEDS[0]], [{"source": None}], [{"source": str(i)} for i in range(paged.MOST_SEEDS + 1)]):
        with pytest.raises(ValueError):
            paged.paged_source(spark, "bad", seeds, service, STEP)


def test_chains_equal_those_of_the_table_way(spark):
    def transport(request):
        source, page = request["api_url"].split("/")
        link = f"{source}/{int(page) + 1}" if int(page) < 3 else None
        if request["api_url"] == "b/2":
            return Response(404, "gone")
        return Response(200, json.dumps({"value": [page], "@odata.nextLink": "d/1" if source == "d" else link}))

    seeds = [{"source": s, "api_url": f"{s}/1"} for s in "abcd"]
    name = paged.chain_source(spark, "chains", seeds, transport, POLICY, in_flight=3)
    read = spark.read.format(name).load()
    table = spark.createDataFrame([(s["source"], 1, "GET", s["api_url"], None, None) for s in seeds],
                                  "source string, page_no int, http_method string, api_url string, input_value string, request_body string")
    key = ("source", "page_no", "attempt_number", "status")
    rows = lambda df: sorted(tuple(r) for r in df.select(*key).collect())
    assert read.rdd.getNumPartitions() == 3
    assert rows(read) == rows(fetch.follow_cursor(table, transport, POLICY))
    assert ("d", 2, 1, "FAILED") in rows(read) and ("a", 3, 1, "SUCCESS") in rows(read)
