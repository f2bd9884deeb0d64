"""Fetching through in-process transports: no server, no port."""

import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidemark.operators import audit
from tidemark.operators.sinks import Store
from tidemark.sources import fetch, ingest
from tidemark.sources.fetch import Response

# Tasks cannot import test modules, so transports are shipped whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def no_pause(seconds):
    return None


POLICY = fetch.RetryPolicy(sleep=no_pause)


class Scripted:
    """Answers by url from a list of (status, text) or exceptions; the last one repeats."""

    def __init__(self, script):
        self.script, self.calls = script, {}

    def __call__(self, request):
        url = request["api_url"]
        n = self.calls[url] = self.calls.get(url, 0) + 1
        answer = self.script[url][min(n, len(self.script[url])) - 1]
        if isinstance(answer, Exception):
            raise answer
        return Response(*answer)


def attempts(script, url="u", policy=POLICY):
    return list(fetch.send({"source": "s", "page_no": 1, "api_url": url}, Scripted(script), policy))


def shape(found):
    return [(a["attempt_number"], a["status"], a["response_code"]) for a in found]


def test_first_try():
    assert shape(attempts({"u": [(204, "")]})) == [(1, "SUCCESS", 204)]


def test_retry_then_success():
    assert shape(attempts({"u": [(500, ""), (200, "x")]})) == [(1, "RETRY", 500), (2, "SUCCESS", 200)]


def test_all_tries_fail():
    found = attempts({"u": [(500, "a"), TimeoutError("slow"), (404, "c")]})
    assert shape(found) == [(1, "RETRY", 500), (2, "RETRY", None), (3, "FAILED", 404)]
    assert [a["error_message"] for a in found] == ["HTTP 500", "slow", "HTTP 404"]


def test_rate_limit_costs_no_try():
    limited = [(429, "", {"Retry-After": "7"})] * 2 + [(429, "", {"Retry-After": "later"})] + [(200, "x")]
    waits = []
    found = attempts({"u": limited}, policy=fetch.RetryPolicy(sleep=waits.append))
    assert shape(found) == [(1, "SUCCESS", 200)] and waits == [7, 7, 5]


def test_endless_rate_limit_gives_up_after_nine_waits():
    waits = []
    found = attempts({"u": [(429, "no")]}, policy=fetch.RetryPolicy(sleep=waits.append))
    assert shape(found) == [(1, "FAILED", 429)] and len(waits) == 9


def test_pauses_grow():
    waits = []
    attempts({"u": [(500, "")]}, policy=fetch.RetryPolicy(base=1.5, sleep=waits.append))
    assert waits == [1.5, 2.25]


@pytest.mark.parametrize("body,want", [
    ('{"@odata.nextLink": "a"}', "a"), ('{"nextLink": "b"}', "b"), ('{"d": {"__next": "c"}}', "c"),
    ('{"d": []}', None), ("[]", None), ("text", None), (None, None),
])
def test_next_link(body, want):
    assert fetch.next_link(body, fetch.NEXT_LINKS) == want


SEED = "source string, page_no int, http_method string, api_url string, input_value string, request_body string"


def seeds(spark, *urls):
    return spark.createDataFrame([(u, 1, "GET", u, None, '{"first": 1}') for u in urls], SEED)


def test_cursor_chains_of_one_three_and_broken(spark):
    def page(link):
        return [(200, json.dumps({"value": [1], **({"nextLink": link} if link else {})}))]

    script = {
        "one": page(None), "a": page("a2"), "a2": page("a3"), "a3": page(None),
        "x": page("x2"), "x2": [(500, "")], "x3": page(None),
    }
    got = fetch.follow_cursor(seeds(spark, "one", "a", "x"), Scripted(script), POLICY).collect()
    pages = sorted((r.source, r.page_no, r.status) for r in got if r.status != "RETRY")
    assert pages == [("a", 1, "SUCCESS"), ("a", 2, "SUCCESS"), ("a", 3, "SUCCESS"), ("one", 1, "SUCCESS"),
                     ("x", 1, "SUCCESS"), ("x", 2, "FAILED")]
    assert {r.request_body for r in got if r.page_no == 1} == {'{"first": 1}'}
    assert {r.request_body for r in got if r.page_no > 1} == {None}


class Crashing:
    def __call__(self, request):
        return None


def test_crashed_worker_leaves_a_row(spark):
    row = fetch.fetch_pages(seeds(spark, "u"), Crashing(), POLICY).collect()
    assert [r.status for r in row][-1] == "FAILED"


@pytest.mark.parametrize("total,pages", [(0, []), (-1, []), (200, []), (201, [2]), (601, [2, 3, 4])])
def test_page_plan(spark, total, pages):
    df = spark.createDataFrame([("s", total)], "source string, total_count int")
    plan = fetch.plan_pages(df, 200, modified_since="2024-01-01", request="body")
    got = plan.orderBy("page_no").collect()
    assert [r.page_no for r in got] == pages
    assert all(json.loads(r.body) == {"step": 200, "page": r.page_no, "modifiedDate": "2024-01-01"} for r in got)


def test_fan_out(spark):
    df = spark.createDataFrame([(1, "P1"), (1, "P9"), (0, "P2"), (None, "P3"), (0, None)], "imoNr int, provisionalId string")
    keys = fetch.fan_out_keys(df)
    got = fetch.fan_out(keys, "https://x/ships/{}/properties", "props").orderBy("api_url").collect()
    assert [r.api_url for r in got] == ["https://x/ships/1/properties", "https://x/ships/P2/properties"]
    assert [r.source for r in got] == ["props:1", "props:P2"]


# -- end to end ----------------------------------------------------------------------------------


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "lake"))


class Paged:
    """451 records at 200 to a page; page 1 answers with an error in disguise first."""

    def __init__(self, bad_page=None, sick=1):
        self.bad_page, self.sick, self.asked = bad_page, sick, 0

    def __call__(self, request):
        page = request["page_no"]
        if page == 1:
            self.asked += 1
            if self.asked <= self.sick:
                return Response(200, '{"totalCount": -1}')
        if page == self.bad_page:
            return Response(500, "broken")
        body = {"totalCount": 451, "results": [] if page == 2 else [{"vesselImo": page}], "token": "secret"}
        return Response(200, json.dumps(body))


def test_paged_ingest(spark, store):
    rows = ingest.ingest_paged(store, seeds(spark, "v"), Paged(), {"v": "vessels"}, 200, "b1", POLICY)
    assert rows == {"audit": 4, "vessels": 2}
    log = store.read("audit")
    assert log.where("status = 'RETRY' AND error_message LIKE 'totalCount is -1%'").count() == 1
    assert log.where("response_body LIKE '%secret%'").count() == 0
    assert log.where("batch_run_id = 'b1' AND EventID IS NOT NULL").count() == 4
    assert sorted(r[0] for r in store.read("vessels").select(F.get_json_object("Api_metadata", "$.page_no")).collect()) == ["1", "3"]


def test_paged_ingest_lands_then_fails(spark, store):
    with pytest.raises(RuntimeError, match="1 request"):
        ingest.ingest_paged(store, seeds(spark, "v"), Paged(bad_page=3), {"v": "vessels"}, 200, "b1", POLICY)
    assert store.read("vessels").count() == 1 and store.read("audit").where("status = 'FAILED'").count() == 1


def test_sentinel_that_never_clears_fails(spark, store):
    with pytest.raises(RuntimeError):
        ingest.ingest_paged(store, seeds(spark, "v"), Paged(sick=9), {"v": "vessels"}, 200, "b1", POLICY)
    assert [r.status for r in store.read("audit").orderBy("attempt_number").collect()] == ["RETRY", "RETRY", "FAILED"]


def test_endpoint_catalogue(spark, store):
    script = {"https://x/a": [(200, "[1]")], "https://x/b": [(404, "gone")], "https://x/c": [(200, "[]")]}
    catalogue = spark.createDataFrame([("a", "https://x/a"), ("b", "https://x/b"), ("c", "https://x/c")], "source string, api_url string")
    with pytest.raises(RuntimeError, match="1 of them refused"):
        ingest.ingest_endpoints(store, catalogue, Scripted(script), {"a": "bronze_a", "b": "bronze_b", "c": "bronze_c"}, "b1",
                                fetch.RetryPolicy(base=1.5, sleep=no_pause))
    assert store.read("audit").count() == 5
    assert [(r.Raw_data, r._is_normalized) for r in store.read("bronze_a").collect()] == [("[1]", False)]
    assert [(r.Raw_data, r._is_normalized) for r in store.read("bronze_b").collect()] == [("gone", True)]
    status = {r.source: r.status for r in audit.source_status(ingest.landed(store, "b1")).collect()}
    assert status == {"a": "SUCCESS", "b": "FAILED", "c": "EMPTY"}


def test_partial_chain_is_partial(spark, store):
    script = {"x": [(200, '{"value": [1], "nextLink": "x2"}')], "x2": [(500, "")]}
    got = ingest.land(store, fetch.follow_cursor(seeds(spark, "x"), Scripted(script), POLICY), "b1", "s")
    assert audit.source_status(got).first().status == "PARTIAL"


def test_keys_with_tolerance(spark, store):
    script = {"https://x/1": [(200, '{"uuid": "u"}')], "https://x/2": [(500, "")]}
    keys = spark.createDataFrame([("1",), ("2",)], "input_value string")
    rows = ingest.ingest_keys(store, keys, "https://x/{}", "props", Scripted(script), "props", "b1", POLICY, tolerate=1)
    assert rows == {"audit": 4, "props": 2}
    got = {r.ImoNr: r._is_normalized for r in store.read("props").collect()}
    assert got == {"1": False, "2": True}


def test_each_request_is_sent_once(spark, store, tmp_path):
    """Audit, bronze and the gate read the landed copy: the service is not asked again."""
    seen = tmp_path / "seen"
    seen.mkdir()

    def transport(request, folder=str(seen)):
        import os, uuid

        open(os.path.join(folder, uuid.uuid4().hex), "w").close()
        return Response(200, "[1]")

    catalogue = spark.createDataFrame([("a", "https://x/a")], "source string, api_url string")
    ingest.ingest_endpoints(store, catalogue, transport, {"a": "bronze_a"}, "b1", POLICY)
    assert len(list(seen.iterdir())) == 1


class Relapsing:
    """Busy twice, then an error in disguise, then a good page."""

    def __init__(self):
        self.n = 0

    def __call__(self, request):
        self.n += 1
        if self.n <= 2:
            return Response(503, "busy")
        return Response(200, '{"totalCount": -1}' if self.n == 3 else '{"totalCount": 1, "results": [1]}')


def test_attempts_are_numbered_on_over_all_turns(spark, store):
    rows = ingest.ingest_paged(store, seeds(spark, "v"), Relapsing(), {"v": "vessels"}, 200, "b1", POLICY)
    assert rows["vessels"] == 1
    tries = store.read("audit").select("attempt_number", "status").orderBy("attempt_number").collect()
    assert [r.attempt_number for r in tries] == [1, 2, 3, 4] and tries[-1].status == "SUCCESS"


def test_the_mark_reaches_page_one_beside_the_seeds_own_parameters(spark, store):
    own = seeds(spark, "v").withColumn("request_body", F.lit('{"fleet": {"id": 7}}'))
    ingest.ingest_paged(store, own, Paged(), {"v": "vessels"}, 200, "b1", POLICY, modified_since="2024-01-01")
    bodies = [json.loads(r.request_body) for r in store.read("audit").collect()]
    assert len(bodies) > 1 and all(b["modifiedDate"] == "2024-01-01" and b["fleet"] == {"id": 7} for b in bodies)
    assert {b["page"] for b in bodies} >= {1, 2}


def test_a_source_without_a_table_is_refused_before_fetching(spark, store):
    with pytest.raises(ValueError, match="'w'"):
        ingest.ingest_paged(store, seeds(spark, "v").union(seeds(spark, "w")), Paged(), {"v": "vessels"}, 200, "b1", POLICY)
    assert not store.exists("audit")


def test_a_chain_that_comes_back_ends(spark):
    link = lambda request: Response(200, '{"value": [1], "nextLink": "https://x.test/v"}')
    tries = fetch.follow_cursor(seeds(spark, "v").withColumn("api_url", F.lit("https://x.test/v")), link, POLICY).collect()
    assert [t.status for t in tries] == ["SUCCESS", "FAILED"]
