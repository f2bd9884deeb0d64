"""Fetching pages on the executors.

Requests are rows; each task sends those of its partition through a transport and emits one row per
attempt. Fetching is not repeatable, so the attempts are written to a table before anything reads
them: audit rows, bronze rows and the failure check all come from that one copy, and a lost executor
repeats only the tasks that had not committed.

A transport is any picklable callable ``transport(request) -> Response``; it carries its own
credentials. No client is bundled.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import key_or_fallback, page_count
from tidemark.plans.layers import FETCHED, names
from tidemark.sources.journal import Journal

COLUMNS = names(FETCHED)
BATCH_ROWS, BATCH_CHARS = 200, 16_000_000

_ARROW_TYPES = {
    "string": pa.string(), "int": pa.int32(), "bigint": pa.int64(),
    "timestamp": pa.timestamp("us", tz="UTC"),
}
ARROW = pa.schema([(f.split()[0], _ARROW_TYPES[f.split()[1]]) for f in FETCHED.split(",")])


@dataclass(frozen=True)
class Response:
    status: int
    text: str
    headers: dict = field(default_factory=dict)


Transport = Callable[[dict], Response]


@dataclass(frozen=True)
class RetryPolicy:
    """Three tries with a growing pause; being rate limited waits as told and costs no try."""

    max_tries: int = 3
    base: float = 2.0
    ok: range = range(200, 205)
    rate_limited: int = 429
    default_wait: int = 5
    sleep: Callable[[float], None] = time.sleep

    def limit_waits(self) -> int:
        return 3 * self.max_tries

    def label(self, tries: int) -> str:
        return "RETRY" if tries < self.max_tries else "FAILED"

    def wait_for(self, response: Response) -> int:
        try:
            return int(response.headers.get("Retry-After", self.default_wait))
        except ValueError:
            return self.default_wait


def send(request: dict, transport: Transport, policy: RetryPolicy) -> Iterator[dict]:
    """All attempts at one request; the last one is SUCCESS or FAILED."""
    tries = waits = 0
    while tries < policy.max_tries:
        sent = datetime.now(timezone.utc)
        code = body = error = None
        try:
            response = transport(request)
            code, body = response.status, response.text
        except Exception as problem:
            error = str(problem)
        took = int((datetime.now(timezone.utc) - sent).total_seconds() * 1000)
        if code == policy.rate_limited and waits < policy.limit_waits():
            waits += 1
            policy.sleep(policy.wait_for(response))
            continue
        tries += 1
        good = code in policy.ok
        label = "SUCCESS" if good else policy.label(tries)
        if code == policy.rate_limited:
            error, label = f"gave up after {waits + 1} rate-limit responses", "FAILED"
        elif code is not None and not good:
            error = f"HTTP {code}"
        yield {
            **{c: request.get(c) for c in COLUMNS},
            "attempt_number": tries, "request_timestamp": sent, "response_code": code,
            "response_body": body, "duration_ms": took, "status": label, "error_message": error,
        }
        if good or label == "FAILED":
            return
        policy.sleep(policy.base**tries)


def crash_row(request: dict, problem: Exception) -> dict:
    """A row for a request lost to an unexpected error, so that audit and gate still see it."""
    return {
        **{c: request.get(c) for c in COLUMNS},
        "attempt_number": 1, "request_timestamp": datetime.now(timezone.utc), "duration_ms": 0,
        "status": "FAILED", "error_message": str(problem),
    }


def record_batches(rows: Iterable[dict | list[dict]], most: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """Attempts in small record batches: the task holds few pages at a time, however many it sends. Those
    that come as a list stay together."""
    held, chars = [], 0
    for row in rows:
        group = row if isinstance(row, list) else [row]
        held += group
        chars += sum(len(one.get("response_body") or "") for one in group)
        if len(held) >= most or chars >= BATCH_CHARS:
            yield pa.RecordBatch.from_pylist(held, ARROW)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, ARROW)


def _on_executors(
    requests: DataFrame, work: Callable[[dict], Iterator[dict]], in_flight: int, journal: str | None = None,
    journal_rows: int = BATCH_ROWS,
):
    """Send from ``in_flight`` tasks, which is the cap on open requests."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = Journal(journal, TaskContext.get().partitionId()) if journal else None

        def asked() -> Iterator[dict]:
            for batch in batches:
                for request in batch.to_pylist():
                    if sent is None or not sent.has(request):
                        yield request

        def rows() -> Iterator[dict]:
            for request in asked():
                yield from tried(request)

        def tried(request: dict) -> Iterator[dict]:
            try:
                yield from work(request)
            except Exception as problem:
                yield crash_row(request, problem)

        if sent is None:
            yield from record_batches(rows())
            return
        yield from sent.kept()
        for group in record_batches((list(tried(request)) for request in asked()), journal_rows):
            yield sent.write(group)

    return requests.repartition(in_flight).mapInArrow(run, FETCHED)


def fetch_pages(
    requests: DataFrame, transport: Transport, policy: RetryPolicy = RetryPolicy(),
    in_flight: int = 5, journal: str | None = None, journal_rows: int = BATCH_ROWS,
) -> DataFrame:
    """Send every request once (with retries); ``in_flight`` is the number of tasks sending.

    ``journal`` names a shared folder for this fetch: a task that runs again takes over what it had sent
    (``Journal``), in files of about ``journal_rows`` attempts. Read or write such a frame once.
    """
    return _on_executors(requests, lambda r: send(r, transport, policy), in_flight, journal, journal_rows)


def fetch_first_pages(
    requests: DataFrame, transport: Transport, policy: RetryPolicy = RetryPolicy(),
    in_flight: int = 5, total_key: str = "totalCount", short: int = 200,
) -> DataFrame:
    """Page 1 of each source, asked again while it answers with the error-in-disguise page."""

    return _on_executors(requests, lambda r: first_page(r, transport, policy, total_key, short), in_flight)


def first_page(
    request: dict, transport: Transport, policy: RetryPolicy, total_key: str = "totalCount", short: int = 200,
) -> Iterator[dict]:
    """All attempts at a page 1 that may be an error in disguise."""
    sent = 0  # attempts are numbered on over all turns of a request
    for turn in range(1, policy.max_tries + 1):
        last = None
        for attempt in send(request, transport, policy):
            if last:
                yield last
            sent += 1
            last = {**attempt, "attempt_number": sent}
        if last["status"] != "SUCCESS" or not _is_sentinel(last["response_body"], total_key, short):
            yield last
            return
        more = turn < policy.max_tries
        yield {
            **last, "status": policy.label(turn), "error_message": f"{total_key} is -1 in a short body",
        }
        if more:
            policy.sleep(policy.base**turn)


def _is_sentinel(body: str | None, total_key: str, short: int) -> bool:
    page = _json(body)
    return isinstance(page, dict) and page.get(total_key) == -1 and len(body) < short


def _json(text: str | None):
    try:
        return json.loads(text)
    except (TypeError, ValueError):
        return None


def next_link(body: str | None, paths: Sequence[str]) -> str | None:
    """The first link found at one of the paths; ``>`` separates the steps of a path."""
    for path in paths:
        node = _json(body)
        for step in path.split(">"):
            node = node.get(step) if isinstance(node, dict) else None
        if node:
            return node
    return None


# Where the services put the link to the next page.
NEXT_LINKS = ("@odata.nextLink", "nextLink", "d>__next")


def follow_cursor(
    seeds: DataFrame, transport: Transport, policy: RetryPolicy = RetryPolicy(),
    next_paths: Sequence[str] = NEXT_LINKS, in_flight: int = 5,
) -> DataFrame:
    """Follow next-page links from each seed until there is none or a page fails.

    A chain is sequential by nature, so each runs in one task; chains run side by side, and pages
    stream out of the task one by one. The request body goes out with the first page only: links
    carry their own parameters.
    """

    return _on_executors(seeds, lambda s: chain(s, transport, policy, next_paths), in_flight)


def chain(seed: dict, transport: Transport, policy: RetryPolicy, next_paths: Sequence[str]) -> Iterator[dict]:
    """All attempts at the pages of one chain, in order."""
    request, page, seen = dict(seed), 1, set()
    while request["api_url"]:
        request["page_no"] = page
        if request["api_url"] in seen:
            yield crash_row(request, ValueError("the chain of links comes back to a page it has had"))
            return
        seen.add(request["api_url"])
        last = None
        for last in send(request, transport, policy):
            yield last
        if last["status"] != "SUCCESS":
            return
        link = next_link(last["response_body"], next_paths)
        request, page = {**request, "api_url": link, "request_body": None}, page + 1


def plan_pages(
    first: DataFrame, step: int, total: str | Column = "total_count",
    modified_since: str | Column | None = None, start: int = 2, request: str | None = None,
) -> DataFrame:
    """The pages still to ask for, one row each.

    Pages are ceil(total / step), or 1 where the total is not positive. ``request`` names a JSON
    parameter column into which page, step and the mark are written; other parameters stay.
    """
    total = F.col(total) if isinstance(total, str) else total
    pages = F.when(total > 0, page_count(total, step)).otherwise(F.lit(1)).cast("int")
    planned = first.withColumn("total_pages", pages).where(F.col("total_pages") >= start)
    planned = planned.withColumn("page_no", F.explode(F.sequence(F.lit(start), "total_pages")))
    if modified_since is not None:
        mark = F.lit(modified_since) if isinstance(modified_since, str) else modified_since
        planned = planned.withColumn("modified_since", mark)
    if request:
        mark = None if modified_since is None else F.col("modified_since")
        planned = with_parameters(planned, request, step, F.col("page_no"), mark)
    return planned


def with_parameters(
    df: DataFrame, request: str, step: int, page: Column, modified_since: str | Column | None = None
) -> DataFrame:
    """Write step, page and the mark into a JSON parameter column, beside what it holds."""
    mark = F.lit(modified_since) if isinstance(modified_since, str) else modified_since
    own = {"step": F.lit(step), "page": page, **({} if mark is None else {"modifiedDate": mark})}
    kind = "map<string,variant>"
    held = F.col(request) if request in df.columns else F.lit("{}")
    before = F.coalesce(F.from_json(held, kind), F.from_json(F.lit("{}"), kind))
    kept = F.map_filter(before, lambda name, _: ~name.isin(*own))
    fresh = F.from_json(F.to_json(F.struct(*[c.alias(n) for n, c in own.items()])), kind)
    return df.withColumn(request, F.to_json(F.map_concat(fresh, kept)))


def fan_out_keys(
    df: DataFrame, key: str = "imoNr", fallback: str = "provisionalId", into: str = "input_value"
) -> DataFrame:
    """Distinct request keys: the key, or the fallback where it is 0; a NULL key asks for nothing."""
    known = df.where(F.col(key).isNotNull()).select(key, fallback).distinct()
    keys = known.select(key_or_fallback(key, fallback).alias(into))
    return keys.where(F.col(into).isNotNull()).distinct()


def fan_out(keys: DataFrame, url_template: str, source: str, key: str = "input_value") -> DataFrame:
    """One request per key; ``{}`` in the template takes the key."""
    head, tail = url_template.split("{}")
    return keys.select(
        F.concat_ws(":", F.lit(source), F.col(key)).alias("source"), F.lit(1).alias("page_no"),
        F.lit("GET").alias("http_method"),
        F.concat(F.lit(head), F.col(key), F.lit(tail)).alias("api_url"),
        F.col(key).alias("input_value"), F.lit(None).cast("string").alias("request_body"),
    )


def seed(
    df: DataFrame, source: str | Column, url: str | Column, body: Column | None = None,
    method: str = "GET",
) -> DataFrame:
    """Requests for the first page of each row of an endpoint catalogue."""
    return df.select(
        (F.lit(source) if isinstance(source, str) else source).alias("source"),
        F.lit(1).alias("page_no"), F.lit(method).alias("http_method"),
        (F.lit(url) if isinstance(url, str) else url).alias("api_url"),
        F.lit(None).cast("string").alias("input_value"),
        (F.lit(None) if body is None else body).cast("string").alias("request_body"),
    )
