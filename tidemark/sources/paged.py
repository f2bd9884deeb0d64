"""Paged services as Spark data sources: ``spark.read.format(name)`` and ``spark.readStream.format(name)``.

``paged_source`` makes a source for one service, ``chain_source`` one for services whose pages link to
the next. Both give the attempts of ``fetch`` (schema ``FETCHED``): one row per request sent, failed
ones included. Pages are planned on the driver, from the number of records each seed announces, and
asked for by the tasks; no page goes through the driver.

A stream counts records. Its offset is the number of records seen of each seed, so what a restarted
stream asks for follows from its checkpoint alone: full pages before the offset are never asked for
again, and a last page that was not full is asked for again once it has grown. The newest row of a
(source, page_no) is the page as it stands; ``land_stream`` gives every micro-batch its own batch id.

Seeds come as a list, are part of the source and must have different names; a service with more than
``MOST_SEEDS`` of them is a table of requests, for ``fetch.fetch_pages``.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import batches
from tidemark.operators.audit import attempts_to_audit, failed_requests, raise_on_failed, to_bronze
from tidemark.operators.select import BATCH
from tidemark.operators.sinks import Store
from tidemark.plans.layers import FETCHED
from tidemark.sources.fetch import (
    NEXT_LINKS, RetryPolicy, Transport, chain, crash_row, first_page, record_batches, send,
)
from tidemark.sources.ingest import FETCHED_TABLE, belongs_to
from tidemark.sources.tables import list_folder, partition_folder

MOST_SEEDS = 10_000
STREAM_AUDIT, STREAM_STEP = "audit_stream", "stream"

#: A request without its page: the columns of ``fetch.seed`` as a dictionary.
Seed = Mapping[str, object]


class Uncounted(RuntimeError):
    """A seed does not tell how many records it has."""


@dataclass(frozen=True)
class Service:
    """What both readers know: seeds, how to ask, and how many records make a page.

    ``count(seed)`` returns the number of records; by default one record is asked for and the total
    read from the answer. Such requests only plan pages and are no attempts; one that fails after all
    retries ends the read with ``Uncounted`` before a page is asked for.
    """

    seeds: tuple[dict, ...]
    transport: Transport
    step: int
    policy: RetryPolicy
    in_flight: int
    modified_since: str | None
    total_key: str
    count: Callable[[dict], int] | None

    def request(self, seed: dict, page: int, step: int | None = None) -> dict:
        """The request for a page: page, step and mark are written beside the parameters of the seed."""
        own = {"step": step or self.step, "page": page}
        if self.modified_since is not None:
            own["modifiedDate"] = self.modified_since
        held = json.loads(seed.get("request_body") or "{}")
        return {**seed, "page_no": page, "request_body": json.dumps({**held, **own}, separators=(",", ":"))}

    def total(self, seed: dict) -> int:
        if self.count:
            return max(0, self.count(seed))
        last = None
        for last in first_page(self.request(seed, 1, step=1), self.transport, self.policy, self.total_key):
            pass
        try:
            if last["status"] != "SUCCESS":
                raise ValueError(last["error_message"])
            return max(0, int(json.loads(last["response_body"])[self.total_key]))
        except (KeyError, TypeError, ValueError) as problem:
            raise Uncounted(f"{seed['source']}: no {self.total_key}: {problem}") from problem

    def totals(self) -> dict[str, int]:
        return {seed["source"]: self.total(seed) for seed in self.seeds}

    def plan(self, start: Mapping[str, int], end: Mapping[str, int]) -> list[Pages]:
        """Pages that hold records after ``start``, dealt evenly over at most ``in_flight`` tasks, which
        is the cap on open requests. A seed that has fewer records than before has nothing new."""
        runs = []
        for at, seed in enumerate(self.seeds):
            seen, total = start.get(seed["source"], 0), end.get(seed["source"], 0)
            if total > seen:
                runs.append((at, seen // self.step + 1, -(-total // self.step)))
        pages = sum(last - first + 1 for _, first, last in runs)
        share = max(1, -(-pages // self.in_flight))
        tasks: list[list[tuple[int, int, int]]] = []
        room = 0
        for at, first, last in runs:
            while first <= last:
                if not room:
                    tasks.append([])
                    room = share
                upto = min(last, first + room - 1)
                tasks[-1].append((at, first, upto))
                room -= upto - first + 1
                first = upto + 1
        return [Pages(tuple(runs)) for runs in tasks]

    def attempts(self, pages: Pages) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for at, first, last in pages.runs:
                for page in range(first, last + 1):
                    request = self.request(self.seeds[at], page)
                    try:
                        yield from send(request, self.transport, self.policy)
                    except Exception as problem:
                        yield crash_row(request, problem)

        return record_batches(rows())


class Pages(InputPartition):
    """Runs of pages (seed, first, last) for one task."""

    def __init__(self, runs: tuple[tuple[int, int, int], ...]):
        self.runs = runs


class Seeds(InputPartition):
    """Seeds whose chains one task follows, one after the other."""

    def __init__(self, numbers: tuple[int, ...]):
        self.numbers = numbers


class PagedReader(DataSourceReader):
    def __init__(self, service: Service):
        self.service = service

    def partitions(self) -> Sequence[InputPartition]:
        return self.service.plan({}, self.service.totals()) or [Pages(())]

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        return self.service.attempts(partition)


class PagedStream(DataSourceStreamReader):
    def __init__(self, service: Service):
        self.service = service

    def initialOffset(self) -> dict:
        return {seed["source"]: 0 for seed in self.service.seeds}

    def latestOffset(self) -> dict:
        return self.service.totals()

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return self.service.plan(start, end)

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        return self.service.attempts(partition)


def _checked(seeds: Sequence[Seed]) -> tuple[dict, ...]:
    names = [seed["source"] for seed in seeds]
    if len(names) > MOST_SEEDS:
        raise ValueError(f"{len(names)} seeds are more than {MOST_SEEDS}; use fetch.fetch_pages")
    if None in names or len(set(names)) < len(names):
        raise ValueError("every seed needs a source of its own")
    return tuple({"http_method": "GET", "input_value": None, "request_body": None, **seed} for seed in seeds)


def paged_source(
    spark: SparkSession, name: str, seeds: Sequence[Seed], transport: Transport, step: int,
    policy: RetryPolicy = RetryPolicy(), in_flight: int = 5, modified_since: str | None = None,
    total_key: str = "totalCount", count: Callable[[dict], int] | None = None,
) -> str:
    """Register a service of numbered pages under ``name``, for reading and for streaming."""
    if step < 1 or in_flight < 1:
        raise ValueError("step and in_flight are at least 1")
    service = Service(_checked(seeds), transport, step, policy, in_flight, modified_since, total_key, count)

    class Paged(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return FETCHED

        def reader(self, schema) -> DataSourceReader:
            return PagedReader(service)

        def streamReader(self, schema) -> DataSourceStreamReader:
            return PagedStream(service)

    spark.dataSource.register(Paged)
    return name


def chain_source(
    spark: SparkSession, name: str, seeds: Sequence[Seed], transport: Transport,
    policy: RetryPolicy = RetryPolicy(), next_paths: Sequence[str] = NEXT_LINKS, in_flight: int = 5,
) -> str:
    """Register services whose pages link to the next, for reading: chains run side by side in at most
    ``in_flight`` tasks. What comes next is known from the page before only, so there is no offset to
    plan a stream from."""
    checked = _checked(seeds)

    class ChainReader(DataSourceReader):
        def partitions(self) -> Sequence[InputPartition]:
            tasks = min(in_flight, len(checked)) or 1
            return [Seeds(tuple(range(task, len(checked), tasks))) for task in range(tasks)]

        def read(self, partition: Seeds) -> Iterator[pa.RecordBatch]:
            def rows() -> Iterator[dict]:
                for number in partition.numbers:
                    try:
                        yield from chain(checked[number], transport, policy, next_paths)
                    except Exception as problem:
                        yield crash_row(checked[number], problem)

            return record_batches(rows())

    class Chain(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return FETCHED

        def reader(self, schema) -> DataSourceReader:
            return ChainReader()

    spark.dataSource.register(Chain)
    return name


def land_stream(
    store: Store, name: str, bronze: Mapping[str, str], checkpoint: str, prefix: str = "stream",
    keep_failures: bool = False, records_path: str | None = None, tolerate: int = 0,
) -> StreamingQuery:
    """Land what is new since the last run, then stop: one batch per micro-batch of the stream.

    Every write replaces the partition of its batch, so a micro-batch that is given again leaves one
    copy, and one whose attempts had landed without a failure is not asked for again. A failed page
    ends the stream before bronze is touched; the checkpoint stays and the next run asks for the whole
    micro-batch again.
    """

    def land(attempts: DataFrame, epoch: int) -> None:
        batch = f"{prefix}-{epoch:010d}"
        home = partition_folder(store.path(FETCHED_TABLE), BATCH, batch)

        def copy() -> DataFrame:
            return store.read(FETCHED_TABLE).where((F.col(BATCH) == batch) & (F.col("_step") == STREAM_STEP))

        if not list_folder(store.spark, home) or failed_requests(copy()).count() > tolerate:
            rows = attempts.withColumns({BATCH: F.lit(batch), "_step": F.lit(STREAM_STEP)})
            if not store.replace_partitions(FETCHED_TABLE, rows, [BATCH, "_step"]).rows:
                return
        landed = copy()
        audit = attempts_to_audit(landed, batch, F.col("source"))
        store.replace_partitions(STREAM_AUDIT, audit, ["batch_run_id"])
        raise_on_failed(landed, tolerate=tolerate)
        for source, table in bronze.items():
            one = landed.where(belongs_to(source))
            pages = to_bronze(one, batch, F.current_timestamp(), keep_failures, records_path)
            if store.replace_partitions(table, pages, [BATCH]).rows:
                batches.recover(store, table, [partition_folder("", BATCH, batch)[1:]])

    if len(set(bronze.values())) < len(bronze):
        raise ValueError("every source of a stream needs a bronze table of its own")
    stream = store.spark.readStream.format(name).load()
    return stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
