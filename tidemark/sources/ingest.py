"""From request rows to landed audit and bronze tables."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import or_
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import batches, reconcile
from tidemark.operators.audit import attempts_to_audit, raise_on_failed, to_bronze
from tidemark.operators.select import BATCH
from tidemark.operators.sinks import Store
from tidemark.session import shared_folder
from tidemark.sources.fetch import (
    NEXT_LINKS, RetryPolicy, Transport, fan_out, fetch_first_pages, fetch_pages, follow_cursor,
    plan_pages, seed, with_parameters,
)
from tidemark.sources.tables import remove_folder

FETCHED_TABLE, AUDIT_TABLE, FAILED_TABLE = "_fetched", "audit", "failed_requests"


def new_batch_id() -> str:
    return str(uuid4())


def land(store: Store, fetched: DataFrame, batch_id: str, step: str) -> DataFrame:
    """Write fetched attempts once and read them back; every later step works on that copy."""
    rows = fetched.withColumns({BATCH: F.lit(batch_id), "_step": F.lit(step)})
    store.append(FETCHED_TABLE, rows, partition_by=[BATCH, "_step"])
    return landed(store, batch_id).where(F.col("_step") == step)


@contextmanager
def journal(store: Store, batch_id: str) -> Iterator[str]:
    """A folder for the journal of one fetch, deleted when its attempts have landed, or have not."""
    folder = f"{shared_folder(store.spark)}/tidemark-journal/{batch_id}-{uuid4().hex}"
    try:
        yield folder
    finally:
        remove_folder(store.spark, folder)


def landed(store: Store, batch_id: str) -> DataFrame:
    return store.read(FETCHED_TABLE).where(F.col(BATCH) == batch_id)


def flush(
    store: Store, attempts: DataFrame, batch_id: str, bronze: Mapping[str, str],
    records_path: str | None = None, keep_failures: bool = False, key: str | None = None,
    context: str | None = None, body_chars: int | None = None, tolerate: int = 0,
    ingestion_ts: Column | None = None, gate: bool = True, total_path: str = "$.totalCount",
) -> dict[str, int]:
    """Audit first, then bronze, then the failure gate; one write per table.

    ``bronze`` maps each source to its bronze table. What the service announced and what landed is
    counted by the write (``reconcile``). Returns rows written per table.
    """
    audit = attempts_to_audit(attempts, batch_id, F.col("source"), context, body_chars)
    rows = {AUDIT_TABLE: store.append(AUDIT_TABLE, audit, evolve=True).rows}
    now = F.current_timestamp() if ingestion_ts is None else ingestion_ts
    for source, table in bronze.items():
        one = attempts.where(belongs_to(source))
        pages = to_bronze(one, batch_id, now, keep_failures, records_path, key)
        done = batches.land(store, table, pages, batch_id, watch=reconcile.page_metrics(records_path, total_path))
        reconcile.record(store, table, batch_id, {s: done.seen[s] for s in reconcile.ON_LANDING}, source)
        rows[table] = rows.get(table, 0) + done.rows
    if gate:
        def listed(failed: DataFrame) -> str:
            return store.append(FAILED_TABLE, failed.withColumn(BATCH, F.lit(batch_id)), evolve=True).path

        raise_on_failed(attempts, tolerate=tolerate, report=listed)
    return rows


def belongs_to(source: str) -> Column:
    """Rows of a source, or of one of its keys (written ``source:key``)."""
    return (F.col("source") == source) | F.col("source").startswith(f"{source}:")


def require_tables(requests: DataFrame, bronze: Mapping[str, str]) -> None:
    """Refuse to fetch what has no table to land in."""
    known = reduce(or_, [belongs_to(source) for source in bronze], F.lit(False))
    lost = [r["source"] for r in requests.where(~known | F.col("source").isNull()).select("source").distinct().collect()]
    if lost:
        raise ValueError(f"no bronze table for source(s) {sorted(map(str, lost))}")


def ingest_endpoints(
    store: Store, catalogue: DataFrame, transport: Transport, bronze: Mapping[str, str],
    batch_id: str, policy: RetryPolicy = RetryPolicy(base=1.5),
    next_paths: Sequence[str] = NEXT_LINKS, in_flight: int = 5, **how,
) -> dict[str, int]:
    """Run every endpoint of a catalogue (``source``, ``api_url``), each into its bronze table."""
    seeds = seed(catalogue, F.col("source"), F.col("api_url"))
    require_tables(seeds, bronze)
    fetched = follow_cursor(seeds, transport, policy, next_paths, in_flight)
    attempts = land(store, fetched, batch_id, "endpoints")
    return flush(store, attempts, batch_id, bronze, **{"keep_failures": True, **how})


def ingest_paged(
    store: Store, seeds: DataFrame, transport: Transport, bronze: Mapping[str, str], step: int,
    batch_id: str, policy: RetryPolicy = RetryPolicy(), in_flight: int = 5,
    modified_since: str | None = None, total_path: str = "$.totalCount",
    records_path: str = "$.results", **how,
) -> dict[str, int]:
    """Page 1 of each source tells how many pages there are; the rest are then sent side by side.

    Page, step and the mark are written into the parameters of every request, page 1 included, beside
    those the seed brings; so the number of pages is that of the changes asked for.
    """
    require_tables(seeds, bronze)
    seeds = with_parameters(seeds, "request_body", step, F.col("page_no"), modified_since)
    fetched = fetch_first_pages(seeds, transport, policy, in_flight)
    first = land(store, fetched, batch_id, "first")
    good = first.where(F.col("status") == "SUCCESS")
    total = F.get_json_object("response_body", total_path).try_cast("bigint")
    planned = plan_pages(
        good.select(*[c for c in seeds.columns if c != "page_no"], total.alias("total_count")),
        step, modified_since=modified_since, request="request_body",
    ).select(*seeds.columns)
    with journal(store, batch_id) as folder:
        land(store, fetch_pages(planned, transport, policy, in_flight, folder), batch_id, "rest")
    attempts = landed(store, batch_id)
    return flush(store, attempts, batch_id, bronze, records_path=records_path, total_path=total_path, **how)


def ingest_keys(
    store: Store, keys: DataFrame, url_template: str, source: str, transport: Transport,
    table: str, batch_id: str, policy: RetryPolicy = RetryPolicy(base=1.5), in_flight: int = 5,
    key: str = "ImoNr", **how,
) -> dict[str, int]:
    """One request per key; the key stays with the page it brought in."""
    requests = fan_out(keys, url_template, source)
    with journal(store, batch_id) as folder:
        attempts = land(store, fetch_pages(requests, transport, policy, in_flight, folder), batch_id, source)
    opts = {"keep_failures": True, "key": key, **how}
    return flush(store, attempts, batch_id, {source: table}, **opts)
