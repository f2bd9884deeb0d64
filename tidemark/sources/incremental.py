"""Incremental runs: each source is asked for what changed since its last good run, and only then moves on.

The mark of a source is the time of the first request of the last run that landed and was normalised
without a loss. Marks are appended and the greatest counts, so a mark never goes back, whatever order
runs end in. Replay rule: the mark is written last. A run that ends anywhere before asks for the same
changes again; what it landed is passed over by the newer batch, which holds all of it, and silver
tables kept by key take the same rows once more without a change.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.audit import failed_requests
from tidemark.operators.select import BATCH, exclude
from tidemark.operators.sinks import Store, Written
from tidemark.sources.fetch import Transport, with_parameters
from tidemark.sources.ingest import ingest_paged, landed, new_batch_id

MARKS = "_marks"
#: Asked for where a source has no mark: everything.
SINCE_EVER = "1900-02-09 12:15:03"
FORMAT = "yyyy-MM-dd HH:mm:ss"


def batch_marks(attempts: DataFrame, batch: str = BATCH) -> DataFrame:
    """(source, batch, modified_since): when a source's first request of a batch was sent, for the
    batches in which none of its requests failed. Changes made while a run went on are after its mark."""
    first = attempts.groupBy("source", batch).agg(F.min("request_timestamp").alias("modified_since"))
    return exclude(first, failed_requests(attempts, ("source", batch, "page_no")), ["source", batch])


def latest_marks(marks: DataFrame) -> DataFrame:
    return marks.groupBy("source").agg(F.max("modified_since").alias("modified_since"))


def with_marks(store: Store, seeds: DataFrame, step: int, default: str = SINCE_EVER, full_refresh: bool = False) -> DataFrame:
    """Seeds with each source's mark in its request parameters, beside those it brings."""
    since = F.lit(default).cast("timestamp")
    asked = seeds
    if not full_refresh and store.exists(MARKS):
        asked = seeds.join(latest_marks(store.read(MARKS)), "source", "left")
        since = F.coalesce("modified_since", since)
    marked = asked.withColumn("_since", F.date_format(since, FORMAT))
    return with_parameters(marked, "request_body", step, F.col("page_no"), F.col("_since")).select(*seeds.columns)


def run(
    store: Store, seeds: DataFrame, transport: Transport, bronze: Mapping[str, str], step: int,
    normalise: Callable[[Store, str], Mapping[str, Written]], batch_id: str | None = None,
    full_refresh: bool = False, default: str = SINCE_EVER, **how,
) -> dict[str, Written]:
    """Mark, pages, gate, silver, mark: one incremental run of all sources of ``seeds``.

    ``bronze`` maps each source to its table and ``normalise(store, table)`` publishes what is waiting
    there. A failed page ends the run at the gate, and every mark stays where it was. Returns what the
    normaliser wrote.
    """
    batch = batch_id or new_batch_id()
    asked = with_marks(store, seeds, step, default, full_refresh)
    ingest_paged(store, asked, transport, bronze, step, batch, **how)
    done: dict[str, Written] = {}
    for table in dict.fromkeys(bronze.values()):
        done.update(normalise(store, table))
    store.append(MARKS, batch_marks(landed(store, batch)).coalesce(1))
    return done
