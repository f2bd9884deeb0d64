"""Bronze to silver, table by table, with the processed ledger."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import batches, reconcile, rejects
from tidemark.operators.select import (
    BATCH, STAMP, all_pending, exclude, is_empty, latest_batch, pending,
)
from tidemark.operators.sinks import Store, Written
from tidemark.operators.staging import staged
from tidemark.plans import accounts, contracts, employees, offhires, ships, vessels

CHOICES = ("latest_batch", "all")
#: What of a batch does not parse goes into this table; the ledger then calls the batch ``partial``.
REJECTED = "rejected_records"
ON_REJECT = ("keep", "fail")
# Tables that keep their rows when a batch has none for them. All others become empty.
GUARDED = (
    "charterparties_option charterparty_brokerageCommission charterparty_deliveryNotices "
    "charterparty_premiums charterparty_redeliveryNotices offhires offhires_atCost offhire_lumpSums "
    "offhire_rates offhire_bunker reviews"
).split()


def pages_to_do(store: Store, table: str, choose: str = "latest_batch") -> DataFrame | None:
    """Pending pages of a bronze table, whole batches only, or None where there are none.

    ``latest_batch`` is the newest batch that landed, processed or not: once it is in silver nothing is
    left to do, and an older batch that was never processed cannot replace it. Where the table has a
    batch index the choice is made from that, and only the folders of the chosen batches are opened;
    without one all of bronze is read.
    """
    if choose not in CHOICES:
        raise ValueError(f"unknown choice {choose!r}, not one of {CHOICES}")
    if not store.exists(table):
        return None
    if batches.is_kept(store, table):
        found = batches.entries(store, table)
        if choose == "latest_batch":
            found = batches.newest(found)
        todo = [r[0] for r in batches.waiting(found).select(BATCH).toLocalIterator()]
        return pending(batches.read_batches(store, table, todo)) if todo else None
    landed, done = store.read(table), store.ledger(table)
    if choose == "all":
        pages = all_pending(landed, done)
    else:
        pages = exclude(latest_batch(pending(landed)), done, [BATCH])
    return None if is_empty(pages) else pages


def _marks(store: Store, table: str, pages: DataFrame, choose: str) -> DataFrame:
    """What the ledger will say: the batches taken are processed, and older ones that the newest batch
    passes over are superseded. Written down before silver is, so that it tells what was read."""
    taken = pages.groupBy(BATCH).agg(F.max(STAMP).alias("at")).withColumn("state", F.lit("processed"))
    if choose == "latest_batch":
        newest = pages.agg(F.max(STAMP).alias("at")).select("at").scalar()
        if batches.is_kept(store, table):
            waiting = batches.waiting(batches.entries(store, table)).select(BATCH, F.col("landed_at").alias("at"))
        else:
            rows = all_pending(store.read(table), store.ledger(table))
            waiting = rows.where(F.col(STAMP) <= newest).groupBy(BATCH).agg(F.max(STAMP).alias("at"))
        passed = exclude(waiting, pages, [BATCH]).where(F.col("at") <= newest)
        taken = taken.unionByName(passed.withColumn("state", F.lit("superseded")))
    return staged(taken.select(BATCH, "state"))


def keep_rejects(store: Store, table: str, found: DataFrame, on_reject: str) -> Written | None:
    """Write what does not parse, by table and batch, so that a run that comes again writes it once.
    ``fail`` then ends the run, before any silver table is touched."""
    if on_reject not in ON_REJECT:
        raise ValueError(f"unknown on_reject {on_reject!r}, not one of {ON_REJECT}")
    if is_empty(found):
        return None
    rows = found.select(F.lit(table).alias("table"), BATCH, "reason", "page", "text", F.current_timestamp().alias("rejected_at"))
    done = store.replace_partitions(REJECTED, rows, ["table", BATCH])
    if on_reject == "fail":
        raise ValueError(f"{done.rows} page(s) or record(s) of {table} do not parse, listed in {done.path}")
    return done


def _finish(store: Store, table: str, marks: DataFrame, lost: Written | None, counts: DataFrame) -> None:
    """Write down what was counted and mark the batches. One of which something was rejected is ``partial``:
    done, but not in silence."""
    reconcile.record_all(store, table, counts)
    state = F.col("state")
    if lost:
        bad = store.read(REJECTED).where(F.col("table") == table).select(F.col(BATCH).cast("string").alias(BATCH)).distinct()
        marks = marks.join(bad.withColumn("_bad", F.lit(True)), BATCH, "left")
        state = F.when((state == "processed") & F.col("_bad"), "partial").otherwise(state)
    store.mark_processed(table, marks, state=state)


def normalise_contracts(
    store: Store, table: str, documents: DataFrame, vessel_dim: DataFrame,
    as_of: Column | None = None, choose: str = "latest_batch", load_ts: Column | None = None,
    on_reject: str = "keep", strict: bool = False, **how,
) -> dict[str, Written]:
    """All contract tables from one parse of the pages, published together. What does not parse goes to
    ``REJECTED``."""
    pages = pages_to_do(store, table, choose)
    if pages is None:
        return {}
    marks = _marks(store, table, pages, choose)
    now = F.lit(store.spark.range(1).select(F.current_timestamp()).first()[0]) if as_of is None else as_of
    checked = staged(contracts.checked_contracts(pages, strict=strict))
    lost = keep_rejects(store, table, rejects.rejected(checked), on_reject)
    records = rejects.accepted(checked)
    rate_rows = contracts.rates(records, load_ts)
    extension_rows = contracts.extensions(records, load_ts)
    with store.together() as group:
        done = {
            "charterparties_rates": group.replace("charterparties_rates", rate_rows),
            "charterparties_extension": group.replace("charterparties_extension", extension_rows),
        }
        for name, make in {
            "charterparties_lump_sums": contracts.lump_sums,
            "charterparties_atcost": contracts.at_cost,
            "charterparty_brokerageCommission": contracts.brokerage_commission,
            "charterparty_deliveryNotices": contracts.delivery_notices,
            "charterparty_premiums": contracts.premiums,
            "charterparty_redeliveryNotices": contracts.redelivery_notices,
        }.items():
            done[name] = group.replace(name, make(records, load_ts), skip_if_empty=name in GUARDED)
        combined = contracts.charterparties(
            records, rate_rows, documents, vessel_dim, now, load_ts, **how
        )
        option_rows = contracts.options(records, rate_rows, now, load_ts, **how)
        done["charterparties"] = group.replace("charterparties", combined)
        done["charterparties_option"] = group.replace("charterparties_option", option_rows, "charterparties_option" in GUARDED)
        combined = group.read("charterparties")
        if group.exists("charterparties_option"):
            option_rows = group.read("charterparties_option")
        done["charterparties_all"] = group.replace(
            "charterparties_all", contracts.contracts_all(combined, option_rows, vessel_dim)
        )
    _finish(store, table, marks, lost, _counted(store, checked, done, "charterparties", "charterparties_option"))
    return done if lost is None else {**done, REJECTED: lost}


def _counted(store: Store, checked: DataFrame, done: Mapping[str, Written], *names: str) -> DataFrame:
    """Counts of the batches; together the tables named hold one row for each record."""
    return reconcile.normalised(checked, {n: store.read(n) if done[n].wrote else None for n in names})


def normalise_offhires(
    store: Store, table: str, choose: str = "latest_batch", load_ts: Column | None = None,
    on_reject: str = "keep", strict: bool = False,
) -> dict[str, Written]:
    pages = pages_to_do(store, table, choose)
    if pages is None:
        return {}
    marks = _marks(store, table, pages, choose)
    checked = staged(offhires.checked_offhires(pages, strict=strict))
    lost = keep_rejects(store, table, rejects.rejected(checked), on_reject)
    records = rejects.accepted(checked)
    makers = {
        "offhires": offhires.offhires, "offhires_atCost": offhires.at_cost,
        "offhire_lumpSums": offhires.lump_sums, "offhire_rates": offhires.rates,
        "offhire_bunker": offhires.bunker,
    }
    with store.together() as group:
        done = {n: group.replace(n, make(records, load_ts), n in GUARDED) for n, make in makers.items()}
    _finish(store, table, marks, lost, _counted(store, checked, done, "offhires"))
    return done if lost is None else {**done, REJECTED: lost}


def _one(
    store: Store, table: str, name: str, choose: str, make: Callable[[DataFrame], DataFrame],
    path: str | None = None, on_reject: str = "keep", **how,
) -> dict[str, Written]:
    """One silver table. Pages without a list of records at ``path`` are rejected; the check reads the
    pages once more, and only if there are such pages does the plan filter them out."""
    pages = pages_to_do(store, table, choose)
    if pages is None:
        return {}
    marks = _marks(store, table, pages, choose)
    lost = keep_rejects(store, table, staged(rejects.rejected_pages(pages, path)), on_reject)
    counts = reconcile.listed(pages, path)
    if lost:
        pages = rejects.sound_pages(pages, path)
    done = {name: store.publish(name, make(pages), skip_if_empty=name in GUARDED, **how)}
    _finish(store, table, marks, lost, counts)
    return done if lost is None else {**done, REJECTED: lost}


def normalise_reviews(store, table, choose="latest_batch", load_ts=None, on_reject="keep"):
    return _one(store, table, "reviews", choose, lambda p: offhires.reviews(p, load_ts), on_reject=on_reject)


def normalise_ships(store, table, choose="latest_batch", load_ts=None, on_reject="keep"):
    return _one(store, table, "ships", choose, lambda p: ships.ships(p, load_ts), "ships", on_reject)


def normalise_ship_properties(store, table, mapping, choose="latest_batch", load_ts=None, on_reject="keep"):
    return _one(
        store, table, "ships_properties", choose,
        lambda p: ships.ship_properties(p, mapping, load_ts=load_ts), "properties", on_reject,
    )


def normalise_vessels(
    store, table, country, choose="latest_batch", load_ts=None, full_refresh=False,
    on_duplicate="error", newest_by=(), on_reject="keep", **how,
):
    """Full refresh on request or on the first run, otherwise an upsert on the vessel number."""
    return _one(
        store, table, "vessel_register", choose,
        lambda p: vessels.vessels(p, country, load_ts=load_ts, **how), "results", on_reject, mode="auto",
        keys=["imo"], full_refresh=full_refresh, on_duplicate=on_duplicate, newest_by=newest_by,
    )


def normalise_directory(store, table, choose="all", load_ts=None, on_reject="keep"):
    return _one(
        store, table, "directory_accounts", choose, lambda p: accounts.directory_accounts(p, load_ts),
        on_reject=on_reject,
    )


def normalise_cloud_directory(store, table, choose="latest_batch", load_ts=None, on_reject="keep"):
    return _one(store, table, "cloud_accounts", choose, lambda p: accounts.cloud_accounts(p, load_ts), "value", on_reject)


def normalise_employees(store, table, choose="all", load_ts=None, on_reject="keep"):
    return _one(store, table, "employees", choose, lambda p: employees.employees(p, load_ts), "d.results", on_reject)
