"""The batch index: choosing a batch opens its own folder only."""

import json
import pathlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import batches
from tidemark.operators.sinks import LEDGER, Store
from tidemark.plans import normalise

PAGE = "Raw_data string, Api_metadata string, _is_normalized boolean, _Batch_run_id string, _ingestion_ts timestamp"


def review(spark, batch, day, *ids, done=False):
    rows = [(json.dumps([{"id": i}]), None, done, batch, datetime(2024, 5, day)) for i in ids]
    return spark.createDataFrame(rows, PAGE)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "lake"))


def states(store, table="t"):
    return {r._Batch_run_id: (r.pages, r.state) for r in batches.entries(store, table).collect()}


def test_choosing_opens_no_other_batch(spark, store):
    for day, batch in enumerate(["100", "2e5", "new/one"], 1):
        batches.land(store, "t", review(spark, batch, day, f"i{day}"), batch)
    batches.land(store, "t", review(spark, "failed", 9, "x", done=True), "failed")
    # A scan, or so much as a listing with a look at footers, of any other batch would end the run.
    for folder in pathlib.Path(store.path("t")).glob("_Batch_run_id=*"):
        if "new" not in folder.name:
            for file in folder.glob("*.parquet"):
                file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
                file.write_bytes(b"no parquet")
    pages = normalise.pages_to_do(store, "t")
    assert ["new" in f for f in pages.inputFiles()] == [True]
    plan = pages._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Location:") == 1 and "100" not in plan
    assert pages.first()._Batch_run_id == "new/one"
    normalise.normalise_reviews(store, "t")
    assert states(store) == {"100": (1, "superseded"), "2e5": (1, "superseded"), "new/one": (1, "processed"), "failed": (0, "landed")}
    assert normalise.normalise_reviews(store, "t") == {}


def test_all_waiting_batches(spark, store):
    for day, batch in enumerate(["a", "b", "c"], 1):
        batches.land(store, "t", review(spark, batch, day, batch), batch)
    store.mark_processed("t", spark.createDataFrame([("b",)], "_Batch_run_id string"))
    pages = normalise.pages_to_do(store, "t", "all")
    assert {r._Batch_run_id for r in pages.collect()} == {"a", "c"}
    normalise.normalise_reviews(store, "t", choose="all")
    assert set(s for _, s in states(store).values()) == {"processed"}
    assert normalise.pages_to_do(store, "t", "all") is None


def test_recover_and_fold(spark, store, monkeypatch):
    store.append("t", review(spark, "1", 1, "x").union(review(spark, "02", 2, "y", "z")), partition_by=["_Batch_run_id"])
    assert not batches.is_kept(store, "t")
    assert batches.recover(store, "t") == 2 and batches.recover(store, "t") == 0
    assert states(store) == {"1": (1, "landed"), "02": (2, "landed")}
    store.append("t", review(spark, "3", 3, "w"), partition_by=["_Batch_run_id"])  # a run that ended too early
    assert batches.recover(store, "t") == 1
    monkeypatch.setattr(batches, "FOLD_FILES", 3)
    for k in range(4):
        batches.land(store, "t", review(spark, "late", 4, f"p{k}"), "late")
    batches.land(store, "other", review(spark, "o", 4, "p"), "o")
    files = list(pathlib.Path(store.path(batches.INDEX)).glob("table=t/*.parquet"))
    assert len(files) <= 4
    assert states(store) == {"1": (1, "landed"), "02": (2, "landed"), "3": (1, "landed"), "late": (4, "landed")}
    assert [r._Batch_run_id for r in batches.newest(batches.entries(store, "t")).collect()] == ["late"]
    assert states(store, "other") == {"o": (1, "landed")}


def test_equal_stamps_take_the_greater_id_and_nothing_waits(spark, store):
    for batch in ("b", "a"):
        batches.land(store, "t", review(spark, batch, 1, "x"), batch)
    assert batches.newest(batches.entries(store, "t")).first()._Batch_run_id == "b"
    batches.land(store, "u", review(spark, "f", 1, "x", done=True), "f")
    assert batches.newest(batches.entries(store, "u")).count() == 0
    assert normalise.pages_to_do(store, "u") is None
    assert not store.exists(LEDGER)
    assert batches.summary(review(spark, "q", 1).where(F.lit(False))).count() == 0
