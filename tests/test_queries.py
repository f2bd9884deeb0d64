"""Every registered query against its SQL twin, and the plans of the ones that matter at scale."""

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as driver
from tidemark.checks import ORACLES, QUERIES
from tidemark.checks.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    assert not compare(spark, con, SF, name).startswith("FAIL")


def test_driver_contract(spark):
    assert driver.entry(spark).columns
    assert set(driver.queries()) >= set(QUERIES) == set(ORACLES) and set(driver.oracle_sql()) >= set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("pipeline", [True, False])
def test_the_rest_imports_without_corpus_operators(tmp_path, pipeline):
    """Also where an emptied folder or the pipeline's module is left behind."""
    home = os.path.dirname(os.path.abspath(driver.__file__))
    copy = tmp_path / "copy"
    gone = ["llm", ".git", "__pycache__"] + ([] if pipeline else ["corpus_pipeline.py"])
    shutil.copytree(home, copy, ignore=shutil.ignore_patterns(*gone))
    if pipeline:
        (copy / "tidemark" / "llm" / "__pycache__").mkdir(parents=True)
    code = "import __spark_entry__ as d; print(*sorted(d.queries()), *sorted(d.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, env={**os.environ, "PYTHONPATH": str(copy)}, capture_output=True, text=True)
    assert out.stdout.split() == [*sorted(QUERIES), *sorted(ORACLES)], out.stderr
