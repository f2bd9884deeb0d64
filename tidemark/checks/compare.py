"""Run registered queries next to their SQL twins in DuckDB and compare whole results."""

from __future__ import annotations

import sys
import time

import duckdb
import numpy as np
import pandas as pd

from tidemark.checks import ORACLES, QUERIES
from tidemark.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _text(v) -> str:
    if isinstance(v, (bool, np.bool_)):
        return str(bool(v))
    return repr(float(v)) if isinstance(v, (int, np.integer)) else str(v)


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    """Columns and rows in a fixed order, values as text."""
    df = df[sorted(df.columns)]
    out = {}
    for c in df.columns:
        s = df[c]
        if pd.api.types.is_datetime64_any_dtype(s):
            text = s.astype("datetime64[us]").astype(str)
        elif pd.api.types.is_float_dtype(s):
            text = s.map(lambda v: repr(float(v)))
        else:
            text = s.map(_text)
        out[c] = text.where(s.notna(), "<null>")
    return pd.DataFrame(out).sort_values(sorted(out)).reset_index(drop=True)


def compare(spark, con, sf_dir: str, name: str) -> str:
    mine = canonical(QUERIES[name](spark, sf_dir).toPandas())
    if name not in ORACLES:
        return f"rows only: {len(mine)}"
    theirs = canonical(con.execute(ORACLES[name]).df())
    if list(mine.columns) != list(theirs.columns):
        return f"FAIL columns {set(mine.columns) ^ set(theirs.columns)}"
    if len(mine) != len(theirs):
        return f"FAIL rows {len(mine)} / {len(theirs)}"
    bad = [c for c in mine.columns if not mine[c].equals(theirs[c])]
    if bad:
        c = bad[0]
        at = (mine[c] != theirs[c]).to_numpy().nonzero()[0][0]
        return f"FAIL values in {bad[:6]}: row {at} {c}: {mine[c][at]!r} / {theirs[c][at]!r}"
    return f"ok {len(mine)}"


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def main(sf_dir: str, wanted: list[str]) -> int:
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in wanted or list(QUERIES):
        began = time.time()
        try:
            result = compare(spark, con, sf_dir, name)
        except Exception as problem:
            result = f"FAIL {type(problem).__name__}: {str(problem)[:400]}"
        bad += result.startswith("FAIL")
        print(f"{time.time() - began:6.2f}s {name}: {result}", flush=True)
    print(f"{bad} of {len(wanted or QUERIES)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1], sys.argv[2:])))
