"""Headline queries on one machine: prints one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from tidemark.checks import QUERIES
from tidemark.session import build_session

HEADLINE = (
    "active_rate contracts_with_rate attach_rate explode_rates explode_lump_sums explode_array_root "
    "explode_map_bunker silver_charterparties_rates silver_charterparties_extension "
    "silver_charterparties silver_charterparties_all silver_offhires silver_vessel_register "
    "silver_employees silver_directory_accounts silver_ships_properties country_lookup hull_to_imo "
    "composite_lookup latest_batch pending_after_mark attempt_status redact_audit "
    "high_water_mark_strict page_plan upsert_merge tick_date zone_minus_minute upsert_slots"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str, at: str) -> float:
        began = time.time()
        QUERIES[name](spark, at).write.format("noop").mode("overwrite").save()
        return time.time() - began

    # Once over the smallest tables first: starting the JVM and compiling is not what is measured.
    small = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        for name in wanted:
            run(name, small)
    times = {name: round(run(name, folder), 3) for name in wanted}
    spark.stop()
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(sf),
    }))


if __name__ == "__main__":
    main()
