"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Each query runs to completion through the ``noop`` sink (no collect).  The
fact table is built and written once ("daily_spine_build"); the dashboard,
feature and model queries then read that Parquet copy, as in production.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from retentia.config import DEFAULT_PERIOD  # noqa: E402
from retentia.operators.spine import AS_OF_RUN_MODE, daily_spine, spine_row_count  # noqa: E402
from retentia.plans import catalog  # noqa: E402
from retentia.plans import context  # noqa: E402
from retentia.session import build_session  # noqa: E402
from retentia.session import scratch_path, session_key  # noqa: E402
from retentia.sources import csv_ingest  # noqa: E402
from retentia.sources.store import default_buckets, materialize  # noqa: E402

HEADLINE = [
    "total_arr",
    "arpa",
    "velocity_30d",
    "app_minutes_30d",
    "mrr_trajectory",
    "velocity_by_month",
    "churned_arr_by_tier",
    "cohort_retention",
    "churn_reasons",
    "support_resolution",
    "growth_multiple",
    "at_risk_arr",
    "churned_account_arr",
    "feature_window",
    "cohort_split",
    "survival_curve",
    "boundary_check",
    "orphans",
    "pk_duplicates",
    "dropped_activity",
    "risk_drivers_linear",
    "portfolio_kpis",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app="retentia-bench")
    times: dict[str, float] = {}

    # Warm-up on the smallest input: JVM, codegen caches, Python workers.
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        run(catalog.QUERIES["total_arr"](spark, warm))

    t = time.time()
    raw = context.raw_tables(spark, sf_dir)
    times["load_raw_tables"] = time.time() - t

    # A1-A5: the same raw tables as CSV exports (written untimed), loaded and typed.
    csv_paths = csv_ingest.write_raw_csv(raw, scratch_path(spark, "raw-csv"))
    t = time.time()
    for df in csv_ingest.load_raw_csv(spark, csv_paths).as_dict().values():
        run(df)
    times["csv_ingest"] = time.time() - t
    t = time.time()
    rows = spine_row_count(raw, DEFAULT_PERIOD)
    n = default_buckets(spark, rows)
    fact = materialize(spark, daily_spine(raw, DEFAULT_PERIOD, partitions=n), buckets=n, placed=True)
    times["daily_spine_build"] = time.time() - t
    context._FACTS[(session_key(spark), sf_dir, "window", DEFAULT_PERIOD)] = fact

    t = time.time()
    run(daily_spine(raw, DEFAULT_PERIOD, AS_OF_RUN_MODE))
    times["daily_spine_as_of_run"] = time.time() - t

    for name in HEADLINE:
        if name == "cohort_split":  # later steps read the written feature table
            t = time.time()
            context.feature_table(spark, sf_dir)
            times["feature_table_write"] = time.time() - t
        t = time.time()
        run(catalog.QUERIES[name](spark, sf_dir))
        times[name] = time.time() - t

    t = time.time()
    r = catalog.model_run(spark, sf_dir)
    run(r["scored"])
    times["model_fit_and_score"] = time.time() - t
    t = time.time()
    run(r["drivers"])
    times["risk_drivers_tree"] = time.time() - t

    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
