"""End-to-end batch run from raw CSV exports (written from the smallest test tables)."""

import os

import pytest

from retentia.config import DEFAULT_PERIOD
from retentia.operators.spine import daily_spine
from retentia.plans import batch_run
from retentia.plans.context import raw_tables
from retentia.sources import csv_ingest, rejects, store
from retentia.sources.manifest import FactStore

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_batch_run_from_csv(spark, tmpdir_path):
    paths = csv_ingest.write_raw_csv(raw_tables(spark, SF), os.path.join(tmpdir_path, "csv"))
    raw, rejected = rejects.load_checked_csv(spark, batch_run.csv_paths(os.path.dirname(paths["accounts"])), os.path.join(tmpdir_path, "raw"))
    assert rejected.count() == 0
    out = batch_run.run_all(spark, raw, DEFAULT_PERIOD, os.path.join(tmpdir_path, "out"))
    fact = FactStore(spark, out["fact_daily_spine"]).read()
    assert fact.count() == daily_spine(raw_tables(spark, SF), DEFAULT_PERIOD).count()
    scores = spark.read.option("header", True).csv(out["live_flight_risk_scores"])
    assert scores.columns[:6] == ["account_id", "industry", "active_mrr_run_rate", "flight_risk_score",
                                  "primary_risk_drivers", "tenure_days"]
    for name in ("dashboard/total_arr", "dashboard/cohort_retention", "quality/orphans", "portfolio_kpis", "model_report"):
        assert spark.read.parquet(out[name]).count() > 0
    export = store.read_spine_csv(spark, out["fact_daily_spine_export"])
    assert export.count() == fact.count()
