"""End-to-end batch run from the five raw CSV exports.

    python -m retentia.plans.batch_run --csv-dir DIR --out OUT [--period reference|test]

DIR holds accounts/, subscriptions/, feature_usage/, support_tickets/ and
churn_events/ CSV files (or files named ``<table>.csv``).  Steps, in the
order of the original batch: load and type the raw tables -> fact table,
refreshed window by window -> spine CSV export -> features, split,
classifier, held-out report -> risk scores file -> survival curve ->
dashboard sheets -> data-quality reports.  Every output is written under
OUT (Parquet, plus the two CSV files the original produced); nothing is
collected to the driver except the few scalars the model needs.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

from retentia import config
from retentia.config import AnalysisPeriod
from retentia.operators import drivers, model, quality, roster, split, survival
from retentia.operators.features import MEANS, feature_window
from retentia.operators.spine import daily_spine, spine_row_count
from retentia.plans import dashboard as dash
from retentia.session import apply_runtime_conf
from retentia.sources import rejects, rollup, store
from retentia.sources.manifest import FactStore
from retentia.sources.raw import RawTables

TABLES = ("accounts", "subscriptions", "feature_usage", "support_tickets", "churn_events")


def csv_paths(csv_dir: str) -> dict[str, str]:
    out = {}
    for t in TABLES:
        f = os.path.join(csv_dir, f"{t}.csv")
        out[t] = f if os.path.exists(f) else os.path.join(csv_dir, t)
    return out


def dashboard_sheets(fact: DataFrame, raw: RawTables, period: AnalysisPeriod, months: rollup.MonthRollup) -> dict[str, DataFrame]:
    """Sheets of sums and cohorts from the month rollup; the others from the panel or the raw tables."""
    return rollup.sheets(months) | {
        "churn_reasons": dash.churn_reasons(raw.churn_events, period.cal_start, period.cal_end),
        "support_resolution": dash.support_resolution(raw.support_tickets, period.cal_start, period.cal_end),
        "growth_multiple": dash.growth_multiple(fact),
        "churned_account_arr": dash.churned_account_arr(fact),
    }


def quality_reports(raw: RawTables, fact: DataFrame, period: AnalysisPeriod) -> dict[str, DataFrame]:
    tables = dict(raw.as_dict(), fact_daily_spine=fact)
    return {
        "table_counts": quality.table_counts(tables),
        "pk_duplicates": quality.pk_duplicates(raw.as_dict()),
        "orphans": quality.orphans(raw),
        "boundary_check": quality.boundary_check(fact, raw.accounts, period),
        "not_null_violations": quality.not_null_violations(fact),
        "dropped_activity": quality.dropped_activity(raw, fact, period),
    }


def run_all(spark: SparkSession, raw: RawTables, period: AnalysisPeriod, out: str, mode: str = "window") -> dict[str, str]:
    """Run every step; returns {output name: path}."""
    apply_runtime_conf(spark)
    out = out.rstrip("/")
    written: dict[str, str] = {}

    def save(name: str, df: DataFrame) -> None:
        path = f"{out}/{name}"
        df.write.mode("overwrite").parquet(path)
        written[name] = path

    # One spine job for all windows; its rows come in the store's buckets, so the panel isn't shuffled. A run into the same folder is one more snapshot.
    facts = FactStore(spark, f"{out}/fact_daily_spine")
    n = facts.buckets(spine_row_count(raw, period, mode))
    facts.refresh(daily_spine(raw, period, mode, partitions=n), period.windows, placed=True)
    fact = facts.read()
    months = rollup.MonthRollup(facts)
    months.update()
    written["fact_daily_spine"] = f"{out}/fact_daily_spine"
    store.export_spine_csv(fact.drop(store.MONTH_COL), f"{out}/fact_daily_spine_export")
    written["fact_daily_spine_export"] = f"{out}/fact_daily_spine_export"

    features = feature_window(fact, exact=True).persist()
    sp = split.cohort_split(features)
    save("features", features.drop(*[f"exact_{c}" for c in MEANS]))
    save("split_summary", split.split_summary(sp))
    frame = model.boosted_frame(sp)
    trees = model.fit_boosted(frame)
    save("model_report", model.evaluate(trees, frame))
    scored = model.score_active(trees, features)
    scores = roster.risk_roster(scored, drivers.boosted_drivers(trees, scored), fact)
    roster.write_scores(scores, f"{out}/live_flight_risk_scores")
    written["live_flight_risk_scores"] = f"{out}/live_flight_risk_scores"
    scores_back = roster.read_scores(spark, f"{out}/live_flight_risk_scores")
    save("portfolio_kpis", roster.portfolio_kpis(scores_back, config.RISK_THRESHOLD))
    curve = survival.survival_curve(fact)
    written.update({f"model_{k}": v for k, v in model.save_models(trees, curve, f"{out}/models").items()})

    for name, df in dashboard_sheets(fact, raw, period, months).items():
        save(f"dashboard/{name}", df)
    for name, df in quality_reports(raw, fact, period).items():
        save(f"quality/{name}", df)
    features.unpersist()
    return written


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n\n")[0])
    ap.add_argument("--csv-dir", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--period", choices=["reference", "test"], default="reference")
    ap.add_argument("--mode", choices=["window", "as_of_run"], default="window")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("retentia-batch").getOrCreate()
    period = config.REFERENCE_PERIOD if a.period == "reference" else config.DEFAULT_PERIOD
    # Bad lines don't stop the batch: they stand in OUT/raw/<table> beside the loaded rows.
    raw, rejected = rejects.load_checked_csv(spark, csv_paths(a.csv_dir), f"{a.out.rstrip('/')}/raw")
    rejects.load_report(raw, rejected).show(100, truncate=False)
    for name, path in run_all(spark, raw, period, a.out, a.mode).items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
