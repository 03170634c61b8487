"""Features (FIXTURES 17-20, 24), survival (21-22), dashboard (23, 25-27), scores (28-29)."""

import datetime as dt
from decimal import Decimal

import pytest
from helpers import account, churn, d, raw, sub, usage
from pyspark.sql import functions as F

from retentia import schemas
from retentia.config import AnalysisPeriod
from retentia.operators import drivers, roster, split, survival
from retentia.operators.features import feature_window
from retentia.operators.spine import daily_spine
from retentia.plans import dashboard as dash

Y = AnalysisPeriod.quarters("2024-01-01", "2024-12-31", [("2024-01-01", "2024-06-30"), ("2024-07-01", "2024-12-31")])


def _panel(spark, rows):
    """Fact rows from (account, date, mrr, time, flag[, csat, friction, tier]) tuples."""
    out = []
    for r in rows:
        aid, day, mrr, secs, flag = r[:5]
        csat = r[5] if len(r) > 5 else None
        fr = r[6] if len(r) > 6 else 0
        tier = r[7] if len(r) > 7 else "Pro"
        out.append((aid, d(day), "DevTools", tier, "ads", Decimal(mrr), Decimal("0"), "monthly", 0, 0, 0, secs, fr, 0, 0,
                    None, Decimal(csat) if csat is not None else None, flag, Decimal("0")))
    return spark.createDataFrame(out, schemas.DAILY_SPINE)


def test_momentum_defaults_and_values(spark):
    days = lambda a, b: [(dt.date(2024, 1, 1) + dt.timedelta(i)).isoformat() for i in range(a, b)]
    rows = [("full", x, "1.00", 100, 0) for x in days(0, 30)]
    rows += [("short", x, "1.00", 50, 0) for x in days(25, 30)]          # 5 days, all in last 7
    rows += [("quiet", x, "1.00", 70, 0) for x in days(5, 20)]           # nothing in the last 7
    panel = _panel(spark, rows)
    f = {r["account_id"]: r for r in feature_window(panel).collect()}
    assert f["short"]["app_usage_momentum"] == 1.0
    assert f["quiet"]["app_usage_momentum"] == 1.0 and f["quiet"]["daily_time_in_app"] == 70.0
    # last 7 mean 100, previous 23 mean 100 -> 100 / 101
    assert f["full"]["app_usage_momentum"] == round(100 / 101, 4)
    assert f["full"]["daily_time_in_app"] == 100.0


def test_first_non_null_and_churned_on_first_day(spark):
    panel = _panel(spark, [("a", "2024-01-01", "5.00", 0, 0, None), ("a", "2024-01-02", "5.00", 0, 0, "4.0"),
                           ("x", "2024-01-01", "5.00", 0, 1)])
    f = {r["account_id"]: r for r in feature_window(panel).collect()}
    assert "x" not in f  # its window ends the day before its only row
    assert f["a"]["avg_csat_score"] == 4.0


def test_trailing_30_is_31_dates(spark):
    rows = [("a", (dt.date(2024, 3, 31) - dt.timedelta(i)).isoformat(), "1.00", 0, 0) for i in range(40)]
    panel = _panel(spark, rows).withColumn("net_mrr_delta", F.lit(1).cast("decimal(10,2)"))
    assert dash.velocity_30d(panel).first()["net_mrr_velocity"] == 31.0


def test_cohort_split_sixty_twenty_twenty_stable(spark):
    rows = [(f"a{i}", "2024-01-10" if i < 5 else "2024-02-01", "1.00", 0, 0) for i in range(10)]
    rows += [(f"a{i}", "2024-02-01", "1.00", 0, 0) for i in range(5)]  # older accounts seen again on the last day
    f = feature_window(_panel(spark, rows))
    s = {r["account_id"]: r["split"] for r in split.cohort_split(f).collect()}
    assert sorted(s.values()).count("train") == 6 and list(s.values()).count("valid") == 2
    order = sorted(s, key=lambda a: (0 if a in {f"a{i}" for i in range(5)} else 1, a))
    assert [s[a] for a in order] == ["train"] * 6 + ["valid"] * 2 + ["test"] * 2


def test_survival_falls_to_zero_and_floors_duration(spark):
    dur = spark.createDataFrame([(0, 1), (2, 0), (3, 1), (3, 1)], "duration_days int, event_observed int")
    dur = dur.withColumn("duration_days", F.greatest("duration_days", F.lit(1)))
    c = {r["t"]: r for r in survival.kaplan_meier(dur).collect()}
    assert c[0]["survival"] == 1.0 and c[1]["at_risk"] == 4
    assert c[1]["survival"] == pytest.approx(0.75)
    # Greenwood: S^2 * d / (n (n - d)) = 0.5625 * 1 / 12
    assert c[1]["greenwood_var"] == pytest.approx(0.046875)
    assert c[1]["ci_lower"] < 0.75 < c[1]["ci_upper"]
    assert c[2]["survival"] == pytest.approx(0.75) and c[2]["censored"] == 1
    assert c[3]["survival"] == 0.0
    s = [c[t]["survival"] for t in sorted(c)]
    assert all(a >= b for a, b in zip(s, s[1:]))


def test_month_difference_counts_boundaries(spark):
    rows = [("a", "2024-01-31", "1.00", 0, 0), ("a", "2024-02-01", "1.00", 0, 0), ("b", "2024-02-01", "1.00", 0, 0)]
    r = {(x["cohort_month"], x["months_since"]): x for x in dash.cohort_retention(_panel(spark, rows)).collect()}
    assert r[(d("2024-01-01"), 1)]["retained_accounts"] == 1
    assert r[(d("2024-01-01"), 1)]["retention_pct"] == 1.0


def test_partial_month_snapshot_and_month_filter(spark):
    rows = [("a", "2024-05-31", "10.00", 0, 0), ("a", "2024-06-30", "20.00", 0, 0), ("a", "2024-11-12", "30.00", 0, 0)]
    panel = _panel(spark, rows)
    traj = {r["obs_month"]: r["snapshot_mrr"] for r in dash.mrr_trajectory(panel).collect()}
    assert traj[d("2024-11-01")] == 30.0  # partial month: its last observed date
    june = dash.cross_filter(panel, months=["2024-06-01"])
    latest = dash.latest_date(panel)  # LOD from the unfiltered panel
    assert june.where(F.col("observation_date") == latest).count() == 0


def test_at_risk_friction_or_csat(spark):
    rows = [("a", "2024-01-31", "10.00", 0, 0, None, 6), ("b", "2024-01-31", "20.00", 0, 0, "2.0", 0),
            ("c", "2024-01-31", "40.00", 0, 0, "4.0", 1)]
    r = dash.at_risk_arr(_panel(spark, rows)).first()
    assert r["at_risk_arr"] == 360.0 and r["at_risk_accounts"] == 2


def test_scores_kpis_duplicates_and_contract(spark):
    cols = "account_id string, industry string, active_mrr_run_rate double, flight_risk_score double, primary_risk_drivers string, tenure_days int"
    zero = spark.createDataFrame([("a", "x", 0.0, 0.9, "", 1)], cols)
    assert roster.portfolio_kpis(zero).first()["pct_at_risk"] == 0.0
    dup = spark.createDataFrame([("a", "x", 1.0, 0.2, "", 1), ("a", "x", 1.0, 0.7, "", 1), ("b", "x", 3.0, 0.6, "", 1)], cols)
    kept, notice = roster.dedup_scores(dup)
    assert {r["account_id"]: r["flight_risk_score"] for r in kept.collect()} == {"a": 0.7, "b": 0.6}
    assert notice.first()["duplicate_rows"] == 1
    k = roster.portfolio_kpis(kept).first()
    assert (k["total_mrr"], k["at_risk_mrr"], k["pct_at_risk"]) == (4.0, 4.0, 100.0)
    with pytest.raises(roster.ScoreContractError, match="tenure_days"):
        roster.check_contract(zero.drop("tenure_days"))


def test_drivers_rank_by_signed_contribution(spark):
    f = spark.createDataFrame([("a", 1.0, 2.0, -5.0)], "account_id string, x1 double, x2 double, x3 double")
    contribs = [("x1", F.lit(-5.0)), ("x2", F.lit(1.0)), ("x3", F.lit(2.0))]
    assert f.select(drivers.top_two(contribs).alias("t")).first()["t"] == "1. X3 | 2. X2"


def test_tree_shapley_values_of_a_stump_sum_to_margin():
    import numpy as np

    from retentia.operators import shapley

    # one stump: x0 <= 0.5 -> 1.0 else 3.0, each for half of the rows, weight 0.5
    pred = np.array([2.0, 1.0, 3.0])
    left, right = np.array([1, -1, -1]), np.array([2, -1, -1])
    feat, thr = np.array([0, -1, -1]), np.array([0.5, 0, 0])
    is_cat, cat_left = np.zeros(3, bool), np.zeros((3, 64), bool)
    trees = [shapley.Tree(0.5, pred, left, right, feat, thr, is_cat, np.array([2.0, 1.0, 1.0]), cat_left)]
    c = shapley.shapley_values(trees, np.array([[0.0, 9.0], [1.0, 9.0]]), 2)
    assert c.tolist() == [[-0.5, 0.0], [0.5, 0.0]] and shapley.base_value(trees) == 1.0


def test_linear_drivers_end_to_end(spark):
    r = raw(spark, [account("a", "2024-01-01")], [sub("s", "a", "2024-01-01", mrr="10.00", downgrade=1)],
            usages=[usage("u", "s", "2024-12-30", errors=40)], churns=[churn("c", "zzz", "2024-01-01")])
    f = feature_window(daily_spine(r, Y))
    row = drivers.linear_drivers(f).first()
    assert row["primary_risk_drivers"] == "1. Daily Friction Events | 2. Downgrade Flag"
    assert 0.0 < row["flight_risk_score"] < 1.0


def test_arpa_exact_and_approximate(spark):
    rows = [(f"a{i}", "2024-03-31", "10.00" if i % 4 else "0.00", 0, 0) for i in range(40)]
    panel = _panel(spark, rows)
    exact = dash.arpa(panel).first()
    approx = dash.arpa(panel, exact=False).first()
    assert exact["paying_accounts"] == 30 and exact["arpa"] == 120.0
    assert abs(approx["paying_accounts"] - 30) <= 1


def test_score_file_fallback_contract_and_card(spark, tmpdir_path):
    import os

    cols = "account_id string, industry string, active_mrr_run_rate double, flight_risk_score double, primary_risk_drivers string, tenure_days int"
    df = spark.createDataFrame([("a", "x", 1234.5, 0.81, "1. A | 2. B", 40), ("b", "y", 10.0, 0.2, "1. C | 2. D", 3)], cols)
    good = os.path.join(tmpdir_path, "scores")
    roster.write_scores(df, good)
    back = roster.read_scores(spark, os.path.join(tmpdir_path, "missing"), good)  # first path absent
    assert [r["account_id"] for r in back.collect()] == ["a", "b"]  # highest score first
    stale = os.path.join(tmpdir_path, "stale")
    roster.write_scores(df, stale)
    spark.read.option("header", True).csv(stale).drop("tenure_days").write.option("header", True).csv(stale + "2")
    with pytest.raises(roster.ScoreContractError, match="tenure_days"):
        roster.read_scores(spark, stale + "2")
    card = roster.account_card_display(roster.account_card(back, "a")).first()
    assert card["flight_risk"] == "81.0%" and card["monthly_revenue"] == "$1,234.50"
    assert card["headline"] == "a / x / 40 d"
    assert roster.source_freshness(spark, good).first()["last_modified"] is not None
