"""Scalar expressions (SURVEY B-list) and the ticket/churn cross-filters."""

from pyspark.sql import functions as F

from retentia.functions import expressions as X
from retentia.plans import dashboard as dash


def test_flags_blanks_month_diff_pct_and_labels(spark):
    df = spark.createDataFrame(
        [(" True", "", "2024-01-31", "2024-02-01", 5.0, 0.0, "net_mrr_delta"),
         ("false", "  x ", "2023-12-15", "2024-12-01", 1.0, 4.0, "app_usage_momentum"),
         (None, None, "2024-03-01", "2024-03-31", None, None, "is_trial")],
        "f string, b string, a string, z string, num double, den double, name string",
    )
    rows = df.select(
        X.text_flag("f").alias("flag"),
        X.blank_to_null("b").alias("blank"),
        X.calendar_month_diff(F.to_date("a"), F.to_date("z")).alias("months"),
        X.guarded_pct("num", "den").alias("pct"),
        X.driver_label("name").alias("label"),
        X.days_in_month(F.to_date("a")).alias("dim"),
    ).collect()
    assert [r["flag"] for r in rows] == [1, 0, 0]
    assert [r["blank"] for r in rows] == [None, "x", None]
    assert [r["months"] for r in rows] == [1, 12, 0]
    assert [r["pct"] for r in rows] == [0.0, 25.0, 0.0]
    assert [r["label"] for r in rows] == ["Net Mrr Delta", "App Usage Momentum", "Is Trial"]
    assert [r["dim"] for r in rows] == [31, 31, 31]


def test_half_up_ratio_is_exact(spark):
    df = spark.createDataFrame([(1, 8), (3, 800), (5, 0), (2, 3)], "n long, d long")
    got = [r[0] for r in df.select(X.half_up_ratio("n", "d")).collect()]
    assert got == [0.125, 0.0038, None, 0.6667]  # 3/800 = 0.00375 rounds up


def test_cross_filter_on_tickets_and_churn_events(spark):
    t = spark.createDataFrame([("urgent",), ("low",), ("high",)], "priority string")
    c = spark.createDataFrame([("pricing",), ("support",)], "reason_code string")
    assert dash.cross_filter(t, priorities=["urgent", "high"]).count() == 2
    assert dash.cross_filter(c, reasons=["support"]).count() == 1
