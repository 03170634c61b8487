"""Kaplan-Meier survival curve of account lifetimes in the panel.

Per account: duration = last - first panel date in days (at least 1),
event = ever flagged as churned.  The curve is computed from counts per
distinct duration - at most one row per day of the calendar range, a bound
set by the analysis period - so the running sums run over that small table:

    n_i = accounts with duration >= t_i,  S(t) = prod_{t_i <= t} (1 - d_i / n_i)

as ``exp(sum(log(1 - d/n)))``; once d = n the curve is 0 from there on.
A t = 0 row with S = 1 starts the curve.  Greenwood's variance and the
log(-log) 95 % band are included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

DATE = "observation_date"


def survival_input(spine: DataFrame) -> DataFrame:
    g = spine.groupBy("account_id").agg(
        F.min(DATE).alias("start_date"),
        F.max(DATE).alias("end_date"),
        F.max("target_churn_flag").cast("int").alias("event_observed"),
    )
    return g.withColumn("duration_days", F.greatest(F.datediff("end_date", "start_date"), F.lit(1)))


def kaplan_meier(durations: DataFrame) -> DataFrame:
    """``durations`` has ``duration_days`` and ``event_observed``."""
    per_t = durations.groupBy(F.col("duration_days").alias("t")).agg(
        F.count(F.lit(1)).alias("n_t"),
        F.sum("event_observed").cast("bigint").alias("events"),
    )
    # Running frames over the per-duration table (<= calendar days rows).
    asc = W.orderBy("t")
    total = F.sum("n_t").over(W.partitionBy())
    before = F.coalesce(F.sum("n_t").over(asc.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    c = per_t.select("t", "n_t", "events", (total - before).alias("at_risk"))
    c = c.withColumn("censored", F.col("n_t") - F.col("events"))
    q = F.col("events") / F.col("at_risk")
    c = c.withColumn("_dead", (F.col("events") == F.col("at_risk")).cast("int"))
    c = c.withColumn("_log", F.when(F.col("_dead") == 0, F.log(F.lit(1.0) - q)).otherwise(F.lit(0.0)))
    c = c.withColumn(
        "_gw",
        F.when(F.col("_dead") == 0, F.col("events") / (F.col("at_risk") * (F.col("at_risk") - F.col("events")))).otherwise(
            F.lit(0.0)
        ),
    )
    run = asc.rowsBetween(W.unboundedPreceding, 0)
    c = c.select(
        "t",
        "at_risk",
        "events",
        "censored",
        F.when(F.max("_dead").over(run) == 1, F.lit(0.0)).otherwise(F.exp(F.sum("_log").over(run))).alias("survival"),
        F.sum("_gw").over(run).alias("_gw_sum"),
        F.sum("_log").over(run).alias("_log_sum"),
    )
    var = F.col("survival") * F.col("survival") * F.col("_gw_sum")
    # log(-log S) band; undefined where S is 0 or 1.
    se = F.sqrt(F.col("_gw_sum")) / F.abs(F.col("_log_sum"))
    ok = (F.col("survival") > 0) & (F.col("survival") < 1)
    lower = F.when(ok, F.pow(F.col("survival"), F.exp(F.lit(1.959963984540054) * se)))
    upper = F.when(ok, F.pow(F.col("survival"), F.exp(F.lit(-1.959963984540054) * se)))
    c = c.select("t", "at_risk", "events", "censored", "survival", var.alias("greenwood_var"), lower.alias("ci_lower"), upper.alias("ci_upper"))
    n = durations.select(F.count(F.lit(1))).scalar()
    start = durations.sparkSession.range(1).select(
        F.lit(0).alias("t"),
        n.alias("at_risk"),
        F.lit(0).cast("bigint").alias("events"),
        F.lit(0).cast("bigint").alias("censored"),
        F.lit(1.0).alias("survival"),
        F.lit(0.0).alias("greenwood_var"),
        F.lit(None).cast("double").alias("ci_lower"),
        F.lit(None).cast("double").alias("ci_upper"),
    )
    return start.unionByName(c.withColumn("t", F.col("t").cast("int")))


def survival_curve(spine: DataFrame) -> DataFrame:
    return kaplan_meier(survival_input(spine))
