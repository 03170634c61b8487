"""Dashboard sheets and calculated fields over the daily fact table.

Evaluation order follows the workbook: fixed level-of-detail values
(latest date, month-end date of each month, each account's cohort month)
are computed on the *unfiltered* panel first, then dimension filters
(including cross-filters), then the sheet's aggregation, then table
calculations (percent of total, reference line).

Plan notes
* Global LODs (latest date) are scalar subqueries - one partial max per
  task, no join.
* Month-level LODs aggregate to at most one row per calendar month of the
  analysis period (a parameter), so they are broadcast by construction.
* Account-level LODs (cohort month) are one row per account; they are
  joined by key and left to AQE (broadcast if small at run time, else a
  shuffle join with skew splitting).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from retentia import config
from retentia.functions.expressions import (
    calendar_month_diff,
    cents,
    half_up_ratio,
    money_double,
    month_bucket,
    sign_label,
    ts_on_days,
)

DATE = "observation_date"
MRR = "active_mrr_run_rate"


YM = "obs_ym"  # month partition column of the stored fact table


def latest_date(spine: DataFrame) -> Column:
    """{FIXED : MAX(observation_date)} as a scalar subquery.  On the stored
    fact table the latest month comes from the partition column alone (no
    column data is read) and only that month is scanned for the day."""
    if YM in spine.columns:
        last_ym = spine.select(F.max(YM)).scalar()
        return spine.where(F.col(YM) == last_ym).select(F.max(DATE)).scalar()
    return spine.select(F.max(DATE)).scalar()


def _month_of(day: Column) -> Column:
    from retentia.sources.store import month_key

    return month_key(day)


def on_latest(spine: DataFrame) -> DataFrame:
    """Rows of the latest date; prunes to its month partition at run time."""
    latest = latest_date(spine)
    out = spine.where(F.col(DATE) == latest)
    return out.where(F.col(YM) == _month_of(latest)) if YM in spine.columns else out


def since(spine: DataFrame, days: int) -> DataFrame:
    """Rows with observation_date >= latest - days (days + 1 dates); the same
    bound on the month partition column prunes older months at run time."""
    lower = F.date_sub(latest_date(spine), days)
    out = spine.where(F.col(DATE) >= lower)
    return out.where(F.col(YM) >= _month_of(lower)) if YM in spine.columns else out


def trailing(spine: DataFrame, days: int) -> Column:
    """observation_date >= latest - days (inclusive: days + 1 dates)."""
    return F.col(DATE) >= F.date_sub(latest_date(spine), days)


def month_end_dates(spine: DataFrame) -> DataFrame:
    """{FIXED month : MAX(observation_date)} - the last *observed* date of
    each month.  At most one row per calendar month."""
    return spine.groupBy(month_bucket(DATE).alias("obs_month")).agg(F.max(DATE).alias("month_end_date"))


def month_end_rows(spine: DataFrame) -> DataFrame:
    """The rows of each month's last observed date, with ``obs_month``; at most one date per calendar month is broadcast."""
    me = F.broadcast(month_end_dates(spine).withColumnRenamed("month_end_date", DATE))
    return spine.join(me, DATE)


def cohorts(spine: DataFrame) -> DataFrame:
    """(account_id, cohort_month): month of the account's first panel row."""
    return spine.groupBy("account_id").agg(F.min(month_bucket(DATE)).alias("cohort_month"))


def cross_filter(
    df: DataFrame,
    months: list[str] | None = None,
    tiers: list[str] | None = None,
    priorities: list[str] | None = None,
    reasons: list[str] | None = None,
    cohort_cells: list[tuple[str, int]] | None = None,
    churn_events: DataFrame | None = None,
    support_tickets: DataFrame | None = None,
) -> DataFrame:
    """Conjunctive dashboard selections, applied after LOD columns exist.

    A churn reason or ticket priority chosen on its own sheet filters a panel
    sheet through account_id, by the related table given.  ``cohort_cells`` are
    (cohort month, months since) cells of the cohort sheet."""
    if cohort_cells:
        cohort = cohorts(df).withColumnRenamed("cohort_month", "_cohort")
        since_ = calendar_month_diff("_cohort", DATE)
        cells = [(F.col("_cohort") == F.lit(m).cast("date")) & (since_ == k) for m, k in cohort_cells]
        test = cells[0]
        for c in cells[1:]:
            test = test | c
        df = df.join(cohort, "account_id").where(test).drop("_cohort")
    if months:
        days = [F.lit(m).cast("date") for m in months]
        if YM in df.columns:  # the same test on the partition column prunes the scan
            df = df.where(F.col(YM).isin([_month_of(d) for d in days]))
        df = df.where(month_bucket(DATE).isin(days))
    if tiers:
        df = df.where(F.col("baseline_tier").isin(tiers))
    for column, chosen, table in (("priority", priorities, support_tickets), ("reason_code", reasons, churn_events)):
        if chosen and column in df.columns:
            df = df.where(F.col(column).isin(chosen))
        elif chosen:
            if table is None:
                raise ValueError(f"a selection by {column} needs its table")
            df = df.join(table.where(F.col(column).isin(chosen)).select("account_id").distinct(), "account_id", "left_semi")
    return df


# --------------------------------------------------------------------------
# KPI tiles
# --------------------------------------------------------------------------


def total_arr(spine: DataFrame) -> DataFrame:
    """G1: sum(MRR) x 12 on the latest date."""
    return on_latest(spine).agg(F.max(DATE).alias("latest_date"), money_double(F.sum(MRR) * 12).alias("total_arr"))


def distinct_count(c: Column, exact: bool = True, rsd: float = 0.01) -> Column:
    """Exact distinct count, or HyperLogLog++ with relative error ``rsd``
    (one fixed-size sketch per group, no shuffle of the distinct values)."""
    return F.countDistinct(c) if exact else F.approx_count_distinct(c, rsd)


def arpa(spine: DataFrame, exact: bool = True) -> DataFrame:
    """Current ARR / distinct paying accounts on the latest date."""
    g = on_latest(spine).agg(
        (F.sum(MRR) * 12).alias("arr"),
        distinct_count(F.when(F.col(MRR) > 0, F.col("account_id")), exact).alias("paying_accounts"),
    )
    return g.select(
        money_double("arr").alias("current_arr"),
        "paying_accounts",
        half_up_ratio(cents("arr"), F.col("paying_accounts") * 100).alias("arpa"),
    )


def velocity_30d(spine: DataFrame, days: int = config.TRAILING_SHORT_DAYS) -> DataFrame:
    """Net MRR change over the trailing window."""
    return since(spine, days).agg(money_double(F.sum("net_mrr_delta")).alias("net_mrr_velocity"))


def app_minutes_30d(spine: DataFrame, days: int = config.TRAILING_SHORT_DAYS) -> DataFrame:
    """Mean daily in-app minutes over the trailing window."""
    g = since(spine, days).agg(F.sum("daily_time_in_app").alias("secs"), F.count("daily_time_in_app").alias("n"))
    return g.select(half_up_ratio("secs", F.col("n") * 60).alias("daily_app_minutes"))


# --------------------------------------------------------------------------
# monthly sheets
# --------------------------------------------------------------------------


def mrr_trajectory(spine: DataFrame) -> DataFrame:
    """G5 / G-m: MRR snapshot and ARR run rate on each month's last observed date."""
    s = month_end_rows(spine)
    return s.groupBy("obs_month").agg(
        money_double(F.sum(MRR)).alias("snapshot_mrr"), money_double(F.sum(MRR) * 12).alias("arr_run_rate")
    ).orderBy("obs_month")


def velocity_by_month(spine: DataFrame) -> DataFrame:
    """G6 / G-h: net MRR change per month with its sign label."""
    g = spine.groupBy(month_bucket(DATE).alias("obs_month")).agg(F.sum("net_mrr_delta").alias("d"))
    return g.select(
        "obs_month", money_double("d").alias("net_mrr_delta"), sign_label("d").alias("velocity_label")
    ).orderBy("obs_month")


def cross_filtered_velocity(spine: DataFrame, tiers: list[str] | None = None, months: list[str] | None = None, **selections) -> DataFrame:
    """Velocity bars after selections on other sheets."""
    g = cross_filter(spine, months=months, tiers=tiers, **selections).groupBy(month_bucket(DATE).alias("obs_month"))
    g = g.agg(F.sum("net_mrr_delta").alias("d"))
    return g.select("obs_month", money_double("d").alias("net_mrr_delta"), sign_label("d").alias("velocity_label"))


def at_risk_arr(spine: DataFrame) -> DataFrame:
    """G-n: ARR on month-end rows with friction > 5 or CSAT < 3, per month."""
    s = month_end_rows(spine)
    risky = (F.col("daily_friction_events") > config.AT_RISK_FRICTION) | (F.col("avg_csat_score") < config.AT_RISK_CSAT)
    return s.groupBy("obs_month").agg(
        money_double(F.sum(F.when(risky, F.col(MRR) * 12).otherwise(0))).alias("at_risk_arr"),
        F.count(F.when(risky, 1)).alias("at_risk_accounts"),
    )


def growth_multiple(spine: DataFrame) -> DataFrame:
    """G-d/e/f: latest-date MRR over the first month's month-end MRR."""
    if YM in spine.columns:  # one month's partition on either end
        opening = spine.where(F.col(YM) == spine.select(F.min(YM)).scalar())
    else:
        opening = spine.where(month_bucket(DATE) == spine.select(F.min(month_bucket(DATE))).scalar())
    first = opening.where(F.col(DATE) == opening.select(F.max(DATE)).scalar())
    ends = first.select(F.col(MRR).alias("f"), F.lit(None).alias("l")).unionByName(on_latest(spine).select(F.lit(None).alias("f"), F.col(MRR).alias("l")))
    g = ends.agg(F.coalesce(F.sum("f"), F.lit(0)).alias("f"), F.coalesce(F.sum("l"), F.lit(0)).alias("l"))
    return g.select(
        money_double("f").alias("first_month_mrr"),
        money_double("l").alias("latest_mrr"),
        half_up_ratio(cents("l"), cents("f")).alias("growth_multiple"),
    )


# --------------------------------------------------------------------------
# churn sheets
# --------------------------------------------------------------------------


def churned_arr_by_tier(spine: DataFrame, days: int = config.TRAILING_LONG_DAYS) -> DataFrame:
    """G7 / G-g: ARR on churn rows of the trailing window, by tier (every tier
    seen in the window, 0 without churn), with percent of total (a table
    calculation over the few tier rows)."""
    # The sheet keeps every trailing-window row and sums a measure that is
    # MRR x 12 on churn rows and 0 elsewhere, so tiers without churn show 0.
    rows = since(spine, days)
    churned = F.when(F.col("target_churn_flag") == 1, F.col(MRR) * 12).otherwise(F.lit(0).cast("decimal(10,2)"))
    g = rows.groupBy("baseline_tier").agg(F.sum(churned).alias("arr"))
    total = F.sum("arr").over(W.partitionBy())  # over <= number of tiers rows
    return g.select(
        "baseline_tier",
        money_double("arr").alias("churned_arr_90d"),
        money_double(total).alias("total_churned_arr_90d"),
        half_up_ratio(cents("arr") * 100, cents(total)).alias("pct_of_total"),
    ).orderBy(F.desc("churned_arr_90d"), "baseline_tier")


def recognized_churned_arr(spine: DataFrame) -> DataFrame:
    """G-i: ARR on every churn row (no trailing window), by tier."""
    rows = spine.where(F.col("target_churn_flag") == 1)
    return rows.groupBy("baseline_tier").agg(
        money_double(F.sum(F.col(MRR) * 12)).alias("recognized_churned_arr"),
        F.count(F.lit(1)).alias("churn_rows"),
    )


def churned_account_arr(spine: DataFrame, days: int = config.TRAILING_LONG_DAYS) -> DataFrame:
    """G-a/b/c: per account - churned in the trailing window, its peak ARR,
    and the ARR on its trailing-window churn rows (accounts with a flag only)."""
    t = trailing(spine, days)
    hit = (F.col("target_churn_flag") == 1) & t
    g = spine.groupBy("account_id").agg(
        F.max(F.when(hit, 1).otherwise(0)).alias("churned_account_flag"),
        F.max(MRR).alias("peak_mrr"),
        F.max(F.when(hit, F.col(MRR) * 12).otherwise(0)).alias("lod_arr"),
    )
    return g.where(F.col("churned_account_flag") == 1).select(
        "account_id",
        "churned_account_flag",
        money_double(F.col("peak_mrr") * 12).alias("churned_arr_fixed"),
        money_double("lod_arr").alias("churned_arr_lod"),
    )


def cohort_retention(spine: DataFrame, max_months: int = config.COHORT_MAX_MONTHS) -> DataFrame:
    """G8 / G-o: share of each cohort present on month-end dates, months 0..12.

    (account_id, observation_date) is the table's key and a month has one
    month-end date, so rows per (cohort, month) are distinct accounts."""
    c = cohorts(spine)
    size = c.groupBy("cohort_month").agg(F.count(F.lit(1)).alias("cohort_size"))
    s = month_end_rows(spine).join(c, "account_id")
    s = s.withColumn("months_since", calendar_month_diff("cohort_month", "obs_month"))
    s = s.where(F.col("months_since").between(0, max_months))
    g = s.groupBy("cohort_month", "months_since").agg(F.count(F.lit(1)).alias("retained_accounts"))
    g = g.join(F.broadcast(size), "cohort_month")  # <= months in the calendar range
    return g.select(
        "cohort_month",
        "months_since",
        "retained_accounts",
        "cohort_size",
        half_up_ratio("retained_accounts", "cohort_size").alias("retention_pct"),
    ).orderBy("cohort_month", "months_since")


def churn_reasons(churn_events: DataFrame, date_from, date_to, exact: bool = True) -> DataFrame:
    """Distinct exits per reason in a date range, with the mean line."""
    ev = churn_events.where(F.col("churn_date").between(F.lit(str(date_from)).cast("date"), F.lit(str(date_to)).cast("date")))
    g = ev.groupBy("reason_code").agg(distinct_count(F.col("churn_event_id"), exact).alias("exits"))
    total = F.sum("exits").over(W.partitionBy())  # over <= number of reasons rows
    return g.select(
        "reason_code",
        "exits",
        half_up_ratio(total, F.count(F.lit(1)).over(W.partitionBy())).alias("avg_exits"),
        half_up_ratio(F.col("exits") * 100, total).alias("pct_of_exits"),
    ).orderBy(F.desc("exits"), "reason_code")


def support_resolution(support_tickets: DataFrame, date_from, date_to) -> DataFrame:
    """Mean resolution hours by priority (urgent, high, medium, low order)."""
    t = support_tickets.where(ts_on_days("submitted_at", date_from, date_to))
    h = F.col("resolution_time_hours")
    g = t.groupBy("priority").agg(
        F.sum(cents(h)).alias("h_cents"), F.count(h).alias("h_n"), F.count(F.lit(1)).alias("tickets")
    )
    order = F.array(*[F.lit(p) for p in config.PRIORITY_ORDER])
    return g.select(
        "priority",
        F.array_position(order, F.col("priority")).cast("int").alias("sort_order"),
        half_up_ratio("h_cents", F.col("h_n") * 100).alias("avg_resolution_hours"),
        "tickets",
    ).orderBy("sort_order", "priority")
