"""Daily account panel ("spine"): one row per account per observed day.

Semantics (per refresh window ``[from, to]``):

* churn cut: the account's latest churn on or before ``to`` ends its rows
  (the churn day itself is kept, later days are not);
* rows run from ``max(signup, from, calendar start)`` to
  ``min(churn cut, to, calendar end)``;
* the governing subscription of a day is the active one (``start <= day``,
  ``end`` NULL or ``>= day``) with the latest start, then the highest MRR
  (subscription_id breaks the remaining ties); it supplies MRR, daily
  accrual, billing frequency and the flags, with 0 / 'none' when none is
  active;
* ``net_mrr_delta`` = MRR - MRR of the previous day, where the previous day
  counts only if it is on/after ``max(signup, calendar start)``; on the
  churn day the delta is ``-previous MRR`` and ``target_churn_flag`` = 1;
* usage (summed per day through the subscription's account) and tickets
  (count, mean resolution hours, mean CSAT per submission day) are
  attached to existing rows only.

Two modes: ``window`` cuts churn per refresh window (an account that
churned, then churned again later has a gap between the two), and
``as_of_run`` uses a single cut at the end of the whole period.

Plan shape: no range join, no ``lag``, and no row per subscription and day.
Subscriptions and panel stays as they are (account, first day, last day), usage
days and ticket days are shuffled once, by account.  Behind that shuffle a span
becomes one row per month it touches, (account, month, first day, last day); a
month's subscriptions with the same first and last day are reduced to the
greatest, so even an account with very many has at most some 500 such change
points a month.  One aggregation adds rows of the same key up, a second one by
account and month gathers what is left of a month, and only there, when the
panel is written, months are expanded into days.  Both take their rows in sorted
order, which spills, so an account's months need no room of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentia.config import AnalysisPeriod
from retentia.functions.expressions import days_in_month, ts_on_days
from retentia.sources.raw import RawTables

WINDOW_MODE = "window"
AS_OF_RUN_MODE = "as_of_run"


def _date(d) -> Column:
    return F.lit(str(d)).cast("date")


def window_array(period: AnalysisPeriod) -> Column:
    """The refresh windows as an array<struct<w, w_from, w_to>> literal."""
    return F.array(
        *[
            F.struct(F.lit(i).alias("w"), _date(a).alias("w_from"), _date(b).alias("w_to"))
            for i, (a, b) in enumerate(period.windows)
        ]
    )


def _resolve(period: AnalysisPeriod, mode: str) -> AnalysisPeriod:
    if mode == WINDOW_MODE:
        return period
    if mode == AS_OF_RUN_MODE:
        return period.as_of_run()
    raise ValueError(f"unknown spine mode {mode!r}")


# --------------------------------------------------------------------------
# churn cut and account bounds
# --------------------------------------------------------------------------


def latest_churn(churn_events: DataFrame, period: AnalysisPeriod) -> DataFrame:
    """(account_id, w, churn_date): latest churn on or before each window end.

    Each event fans out to the windows ending on/after it (at most the number
    of windows, a parameter), then ``max`` per (account, window)."""
    ev = churn_events.select("account_id", "churn_date").where(F.col("churn_date") <= _date(period.last_to))
    wins = F.filter(window_array(period), lambda x: x["w_to"] >= F.col("churn_date"))
    ev = ev.select("account_id", "churn_date", F.explode(wins).alias("win"))
    return ev.groupBy("account_id", F.col("win.w").alias("w")).agg(F.max("churn_date").alias("churn_date"))


def account_windows(accounts: DataFrame, churn_cut: DataFrame, period: AnalysisPeriod) -> DataFrame:
    """One row per (account, window) with a non-empty day range ``[lo, hi]``."""
    acc = accounts.select(
        "account_id",
        "industry",
        F.col("plan_tier").alias("baseline_tier"),
        "referral_source",
        "signup_date",
    )
    wins = F.filter(window_array(period), lambda x: x["w_to"] >= F.col("signup_date"))
    acc = acc.select("*", F.explode(wins).alias("win")).select(
        "*", F.col("win.w").alias("w"), F.col("win.w_from").alias("w_from"), F.col("win.w_to").alias("w_to")
    ).drop("win")
    acc = acc.join(churn_cut, ["account_id", "w"], "left")
    lo = F.greatest(F.col("signup_date"), F.col("w_from"), _date(period.cal_start))
    hi = F.least(F.coalesce(F.col("churn_date"), F.col("w_to")), F.col("w_to"), _date(period.cal_end))
    return (
        acc.select(
            "account_id",
            "w",
            "industry",
            "baseline_tier",
            "referral_source",
            "churn_date",
            lo.alias("lo"),
            hi.alias("hi"),
            F.greatest(F.col("signup_date"), _date(period.cal_start)).alias("lo_full"),
        )
        .where(F.col("lo") <= F.col("hi"))
    )


def spine_days(bounds: DataFrame) -> DataFrame:
    """Account-days of the panel (the row set of the fact table); accounts are dealt to all tasks first, as their table may come in few."""
    n = int(bounds.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return bounds.repartition(n).select(
        "account_id",
        F.explode(F.sequence("lo", "hi")).alias("observation_date"),
        "w",
        "churn_date",
        "lo_full",
        "industry",
        "baseline_tier",
        "referral_source",
    )


# --------------------------------------------------------------------------
# subscriptions, usage, tickets as (account_id, day) rows
# --------------------------------------------------------------------------

_GOV_ORDER = ("start_date", "mrr_amount", "subscription_id")
_GOV_PAYLOAD = ("downgrade_flag", "billing_frequency", "auto_renew_flag", "is_trial")


def month_key(day: Column) -> Column:
    return (F.year(day) * 100 + F.month(day)).cast("int")


def _months(lo: Column, hi: Column) -> Column:
    """First days of the months that the days lo to hi touch."""
    return F.explode(F.sequence(F.trunc(lo, "month"), F.trunc(hi, "month"), F.expr("interval 1 month")))


def subscription_spans(subscriptions: DataFrame, period: AnalysisPeriod) -> DataFrame:
    """(account_id, a, b, gov): each subscription's active days that bear on the period (its days, and the day before them), with no join."""
    first, last = _date(period.first_from), _date(period.last_to)
    s = subscriptions.where((F.col("start_date") <= last) & (F.col("end_date").isNull() | (F.col("end_date") >= F.date_sub(first, 1))))
    a = F.greatest(F.col("start_date"), F.date_sub(first, 1))
    b = F.least(F.coalesce(F.col("end_date"), last), last)
    gov = F.struct(*[F.col(c) for c in _GOV_ORDER + _GOV_PAYLOAD])
    return s.select("account_id", a.alias("a"), b.alias("b"), gov.alias("gov")).where("a <= b")


_STAY = ("lo_full", "churn_date", "industry", "baseline_tier", "referral_source")


def stay_spans(bounds: DataFrame) -> DataFrame:
    """(account_id, a, b, stay): an account's panel days of each window."""
    return bounds.select("account_id", F.col("lo").alias("a"), F.col("hi").alias("b"), F.struct(*_STAY).alias("stay"))


def spans_by_month(spans: DataFrame, period: AnalysisPeriod) -> DataFrame:
    """The spans again, a row for each month they touch, as (obs_ym, d1, d2): their days there.

    A subscription also counts on the day before a month (a month's first day has a day before it, too) and touches the month after its last day."""
    first, last = _date(period.first_from), _date(period.last_to)
    sub = F.col("gov").isNotNull()
    m = _months(F.when(sub, F.greatest("a", first)).otherwise(F.col("a")), F.when(sub, F.least(F.date_add("b", 1), last)).otherwise(F.col("b")))
    rest = [c for c in spans.columns if c not in ("account_id", "a", "b")]
    d1 = F.greatest(F.col("a"), F.when(sub, F.date_sub("m", 1)).otherwise(F.col("m")))
    return spans.select("*", m.alias("m")).select("account_id", month_key(F.col("m")).alias("obs_ym"), d1.alias("d1"), F.least(F.col("b"), F.last_day("m")).alias("d2"), *rest)


def _as_of(c: Column, period: AnalysisPeriod, lower: bool) -> Column:
    """``c <= to`` (the as-of cut); with ``lower`` also ``c >= from`` - safe
    inside the spine, whose rows all lie on/after the first window start."""
    cond = c <= _date(period.last_to)
    return cond & (c >= _date(period.first_from)) if lower else cond


def _usage_rows(
    feature_usage: DataFrame, subscriptions: DataFrame, period: AnalysisPeriod, lower: bool = True
) -> DataFrame:
    """Usage summed per (subscription, day) *before* the join to subscriptions:
    a subscription then brings at most one row per day to the join, however
    many events it has (map-side partial sums do the reduction)."""
    u = feature_usage.select(
        "subscription_id", "usage_date", "usage_duration_secs", "error_count", "is_beta_feature"
    ).where(_as_of(F.col("usage_date"), period, lower))
    u = u.groupBy("subscription_id", "usage_date").agg(
        F.sum("usage_duration_secs").alias("u_time"),
        F.sum("error_count").alias("u_err"),
        F.sum("is_beta_feature").alias("u_beta"),
    )
    s = subscriptions.select("subscription_id", "account_id")
    return u.join(s, "subscription_id", "inner").select(
        "account_id", F.col("usage_date").alias("observation_date"), "u_time", "u_err", "u_beta"
    )


def telemetry_rollup(
    feature_usage: DataFrame, subscriptions: DataFrame, period: AnalysisPeriod, lower: bool = False
) -> DataFrame:
    """Usage summed per (account, usage day) through the subscription's account."""
    return (
        _usage_rows(feature_usage, subscriptions, period, lower)
        .groupBy("account_id", F.col("observation_date").alias("activity_date"))
        .agg(
            F.sum("u_time").cast("bigint").alias("daily_time_in_app"),
            F.sum("u_err").cast("bigint").alias("daily_friction_events"),
            F.sum("u_beta").cast("bigint").alias("beta_interactions"),
        )
    )


def _ticket_rows(support_tickets: DataFrame, period: AnalysisPeriod, lower: bool = True) -> DataFrame:
    d = F.to_date("submitted_at")
    pushable = ts_on_days("submitted_at", period.first_from if lower else None, period.last_to)
    return support_tickets.where(pushable & _as_of(d, period, lower)).select(
        "account_id",
        d.alias("observation_date"),
        F.when(F.col("ticket_id").isNotNull(), F.lit(1)).alias("t_n"),
        F.col("resolution_time_hours").alias("t_res"),
        F.col("satisfaction_score").alias("t_csat"),
    )


def support_friction(support_tickets: DataFrame, period: AnalysisPeriod, lower: bool = False) -> DataFrame:
    """Tickets per (account, submission day): count, mean hours, mean CSAT."""
    return (
        _ticket_rows(support_tickets, period, lower)
        .groupBy("account_id", F.col("observation_date").alias("ticket_date"))
        .agg(
            F.count("t_n").alias("support_volume"),
            F.avg("t_res").cast("decimal(10,2)").alias("avg_resolution_time"),
            F.avg("t_csat").cast("decimal(3,1)").alias("avg_csat_score"),
        )
    )


# --------------------------------------------------------------------------
# the fact table
# --------------------------------------------------------------------------


def spine_bounds(raw: RawTables, period: AnalysisPeriod, mode: str = WINDOW_MODE) -> DataFrame:
    p = _resolve(period, mode)
    return account_windows(raw.accounts, latest_churn(raw.churn_events, p), p)


def spine_row_count(raw: RawTables, period: AnalysisPeriod, mode: str = WINDOW_MODE) -> int:
    """Exact number of fact rows, from the per-(account, window) day ranges
    alone - a small job over accounts and churn events, used to size the
    fact table's buckets before the spine is built."""
    b = spine_bounds(raw, period, mode)
    n = b.agg(F.sum(F.datediff("hi", "lo") + 1).alias("n")).first()["n"]
    return int(n or 0)


_SUMS = ("u_time", "u_err", "u_beta")


def account_months(bounds: DataFrame, subscriptions: DataFrame, period: AnalysisPeriod, usage: DataFrame | None = None, tickets: DataFrame | None = None, partitions: int | None = None) -> DataFrame:
    """One row per account and month with all that its panel days need: stays, subs (change points of the governing
    subscription) and acts (days with usage or tickets), as arrays; their sizes are bounded by the days of a month."""
    spans = stay_spans(bounds).unionByName(subscription_spans(subscriptions, period), allowMissingColumns=True)
    day = F.col("observation_date")
    for one in (usage, tickets):
        if one is not None:
            dated = one.select("account_id", day.alias("a"), day.alias("b"), *[c for c in one.columns if c not in ("account_id", "observation_date")])
            spans = spans.unionByName(dated, allowMissingColumns=True)
    n = partitions or int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = spans_by_month(spans.repartition(n, "account_id"), period)
    sums = [F.sum(c).alias(c) if c in rows.columns else F.lit(None).cast("bigint").alias(c) for c in _SUMS]
    of_tickets = [F.count("t_n").alias("t_n"), F.avg("t_res").alias("t_res"), F.avg("t_csat").alias("t_csat")] if tickets is not None else [F.lit(0).cast("bigint").alias("t_n"), F.lit(None).cast("decimal(14,6)").alias("t_res"), F.lit(None).cast("decimal(7,5)").alias("t_csat")]
    points = rows.groupBy("account_id", "obs_ym", "d1", "d2").agg(F.max("stay").alias("stay"), F.max("gov").alias("gov"), *sums, *of_tickets)
    span = lambda *c: F.struct("d1", "d2", *c)
    acts = F.struct(F.col("d1").alias("day"), *_SUMS, "t_n", "t_res", "t_csat")
    active = (F.col("t_n") > 0) | F.greatest(*_SUMS).isNotNull()
    return points.groupBy("account_id", "obs_ym").agg(
        F.collect_list(F.when(F.col("stay").isNotNull(), span("stay"))).alias("stays"),
        F.collect_list(F.when(F.col("gov").isNotNull(), span("gov"))).alias("subs"),
        F.collect_list(F.when(active, acts)).alias("acts"),
    )


def panel_runs(months: DataFrame) -> DataFrame:
    """The panel's rows as runs: (account_id, obs_ym, first, last) with the stay, the governing subscription of the run (``gov``) and of
    the day before it (``gov_eve``), and the month's days with usage or tickets (``acts``, by day).

    The governing subscription changes only where one starts or the day after one ends, so a run goes from one such day to the next."""
    acts = F.map_from_entries(F.transform("acts", lambda x: F.struct(x["day"], x)))
    one = months.where(F.size("stays") > 0).select("account_id", "obs_ym", "subs", acts.alias("acts"), F.inline("stays"))
    turns = F.concat(F.transform("subs", lambda x: x["d1"]), F.transform("subs", lambda x: F.date_add(x["d2"], 1)))
    starts = F.concat(F.array("d1"), F.array_sort(F.array_distinct(F.filter(turns, lambda d: (F.col("d1") < d) & (d <= F.col("d2"))))))
    one = one.select("*", starts.alias("starts"))
    top = lambda d: F.array_max(F.transform(F.filter("subs", lambda x: (x["d1"] <= d) & (d <= x["d2"])), lambda x: x["gov"]))
    end = lambda i: F.coalesce(F.date_sub(F.get("starts", i + 1), 1), F.col("d2"))
    run = lambda d, i: F.struct(d.alias("first"), end(i).alias("last"), top(d).alias("gov"), top(F.date_sub(d, 1)).alias("gov_eve"))
    return one.select("account_id", "obs_ym", "stay.*", "acts", F.inline(F.transform("starts", run)))


def panel_days(runs: DataFrame) -> DataFrame:
    """The panel's days with the governing subscription of the day and of the day before, usage and tickets.

    Only the day itself is generated; the rest is a projection, so a reader computes the columns that it takes, and those alone."""
    days = runs.select("*", F.explode(F.sequence("first", "last")).alias("observation_date"))
    day = F.col("observation_date")
    act = F.element_at("acts", day)
    acts = [*[act[c].alias(c) for c in (*_SUMS, "t_res", "t_csat")], F.coalesce(act["t_n"], F.lit(0)).alias("t_n")]
    eve = F.when(day == F.col("first"), F.col("gov_eve")).otherwise(F.col("gov"))
    return days.select("account_id", "obs_ym", "observation_date", *_STAY, "gov", eve.alias("gov_prev"), *acts)


def governing_runs(raw: RawTables, period: AnalysisPeriod, mode: str = WINDOW_MODE, partitions: int | None = None) -> DataFrame:
    """``panel_runs`` without usage and tickets."""
    p = _resolve(period, mode)
    return panel_runs(account_months(spine_bounds(raw, period, mode), raw.subscriptions, p, partitions=partitions))


def governing_subscription(raw: RawTables, period: AnalysisPeriod, mode: str = WINDOW_MODE) -> DataFrame:
    """Per panel day (account_id, observation_date): the governing subscription (``gov``) and the day before's (``gov_prev``), null where none is active;
    ``first_day`` is the account's first day in the calendar."""
    return panel_days(governing_runs(raw, period, mode)).select("account_id", "observation_date", "gov", "gov_prev", F.col("lo_full").alias("first_day"))


def spine_runs(raw: RawTables, period: AnalysisPeriod, mode: str = WINDOW_MODE, partitions: int | None = None) -> DataFrame:
    """The panel as runs (``panel_runs``), hash-partitioned by account into ``partitions`` parts (default: the shuffle partition count)."""
    p = _resolve(period, mode)
    usage = _usage_rows(raw.feature_usage, raw.subscriptions, p)
    tickets = _ticket_rows(raw.support_tickets, p)
    return panel_runs(account_months(spine_bounds(raw, period, mode), raw.subscriptions, p, usage, tickets, partitions))


def spine_of_runs(runs: DataFrame) -> DataFrame:
    """The daily fact table and its month (``obs_ym``) from the panel's runs."""
    return finish_spine(panel_days(runs))


def daily_spine(raw: RawTables, period: AnalysisPeriod, mode: str = WINDOW_MODE, partitions: int | None = None) -> DataFrame:
    """The daily fact table (schema ``retentia.schemas.DAILY_SPINE``).

    One plan at every size.  The rows come hash-partitioned by account into ``partitions`` parts (default: the shuffle
    partition count), which is how ``store.materialize`` places buckets, so that the panel itself is never shuffled."""
    return spine_of_runs(spine_runs(raw, period, mode, partitions).sortWithinPartitions("account_id", "first")).drop("obs_ym")


def finish_spine(g: DataFrame) -> DataFrame:
    """Defaults, churn-day override and the fact table's column types; the month last."""
    day = F.col("observation_date")
    mrr = F.coalesce(F.col("gov.mrr_amount"), F.lit(0).cast("decimal(10,2)"))
    prev = F.when(
        F.date_sub(day, 1) >= F.col("lo_full"), F.coalesce(F.col("gov_prev.mrr_amount"), F.lit(0).cast("decimal(10,2)"))
    ).otherwise(F.lit(0).cast("decimal(10,2)"))
    is_churn_day = F.col("churn_date").isNotNull() & (F.col("churn_date") == day)
    return g.select(
        "account_id",
        day.alias("observation_date"),
        "industry",
        "baseline_tier",
        "referral_source",
        mrr.cast("decimal(10,2)").alias("active_mrr_run_rate"),
        (mrr / days_in_month(day)).cast("decimal(10,4)").alias("daily_billing_accrual"),
        F.coalesce(F.col("gov.billing_frequency"), F.lit("none")).alias("billing_frequency"),
        F.coalesce(F.col("gov.auto_renew_flag"), F.lit(0)).cast("int").alias("auto_renew_flag"),
        F.coalesce(F.col("gov.is_trial"), F.lit(0)).cast("int").alias("is_trial"),
        F.coalesce(F.col("gov.downgrade_flag"), F.lit(0)).cast("int").alias("downgrade_flag"),
        F.coalesce(F.col("u_time"), F.lit(0)).cast("int").alias("daily_time_in_app"),
        F.coalesce(F.col("u_err"), F.lit(0)).cast("int").alias("daily_friction_events"),
        F.coalesce(F.col("u_beta"), F.lit(0)).cast("int").alias("beta_interactions"),
        F.col("t_n").cast("int").alias("ticket_volume"),
        F.col("t_res").cast("decimal(10,2)").alias("avg_resolution_time"),
        F.col("t_csat").cast("decimal(3,1)").alias("avg_csat_score"),
        F.when(is_churn_day, F.lit(1)).otherwise(F.lit(0)).alias("target_churn_flag"),
        F.when(is_churn_day, -prev).otherwise(mrr - prev).cast("decimal(10,2)").alias("net_mrr_delta"),
        "obs_ym",
    )
