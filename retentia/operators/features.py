"""Per-account feature table over the last 30 days before the observation end.

Per account: exit = last churn-flag date; observation end = exit - 1 day,
or the panel's latest date when the account never churned; the window is
``(end - 30, end]``.  Inside it: first non-null categorical values (date
order), last non-null MRR, sums / maxima / means of the daily measures, a
support-contact flag and the usage momentum ``mean(last 7 days) /
(mean(previous 23 days) + 1)`` (1.0 when either part is empty).  Accounts
with no row in their window drop out.  The label is "any churn flag ever".

Plan: one account-level aggregation (exit, first seen, label), joined back
to the panel on account_id, then one aggregation on the same key - the
join output is already partitioned by account_id, so the panel is shuffled
once.  A very large account is split by AQE's skew-join handling; the
aggregations combine map-side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentia import config
from retentia.functions.expressions import cents, half_up_ratio

DATE = "observation_date"

CATEGORICAL = ("industry", "baseline_tier", "referral_source", "billing_frequency")
NUMERIC = (
    "active_mrr_run_rate",
    "net_mrr_delta",
    "downgrade_flag",
    "auto_renew_flag",
    "is_trial",
    "daily_time_in_app",
    "daily_friction_events",
    "beta_interactions",
    "ticket_volume",
    "avg_resolution_time",
    "avg_csat_score",
    "had_support_contact",
    "app_usage_momentum",
)
# The 17 model inputs, in the feature table's column order.
MODEL_FEATURES = (
    "industry",
    "baseline_tier",
    "referral_source",
    "billing_frequency",
    "active_mrr_run_rate",
    "net_mrr_delta",
    "downgrade_flag",
    "auto_renew_flag",
    "is_trial",
    "daily_time_in_app",
    "daily_friction_events",
    "beta_interactions",
    "ticket_volume",
    "avg_resolution_time",
    "avg_csat_score",
    "had_support_contact",
    "app_usage_momentum",
)


# Means that the report rounds to 4 places and the model takes as they are.
MEANS = ("daily_time_in_app", "avg_resolution_time", "avg_csat_score", "app_usage_momentum")


def unrounded(features: DataFrame) -> DataFrame:
    """The features with their means as the model takes them, where ``feature_window`` kept them."""
    kept = {c: F.col(f"exact_{c}") for c in MEANS if f"exact_{c}" in features.columns}
    return features.withColumns(kept).drop(*[f"exact_{c}" for c in kept])


def _first_non_null(c: str) -> Column:
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(DATE)))


def _last_non_null(c: str) -> Column:
    return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(DATE)))


def account_profile(spine: DataFrame) -> DataFrame:
    """(account_id, exit_date, first_seen_date, target_churn_flag)."""
    return spine.groupBy("account_id").agg(
        F.max(F.when(F.col("target_churn_flag") == 1, F.col(DATE))).alias("exit_date"),
        F.min(DATE).alias("first_seen_date"),
        F.max("target_churn_flag").cast("int").alias("target_churn_flag"),
    )


def feature_window(
    spine: DataFrame, days: int = config.FEATURE_WINDOW_DAYS, recent: int = config.FEATURE_RECENT_DAYS, exact: bool = False,
    rows: Callable[[DataFrame, int], DataFrame] | None = None,
) -> DataFrame:
    """``exact`` adds the unrounded means as ``exact_<name>``, for the model.  ``rows`` gives the panel rows of the accounts' windows, and
    maybe others, from (account_id, eval_end_date) and ``days``, where a reader can find them without all others."""
    from retentia.plans.dashboard import latest_date

    latest = latest_date(spine)
    prof = account_profile(spine).withColumnRenamed("target_churn_flag", "_label").withColumn(
        "eval_end_date", F.coalesce(F.date_sub(F.col("exit_date"), 1), latest)
    )
    # One row an account: hashed, so that the panel is neither sorted nor moved where it comes by account.
    s = rows(prof.select("account_id", "eval_end_date"), days) if rows else spine
    s = s.join(prof.hint("shuffle_hash"), "account_id")
    s = s.where((F.col(DATE) > F.date_sub("eval_end_date", days)) & (F.col(DATE) <= F.col("eval_end_date")))
    recent_row = F.col(DATE) > F.date_sub("eval_end_date", recent)
    t = F.col("daily_time_in_app").cast("bigint")
    res, csat = F.col("avg_resolution_time"), F.col("avg_csat_score")
    g = s.groupBy("account_id").agg(
        *[_first_non_null(c).alias(c) for c in CATEGORICAL],
        _last_non_null("active_mrr_run_rate").cast("double").alias("active_mrr_run_rate"),
        F.sum("net_mrr_delta").cast("double").alias("net_mrr_delta"),
        F.max("downgrade_flag").alias("downgrade_flag"),
        F.max("auto_renew_flag").alias("auto_renew_flag"),
        F.max("is_trial").alias("is_trial"),
        F.sum(t).alias("_t_sum"),
        F.count(t).alias("_t_n"),
        F.sum("daily_friction_events").cast("bigint").alias("daily_friction_events"),
        F.sum("beta_interactions").cast("bigint").alias("beta_interactions"),
        F.sum("ticket_volume").cast("bigint").alias("ticket_volume"),
        F.sum(cents(res)).alias("_res_sum"),
        F.count(res).alias("_res_n"),
        F.sum((csat * 10).cast("bigint")).alias("_csat_sum"),
        F.count(csat).alias("_csat_n"),
        F.max("eval_end_date").alias("eval_end_date"),
        F.sum(F.when(recent_row, t)).alias("_r_sum"),
        F.count(F.when(recent_row, t)).alias("_r_n"),
        F.sum(F.when(~recent_row, t)).alias("_p_sum"),
        F.count(F.when(~recent_row, t)).alias("_p_n"),
        F.max("_label").alias("target_churn_flag"),
        F.max("first_seen_date").alias("first_seen_date"),
    )
    # Means are rounded half-up to 4 decimals on the exact quotient:
    # momentum = (r_sum / r_n) / (p_sum / p_n + 1) = r_sum * p_n / (r_n * (p_sum + p_n)).
    momentum = F.when(
        (F.col("_r_n") > 0) & (F.col("_p_n") > 0),
        half_up_ratio(F.col("_r_sum") * F.col("_p_n"), F.col("_r_n") * (F.col("_p_sum") + F.col("_p_n"))),
    )
    quotient = lambda a, b: F.when(F.col(b) > 0, F.col(a).cast("double") / F.col(b))
    means = {
        "daily_time_in_app": quotient("_t_sum", "_t_n"),
        "avg_resolution_time": quotient("_res_sum", "_res_n") / 100,
        "avg_csat_score": quotient("_csat_sum", "_csat_n") / 10,
        "app_usage_momentum": F.coalesce(quotient("_r_sum", "_r_n") / (quotient("_p_sum", "_p_n") + 1), F.lit(1.0)),
    }
    return g.select(
        "account_id",
        *CATEGORICAL,
        "active_mrr_run_rate",
        "net_mrr_delta",
        "downgrade_flag",
        "auto_renew_flag",
        "is_trial",
        half_up_ratio("_t_sum", "_t_n").alias("daily_time_in_app"),
        "daily_friction_events",
        "beta_interactions",
        "ticket_volume",
        half_up_ratio("_res_sum", F.col("_res_n") * 100).alias("avg_resolution_time"),
        half_up_ratio("_csat_sum", F.col("_csat_n") * 10).alias("avg_csat_score"),
        "eval_end_date",
        (F.col("ticket_volume") > 0).cast("int").alias("had_support_contact"),
        F.coalesce(momentum, F.lit(1.0)).alias("app_usage_momentum"),
        "target_churn_flag",
        "first_seen_date",
        *[means[c].alias(f"exact_{c}") for c in MEANS if exact],
    )


def churn_label(spine: DataFrame) -> DataFrame:
    """(account_id, target_churn_flag) - any churn flag in the panel."""
    return spine.groupBy("account_id").agg(F.max("target_churn_flag").cast("int").alias("target_churn_flag"))
