"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the provided test tables (through the adapter) or the
fact table Spark derives from them.  Money and means are reported as
doubles rounded half-up to 4 decimals; counts as bigint; dates as date.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retentia import schemas
from retentia.config import DEFAULT_PERIOD
from retentia.operators import features as feat
from retentia.operators import quality, spine, split, survival
from retentia.plans import dashboard as dash
from retentia.plans.context import fact_buckets, fact_runs, fact_table, feature_table, month_rollup, raw_tables, window_rows
from retentia.session import scratch_path, session_key, ship_by_value
from retentia.sources import adapter, csv_ingest, rejects, rollup
from retentia.sources.raw import RawTables
from retentia.streaming import usage_state

P = DEFAULT_PERIOD
Query = Callable[[SparkSession, str], DataFrame]


def decimals_to_double(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.round(F.col(f.name), 4).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# -- spine building blocks ---------------------------------------------------


def q_usage_dedup(spark, sf):
    return raw_tables(spark, sf).feature_usage


_STREAMED: dict[tuple, str] = {}


def q_usage_dedup_streamed(spark, sf):
    """F1 on a stream: usage with its re-delivered copies lands as files; micro-batches of a quarter of them meet keyed state."""
    key = (session_key(spark), sf.rstrip("/"))
    if key not in _STREAMED:
        path = scratch_path(spark, "usage-stream")
        staging = adapter.feature_usage_staging(adapter.load_test_tables(spark, sf)["lineitem"])
        staging.write.parquet(f"{path}/landing")
        files = len(spark.read.parquet(f"{path}/landing").inputFiles())
        ship_by_value(usage_state, schemas)
        usage_state.start_usage_dedup(
            spark, f"{path}/landing", f"{path}/store", f"{path}/checkpoint", files_a_batch=max(files // 4, 1)
        ).awaitTermination()
        _STREAMED[key] = f"{path}/store"
    return usage_state.current_usage(spark, _STREAMED[key])


def q_latest_churn(spark, sf):
    return spine.latest_churn(raw_tables(spark, sf).churn_events, P)


def q_spine_days(spark, sf):
    b = spine.spine_bounds(raw_tables(spark, sf), P)
    return spine.spine_days(b).select("account_id", "observation_date", "w")


def q_governing_subscription(spark, sf):
    gov = spine.governing_subscription(raw_tables(spark, sf), P)
    return gov.select("account_id", "observation_date", F.col("gov.subscription_id").alias("subscription_id"))


def q_telemetry_rollup(spark, sf):
    raw = raw_tables(spark, sf)
    return spine.telemetry_rollup(raw.feature_usage, raw.subscriptions, P)


def q_support_friction(spark, sf):
    return decimals_to_double(spine.support_friction(raw_tables(spark, sf).support_tickets, P))


def q_mrr_delta(spark, sf):
    """the day before's MRR (0 before the account's first day in the calendar), looked up anew beside the stored delta.

    The lookup is by account, in its runs of days with one governing subscription; no side is broadcast or expanded for it."""
    raw = raw_tables(spark, sf)
    before = spine.governing_runs(raw, P, partitions=fact_buckets(spark, raw)).select(
        "account_id", "first", "last", F.col("gov.mrr_amount").alias("mrr"), F.col("gov_eve.mrr_amount").alias("mrr_eve"), F.col("lo_full").alias("first_day")
    )
    day = F.col("observation_date")
    rows = fact_table(spark, sf).join(before.hint("shuffle_hash"), "account_id").where(day.between(F.col("first"), F.col("last")))
    prev = F.when(day > F.col("first_day"), F.when(day == F.col("first"), F.col("mrr_eve")).otherwise(F.col("mrr")))
    return rows.select(
        "account_id",
        "observation_date",
        F.round("active_mrr_run_rate", 4).cast("double").alias("active_mrr_run_rate"),
        F.coalesce(F.round(prev, 4).cast("double"), F.lit(0.0)).alias("prev_day_mrr"),
        F.round("net_mrr_delta", 4).cast("double").alias("net_mrr_delta"),
    )


def q_daily_spine(spark, sf):
    return decimals_to_double(fact_table(spark, sf).drop("obs_ym"))


def q_daily_spine_as_of_run(spark, sf):
    return decimals_to_double(fact_table(spark, sf, mode=spine.AS_OF_RUN_MODE).drop("obs_ym"))


# -- quality -----------------------------------------------------------------


def q_table_counts(spark, sf):
    raw = raw_tables(spark, sf)
    t = dict(raw.as_dict())
    t["fact_daily_spine"] = fact_table(spark, sf)
    return quality.table_counts(t)


def q_pk_duplicates(spark, sf):
    raw = raw_tables(spark, sf)
    t = dict(raw.as_dict())
    t["feature_usage_staging"] = adapter.feature_usage_staging(adapter.load_test_tables(spark, sf)["lineitem"])
    keys = dict(quality.PRIMARY_KEYS, feature_usage_staging=["usage_id"])
    return quality.pk_duplicates(t, keys)


def q_orphans(spark, sf):
    return quality.orphans(raw_tables(spark, sf))


def q_boundary_check(spark, sf):
    return quality.boundary_check(fact_table(spark, sf), raw_tables(spark, sf).accounts, P)


def q_not_null_violations(spark, sf):
    return quality.not_null_violations(fact_table(spark, sf))


def q_dropped_activity(spark, sf):
    return quality.dropped_activity(raw_tables(spark, sf), fact_table(spark, sf), P, runs=fact_runs(spark, sf))


# -- raw CSV exports -----------------------------------------------------------


def q_csv_round_trip(spark, sf):
    """The raw tables written as CSV exports, loaded and typed again: a profile of each column."""
    paths = csv_ingest.write_raw_csv(raw_tables(spark, sf), scratch_path(spark, "csv"))
    return rejects.column_profile(csv_ingest.load_raw_csv(spark, paths))


def _damaged(raw: RawTables) -> RawTables:
    """The raw tables as text with bad fields in rows that their ids name."""
    hit = lambda c, n: F.substring_index(c, "-", -1).cast("bigint") % n == 0
    text = lambda c, key, n, bad: F.when(hit(key, n), F.lit(bad)).otherwise(F.col(c).cast("string"))
    return RawTables(
        raw.accounts.withColumn("seats", text("seats", "account_id", 17, "many")),
        raw.subscriptions.withColumn("start_date", text("start_date", "subscription_id", 11, "2000-02-30")),
        raw.feature_usage.withColumn("usage_id", text("usage_id", "usage_id", 13, None)),
        raw.support_tickets.withColumn("submitted_at", text("submitted_at", "ticket_id", 19, "noon")),
        raw.churn_events.withColumn("refund_amount_usd", text("refund_amount_usd", "churn_event_id", 5, "1,00")),
    )


def q_csv_load_report(spark, sf):
    """CSV exports of the raw tables with bad fields among them, loaded with a store of rejected rows: rows by outcome."""
    paths = csv_ingest.write_raw_csv(_damaged(raw_tables(spark, sf)), scratch_path(spark, "csv-damaged"))
    return rejects.load_report(*rejects.load_checked_csv(spark, paths, scratch_path(spark, "csv-loaded")))


# -- features, split, survival -------------------------------------------------


def q_feature_window(spark, sf):
    return feat.feature_window(fact_table(spark, sf), rows=window_rows(spark, sf))


def q_churn_label(spark, sf):
    return feat.churn_label(fact_table(spark, sf))


def q_cohort_split(spark, sf):
    return split.cohort_split(feature_table(spark, sf)).select("account_id", "position", "split")


def q_split_summary(spark, sf):
    return split.split_summary(split.cohort_split(feature_table(spark, sf)))


def q_survival_curve(spark, sf):
    c = survival.survival_curve(fact_table(spark, sf))
    return c.select(
        "t",
        "at_risk",
        "events",
        "censored",
        F.round("survival", 4).alias("survival"),
        F.round("greenwood_var", 6).alias("greenwood_var"),
        F.round("ci_lower", 4).alias("ci_lower"),
        F.round("ci_upper", 4).alias("ci_upper"),
    )


# -- dashboard -----------------------------------------------------------------


def _dash(fn):
    return lambda spark, sf: fn(fact_table(spark, sf))


def q_churn_reasons(spark, sf):
    return dash.churn_reasons(raw_tables(spark, sf).churn_events, P.cal_start, P.cal_end)


def q_support_resolution(spark, sf):
    return dash.support_resolution(raw_tables(spark, sf).support_tickets, P.cal_start, P.cal_end)


def q_cross_filtered_velocity(spark, sf):
    return dash.cross_filtered_velocity(fact_table(spark, sf), ["Enterprise"], ["2000-04-01", "2000-05-01", "2000-06-01"])


def q_cross_filtered_by_reason(spark, sf):
    return dash.cross_filtered_velocity(fact_table(spark, sf), reasons=["pricing", "support"], churn_events=raw_tables(spark, sf).churn_events)


def q_cross_filtered_by_priority(spark, sf):
    return dash.cross_filtered_velocity(fact_table(spark, sf), priorities=["urgent"], support_tickets=raw_tables(spark, sf).support_tickets)


def q_cross_filtered_by_cohort(spark, sf):
    return dash.cross_filtered_velocity(fact_table(spark, sf), cohort_cells=[("2000-01-01", 2), ("2000-02-01", 3)])


QUERIES: dict[str, Query] = {
    "usage_dedup": q_usage_dedup,
    "usage_dedup_streamed": q_usage_dedup_streamed,
    "csv_round_trip": q_csv_round_trip,
    "csv_load_report": q_csv_load_report,
    "latest_churn": q_latest_churn,
    "spine_days": q_spine_days,
    "governing_subscription": q_governing_subscription,
    "telemetry_rollup": q_telemetry_rollup,
    "support_friction": q_support_friction,
    "mrr_delta": q_mrr_delta,
    "daily_spine": q_daily_spine,
    "daily_spine_as_of_run": q_daily_spine_as_of_run,
    "table_counts": q_table_counts,
    "pk_duplicates": q_pk_duplicates,
    "orphans": q_orphans,
    "boundary_check": q_boundary_check,
    "not_null_violations": q_not_null_violations,
    "dropped_activity": q_dropped_activity,
    "feature_window": q_feature_window,
    "churn_label": q_churn_label,
    "cohort_split": q_cohort_split,
    "split_summary": q_split_summary,
    "survival_curve": q_survival_curve,
    "total_arr": _dash(dash.total_arr),
    "arpa": _dash(dash.arpa),
    "velocity_30d": _dash(dash.velocity_30d),
    "app_minutes_30d": _dash(dash.app_minutes_30d),
    "mrr_trajectory": _dash(dash.mrr_trajectory),
    "velocity_by_month": _dash(dash.velocity_by_month),
    "churned_arr_by_tier": _dash(dash.churned_arr_by_tier),
    "cohort_retention": _dash(dash.cohort_retention),
    "churn_reasons": q_churn_reasons,
    "support_resolution": q_support_resolution,
    "growth_multiple": _dash(dash.growth_multiple),
    "at_risk_arr": _dash(dash.at_risk_arr),
    "churned_account_arr": _dash(dash.churned_account_arr),
    "cross_filtered_velocity": q_cross_filtered_velocity,
    "cross_filtered_by_reason": q_cross_filtered_by_reason,
    "cross_filtered_by_priority": q_cross_filtered_by_priority,
    "cross_filtered_by_cohort": q_cross_filtered_by_cohort,
    "recognized_churned_arr": _dash(dash.recognized_churned_arr),
}


# -- model, scores, drivers ----------------------------------------------------

_MODEL_RUNS: dict[tuple, dict] = {}


def model_run(spark: SparkSession, sf: str) -> dict:
    """Features -> split -> boosted trees -> held-out report -> active scores ->
    tree drivers, once per (session, input folder)."""
    from retentia.operators import drivers, model

    key = (session_key(spark), sf.rstrip("/"))
    if key not in _MODEL_RUNS:
        fact = fact_table(spark, sf)
        # One row per account, read by the split, the fit, scoring and drivers.
        features = feature_table(spark, sf)
        sp = split.cohort_split(features)
        frame = model.boosted_frame(sp)
        trees = model.fit_boosted(frame)
        scored = model.score_active(trees, features)
        _MODEL_RUNS[key] = {
            "features": features,
            "frame": frame,
            "model": trees,
            "scored": scored,
            "drivers": drivers.boosted_drivers(trees, scored),
            "fact": fact,
        }
    return _MODEL_RUNS[key]


def q_model_report(spark, sf):
    from retentia.operators import model

    r = model_run(spark, sf)
    return model.evaluate(r["model"], r["frame"])


def q_risk_scores(spark, sf):
    from retentia.operators import roster

    r = model_run(spark, sf)
    return roster.risk_roster(r["scored"], r["drivers"], r["fact"])


def q_portfolio_kpis_fitted(spark, sf):
    """J10 on the fitted model's scores; ``portfolio_kpis`` is the same report on the fixed linear score."""
    from retentia.operators import roster

    return roster.portfolio_kpis(q_risk_scores(spark, sf))


def q_risk_drivers_tree(spark, sf):
    return model_run(spark, sf)["drivers"]


_SCORES: dict[tuple, DataFrame] = {}


def _linear_scores(spark, sf) -> DataFrame:
    """Score table of the deterministic linear score for never-churned
    accounts, written once per session to the shared folder (the app and
    KPIs read a written score table, as the original app reads its file)."""
    from retentia.operators import drivers, roster

    key = (session_key(spark), sf.rstrip("/"))
    if key not in _SCORES:
        fact = fact_table(spark, sf)
        f = feature_table(spark, sf).where(F.col("target_churn_flag") == 0)
        scored = drivers.linear_drivers(f, keep=("industry", "active_mrr_run_rate"))
        table = roster.risk_roster(scored, None, fact)
        path = scratch_path(spark, "linear_scores")
        table.write.parquet(path)
        _SCORES[key] = spark.read.parquet(path)
    return _SCORES[key]


def q_risk_drivers_linear(spark, sf):
    from retentia.operators import drivers

    f = feature_table(spark, sf).where(F.col("target_churn_flag") == 0)
    return drivers.linear_drivers(f)


def q_shapley_stored_tree(spark, sf):
    from retentia.operators import drivers

    return drivers.stored_tree_values(feature_table(spark, sf))


def q_auc_of_linear_score(spark, sf):
    from retentia.operators import drivers, ranking

    scored = drivers.linear_drivers(feature_table(spark, sf), keep=("target_churn_flag",))
    # Two digits only, so that many scores tie.
    return ranking.auc(scored.select(F.round("flight_risk_score", 2).alias("score"), F.col("target_churn_flag").alias("label")))


def q_risk_roster(spark, sf):
    # The order is part of the result; reading files back doesn't keep it.
    return _linear_scores(spark, sf).orderBy(F.desc("flight_risk_score"), "account_id")


def q_portfolio_kpis(spark, sf):
    from retentia.operators import roster

    return roster.portfolio_kpis(_linear_scores(spark, sf))


def q_account_card(spark, sf):
    from retentia.operators import roster

    s = _linear_scores(spark, sf)
    top = s.select(F.min_by("account_id", F.struct(-F.col("flight_risk_score"), F.col("account_id")))).scalar()
    return roster.account_card(s, top)


QUERIES.update(
    {
        "risk_drivers_linear": q_risk_drivers_linear,
        "shapley_stored_tree": q_shapley_stored_tree,
        "auc_of_linear_score": q_auc_of_linear_score,
        "risk_roster": q_risk_roster,
        "portfolio_kpis": q_portfolio_kpis,
        "account_card": q_account_card,
    }
)

# Model-based queries: no SQL oracle (row-count check only).
def _from_rollup(name: str) -> Query:
    kind, sheet = rollup.SHEETS[name]
    return lambda spark, sf: sheet(month_rollup(spark, sf).read(kind))


#: The sheets again, from the month rollup's slices alone.
QUERIES.update({f"rollup_{name}": _from_rollup(name) for name in rollup.SHEETS})

MODEL_QUERIES: dict[str, Query] = {
    "model_report": q_model_report,
    "risk_scores": q_risk_scores,
    "portfolio_kpis_fitted": q_portfolio_kpis_fitted,
    "risk_drivers_tree": q_risk_drivers_tree,
}
