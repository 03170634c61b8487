"""Typed schemas of the raw tables, the calendar and the daily fact table."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, I, TS = T.StringType(), T.DateType(), T.IntegerType(), T.TimestampNTZType()
MONEY = T.DecimalType(10, 2)
ACCRUAL = T.DecimalType(10, 4)
CSAT = T.DecimalType(3, 1)


def _st(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


ACCOUNTS = _st(
    ("account_id", S, False),
    ("account_name", S, True),
    ("industry", S, True),
    ("country", S, True),
    ("signup_date", D, True),
    ("referral_source", S, True),
    ("plan_tier", S, True),
    ("seats", I, True),
    ("is_trial", I, True),
    ("churn_flag", I, True),
)

SUBSCRIPTIONS = _st(
    ("subscription_id", S, False),
    ("account_id", S, True),
    ("start_date", D, True),
    ("end_date", D, True),
    ("plan_tier", S, True),
    ("seats", I, True),
    ("mrr_amount", MONEY, True),
    ("arr_amount", MONEY, True),
    ("is_trial", I, True),
    ("upgrade_flag", I, True),
    ("downgrade_flag", I, True),
    ("churn_flag", I, True),
    ("billing_frequency", S, True),
    ("auto_renew_flag", I, True),
)

FEATURE_USAGE = _st(
    ("usage_id", S, False),
    ("subscription_id", S, True),
    ("usage_date", D, True),
    ("feature_name", S, True),
    ("usage_count", I, True),
    ("usage_duration_secs", I, True),
    ("error_count", I, True),
    ("is_beta_feature", I, True),
)

SUPPORT_TICKETS = _st(
    ("ticket_id", S, False),
    ("account_id", S, True),
    ("submitted_at", TS, True),
    ("closed_at", TS, True),
    ("resolution_time_hours", MONEY, True),
    ("priority", S, True),
    ("first_response_time_minutes", I, True),
    ("satisfaction_score", CSAT, True),
    ("escalation_flag", I, True),
)

CHURN_EVENTS = _st(
    ("churn_event_id", S, False),
    ("account_id", S, True),
    ("churn_date", D, True),
    ("reason_code", S, True),
    ("refund_amount_usd", MONEY, True),
    ("preceding_upgrade_flag", I, True),
    ("preceding_downgrade_flag", I, True),
    ("is_reactivation", I, True),
    ("feedback_text", S, True),
)

RAW = {
    "accounts": ACCOUNTS,
    "subscriptions": SUBSCRIPTIONS,
    "feature_usage": FEATURE_USAGE,
    "support_tickets": SUPPORT_TICKETS,
    "churn_events": CHURN_EVENTS,
}

# Flag columns given as text 'True'/'False' in the raw CSV files.
FLAG_COLUMNS = {
    "accounts": ("is_trial", "churn_flag"),
    "subscriptions": ("is_trial", "upgrade_flag", "downgrade_flag", "churn_flag", "auto_renew_flag"),
    "feature_usage": ("is_beta_feature",),
    "support_tickets": ("escalation_flag",),
    "churn_events": ("preceding_upgrade_flag", "preceding_downgrade_flag", "is_reactivation"),
}

DIM_DATE = _st(
    ("date_id", D, False),
    ("year_num", I, False),
    ("month_num", I, False),
    ("day_num", I, False),
    ("quarter_num", I, False),
    ("days_in_month", I, False),
    ("is_month_end", I, False),
)

DAILY_SPINE = _st(
    ("account_id", S, False),
    ("observation_date", D, False),
    ("industry", S, True),
    ("baseline_tier", S, True),
    ("referral_source", S, True),
    ("active_mrr_run_rate", MONEY, False),
    ("daily_billing_accrual", ACCRUAL, False),
    ("billing_frequency", S, False),
    ("auto_renew_flag", I, False),
    ("is_trial", I, False),
    ("downgrade_flag", I, False),
    ("daily_time_in_app", I, False),
    ("daily_friction_events", I, False),
    ("beta_interactions", I, False),
    ("ticket_volume", I, False),
    ("avg_resolution_time", MONEY, True),
    ("avg_csat_score", CSAT, True),
    ("target_churn_flag", I, False),
    ("net_mrr_delta", MONEY, False),
)

SPINE_COLUMNS = [f.name for f in DAILY_SPINE.fields]
