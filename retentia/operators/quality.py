"""Data-quality reports: row counts, key uniqueness, orphans, window
boundary check, NOT NULL checks and activity that found no panel row.

Reports are aggregations - they return counts per table/relation/date,
never the offending rows themselves unless asked for.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentia import schemas
from retentia.functions.expressions import ts_on_days
from retentia.config import AnalysisPeriod
from retentia.sources.raw import RawTables
from retentia.sources.store import month_key

PRIMARY_KEYS = {
    "accounts": ["account_id"],
    "subscriptions": ["subscription_id"],
    "feature_usage": ["usage_id"],
    "support_tickets": ["ticket_id"],
    "churn_events": ["churn_event_id"],
}

# (child table, child key, parent table, parent key)
FOREIGN_KEYS = (
    ("subscriptions", "account_id", "accounts", "account_id"),
    ("feature_usage", "subscription_id", "subscriptions", "subscription_id"),
    ("support_tickets", "account_id", "accounts", "account_id"),
    ("churn_events", "account_id", "accounts", "account_id"),
)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """HS6/K2: one (table_name, row_count) row per table."""
    # agg-without-groupBy gives one row each; union of tiny results.
    parts = [df.groupBy().agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def pk_duplicates(tables: dict[str, DataFrame], keys: dict[str, list[str]] | None = None) -> DataFrame:
    """K3: per table, keys seen more than once and the surplus rows."""
    keys = keys or PRIMARY_KEYS
    parts = []
    for name, df in tables.items():
        k = keys[name]
        g = df.groupBy(*k).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
        parts.append(
            g.agg(
                F.count(F.lit(1)).alias("duplicate_keys"),
                F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("surplus_rows"),
            ).select(F.lit(name).alias("table_name"), "duplicate_keys", "surplus_rows")
        )
    return reduce(DataFrame.unionByName, parts)


def orphans(raw: RawTables) -> DataFrame:
    """K4: child rows whose parent key is missing, per relation."""
    t = raw.as_dict()
    parts = []
    for child, ck, parent, pk in FOREIGN_KEYS:
        # Distinct child keys with their row counts first: a key referenced by
        # a huge share of the rows reaches the anti join as one row.
        c = t[child].where(F.col(ck).isNotNull()).groupBy(F.col(ck).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
        p = t[parent].select(F.col(pk).alias("_k"))
        n = c.join(p, "_k", "left_anti").agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("orphan_rows"))
        parts.append(n.select(F.lit(f"{child}.{ck} -> {parent}.{pk}").alias("relation"), "orphan_rows"))
    return reduce(DataFrame.unionByName, parts)


def boundary_check(spine: DataFrame, accounts: DataFrame, period: AnalysisPeriod) -> DataFrame:
    """K5: rows on the first day of every window but the first whose delta
    equals the full MRR although the account did not sign up that day."""
    starts = [str(a) for a, _ in period.windows[1:]]
    s = spine.where(F.col("observation_date").isin([F.lit(d).cast("date") for d in starts]))
    s = s.where((F.col("active_mrr_run_rate") > 0) & (F.abs(F.col("net_mrr_delta") - F.col("active_mrr_run_rate")) < 0.01))
    j = s.join(accounts.select("account_id", "signup_date"), "account_id")
    j = j.where(F.col("signup_date") != F.col("observation_date"))
    return j.groupBy("observation_date").agg(F.count(F.lit(1)).alias("suspect_rows"))


def not_null_violations(spine: DataFrame) -> DataFrame:
    """K8: NULL count for every NOT NULL fact column (one row per column)."""
    cols = [f.name for f in schemas.DAILY_SPINE.fields if not f.nullable]
    row = spine.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in cols]))
    return row.select(stacked.alias("x")).select("x.column_name", "x.null_rows")


def dropped_activity(raw: RawTables, spine: DataFrame, period: AnalysisPeriod, runs: DataFrame | None = None) -> DataFrame:
    """H-6: usage / ticket activity inside the period that has no panel row
    (before signup, after churn, orphan subscription).  ``runs``: the stored runs of the panel (``spine.panel_runs``), whose days then
    aren't expanded."""
    lo, hi = F.lit(str(period.first_from)).cast("date"), F.lit(str(period.last_to)).cast("date")
    # The panel's days of an account and month as bits of one number: 30 rows less to join, made where the panel's rows are.
    month, bit = month_key("observation_date"), F.expr("shiftleft(1L, day(observation_date))")
    if runs is not None:  # a run lies in one month
        panel = runs.groupBy("account_id", F.col("obs_ym").alias("_ym")).agg(F.bit_or(F.expr("shiftleft(1L, day(last) + 1) - shiftleft(1L, day(first))")).alias("_days"))
    else:
        panel = spine.groupBy("account_id", (F.col("obs_ym") if "obs_ym" in spine.columns else month).alias("_ym")).agg(F.bit_or(bit).alias("_days"))
    days = lambda rows, key: rows.withColumn("_ym", month).join(panel.withColumnRenamed("account_id", key), [key, "_ym"], "left")
    outside = F.coalesce(F.col("_days").bitwiseAND(bit), F.lit(0)) == 0
    dropped = lambda kind, hit: F.struct(F.lit(kind).alias("kind"), F.coalesce(F.sum(F.when(hit, F.col("_n"))), F.lit(0)).cast("bigint").alias("dropped_rows"))
    # Rows per (subscription, day) and per (account, day) first, so a hot key
    # reaches each join as one row with its count.
    u = raw.feature_usage.where(F.col("usage_date").between(lo, hi)).groupBy(
        "subscription_id", F.col("usage_date").alias("observation_date")
    ).agg(F.count(F.lit(1)).alias("_n"))
    u = u.join(raw.subscriptions.select("subscription_id", "account_id"), "subscription_id", "left")
    # Orphans are told by their null account alone; they go through the join by their own ids, as nulls would meet in one task.
    u = days(u.withColumn("_key", F.coalesce("account_id", "subscription_id")), "_key")
    orphan = F.col("account_id").isNull()
    t = raw.support_tickets.where(ts_on_days("submitted_at", period.first_from, period.last_to))
    t = t.select("account_id", F.to_date("submitted_at").alias("observation_date")).groupBy("account_id", "observation_date").agg(
        F.count(F.lit(1)).alias("_n")
    )
    counts = [
        u.agg(F.array(dropped("usage_orphan_subscription", orphan), dropped("usage_outside_panel", ~orphan & outside)).alias("x")),
        days(t, "account_id").agg(F.array(dropped("tickets_outside_panel", outside)).alias("x")),
    ]
    return reduce(DataFrame.unionByName, [c.select(F.inline("x")) for c in counts])
