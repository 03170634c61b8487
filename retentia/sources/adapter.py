"""Derive the five raw tables from the provided TPC-H-like test tables.

The raw CSVs of the original business are not available, so the test
tables are mapped onto the same schema with integer/date arithmetic that
Spark and DuckDB evaluate identically (the DuckDB twin of every expression
is in ``retentia.plans.oracle``).  The mapping is total: every customer is
an account, every order a subscription, every line item a usage event,
every returned ('A') line item a support ticket and every urgent, finished
order placed on or after the signup epoch a churn event.

* accounts       <- customer  (signup on a 400-day fold from 1999-10-01)
* subscriptions  <- orders    (start = order date, ends 30..729 days later,
                               every 7th open-ended; MRR = price / 100)
* feature_usage  <- lineitem  (dates folded onto 2000; returned-'N', open
                               lines appear a second time, shifted -2..+2
                               days, to exercise the usage_id de-duplication)
* support_tickets<- lineitem with l_returnflag = 'A', joined to orders
* churn_events   <- orders with priority '1-URGENT', status 'F', dated
                    on/after 1999-10-01
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia.sources.raw import RawTables

# Fixed values of the mapping.
SIGNUP_EPOCH = "1999-10-01"
SIGNUP_SPREAD_DAYS = 400
USAGE_EPOCH = "2000-01-01"
SHIP_EPOCH = "1995-01-01"
FOLD_DAYS = 366
REFERRALS = ("organic", "ads", "event", "partner", "other")
REASONS = ("pricing", "support", "features", "budget", "competitor", "unknown")


def _lit_date(s: str) -> Column:
    return F.lit(s).cast("date")


def _pick(key: Column, values: tuple[str, ...]) -> Column:
    out = None
    for i, v in enumerate(values):
        out = (F.when(key == i, F.lit(v))) if out is None else out.when(key == i, F.lit(v))
    return out


def _id(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def _flag(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def _cents_to_money(cents: Column) -> Column:
    return (F.floor(cents).cast("decimal(12,0)") * F.lit(0.01).cast("decimal(2,2)")).cast("decimal(10,2)")


def _folded_date(ts: Column) -> Column:
    days = F.datediff(F.to_date(ts), _lit_date(SHIP_EPOCH)) % FOLD_DAYS
    return F.date_add(_lit_date(USAGE_EPOCH), days.cast("int"))


def accounts(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.select(
        _id("A-", k).alias("account_id"),
        F.col("c_name").alias("account_name"),
        F.col("c_mktsegment").alias("industry"),
        F.col("c_nationkey").cast("string").alias("country"),
        F.date_add(_lit_date(SIGNUP_EPOCH), ((k * 37) % SIGNUP_SPREAD_DAYS).cast("int")).alias("signup_date"),
        _pick(k % 5, REFERRALS).alias("referral_source"),
        F.when(F.col("c_acctbal") < 2500, "Basic").when(F.col("c_acctbal") < 6500, "Pro")
        .otherwise("Enterprise").alias("plan_tier"),
        (F.lit(1) + k % 50).cast("int").alias("seats"),
        _flag(k % 10 == 0).alias("is_trial"),
        _flag(F.col("c_acctbal") < 0).alias("churn_flag"),
    )


def subscriptions(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    start = F.to_date("o_orderdate")
    pr = F.col("o_orderpriority")
    mrr = _cents_to_money(F.col("o_totalprice"))
    return orders.select(
        _id("S-", k).alias("subscription_id"),
        _id("A-", F.col("o_custkey")).alias("account_id"),
        start.alias("start_date"),
        F.when(k % 7 == 0, F.lit(None).cast("date"))
        .otherwise(F.date_add(start, (F.lit(30) + k % 700).cast("int"))).alias("end_date"),
        F.when(pr.isin("1-URGENT", "2-HIGH"), "Enterprise").when(pr == "3-MEDIUM", "Pro")
        .otherwise("Basic").alias("plan_tier"),
        (F.lit(1) + k % 40).cast("int").alias("seats"),
        mrr.alias("mrr_amount"),
        (mrr * 12).cast("decimal(10,2)").alias("arr_amount"),
        _flag(k % 13 == 0).alias("is_trial"),
        _flag(k % 8 == 0).alias("upgrade_flag"),
        _flag(k % 9 == 0).alias("downgrade_flag"),
        _flag(F.col("o_orderstatus") == "F").alias("churn_flag"),
        F.when(pr.isin("1-URGENT", "2-HIGH"), "annual").otherwise("monthly").alias("billing_frequency"),
        _flag(F.col("o_orderstatus") == "O").alias("auto_renew_flag"),
    )


def _usage_rows(li: DataFrame, shift: Column | None, extra_count: int) -> DataFrame:
    d = _folded_date(F.col("l_shipdate"))
    if shift is not None:
        d = F.date_add(d, shift)
    q = F.col("l_quantity").cast("int")
    return li.select(
        _id("U-", F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("usage_id"),
        _id("S-", F.col("l_orderkey")).alias("subscription_id"),
        d.alias("usage_date"),
        F.concat(F.lit("feature_"), (F.col("l_partkey") % 40).cast("string")).alias("feature_name"),
        (q + F.lit(extra_count)).cast("int").alias("usage_count"),
        (q * 60).cast("int").alias("usage_duration_secs"),
        F.round(F.col("l_discount") * 100).cast("int").alias("error_count"),
        _flag(F.col("l_returnflag") == "R").alias("is_beta_feature"),
    )


def feature_usage_staging(lineitem: DataFrame) -> DataFrame:
    """Usage events including re-delivered copies (duplicate usage_id)."""
    base = _usage_rows(lineitem, None, 0)
    copies = _usage_rows(
        lineitem.where((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O")),
        ((F.col("l_partkey") % 5) - 2).cast("int"),
        1,
    )
    return base.unionByName(copies)


def support_tickets(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    li = lineitem.where(F.col("l_returnflag") == "A").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_tax", "l_linestatus", "l_shipdate"
    )
    o = orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    submitted = F.expr(
        "cast(date_add(date'2000-01-01', cast(datediff(to_date(l_shipdate), date'1995-01-01') % 366 as int))"
        " as timestamp_ntz) + make_dt_interval(0, cast(l_suppkey % 24 as int), 0, 0)"
    )
    q = F.col("l_quantity").cast("int")
    pr = F.col("o_orderpriority")
    return j.select(
        _id("T-", F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ticket_id"),
        _id("A-", F.col("o_custkey")).alias("account_id"),
        submitted.alias("submitted_at"),
        F.when(F.col("l_linestatus") == "O", F.lit(None).cast("timestamp_ntz"))
        .otherwise(submitted + F.make_dt_interval(F.lit(0), q)).alias("closed_at"),
        (F.col("l_quantity").cast("decimal(10,2)") * F.lit(1.25).cast("decimal(3,2)"))
        .cast("decimal(10,2)").alias("resolution_time_hours"),
        F.when(pr == "1-URGENT", "urgent").when(pr == "2-HIGH", "high").when(pr == "3-MEDIUM", "medium")
        .otherwise("low").alias("priority"),
        F.round(F.col("l_tax") * 1000).cast("int").alias("first_response_time_minutes"),
        F.when(F.col("l_partkey") % 3 == 0, F.lit(None).cast("decimal(3,1)"))
        .otherwise((F.lit(1) + F.col("l_partkey") % 5).cast("decimal(3,1)")).alias("satisfaction_score"),
        _flag((F.col("l_linestatus") == "O") & (pr == "1-URGENT")).alias("escalation_flag"),
    )


def churn_events(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    ev = orders.where(
        (F.col("o_orderpriority") == "1-URGENT")
        & (F.col("o_orderstatus") == "F")
        & (F.col("o_orderdate") >= F.lit(SIGNUP_EPOCH).cast("timestamp_ntz"))
    )
    reason = _pick(k % 6, REASONS)
    return ev.select(
        _id("C-", k).alias("churn_event_id"),
        _id("A-", F.col("o_custkey")).alias("account_id"),
        F.to_date("o_orderdate").alias("churn_date"),
        reason.alias("reason_code"),
        _cents_to_money(F.col("o_totalprice") / 10).alias("refund_amount_usd"),
        _flag(k % 4 == 0).alias("preceding_upgrade_flag"),
        _flag(k % 5 == 0).alias("preceding_downgrade_flag"),
        _flag(k % 9 == 0).alias("is_reactivation"),
        F.when(k % 3 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit('left, "'), reason, F.lit('" noted'))).alias("feedback_text"),
    )


def load_test_tables(spark: SparkSession, sf_dir: str, names=("customer", "orders", "lineitem")) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names}


def raw_from_test_tables(spark: SparkSession, sf_dir: str, dedup: bool = True, customer_parts: int | None = None) -> RawTables:
    """The five typed raw tables derived from ``sf_dir``; usage is de-duplicated
    (earliest usage_date per usage_id) unless ``dedup=False``.  ``customer_parts``
    deals the customers to so many tasks before accounts are derived."""
    from retentia.operators.dedup import dedup_usage

    t = load_test_tables(spark, sf_dir)
    if customer_parts:
        t["customer"] = t["customer"].repartition(customer_parts)
    usage = feature_usage_staging(t["lineitem"])
    if dedup:
        usage = dedup_usage(usage)
    return RawTables(
        accounts=accounts(t["customer"]),
        subscriptions=subscriptions(t["orders"]),
        feature_usage=usage,
        support_tickets=support_tickets(t["lineitem"], t["orders"]),
        churn_events=churn_events(t["orders"]),
    )
