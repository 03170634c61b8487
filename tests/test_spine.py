"""Daily spine micro-fixtures (FIXTURES.md §3, cases 5-16) and invariants."""

from decimal import Decimal

from helpers import account, churn, d, raw, rows_by_day, sub, ticket, usage

from retentia.config import AnalysisPeriod
from retentia.operators import quality
from retentia.operators.spine import AS_OF_RUN_MODE, daily_spine

PERIOD = AnalysisPeriod.quarters(
    "2024-01-01",
    "2024-12-31",
    [("2024-01-01", "2024-03-31"), ("2024-04-01", "2024-06-30"), ("2024-07-01", "2024-09-30"), ("2024-10-01", "2024-12-31")],
)


def test_overlap_same_start_higher_mrr_governs(spark):
    r = raw(spark, [account("a", "2024-01-01")],
            [sub("s1", "a", "2024-01-01", mrr="100.00"), sub("s2", "a", "2024-01-01", mrr="250.00", billing="annual")])
    days = rows_by_day(daily_spine(r, PERIOD))
    assert days[d("2024-02-01")]["active_mrr_run_rate"] == Decimal("250.00")
    assert days[d("2024-02-01")]["billing_frequency"] == "annual"


def test_newer_cheaper_subscription_governs(spark):
    r = raw(spark, [account("a", "2024-01-01")],
            [sub("old", "a", "2024-01-01", mrr="900.00"), sub("new", "a", "2024-03-01", mrr="50.00")])
    days = rows_by_day(daily_spine(r, PERIOD))
    assert days[d("2024-02-29")]["active_mrr_run_rate"] == Decimal("900.00")
    assert days[d("2024-03-01")]["active_mrr_run_rate"] == Decimal("50.00")
    assert days[d("2024-03-01")]["net_mrr_delta"] == Decimal("-850.00")


def test_end_date_inclusive_then_zero_and_none(spark):
    r = raw(spark, [account("a", "2024-01-01")], [sub("s", "a", "2024-01-01", "2024-01-10", mrr="310.00")])
    days = rows_by_day(daily_spine(r, PERIOD))
    assert days[d("2024-01-10")]["active_mrr_run_rate"] == Decimal("310.00")
    assert days[d("2024-01-10")]["daily_billing_accrual"] == Decimal("10.0000")
    assert days[d("2024-01-11")]["active_mrr_run_rate"] == Decimal("0.00")
    assert days[d("2024-01-11")]["billing_frequency"] == "none"
    assert days[d("2024-01-11")]["net_mrr_delta"] == Decimal("-310.00")


def test_churn_day_keeps_mrr_and_negates_delta(spark):
    r = raw(spark, [account("a", "2024-01-01")], [sub("s", "a", "2024-01-01", mrr="100.00")],
            churns=[churn("c", "a", "2024-02-15")])
    days = rows_by_day(daily_spine(r, PERIOD))
    last = days[d("2024-02-15")]
    assert max(days) == d("2024-02-15")
    assert last["active_mrr_run_rate"] == Decimal("100.00")
    assert last["net_mrr_delta"] == Decimal("-100.00")
    assert last["target_churn_flag"] == 1
    assert sum(r["target_churn_flag"] for r in days.values()) == 1


def test_two_churns_in_different_windows_window_vs_as_of_run(spark):
    r = raw(spark, [account("a", "2024-01-01")], [sub("s", "a", "2024-01-01", mrr="100.00")],
            churns=[churn("c1", "a", "2024-02-10"), churn("c2", "a", "2024-11-20")])
    w = rows_by_day(daily_spine(r, PERIOD))
    assert max(x for x in w if x < d("2024-10-01")) == d("2024-02-10")  # gap in windows 2-3
    assert min(x for x in w if x > d("2024-02-10")) == d("2024-10-01")
    assert max(w) == d("2024-11-20")
    assert sum(x["target_churn_flag"] for x in w.values()) == 2
    # first row after the gap: previous day (2024-09-30) had MRR, so delta 0
    assert w[d("2024-10-01")]["net_mrr_delta"] == Decimal("0.00")
    a = rows_by_day(daily_spine(r, PERIOD, AS_OF_RUN_MODE))
    assert len(a) == (d("2024-11-20") - d("2024-01-01")).days + 1
    assert sum(x["target_churn_flag"] for x in a.values()) == 1


def test_two_churns_in_one_window_only_later_flagged(spark):
    r = raw(spark, [account("a", "2024-01-01")], [sub("s", "a", "2024-01-01")],
            churns=[churn("c1", "a", "2024-02-10"), churn("c2", "a", "2024-03-05")])
    w = rows_by_day(daily_spine(r, PERIOD))
    assert max(w) == d("2024-03-05")
    assert w[d("2024-02-10")]["target_churn_flag"] == 0
    assert w[d("2024-03-05")]["target_churn_flag"] == 1


def test_churn_before_signup_gives_no_rows(spark):
    r = raw(spark, [account("a", "2024-05-01")], [sub("s", "a", "2024-05-01")], churns=[churn("c", "a", "2024-04-01")])
    assert daily_spine(r, PERIOD).count() == 0


def test_signup_before_calendar_start(spark):
    r = raw(spark, [account("a", "2023-06-01")], [sub("s", "a", "2023-06-01", mrr="75.00")])
    w = rows_by_day(daily_spine(r, PERIOD))
    assert min(w) == d("2024-01-01")
    assert w[d("2024-01-01")]["net_mrr_delta"] == Decimal("75.00")


def test_constant_mrr_over_window_boundary_and_boundary_check(spark):
    accts = [account("a", "2024-01-01"), account("b", "2024-01-01")]
    subs = [sub("s", "a", "2024-01-01", mrr="100.00"), sub("t", "b", "2024-04-01", mrr="40.00")]
    r = raw(spark, accts, subs)
    sp = daily_spine(r, PERIOD)
    w = rows_by_day(sp, "a")
    assert w[d("2024-04-01")]["net_mrr_delta"] == Decimal("0.00")
    # b genuinely starts paying on a window's first day: listed by the check
    chk = {x["observation_date"]: x["suspect_rows"] for x in quality.boundary_check(sp, r.accounts, PERIOD).collect()}
    assert chk == {d("2024-04-01"): 1}


def test_activity_outside_panel_is_dropped_and_counted(spark):
    r = raw(
        spark,
        [account("a", "2024-03-01")],
        [sub("s", "a", "2024-03-01")],
        usages=[usage("u1", "s", "2024-02-01"), usage("u2", "s", "2024-05-01"), usage("u3", "s", "2024-03-02"),
                usage("u4", "ghost", "2024-03-02")],
        tickets=[ticket("t1", "a", "2024-03-10 10:00:00"), ticket("t2", "a", "2024-06-01 10:00:00")],
        churns=[churn("c", "a", "2024-04-15")],
    )
    sp = daily_spine(r, PERIOD)
    w = rows_by_day(sp)
    assert w[d("2024-03-02")]["daily_time_in_app"] == 60
    assert sum(x["daily_time_in_app"] for x in w.values()) == 60
    assert sum(x["ticket_volume"] for x in w.values()) == 1
    dropped = {x["kind"]: x["dropped_rows"] for x in quality.dropped_activity(r, sp, PERIOD).collect()}
    assert dropped == {"usage_orphan_subscription": 1, "usage_outside_panel": 2, "tickets_outside_panel": 1}


def test_support_means_round_half_up(spark):
    r = raw(spark, [account("a", "2024-01-01")], [sub("s", "a", "2024-01-01")],
            tickets=[ticket("t1", "a", "2024-01-05 09:00:00", hours="1.00", csat="4.0"),
                     ticket("t2", "a", "2024-01-05 17:00:00", hours="1.25", csat=None),
                     ticket("t3", "a", "2024-01-05 18:00:00", hours="1.00", csat="3.0")])
    w = rows_by_day(daily_spine(r, PERIOD))[d("2024-01-05")]
    assert w["ticket_volume"] == 3
    assert w["avg_resolution_time"] == Decimal("1.08")  # 3.25 / 3 = 1.0833
    assert w["avg_csat_score"] == Decimal("3.5")


def test_invariants_pk_unique_and_delta_telescopes(spark):
    accts = [account("a", "2024-01-01"), account("b", "2024-02-15")]
    subs = [sub("s1", "a", "2024-01-01", "2024-05-31", mrr="100.00"), sub("s2", "a", "2024-04-01", mrr="130.00"),
            sub("s3", "b", "2024-02-20", "2024-08-31", mrr="55.50")]
    sp = daily_spine(raw(spark, accts, subs), PERIOD)
    assert sp.count() == sp.select("account_id", "observation_date").distinct().count()
    for aid in ("a", "b"):
        w = rows_by_day(sp, aid)
        total = sum(x["net_mrr_delta"] for x in w.values())
        assert total == w[max(w)]["active_mrr_run_rate"]
        days = sorted(w)
        assert (days[-1] - days[0]).days + 1 == len(days)  # no gaps without churn


def test_both_subscription_clipping_forms_agree(spark):
    import os

    from retentia.plans.catalog import decimals_to_double
    from retentia.plans.context import raw_tables
    from retentia.config import DEFAULT_PERIOD

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        return
    r = raw_tables(spark, sf)
    a = daily_spine(r, DEFAULT_PERIOD)
    b = daily_spine(r, DEFAULT_PERIOD, partitions=3)
    assert a.count() == b.count() > 0
    assert decimals_to_double(a).exceptAll(decimals_to_double(b)).count() == 0


def test_account_with_most_subscriptions_stays_bounded(spark):
    import datetime as dt
    import random

    from pyspark.sql import functions as F

    from retentia.operators import spine

    rng = random.Random(3)
    day = lambda n: dt.date(2023, 12, 15) + dt.timedelta(days=n)
    subs = []
    for k in range(1500):  # account a has two thirds of all subscriptions
        start = rng.randrange(120)
        subs.append(sub(f"s{k:04d}", "a" if k % 3 else f"x{k}", str(day(start)), str(day(start + rng.randrange(60))), mrr=f"{rng.randrange(1, 50)}.00"))
    p = AnalysisPeriod.quarters("2024-01-01", "2024-03-31", [("2024-01-01", "2024-02-10"), ("2024-02-11", "2024-03-31")])
    r = raw(spark, [account("a", "2024-01-01")], subs)
    months = spine.account_months(spine.spine_bounds(r, p), r.subscriptions, p)
    assert months.select(F.max(F.size("subs"))).first()[0] <= 32 * 33 // 2
    got = rows_by_day(spine.governing_subscription(r, p), "a")
    assert len(got) == 91
    for at, row in got.items():
        for when, gov in ((at, row["gov"]), (at - dt.timedelta(days=1), row["gov_prev"])):
            active = [(x[2], x[6], x[0]) for x in subs if x[1] == "a" and x[2] <= when <= x[3]]
            assert (gov and gov["subscription_id"]) == (max(active)[2] if active else None)


def test_mrr_delta_looks_up_by_account_without_a_broadcast(spark, tmpdir_path):
    import datetime as dt

    from retentia.plans import catalog

    at = lambda s: dt.datetime.fromisoformat(s)
    spark.createDataFrame([(1, "n", 1, 10.0, "x"), (None, "n", 1, 10.0, "x")], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{tmpdir_path}/customer.parquet")
    orders = [(10, 1, "O", 100.0, at("1999-12-20"), "1-URGENT"), (11, 1, "O", 250.0, at("2000-02-03"), "3-MEDIUM")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{tmpdir_path}/orders.parquet")
    lines = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    spark.createDataFrame([], lines).write.parquet(f"{tmpdir_path}/lineitem.parquet")
    got = catalog.q_mrr_delta(spark, tmpdir_path)
    plan = got._jdf.queryExecution().executedPlan().toString()
    top = next(line for line in plan.splitlines() if "Join" in line)  # the panel's; those below it join accounts
    assert "ShuffledHashJoin" in top and "observation_date" in top
    rows = {str(r.observation_date): (r.active_mrr_run_rate, r.prev_day_mrr, r.net_mrr_delta) for r in got.collect()}
    assert rows["2000-01-29"] == (1.0, 1.0, 0.0) and rows["2000-01-30"] == (0.0, 1.0, -1.0)  # order 10 lasts 40 days
    assert rows["2000-02-03"] == (2.5, 0.0, 2.5) and rows["2000-02-04"] == (2.5, 2.5, 0.0)
    assert len(rows) == 366 and rows["2000-01-01"] == (1.0, 0.0, 1.0)  # signed up before the calendar


def test_panel_runs_are_few_and_expand_to_the_panel(spark):
    from retentia.operators import spine

    p = AnalysisPeriod.quarters("2024-01-01", "2024-03-31", [("2024-01-01", "2024-02-10"), ("2024-02-11", "2024-03-31")])
    r = raw(spark, [account("a", "2023-12-01")], [sub("s1", "a", "2023-12-05", "2024-02-20", mrr="5.00"), sub("s2", "a", "2024-03-10", None, mrr="7.00")])
    runs = spine.spine_runs(r, p)
    # January; February to the window's end, to s1's end and to the month's end; March before and from s2 on.
    assert sorted((str(x["first"]), str(x["last"])) for x in runs.collect()) == [
        ("2024-01-01", "2024-01-31"), ("2024-02-01", "2024-02-10"), ("2024-02-11", "2024-02-20"),
        ("2024-02-21", "2024-02-29"), ("2024-03-01", "2024-03-09"), ("2024-03-10", "2024-03-31"),
    ]
    days = {str(x["observation_date"]): (float(x["active_mrr_run_rate"]), float(x["net_mrr_delta"]), x["obs_ym"]) for x in spine.spine_of_runs(runs).collect()}
    assert len(days) == 91
    assert days["2024-02-20"] == (5.0, 0.0, 202402) and days["2024-02-21"] == (0.0, -5.0, 202402) and days["2024-03-10"] == (7.0, 7.0, 202403)


def test_account_days_are_expanded_by_many_tasks(spark):
    from retentia.operators import spine

    p = AnalysisPeriod.quarters("2024-01-01", "2024-03-31", [("2024-01-01", "2024-03-31")])
    r = raw(spark, [account(f"a{k}", "2023-12-01") for k in range(64)], [])
    one = spine.spine_bounds(r, p).coalesce(1)
    assert spine.spine_days(one).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spine.spine_days(one).count() == 64 * 91


def test_accounts_of_one_file_are_fanned_out_by_many_tasks(spark, tmpdir_path, monkeypatch):
    import datetime as dt

    from retentia import session
    from retentia.plans import catalog, context

    cores = spark.sparkContext.defaultParallelism
    customers = [(k, "n", 1, 10.0, "x") for k in range(1, 8 * cores + 1)] + [(1, "again", 1, 10.0, "x"), (None, "n", 1, 10.0, "x")]
    spark.createDataFrame(customers, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").coalesce(1).write.parquet(f"{tmpdir_path}/customer.parquet")
    spark.createDataFrame([(1, 2, "F", 100.0, dt.datetime(2000, 1, 5), "1-URGENT")], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{tmpdir_path}/orders.parquet")
    lines = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    spark.createDataFrame([], lines).write.parquet(f"{tmpdir_path}/lineitem.parquet")
    raw = context.raw_tables(spark, tmpdir_path)
    assert len(raw.accounts.inputFiles()) == cores
    assert raw.accounts.count() == len(customers)  # copies of a key and null keys stay
    assert raw.accounts.rdd.getNumPartitions() == cores
    days = catalog.q_spine_days(spark, tmpdir_path).groupBy("account_id").count().collect()
    one = {r["account_id"]: r["count"] for r in days}
    assert one["A-2"] == 5  # churned on January 5
    assert one["A-1"] == 2 * 366 and one["A-3"] == 366 - 19  # two rows of one key; signed up on January 20
    monkeypatch.setattr(session, "SHUFFLE_ROWS", 4)
    assert session.tasks_for(spark, 8 * cores + 2) == 2 * cores + 1
    assert session.tasks_for(spark, 1) == cores


def test_shuffles_grow_with_the_tables(spark, tmpdir_path, monkeypatch):
    import datetime as dt

    from retentia import session
    from retentia.plans import context

    day = dt.datetime(2000, 1, 5)
    spark.createDataFrame([(1, "n", 1, 10.0, "x")], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{tmpdir_path}/customer.parquet")
    spark.createDataFrame([(k, 1, "O", 100.0, day, "3-MEDIUM") for k in range(30)], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{tmpdir_path}/orders.parquet")
    lines = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    spark.createDataFrame([], lines).write.parquet(f"{tmpdir_path}/lineitem.parquet")
    name, before = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set(name, 5)
        session.size_shuffles(spark, session.SHUFFLE_ROWS * 5)
        assert spark.conf.get(name) == "5"
        monkeypatch.setattr(session, "SHUFFLE_ROWS", 4)
        context.raw_tables(spark, tmpdir_path)
        assert spark.conf.get(name) == "8"  # 30 orders
        session.size_shuffles(spark, 3)
        assert spark.conf.get(name) == "8"
    finally:
        spark.conf.set(name, before)


def test_months_are_gathered_behind_one_shuffle(spark):
    from retentia.operators import spine

    p = AnalysisPeriod.quarters("2024-01-01", "2024-03-31", [("2024-01-01", "2024-02-10"), ("2024-02-11", "2024-03-31")])
    r = raw(spark, [account("a", "2024-01-05")], [sub("s1", "a", "2023-12-20", "2024-02-15", mrr="5.00")])
    months = spine.account_months(spine.spine_bounds(r, p), r.subscriptions, p, partitions=3)
    above = months._jdf.queryExecution().executedPlan().toString().split("Union")[0]
    assert above.count("Exchange") == 1  # of spans, not of months
    got = {x["obs_ym"]: (len(x["stays"]), [(str(y["d1"]), str(y["d2"])) for y in x["subs"]]) for x in months.collect()}
    assert got == {
        202401: (1, [("2023-12-31", "2024-01-31")]),
        202402: (2, [("2024-01-31", "2024-02-15")]),
        202403: (1, []),
    }


def test_dropped_activity_from_runs(spark):
    from retentia.operators import spine

    p = AnalysisPeriod.quarters("2024-01-01", "2024-03-31", [("2024-01-01", "2024-02-10"), ("2024-02-11", "2024-03-31")])
    subs = [sub("s1", "a", "2023-12-20", "2024-02-15", mrr="5.00"), sub("s2", "b", "2024-01-31", "2024-03-31", mrr="7.00")]
    days = ["2024-01-01", "2024-01-05", "2024-01-31", "2024-02-29", "2024-03-31"]
    r = raw(spark, [account("a", "2024-01-05"), account("b", "2024-01-31")], subs, usages=[usage(f"u{k}{s}", s, d) for s in ("s1", "s2", "gone") for k, d in enumerate(days)])
    runs = spine.spine_runs(r, p)
    of_days = quality.dropped_activity(r, spine.spine_of_runs(runs), p).collect()
    assert sorted(quality.dropped_activity(r, spine.spine_of_runs(runs), p, runs=runs).collect()) == sorted(of_days)
    assert {x["kind"]: x["dropped_rows"] for x in of_days} == {"usage_orphan_subscription": 5, "usage_outside_panel": 3, "tickets_outside_panel": 0}
    plan = quality.dropped_activity(r, spine.spine_of_runs(runs), p, runs=r.accounts.selectExpr("account_id", "202401 as obs_ym", "signup_date as first", "signup_date as last"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("usage_date") and plan.count("Aggregate [subscription_id") == 1  # usage is counted in one pass
