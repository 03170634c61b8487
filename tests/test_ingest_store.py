"""CSV ingestion (FIXTURES cases 1-4), window refresh (16), export (A8), calendar (30)."""

import os
from decimal import Decimal

from helpers import account, d, raw, rows_by_day, sub

from retentia import schemas
from retentia.config import REFERENCE_PERIOD, AnalysisPeriod
from retentia.operators.calendar import build_calendar, calendar_profile
from retentia.operators.dedup import dedup_usage
from retentia.operators.spine import daily_spine
from retentia.sources import csv_ingest, store


def _write(path, lines):
    with open(path, "wb") as f:
        f.write("\r\n".join(lines).encode() + b"\r\n")


def test_flags_and_blank_dates(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "subs.csv")
    _write(p, [
        "subscription_id,account_id,start_date,end_date,plan_tier,seats,mrr_amount,arr_amount,is_trial,upgrade_flag,"
        "downgrade_flag,churn_flag,billing_frequency,auto_renew_flag",
        's1,a,2024-01-01,,Pro,3,10.50,126.00, True,TRUE,False,,monthly,true',
        's2,a,2024-01-01,2024-02-01,Pro,3,10.50,126.00,False,false,x,True,annual,',
    ])
    df = csv_ingest.read_typed_csv(spark, p, "subscriptions")
    rows = {r["subscription_id"]: r for r in df.collect()}
    assert rows["s1"]["end_date"] is None
    assert (rows["s1"]["is_trial"], rows["s1"]["upgrade_flag"], rows["s1"]["downgrade_flag"], rows["s1"]["churn_flag"]) == (1, 1, 0, 0)
    assert rows["s2"]["end_date"] == d("2024-02-01")
    assert rows["s2"]["auto_renew_flag"] == 0 and rows["s2"]["churn_flag"] == 1
    assert rows["s1"]["mrr_amount"] == Decimal("10.50")


def test_crlf_quoted_feedback_round_trip(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "churn.csv")
    _write(p, [
        "churn_event_id,account_id,churn_date,reason_code,refund_amount_usd,preceding_upgrade_flag,"
        "preceding_downgrade_flag,is_reactivation,feedback_text",
        'c1,a,2024-03-01,pricing,0.00,False,False,False,"too pricey, said ""no"" twice"',
        'c3,a,2024-05-01,features,0.00,False,False,False,"line one\nline two"',
        "c2,a,2024-04-01,support,1.00,True,False,False,",
    ])
    df = csv_ingest.read_typed_csv(spark, p, "churn_events")
    rows = {r["churn_event_id"]: r for r in df.collect()}
    assert rows["c1"]["feedback_text"] == 'too pricey, said "no" twice'
    assert rows["c2"]["feedback_text"] is None
    assert rows["c2"]["preceding_upgrade_flag"] == 1
    assert rows["c3"]["feedback_text"] == "line one\nline two"
    # export in the same dialect and read back
    r = raw(spark, churns=[])
    r = r.__class__(r.accounts, r.subscriptions, r.feature_usage, r.support_tickets, df)
    paths = csv_ingest.write_raw_csv(r, os.path.join(tmpdir_path, "out"))
    back = {x["churn_event_id"]: x for x in csv_ingest.read_typed_csv(spark, paths["churn_events"], "churn_events").collect()}
    assert back["c1"]["feedback_text"] == 'too pricey, said "no" twice'
    assert back["c2"]["feedback_text"] is None


def test_usage_dedup_earliest_and_deterministic_tie(spark):
    from helpers import usage
    from retentia import schemas

    rows = [usage("u1", "s", "2024-01-05", count=1), usage("u1", "s", "2024-01-03", count=9),
            usage("u2", "s", "2024-01-05", count=7), usage("u2", "s", "2024-01-05", count=2)]
    df = spark.createDataFrame(rows, schemas.FEATURE_USAGE)
    out = {r["usage_id"]: r for r in dedup_usage(df).collect()}
    assert out["u1"]["usage_date"] == d("2024-01-03") and out["u1"]["usage_count"] == 9
    assert out["u2"]["usage_count"] == 2


def test_window_refresh_drops_rows_of_emptied_window(spark):
    period = AnalysisPeriod.quarters("2024-01-01", "2024-06-30", [("2024-01-01", "2024-03-31"), ("2024-04-01", "2024-06-30")])
    before = raw(spark, [account("a", "2024-01-01"), account("b", "2024-01-01")],
                 [sub("s", "a", "2024-01-01"), sub("t", "b", "2024-01-01")])
    full = daily_spine(before, period)
    p1 = store.refresh_window(spark, None, full, *period.windows[0])
    p2 = store.refresh_window(spark, p1, full, *period.windows[1])
    assert store.read_fact(spark, p2).count() == 2 * 182
    # account b is deleted upstream; re-running window 2 must remove its rows there only
    after = raw(spark, [account("a", "2024-01-01")], [sub("s", "a", "2024-01-01")])
    p3 = store.refresh_window(spark, p2, daily_spine(after, period), *period.windows[1])
    fact = store.read_fact(spark, p3)
    b_days = rows_by_day(fact, "b")
    assert max(b_days) == d("2024-03-31") and len(b_days) == 91
    assert fact.where("account_id = 'a'").count() == 182


def test_export_sorted_quoted_crlf(spark, tmpdir_path):
    sp = daily_spine(raw(spark, [account("b", "2024-01-01"), account("a", "2024-01-01")], [sub("s", "a", "2024-01-01")]),
                     AnalysisPeriod.quarters("2024-01-01", "2024-01-03", [("2024-01-01", "2024-01-03")]))
    out = os.path.join(tmpdir_path, "export")
    store.export_spine_csv(sp, out)
    parts = sorted(f for f in os.listdir(out) if f.startswith("part-"))
    text = b"".join(open(os.path.join(out, f), "rb").read() for f in parts)
    lines = text.split(b"\r\n")
    assert lines[0].startswith(b'"account_id","observation_date"')
    data = [x for x in lines[1:] if x]
    assert [x.split(b",")[0] for x in data] == [b'"a"'] * 3 + [b'"b"'] * 3
    back = store.read_spine_csv(spark, out)
    assert back.schema.simpleString() == sp.select(*schemas.SPINE_COLUMNS).schema.simpleString()
    assert sorted(back.collect()) == sorted(sp.select(*schemas.SPINE_COLUMNS).collect())
    assert back.count() == 6 and back.where("avg_resolution_time is null").count() == 6


def test_calendar_leap_year_and_reference_profile(spark):
    cal = {r["date_id"]: r for r in build_calendar(spark, "2024-02-27", "2024-03-01").collect()}
    assert cal[d("2024-02-29")]["days_in_month"] == 29 and cal[d("2024-02-29")]["is_month_end"] == 1
    assert cal[d("2024-02-28")]["is_month_end"] == 0
    prof = calendar_profile(build_calendar(spark, REFERENCE_PERIOD.cal_start, REFERENCE_PERIOD.cal_end)).first()
    assert (prof["total_days"], prof["month_end_flags"]) == (699, 23)
    sp = rows_by_day(daily_spine(raw(spark, [account("a", "2024-01-01")], [sub("s", "a", "2024-01-01", mrr="100.00")]),
                                 AnalysisPeriod.quarters("2024-01-01", "2024-03-31", [("2024-01-01", "2024-03-31")])))
    assert sp[d("2024-02-10")]["daily_billing_accrual"] == Decimal("3.4483")  # 100 / 29


def test_backfill_equals_single_window_mode_job(spark):
    from retentia.sources.store import read_fact

    period = AnalysisPeriod.quarters("2024-01-01", "2024-06-30", [("2024-01-01", "2024-03-31"), ("2024-04-01", "2024-06-30")])
    from helpers import churn

    r = raw(spark, [account("a", "2024-01-01"), account("b", "2024-02-01")],
            [sub("s", "a", "2024-01-01", mrr="10.00"), sub("t", "b", "2024-02-01", "2024-05-01", mrr="20.00")],
            churns=[churn("c", "b", "2024-05-10")])
    path = store.backfill(spark, r, period)
    got = sorted(tuple(x) for x in read_fact(spark, path).drop("obs_ym").collect())
    want = sorted(tuple(x) for x in daily_spine(r, period).collect())
    assert got == want


def test_backfill_as_of_run_sees_all_churns(spark):
    from helpers import churn

    from retentia.operators.spine import AS_OF_RUN_MODE
    from retentia.sources.store import read_fact

    period = AnalysisPeriod.quarters("2024-01-01", "2024-06-30", [("2024-01-01", "2024-03-31"), ("2024-04-01", "2024-06-30")])
    r = raw(spark, [account("a", "2024-01-01")], [sub("s", "a", "2024-01-01", mrr="10.00")], churns=[churn("c", "a", "2024-02-10"), churn("e", "a", "2024-05-20")])
    for mode in ("window", AS_OF_RUN_MODE):
        path = store.backfill(spark, r, period, mode=mode)
        got = sorted(tuple(x) for x in read_fact(spark, path).drop("obs_ym").collect())
        assert got == sorted(tuple(x) for x in daily_spine(r, period, mode).collect())
    assert len(got) == 141


def test_namespaces_created(spark):
    store.ensure_namespaces(spark)
    assert all(spark.catalog.databaseExists(ns) for ns in store.NAMESPACES)
