"""Rejected rows beside the typed tables."""

import datetime as dt
import os
from collections import Counter
from decimal import Decimal

from retentia import schemas
from retentia.sources import rejects

LINES = {
    "accounts": [
        "a1,Alpha,Tech,US,2024-01-05,ads,Pro,3,False,False",
        "a2,Beta,Tech,US,2024-13-05,ads,Pro,3,False,False",  # no such month
        "a3,Gamma,Tech,US,2024-02-05,ads,Pro,three,maybe,False",  # no number; any flag passes
        ' ,Delta,Tech,US,2024-02-30,ads,Pro,4,False,False',  # two faults, the key first
        "a5,Short,Tech,US",
        "a6,Long,Tech,US,2024-01-05,ads,Pro,3,False,False,more,fields",
        'a7,"Say ""hi"", ok",Tech,US,2024-01-05,ads,Pro,x9,False,False',
        "a8,Blank,,,,,,,,",
        '"a9,Open quote,Tech,US,2024-01-05,ads,Pro,3,False,False',
    ],
    "subscriptions": [
        "s1,a1,2024-01-05,,Pro,3,10.50,126.00,False,False,False,False,monthly,True",
        "s2,a1,2024-01-05,,Pro,3,123456789012.00,126.00,False,False,False,False,monthly,True",  # too large for its type
    ],
    "feature_usage": [
        "u1,s1,2024-01-07,chat,2,60,0,False",
        "u1,s1,2024-01-06,chat,2,60,0,False",
        "u1,s1,oops,chat,2,60,0,False",  # a bad copy doesn't take part in the de-duplication
    ],
    "support_tickets": ["t1,a1,2024-01-06 10:00:00,yesterday,1.50,high,5,4.0,False"],
    "churn_events": ['c1,a1,2024-03-01,price,0.00,False,False,False,"two\nlines"', 'c2,a1,2024-03-01,price,free,False,False,False,"two\nlines"'],
}


def _files(path, lines):
    out = {}
    for name, rows in lines.items():
        out[name] = os.path.join(path, f"{name}.csv")
        with open(out[name], "wb") as f:
            f.write("\r\n".join([",".join(schemas.RAW[name].fieldNames()), *rows]).encode() + b"\r\n")
    return out


def test_bad_lines_land_in_the_store_and_good_ones_load(spark, tmpdir_path):
    raw, bad = rejects.load_checked_csv(spark, _files(tmpdir_path, LINES), os.path.join(tmpdir_path, "out"), dedup=False)
    got = {(r.table_name, r.reason, r.column_name): r for r in bad.collect()}
    assert Counter((r.table_name, r.reason, r.column_name) for r in bad.collect()) == {
        ("accounts", "type", "signup_date"): 1,
        ("accounts", "type", "seats"): 2,
        ("accounts", "missing", "account_id"): 1,
        ("accounts", "fields", None): 3,
        ("subscriptions", "type", "mrr_amount"): 1,
        ("feature_usage", "type", "usage_date"): 1,
        ("support_tickets", "type", "closed_at"): 1,
        ("churn_events", "type", "refund_amount_usd"): 1,
    }
    assert got["accounts", "missing", "account_id"].faults == 2
    assert got["accounts", "type", "signup_date"].record == LINES["accounts"][1]
    assert {r.record for r in bad.where("reason = 'fields'").collect()} == {LINES["accounts"][i] for i in (4, 5, 8)}
    assert 'a7,"Say ""hi"", ok",Tech' in "".join(r.record for r in bad.where("table_name = 'accounts'").collect())
    assert "two\nlines" in got["churn_events", "type", "refund_amount_usd"].record
    a = {r.account_id: r for r in raw.accounts.collect()}
    assert set(a) == {"a1", "a8"} and a["a1"].signup_date == dt.date(2024, 1, 5) and a["a8"].signup_date is None
    assert raw.subscriptions.first().mrr_amount == Decimal("10.50") and raw.support_tickets.count() == 0
    per_table = Counter({n: df.count() for n, df in raw.as_dict().items()}) + Counter(r.table_name for r in bad.collect())
    assert per_table == {n: len(v) for n, v in LINES.items()}
    for name, df in raw.as_dict().items():
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schemas.RAW[name].fields]
    report = {(r.table_name, r.reason, r.column_name): r.row_count for r in rejects.load_report(raw, bad).collect()}
    assert report["accounts", "loaded", None] == 2 and report["support_tickets", "loaded", None] == 0 and report["accounts", "fields", None] == 3


def test_bad_copies_do_not_win_and_empty_files_load(spark, tmpdir_path):
    raw, _ = rejects.load_checked_csv(spark, _files(tmpdir_path, LINES), os.path.join(tmpdir_path, "out"))
    assert [r.usage_date for r in raw.feature_usage.collect()] == [dt.date(2024, 1, 6)]
    none = {n: [] for n in LINES}
    raw, bad = rejects.load_checked_csv(spark, _files(tmpdir_path, none), os.path.join(tmpdir_path, "none"))
    assert bad.count() == 0 and all(df.count() == 0 for df in raw.as_dict().values())
