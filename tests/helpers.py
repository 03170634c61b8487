"""Tiny hand-made raw tables for micro-fixtures."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from retentia import schemas
from retentia.sources.raw import RawTables


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def account(aid, signup, industry="DevTools", tier="Pro", referral="organic"):
    return (aid, f"name {aid}", industry, "US", d(signup), referral, tier, 5, 0, 0)


def sub(sid, aid, start, end=None, mrr="100.00", downgrade=0, billing="monthly", auto_renew=1, trial=0):
    m = Decimal(mrr)
    return (sid, aid, d(start), d(end) if end else None, "Pro", 5, m, m * 12, trial, 0, downgrade, 0, billing, auto_renew)


def usage(uid, sid, day, secs=60, errors=0, beta=0, count=1, feature="f1"):
    return (uid, sid, d(day), feature, count, secs, errors, beta)


def ticket(tid, aid, at, hours="1.00", priority="low", csat="4.0"):
    return (tid, aid, ts(at), None, Decimal(hours), priority, 10, Decimal(csat) if csat is not None else None, 0)


def churn(cid, aid, day, reason="pricing"):
    return (cid, aid, d(day), reason, Decimal("0.00"), 0, 0, 0, None)


def raw(spark, accounts=(), subs=(), usages=(), tickets=(), churns=()) -> RawTables:
    mk = lambda rows, s: spark.createDataFrame(list(rows), s)
    return RawTables(
        accounts=mk(accounts, schemas.ACCOUNTS),
        subscriptions=mk(subs, schemas.SUBSCRIPTIONS),
        feature_usage=mk(usages, schemas.FEATURE_USAGE),
        support_tickets=mk(tickets, schemas.SUPPORT_TICKETS),
        churn_events=mk(churns, schemas.CHURN_EVENTS),
    )


def rows_by_day(df, account_id=None):
    if account_id is not None:
        df = df.where(df.account_id == account_id)
    return {r["observation_date"]: r for r in df.collect()}
