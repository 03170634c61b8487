"""Property test: the Spark spine by change points equals the SQL oracle
(unnested days, arg_max, a lookup of the day before) on random raw tables."""

import datetime as dt
from decimal import Decimal

import duckdb
import pandas as pd
import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from helpers import raw

from retentia.config import AnalysisPeriod
from retentia.operators.spine import AS_OF_RUN_MODE, WINDOW_MODE, daily_spine
from retentia.plans.oracle import SPINE_OUT, spine_ctes

P = AnalysisPeriod.quarters("2024-01-01", "2024-04-30", [("2024-01-01", "2024-02-15"), ("2024-02-16", "2024-04-30")])
BASE = dt.date(2023, 12, 1)

days = st.integers(min_value=0, max_value=170)
accounts_st = st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d"]), days), min_size=1, max_size=4, unique_by=lambda x: x[0])
subs_st = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", "d", "zz"]), days, st.one_of(st.none(), st.integers(0, 90)),
              st.sampled_from(["10.00", "25.50", "99.99"]), st.sampled_from(["monthly", "annual"]), st.integers(0, 1)),
    max_size=8,
)
churn_st = st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d"]), days), max_size=5)
usage_st = st.lists(st.tuples(st.integers(0, 7), days, st.integers(0, 500), st.integers(0, 9)), max_size=10)
ticket_st = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), days, st.integers(0, 23),
                               st.sampled_from(["1.00", "2.25", "7.50"]), st.one_of(st.none(), st.integers(1, 5))), max_size=8)


def _d(n):
    return BASE + dt.timedelta(days=n)


def _tables(accts, subs, churns, usages, tickets):
    from helpers import account, churn, sub, ticket, usage

    A = [account(a, str(_d(s))) for a, s in accts]
    S = [sub(f"s{i}", a, str(_d(s)), str(_d(s + e)) if e is not None else None, mrr=m, billing=b, downgrade=g)
         for i, (a, s, e, m, b, g) in enumerate(subs)]
    C = [churn(f"c{i}", a, str(_d(x))) for i, (a, x) in enumerate(churns)]
    U = [usage(f"u{i}", f"s{k}", str(_d(x)), secs=secs, errors=err) for i, (k, x, secs, err) in enumerate(usages)]
    T = [ticket(f"t{i}", a, f"{_d(x)} {h:02d}:00:00", hours=hr, csat=None if cs is None else f"{cs}.0")
         for i, (a, x, h, hr, cs) in enumerate(tickets)]
    return A, S, C, U, T


def _oracle(tables, mode):
    from retentia import schemas

    con = duckdb.connect()
    names = ["accounts", "subscriptions", "feature_usage", "support_tickets", "churn_events"]
    a, s_, c, u, t = tables  # _tables order: accounts, subs, churns, usage, tickets
    for name, rows in zip(names, (a, s_, u, t, c)):
        cols = schemas.RAW[name].fieldNames()
        pdf = pd.DataFrame(rows, columns=cols)
        for c in pdf.columns:
            if pdf[c].map(lambda v: isinstance(v, Decimal)).any():
                pdf[c] = pdf[c].map(lambda v: None if v is None else str(v))
        con.register(f"{name}_df", pdf)
        typed = ", ".join(
            f"CAST({c} AS {'DECIMAL(10,2)' if c in ('mrr_amount', 'arr_amount', 'resolution_time_hours', 'refund_amount_usd') else 'DECIMAL(3,1)' if c == 'satisfaction_score' else 'DATE' if c.endswith('_date') else 'TIMESTAMP' if c in ('submitted_at', 'closed_at') else 'INTEGER' if c in ('seats', 'usage_count', 'usage_duration_secs', 'error_count', 'first_response_time_minutes') or c in schemas.FLAG_COLUMNS.get(name, ()) else 'VARCHAR'}) AS {c}"
            for c in cols
        )
        con.execute(f"CREATE TABLE {name} AS SELECT {typed} FROM {name}_df")
    sql = "WITH " + spine_ctes(P, mode).lstrip() + f"\nSELECT {SPINE_OUT} FROM spine"
    return sorted(tuple(r) for r in con.execute(sql).fetchall())


@pytest.mark.parametrize("mode", [WINDOW_MODE, AS_OF_RUN_MODE])
@settings(max_examples=10, deadline=None, phases=[Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(accounts_st, subs_st, churn_st, usage_st, ticket_st)
def test_spine_matches_sql(spark, mode, accts, subs, churns, usages, tickets):
    tables = _tables(accts, subs, churns, usages, tickets)
    r = raw(spark, *[tables[i] for i in (0, 1, 3, 4, 2)])
    from retentia.plans.catalog import decimals_to_double

    spine = daily_spine(r, P, mode)
    got = sorted(tuple(x) for x in decimals_to_double(spine).collect())
    assert got == _oracle(tables, mode)
