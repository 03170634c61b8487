"""Every registered query against its DuckDB oracle on the smallest test tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, value_hash  # noqa: E402

from retentia.plans.catalog import MODEL_QUERIES, QUERIES  # noqa: E402
from retentia.plans.oracle import oracle_queries  # noqa: E402

SF = "/root/testdata/sf0.001"
SQL = oracle_queries()  # the corpus queries have tests of their own
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["latest_date", "total_arr"] and len(rows) == 1


def test_every_query_has_oracle_or_is_model_based():
    assert not set(QUERIES) - set(SQL) and set(QUERIES) | set(MODEL_QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[name])
    o_cols = [x[0] for x in cur.description]
    o_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert value_hash(df.columns, s_rows) == value_hash(o_cols, o_rows)


def test_risk_roster_is_in_order(spark):
    rows = [(-r.flight_risk_score, r.account_id) for r in E.queries()["risk_roster"](spark, SF).collect()]
    assert rows == sorted(rows)
