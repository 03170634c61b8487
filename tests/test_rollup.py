"""The month rollup: its sheets equal the panel's, and one changed month builds one slice."""

import random

import pytest
from helpers import account, churn, d, raw, sub, ticket, usage

from retentia.config import AnalysisPeriod
from retentia.operators.spine import daily_spine
from retentia.plans import dashboard as dash
from retentia.sources import rollup as R
from retentia.sources.manifest import FactStore
from retentia.sources.rollup import MonthRollup

P = AnalysisPeriod.quarters("2024-01-01", "2024-06-30", [("2024-01-01", "2024-03-31"), ("2024-04-01", "2024-06-30")])
MAY = (d("2024-05-01"), d("2024-05-31"))


def tables(spark, seed=1):
    rng = random.Random(seed)
    day = lambda lo=1: f"2024-0{rng.randint(lo, 6)}-{rng.randint(1, 28):02d}"
    ids = [f"a{i}" for i in range(30)]
    accounts = [account(a, "2024-01-01" if i % 3 else day(), tier=rng.choice(["Pro", "Basic", "Team"])) for i, a in enumerate(ids)]
    accounts[4] = (*accounts[4][:6], None, *accounts[4][7:])  # no tier
    subs = [sub(f"s{i}-{k}", a, day(), None if k else "2024-05-20", mrr=f"{rng.randint(0, 90)}.{rng.randint(10, 99)}") for i, a in enumerate(ids) for k in (0, 1)]
    usages = [usage(f"u{i}", f"s{rng.randrange(30)}-1", day(), secs=rng.randint(1, 900), errors=rng.randint(0, 9)) for i in range(150)]
    tickets = [ticket(f"t{i}", rng.choice(ids), f"{x}T10:00:00", csat=rng.choice([None, "1.0", "4.0"])) for i, x in enumerate(["2024-01-31", "2024-03-31", "2024-06-30", day(), day()] * 4)]
    churns = [churn(f"c{i}", a, day(4)) for i, a in enumerate(rng.sample(ids, 12))]
    return raw(spark, accounts, subs, usages, tickets, churns)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_sheets_equal_the_panels(spark, tmpdir_path):
    store = FactStore(spark, f"{tmpdir_path}/fact")
    store.refresh(daily_spine(tables(spark), P), P.windows)
    fact, got = store.read(), R.sheets(MonthRollup(store))
    assert len(got) == 10
    for name, df in got.items():
        want = getattr(dash, name)(fact)
        assert df.columns == want.columns and df.dtypes == want.dtypes, name
        a, b = rows(df), rows(want)
        assert sorted(a, key=str) == sorted(b, key=str) and (a or name != "cohort_retention"), name
    chosen = dict(tiers=["Pro", "Team"], months=["2024-02-01", "2024-05-01"])
    days = MonthRollup(store).read("days")
    assert rows(R.velocity_by_month(days, **chosen)) == sorted(rows(dash.cross_filtered_velocity(fact, **chosen)))


def test_one_changed_month_builds_one_slice(spark, tmpdir_path):
    store = FactStore(spark, f"{tmpdir_path}/fact")
    first = store.refresh(daily_spine(tables(spark), P), P.windows)
    rollup = MonthRollup(store)
    assert len(rollup.update()) == 1 and rollup.update() == []
    before = set(rollup.read("days").inputFiles()) | set(rollup.read("members").inputFiles())
    old = rows(R.velocity_by_month(rollup.read("days")))
    second = store.refresh(daily_spine(tables(spark, 2), P), [MAY])
    assert rollup.update() == [second.months[202405].split("/")[-2]]
    now = set(rollup.read("days").inputFiles()) | set(rollup.read("members").inputFiles())
    assert {f.split("slice=")[1][:6] for f in now - before} == {f.split("slice=")[1][:6] for f in before - now} == {"202405"}
    new = rows(R.velocity_by_month(rollup.read("days")))
    assert [a == b for a, b in zip(old, new)] == [True] * 4 + [False, True]
    assert new == rows(dash.velocity_by_month(store.read()))
    assert rows(R.velocity_by_month(rollup.read("days", first))) == old  # an older snapshot keeps its slices


def test_unpublished_try_and_empty_store(spark, tmpdir_path, monkeypatch):
    store = FactStore(spark, f"{tmpdir_path}/fact")
    rollup = MonthRollup(store)
    for name, df in R.sheets(rollup).items():
        assert rows(df) == rows(getattr(dash, name)(store.read())), name
    store.refresh(daily_spine(tables(spark), P), P.windows)
    with monkeypatch.context() as m:
        m.setattr(R, "month_members", lambda panel: 1 / 0)  # ends between the two kinds
        with pytest.raises(ZeroDivisionError):
            rollup.update()
    assert len(rollup.update()) == 1
    assert rows(R.total_arr(rollup.read("days"))) == rows(dash.total_arr(store.read()))
