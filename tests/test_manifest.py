"""Month folders behind a manifest: a refresh touches its months alone, a crash before the swap changes nothing, buckets stay."""

import datetime as dt
import re

import pytest
from helpers import account, d, raw, rows_by_day, sub

from retentia.config import AnalysisPeriod
from retentia.operators.spine import daily_spine
from retentia.sources.manifest import FactStore, Snapshot, touched_months

P = AnalysisPeriod.quarters("2024-01-01", "2024-06-30", [("2024-01-01", "2024-03-31"), ("2024-04-01", "2024-06-30")])


def tables(spark, mrr="10.00", accounts="ab"):
    return raw(spark, [account(a, "2024-01-01") for a in accounts], [sub(f"s{a}", a, "2024-01-01", mrr=mrr) for a in accounts])


def files(df):
    return {re.sub(r"^file:(//)?", "", f) for f in df.inputFiles()}


def test_refresh_touches_its_months_alone(spark, tmpdir_path):
    store = FactStore(spark, f"{tmpdir_path}/fact")
    assert store.snapshot() is None and store.read().count() == 0 and store.row_count() == 0
    first = store.refresh(daily_spine(tables(spark), P), P.windows)
    assert sorted(first.months) == [202401, 202402, 202403, 202404, 202405, 202406] and store.row_count() == 2 * 182
    before = files(store.read())
    second = store.refresh(daily_spine(tables(spark, "20.00", "a"), P), [P.windows[1]])
    assert second.number == 2 and {m for m in second.months if second.months[m] != first.months[m]} == {202404, 202405, 202406}
    now = files(store.read())
    kept = {f for f in before if re.search(r"obs_ym=20240[123]/", f)}
    assert kept <= now and not (before - kept) & now
    rows = rows_by_day(store.read(), "a")
    assert len(rows) == 182 and rows[d("2024-03-31")]["active_mrr_run_rate"] == 10 and rows[d("2024-04-01")]["active_mrr_run_rate"] == 20
    assert max(rows_by_day(store.read(), "b")) == d("2024-03-31")
    # An older snapshot still reads what it named.
    assert store.read(first).count() == 2 * 182 and store.read(store.snapshot(1)).where("active_mrr_run_rate = 20").count() == 0


def test_part_of_a_month_and_an_emptied_one(spark, tmpdir_path):
    store = FactStore(spark, f"{tmpdir_path}/fact")
    store.refresh(daily_spine(tables(spark), P), P.windows)
    window = (dt.date(2024, 2, 10), dt.date(2024, 2, 20))
    store.refresh(daily_spine(tables(spark, "30.00"), P), [window])
    rows = rows_by_day(store.read(), "a")
    assert {x for x, r in rows.items() if r["active_mrr_run_rate"] == 30} == {dt.date(2024, 2, k) for k in range(10, 21)} and len(rows) == 182
    gone = store.refresh(daily_spine(tables(spark, accounts=""), P), [(dt.date(2024, 5, 1), dt.date(2024, 5, 31))])
    assert 202405 not in gone.months and store.read().where("obs_ym = 202405").count() == 0 and store.row_count() == store.read().count() == 2 * 151
    assert touched_months([(dt.date(2023, 11, 30), dt.date(2024, 2, 1))]) == [202311, 202312, 202401, 202402]


def test_a_crash_before_the_swap_leaves_the_last_snapshot(spark, tmpdir_path):
    store = FactStore(spark, f"{tmpdir_path}/fact")
    store.refresh(daily_spine(tables(spark), P), P.windows)
    staged = store.stage(daily_spine(tables(spark, "99.00"), P), [P.windows[0]])  # written; the driver ends here
    again = FactStore(spark, f"{tmpdir_path}/fact")
    assert again.snapshot().number == 1 and again.read().where("active_mrr_run_rate = 99").count() == 0
    again.publish(staged)
    assert again.read().where("active_mrr_run_rate = 99").count() == 2 * 91
    with pytest.raises(FileExistsError):  # a second writer of the same number
        again.publish(Snapshot(2, staged.buckets))


def test_buckets_and_pruning_stay(spark, tmpdir_path):
    store = FactStore(spark, f"{tmpdir_path}/fact")
    n = store.buckets()
    store.refresh(daily_spine(tables(spark), P, partitions=n), P.windows, placed=True)
    store.refresh(daily_spine(tables(spark, "20.00"), P), [P.windows[1]])
    plan = store.read().groupBy("account_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    pruned = store.read().where("obs_ym = 202402")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in pruned and store.read().where("obs_ym = 202402").count() == 2 * 29
    assert sorted(map(tuple, store.read().drop("obs_ym").where("observation_date < '2024-04-01'").collect())) == sorted(map(tuple, daily_spine(tables(spark), P).where("observation_date < '2024-04-01'").collect()))


def test_checks_come_from_the_snapshot(spark, tmpdir_path):
    from pyspark.sql import functions as F

    from retentia.operators import quality

    store = FactStore(spark, f"{tmpdir_path}/fact")
    spine = daily_spine(tables(spark), P)
    hole = F.when(F.dayofmonth("observation_date") == 3, F.lit(None)).otherwise(F.col("billing_frequency"))
    store.refresh(spine.withColumn("billing_frequency", hole), P.windows)  # planted NULLs
    scanned = {r.column_name: r.null_rows for r in quality.not_null_violations(store.read()).collect()}
    assert scanned["billing_frequency"] == 2 * 6 and {c: store.null_counts()[c] for c in scanned} == scanned
    store.refresh(spine, [P.windows[1]])
    assert store.null_counts()["billing_frequency"] == 2 * 3 and store.row_count() == store.read().count()
