"""Streaming usage refresh ends in the same fact table as the batch job."""

import os

from helpers import account, raw, sub, usage

from retentia import schemas
from retentia.config import AnalysisPeriod
from retentia.operators.dedup import dedup_usage
from retentia.operators.spine import daily_spine
from retentia.sources.manifest import FactStore
from retentia.sources.store import backfill, read_fact
from retentia.streaming.usage_refresh import FactPointer, start_usage_refresh

P = AnalysisPeriod.quarters("2024-01-01", "2024-06-30", [("2024-01-01", "2024-03-31"), ("2024-04-01", "2024-06-30")])


def test_stream_matches_batch(spark, tmpdir_path):
    first = [usage("u1", "s", "2024-01-05", secs=30), usage("u2", "s", "2024-02-05", secs=40)]
    later = [usage("u3", "s", "2024-05-05", secs=50), usage("u1", "s", "2024-01-02", secs=99)]  # earlier copy of u1
    base = raw(spark, [account("a", "2024-01-01")], [sub("s", "a", "2024-01-01", mrr="10.00")])
    landing, store, ckpt = (os.path.join(tmpdir_path, x) for x in ("landing", "store", "ckpt"))
    pointer = FactPointer(backfill(spark, base, P))  # start from a full build

    spark.createDataFrame(first, schemas.FEATURE_USAGE).write.mode("append").parquet(landing)
    start_usage_refresh(spark, landing, store, base, P, pointer, ckpt).awaitTermination()
    assert len(pointer.history) == 1  # one new version for the touched window
    first_version = pointer.path
    spark.createDataFrame(later, schemas.FEATURE_USAGE).write.mode("append").parquet(landing)
    start_usage_refresh(spark, landing, store, base, P, pointer, ckpt).awaitTermination()

    full = raw(spark, [account("a", "2024-01-01")], [sub("s", "a", "2024-01-01", mrr="10.00")], usages=first + later)
    full = full.__class__(full.accounts, full.subscriptions, dedup_usage(full.feature_usage), full.support_tickets,
                          full.churn_events)
    want = sorted(tuple(r) for r in daily_spine(full, P).collect())
    got = sorted(tuple(r) for r in read_fact(spark, pointer.path).drop("obs_ym").collect())
    diff = sorted(set(got) ^ set(want))
    assert got == want, diff[:6]
    assert pointer.path != first_version
    days = {r[1]: r for r in got}
    import datetime as dt

    assert days[dt.date(2024, 1, 2)][11] == 99 and days[dt.date(2024, 1, 5)][11] == 0


def test_stream_into_a_fact_store_touches_its_months_alone(spark, tmpdir_path):
    first = [usage("u1", "s", "2024-05-05", secs=30)]
    later = [usage("u2", "s", "2024-02-02", secs=99)]
    base = raw(spark, [account("a", "2024-01-01")], [sub("s", "a", "2024-01-01", mrr="10.00")])
    landing, store, ckpt = (os.path.join(tmpdir_path, x) for x in ("landing", "store", "ckpt"))
    facts = FactStore(spark, os.path.join(tmpdir_path, "fact"))
    built = facts.refresh(daily_spine(base, P), P.windows)
    seen = [built]
    for rows in (first, later):  # each batch in a query of its own, as after a restart
        spark.createDataFrame(rows, schemas.FEATURE_USAGE).write.mode("append").parquet(landing)
        start_usage_refresh(spark, landing, store, base, P, FactStore(spark, facts.base), ckpt).awaitTermination()
        seen.append(facts.snapshot())
    moved = lambda a, b: {m for m in b.months if a.months[m] != b.months[m]}
    assert [s.number for s in seen] == [1, 2, 3]
    assert moved(seen[0], seen[1]) == {202404, 202405, 202406} and moved(seen[1], seen[2]) == {202401, 202402, 202403}
    full = raw(spark, [account("a", "2024-01-01")], [sub("s", "a", "2024-01-01", mrr="10.00")], usages=first + later)
    assert sorted(map(tuple, facts.read().drop("obs_ym").collect())) == sorted(map(tuple, daily_spine(full, P).collect()))


def test_usage_id_moved_to_another_window(spark, tmpdir_path):
    first = [usage("u1", "s", "2024-05-05", secs=30)]
    later = [usage("u1", "s", "2024-01-02", secs=99)]
    base = raw(spark, [account("a", "2024-01-01")], [sub("s", "a", "2024-01-01", mrr="10.00")])
    landing, store, ckpt = (os.path.join(tmpdir_path, x) for x in ("landing", "store", "ckpt"))
    pointer = FactPointer(backfill(spark, base, P))
    for rows in (first, later):
        spark.createDataFrame(rows, schemas.FEATURE_USAGE).write.mode("append").parquet(landing)
        start_usage_refresh(spark, landing, store, base, P, pointer, ckpt).awaitTermination()
    fact = read_fact(spark, pointer.path).where("daily_time_in_app > 0")
    assert [(str(r.observation_date), r.daily_time_in_app) for r in fact.collect()] == [("2024-01-02", 99)]


def test_pointer_survives_driver_restart(spark, tmpdir_path):
    f = os.path.join(tmpdir_path, "fact.pointer")
    p = FactPointer(pointer_file=f, spark=spark)
    p.swap("/shared/fact/v1")
    p.swap("/shared/fact/v2")
    assert FactPointer.restore(spark, f).path == "/shared/fact/v2"
    assert FactPointer.restore(spark, os.path.join(tmpdir_path, "missing")).path is None
