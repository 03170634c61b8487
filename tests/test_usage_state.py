"""The stateful de-duplication of a usage stream against batch mode."""

import os
import random

from helpers import usage

from retentia import schemas
from retentia.operators.dedup import dedup_usage
from retentia.session import ship_by_value
from retentia.streaming import usage_state
from retentia.streaming.usage_state import current_usage, epoch_changes, start_usage_dedup, write_changes

ship_by_value(usage_state, schemas)


def land(spark, folder, rows):
    spark.createDataFrame(rows, schemas.FEATURE_USAGE).coalesce(1).write.mode("append").parquet(folder)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def folders(tmp):
    return [os.path.join(tmp, x) for x in ("landing", "store", "ckpt")]


def test_batches_and_a_restart_equal_batch_mode(spark, tmpdir_path):
    landing, store, ckpt = folders(tmpdir_path)
    rng = random.Random(5)
    row = lambda: usage(f"u{rng.randrange(40)}", rng.choice(["s", "t"]), f"2024-0{rng.randint(1, 6)}-1{rng.randint(0, 2)}", secs=rng.randint(1, 3))
    batches = [[row() for _ in range(60)] for _ in range(3)]
    undated = list(usage("u1", "s", "2024-01-01"))
    undated[2] = undated[3] = None
    batches[1] += [tuple(undated), usage("u2", None, "2024-01-01")]
    batches[2] += batches[0][:20] + [usage("hot", "s", "2024-06-30")] * 500  # copies again, and a hot id
    seen = []
    for rows in batches:  # a query of its own each, as after a restart
        land(spark, landing, rows)
        start_usage_dedup(spark, landing, store, ckpt).awaitTermination()
        seen += rows
        assert rows_of(current_usage(spark, store)) == rows_of(dedup_usage(spark.createDataFrame(seen, schemas.FEATURE_USAGE)))
    start_usage_dedup(spark, landing, store, ckpt).awaitTermination()  # nothing landed
    assert epoch_changes(spark, store, 3).count() == 0


def test_changes_carry_withdrawals_and_their_months_alone(spark, tmpdir_path):
    landing, store, ckpt = folders(tmpdir_path)
    first = [usage("u1", "s", "2024-05-05"), usage("u2", "s", "2024-05-06"), usage("u3", "s", "2024-03-09")]
    later = [usage("u1", "s", "2024-02-02"), usage("u2", "s", "2024-05-01"), usage("u2", "s", "2024-05-20")]
    epochs = []
    for rows in (first, later):
        land(spark, landing, rows)
        start_usage_dedup(spark, landing, store, ckpt, after=epochs.append).awaitTermination()
    assert epochs == [0, 1]
    got = {(r.usage_id, str(r.usage_date), r.change) for r in epoch_changes(spark, store, 1).collect()}
    assert got == {("u1", "2024-05-05", -1), ("u1", "2024-02-02", 1), ("u2", "2024-05-06", -1), ("u2", "2024-05-01", 1)}
    may = current_usage(spark, store, [202405])
    assert [(r.usage_id, str(r.usage_date)) for r in may.collect()] == [("u2", "2024-05-01")]
    assert all("usage_month=202405" in f for f in may.inputFiles()) and may.inputFiles()
    assert current_usage(spark, store, [202401]).count() == 0


def test_replayed_epoch_leaves_the_same_rows(spark, tmpdir_path):
    store = os.path.join(tmpdir_path, "store")
    one = spark.createDataFrame([(*usage("u1", "s", "2024-05-05"), 1)], usage_state.CHANGES)
    move = spark.createDataFrame([(*usage("u1", "s", "2024-05-05"), -1), (*usage("u1", "s", "2024-02-02"), 1)], usage_state.CHANGES)
    for epoch, changes in ((0, one), (1, move), (1, move)):
        write_changes(changes, store, epoch)
    assert epoch_changes(spark, store, 1).count() == 2
    assert [str(r.usage_date) for r in current_usage(spark, store).collect()] == ["2024-02-02"]


def test_state_is_reached_by_slots_not_by_ids():
    import pyarrow as pa

    ids = [f"u{k}" for k in range(5000)]
    columns = [pa.array(ids) if c == "usage_id" else pa.nulls(5000, pa.int32()) for c in usage_state.COLUMNS]
    batch = pa.RecordBatch.from_arrays([pa.array([k % 7 for k in range(5000)], pa.int32()), *columns], names=["slot", *usage_state.COLUMNS])
    (packed,) = usage_state.packed_slots(iter([batch]))
    assert packed.num_rows == 7  # one row, and so one state value, a slot
    back = [x for blob in packed.column(1) for x in pa.ipc.open_stream(blob.as_py()).read_all().column("usage_id").to_pylist()]
    assert sorted(back) == sorted(ids)
