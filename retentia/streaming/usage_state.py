"""De-duplication of a usage stream with state: earliest ``usage_date`` wins, and a moved row is withdrawn.

The state holds one row per usage_id, the one that counts now, in ``SLOTS`` slots; its order is
``dedup_usage``'s (NULLs first, then usage_date, then the other columns).  A
micro-batch is first reduced to one row per usage_id and Arrow batch, so of
many copies of one id only few meet in one task; what is left is compared with
the state alone, a slot at a time, so a micro-batch reads and writes the slots that it
has rows of, in whole columns.  Out come changes: ``change`` 1, the row counts
from now on, or -1, it no longer does.

Changes are kept as ``usage_month=yyyymm/epoch=n`` folders.  An epoch's
folders are written whole, so a replayed epoch (the state goes back to its
last committed version with it) leaves the same files.  The usage of a month
is, for each id, its last change there, if that is 1: reading a month lists
and reads the folders of that month alone.

Odd cases: rows without a usage_date win over dated copies, as in batch mode,
and lie in no month that a window touches; rows without usage_id are copies of
one another; copies of the row that counts change nothing; an empty batch
writes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from retentia import schemas

ID, DATE, MONTH = "usage_id", "usage_date", "usage_month"
COLUMNS = schemas.FEATURE_USAGE.fieldNames()
ORDER = [DATE, *[c for c in COLUMNS if c not in (ID, DATE)]]
STATE_SCHEMA = T.StructType([T.StructField("rows", T.BinaryType())])
CHANGE_BLOBS = T.StructType([T.StructField("rows", T.BinaryType()), T.StructField("change", T.IntegerType())])
#: Parts of the state, by a hash of usage_id: a fixed number of calls a micro-batch, whatever its rows.
SLOTS = 1024
CHANGES = T.StructType([*[T.StructField(f.name, f.dataType) for f in schemas.FEATURE_USAGE], T.StructField("change", T.IntegerType())])
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _firsts(ids: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Places of the first row of each id, of sorted ids."""
    codes = ids.dictionary_encode(null_encoding="encode")
    codes = (codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes).indices.to_numpy()
    return np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)


def earliest_of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each usage_id in every Arrow batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        by = [(c, "ascending") for c in (ID, *ORDER)]
        rows = batch.take(pc.sort_indices(batch, sort_keys=by, null_placement="at_start"))
        yield rows.take(pa.array(_firsts(rows.column(COLUMNS.index(ID)))))


def _blob(table: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema) as w:
        w.write_table(table)
    return out.getvalue().to_pybytes()


class EarliestUsage(StatefulProcessor):
    """Keeps the earliest row of each usage_id of a slot; emits it when it first counts, and the old one's withdrawal when it moves.

    The state of a slot is one value, its rows as an Arrow stream: it is read and written by one call each a micro-batch, and compared
    with the new rows column by column, so no usage_id costs a call."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("counts", STATE_SCHEMA)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pa.concat_tables([pa.ipc.open_stream(x).read_all() for part in rows for x in part["rows"]])
        kept = self.state.get()  # None for a new slot
        old = pa.ipc.open_stream(kept[0]).read_all() if kept is not None else new.slice(0, 0)
        both = pa.concat_tables([old.append_column("old", pa.array(np.ones(len(old), bool))), new.append_column("old", pa.array(np.zeros(len(new), bool)))])
        # Of equal rows the kept one comes first, so that it stays.
        by = [*((c, "ascending") for c in (ID, *ORDER)), ("old", "descending")]
        both = both.take(pc.sort_indices(both, sort_keys=by, null_placement="at_start")).combine_chunks()
        first = _firsts(both.column(ID))
        counts = np.zeros(len(both), bool)
        counts[first] = True
        was = both.column("old").to_numpy(zero_copy_only=False)
        if (counts & ~was).any():
            self.state.update((_blob(both.filter(pa.array(counts)).drop_columns(["old"])),))
        for hit, change in ((was & ~counts, -1), (counts & ~was, 1)):
            if hit.any():
                gone = both.filter(pa.array(hit)).drop_columns(["old"])
                yield pd.DataFrame({"rows": [_blob(gone)], "change": np.array([change], np.int32)})

    def close(self) -> None:
        pass


def packed_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of every slot of each Arrow batch as one Arrow stream."""
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table.take(pc.sort_indices(table, sort_keys=[("slot", "ascending")]))
        slot = table.column("slot").to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        rows = table.drop_columns(["slot"])
        blobs = [_blob(rows.slice(a, b - a).combine_chunks()) for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(slot)])]
        yield pa.RecordBatch.from_arrays([pa.array(slot[starts], pa.int32()), pa.array(blobs, pa.binary())], names=["slot", "rows"])


def unpacked_changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for blob, change in zip(batch.column(0), batch.column(1).to_pylist()):
            for rows in pa.ipc.open_stream(blob.as_py()).read_all().to_batches(max_chunksize=10_000):
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.full(rows.num_rows, change, np.int32))], names=[*COLUMNS, "change"])


def usage_changes(stream: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Streaming usage rows -> streaming changes of the de-duplicated usage.  ``slots``, by a hash of usage_id, divide the state; a running query keeps its number."""
    first = stream.select(*COLUMNS).mapInArrow(earliest_of_batch, schemas.FEATURE_USAGE)
    slot = F.pmod(F.xxhash64(ID), F.lit(slots)).cast("int").alias("slot")
    packed = first.select(slot, *COLUMNS).mapInArrow(packed_slots, "slot int, rows binary")
    out = packed.groupBy("slot").transformWithStateInPandas(EarliestUsage(), CHANGE_BLOBS, "Update", "None")
    return out.mapInArrow(unpacked_changes, CHANGES)


def _folders(spark: SparkSession, pattern: str) -> list[str]:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return [s.getPath().toString() for s in found or []]


def write_changes(changes: DataFrame, store: str, epoch: int) -> None:
    """Puts an epoch's changes into its folders, in place of any from an earlier try."""
    dated = changes.withColumn(MONTH, F.year(DATE) * 100 + F.month(DATE)).withColumn("epoch", F.lit(epoch).cast("bigint"))
    out = dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.partitionBy(MONTH, "epoch").parquet(store)


def _read(spark: SparkSession, store: str, pattern: str) -> DataFrame:
    schema = T.StructType([*CHANGES, T.StructField(MONTH, T.IntegerType()), T.StructField("epoch", T.LongType())])
    paths = _folders(spark, f"{store}/{pattern}")
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", store).parquet(*paths)


def epoch_changes(spark: SparkSession, store: str, epoch: int) -> DataFrame:
    """The changes of one micro-batch."""
    return _read(spark, store, f"{MONTH}=*/epoch={epoch}")


def current_usage(spark: SparkSession, store: str, months: list[int] | None = None) -> DataFrame:
    """The de-duplicated usage of some months (yyyymm), or of all with the undated rows; no other month is listed or read."""
    pattern = f"{MONTH}=*" if months is None else f"{MONTH}={{{','.join(str(m) for m in months)}}}"
    row = F.struct("epoch", "change", F.struct(*COLUMNS).alias("row"))
    last = _read(spark, store, pattern).groupBy(MONTH, ID).agg(F.max(row).alias("last"))
    return last.where(F.col("last.change") == 1).select("last.row.*")


def start_usage_dedup(spark: SparkSession, landing_dir: str, store: str, checkpoint_location: str,
                      after: Callable[[int], None] | None = None, file_format: str = "parquet",
                      available_now: bool = True, files_a_batch: int | None = None):
    """Starts the query that keeps ``store`` up to date with the files landing in a folder; ``after(epoch)`` runs once an
    epoch's changes are written.  State lives in RocksDB under ``checkpoint_location``, a shared folder."""
    reader = spark.readStream.schema(schemas.FEATURE_USAGE).format(file_format)
    if files_a_batch:
        reader = reader.option("maxFilesPerTrigger", files_a_batch)

    def on_batch(changes: DataFrame, epoch: int) -> None:
        write_changes(changes, store, epoch)  # the only action on the batch: the state is read and written once
        if after is not None:
            after(epoch)

    writer = usage_changes(reader.load(landing_dir)).writeStream.outputMode("update").foreachBatch(on_batch)
    writer = writer.option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKS_DB)  # this kind of state needs it; a query keeps the settings it started with
    try:
        return writer.start()
    finally:
        spark.conf.set(STATE_STORE, before)
