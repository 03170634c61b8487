"""Incremental fact refresh driven by arriving feature-usage files.

The original pipeline has no streaming; its nearest relative is the
idempotent window refresh.  This wires that refresh to Structured
Streaming: usage files landing in a folder are read as a stream and
de-duplicated against keyed state (``usage_state``: "earliest usage_date
wins" over everything received so far, as in batch mode), and only the refresh
windows that hold a changed row, on its new or its old date, are recomputed
(window refresh replaces exactly those dates).  A batch reads its own rows,
the state and the usage of the touched windows' months.  With a ``FactStore``
as its target only the touched months of the panel are read and written, with their slices of the month rollup, and each batch
publishes one snapshot;
with a ``FactPointer`` each batch writes a whole new version.  Because a window refresh is a pure function
of the raw tables, replaying a batch after a failure rewrites the same rows
- the sink is idempotent, so the checkpointed query is effectively
exactly-once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia import schemas
from retentia.config import AnalysisPeriod
from retentia.operators.spine import WINDOW_MODE, daily_spine, window_array
from retentia.session import ship_by_value
from retentia.sources.manifest import FactStore, touched_months
from retentia.sources.raw import RawTables
from retentia.sources.rollup import MonthRollup
from retentia.sources.store import refresh_windows
from retentia.streaming import usage_state
from retentia.streaming.usage_state import current_usage, epoch_changes, start_usage_dedup


@dataclass
class FactPointer:
    """Current version folder of the fact table (swapped after each refresh).

    With ``pointer_file`` set, every swap is also written there through the
    Hadoop FileSystem API (temp file, then rename), so a restarted driver
    resumes from the last published version while the stream resumes from
    its checkpoint."""

    path: str | None = None
    history: list[str] = field(default_factory=list)
    pointer_file: str | None = None
    spark: SparkSession | None = None

    def swap(self, new_path: str) -> None:
        if self.path:
            self.history.append(self.path)
        self.path = new_path
        if self.pointer_file and self.spark is not None:
            _write_text(self.spark, self.pointer_file, new_path)

    @staticmethod
    def restore(spark: SparkSession, pointer_file: str) -> "FactPointer":
        # A crash between the delete and the rename of a swap leaves only the
        # complete temp file; it holds the newest version.
        path = _read_text(spark, pointer_file) or _read_text(spark, pointer_file + ".tmp")
        return FactPointer(path, [], pointer_file, spark)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    p, fs = _fs(spark, path)
    tmp, _ = _fs(spark, path + ".tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(p):
        fs.delete(p, False)
    fs.rename(tmp, p)


def _read_text(spark: SparkSession, path: str) -> str | None:
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    reader = spark.sparkContext._jvm.java.io.BufferedReader(spark.sparkContext._jvm.java.io.InputStreamReader(stream))
    line = reader.readLine()
    reader.close()
    return line


def touched_windows(batch: DataFrame, period: AnalysisPeriod) -> list[int]:
    """Window indexes containing any usage date of the batch (at most the
    number of windows, a parameter, so the result is bounded)."""
    wins = F.filter(window_array(period), lambda w: (w["w_from"] <= F.col("usage_date")) & (F.col("usage_date") <= w["w_to"]))
    hits = batch.select(F.explode(wins).alias("w")).select("w.w").distinct()
    return sorted(r["w"] for r in hits.collect())


def start_usage_refresh(
    spark: SparkSession,
    landing_dir: str,
    usage_store: str,
    base: RawTables,
    period: AnalysisPeriod,
    pointer: FactPointer | FactStore,
    checkpoint_location: str,
    file_format: str = "parquet",
    mode: str = WINDOW_MODE,
    available_now: bool = True,
):
    """Start the streaming query; returns the ``StreamingQuery``.

    ``base`` supplies accounts, subscriptions, tickets and churn events; the
    usage table is what ``usage_store`` holds, changes by month."""

    def after(epoch: int) -> None:
        touched = touched_windows(epoch_changes(spark, usage_store, epoch), period)
        if not touched:
            return
        windows = [period.windows[w] for w in touched]
        # A window's rows depend on no usage outside it: only its months are read.
        usage = current_usage(spark, usage_store, touched_months(windows))
        raw = RawTables(base.accounts, base.subscriptions, usage, base.support_tickets, base.churn_events)
        # In window mode a window's rows depend on that window alone, so only
        # the touched windows are rebuilt; as-of-run mode has one window.
        sub = AnalysisPeriod(period.cal_start, period.cal_end, tuple(windows)) if mode == WINDOW_MODE else period
        spine = daily_spine(raw, sub, mode)
        if isinstance(pointer, FactStore):
            pointer.refresh(spine, windows)
            MonthRollup(pointer).update()
        else:
            pointer.swap(refresh_windows(spark, pointer.path, spine, windows))

    ship_by_value(usage_state, schemas)
    return start_usage_dedup(spark, landing_dir, usage_store, checkpoint_location, after, file_format, available_now)
