"""The fact table as month folders behind a manifest.

A snapshot is a small JSON file: the bucket count, and for each month the
folder that holds its rows, bucketed by account.  A refresh reads and writes
only the months that its windows touch; the next snapshot names the new
folders for them and the old ones for all others.  Publishing is one rename of
a finished temporary file to ``snapshots/<number>.json``: a crash before it
leaves the last snapshot, and readers of an older one keep their files.

Readers get a table whose partitions are the folders of one snapshot, so
months are pruned, and scans by account come clustered by bucket.  All file
access goes through Spark's Hadoop file systems; only manifests pass through
the driver, whose size is the number of months.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia import schemas
from retentia.sources.store import MONTH_COL, default_buckets, month_key, write_buckets

Window = tuple[dt.date, dt.date]


@dataclass(frozen=True)
class Snapshot:
    number: int
    buckets: int
    #: Month (yyyymm) -> folder; months without rows have none.
    months: dict[int, str] = field(default_factory=dict)
    #: Rows and NULLs by column of each month, counted from its files as they were written.
    checks: dict[int, dict[str, int]] = field(default_factory=dict)


def touched_months(windows: Sequence[Window]) -> list[int]:
    out = set()
    for a, b in windows:
        y, m = a.year, a.month
        while (y, m) <= (b.year, b.month):
            out.add(y * 100 + m)
            y, m = (y, m + 1) if m < 12 else (y + 1, 1)
    return sorted(out)


def whole_months(windows: Sequence[Window]) -> set[int]:
    """The touched months all of whose days lie in the windows."""
    days: dict[int, int] = {}
    for m in touched_months(windows):
        first = dt.date(m // 100, m % 100, 1)
        last = (first + dt.timedelta(days=31)).replace(day=1) - dt.timedelta(days=1)
        days[m] = (last - first).days + 1 - sum(max((min(b, last) - max(a, first)).days + 1, 0) for a, b in windows)
    return {m for m, missing in days.items() if not missing}


def _inside(windows: Sequence[Window]):
    day = F.col("observation_date")
    cond = F.lit(False)
    for a, b in windows:
        cond = cond | day.between(F.lit(str(a)).cast("date"), F.lit(str(b)).cast("date"))
    return cond


class FactStore:
    """Snapshots of the fact table under one folder of the shared store."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    # -- files -----------------------------------------------------------------

    def _path(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        p, fs = self._path(f"{self.base}/snapshots")
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def snapshot(self, number: int | None = None) -> Snapshot | None:
        """The snapshot of this number, or the last one; None if there is none."""
        numbers = self._numbers()
        if not numbers:
            return None
        number = numbers[-1] if number is None else number
        text = "\n".join(r.value for r in self.spark.read.text(f"{self.base}/snapshots/{number}.json").collect())
        raw = json.loads(text)
        as_months = lambda d: {int(k): v for k, v in d.items()}
        return Snapshot(raw["number"], raw["buckets"], as_months(raw["months"]), as_months(raw["checks"]))

    def publish(self, snapshot: Snapshot) -> Snapshot:
        """Makes a snapshot the last one, by one rename; an error if its number is taken."""
        temp, fs = self._path(f"{self.base}/snapshots/.{snapshot.number}-{uuid.uuid4().hex}.tmp")
        out = fs.create(temp, False)
        out.write(bytearray(json.dumps(snapshot.__dict__).encode()))
        out.close()
        final, _ = self._path(f"{self.base}/snapshots/{snapshot.number}.json")
        if fs.exists(final) or not fs.rename(temp, final):
            raise FileExistsError(f"snapshot {snapshot.number} is there already: another writer came first")
        return snapshot

    # -- rows ------------------------------------------------------------------

    def read(self, snapshot: Snapshot | None = None) -> DataFrame:
        """The fact columns and the month column of one snapshot (default: the last one)."""
        snapshot = snapshot or self.snapshot()
        if snapshot is None:
            return self.spark.createDataFrame([], schemas.DAILY_SPINE).withColumn(MONTH_COL, F.lit(0))
        name = f"retentia_fact_{uuid.uuid5(uuid.NAMESPACE_URL, f'{self.base}/{snapshot.number}').hex}"
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.DAILY_SPINE)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}, {MONTH_COL} INT) USING parquet PARTITIONED BY ({MONTH_COL}) "
                f"CLUSTERED BY (account_id) SORTED BY (account_id, observation_date) INTO {snapshot.buckets} BUCKETS LOCATION '{self.base}/table-{snapshot.number}'"
            )
            if snapshot.months:
                parts = " ".join(f"PARTITION ({MONTH_COL}={m}) LOCATION '{p}'" for m, p in sorted(snapshot.months.items()))
                self.spark.sql(f"ALTER TABLE {name} ADD {parts}")
        return self.spark.table(name).select(*schemas.SPINE_COLUMNS, MONTH_COL)

    def _write(self, rows: DataFrame, buckets: int, placed: bool) -> tuple[str, dict[int, dict[str, int]]]:
        """Writes rows as month folders; the folder, and per written month its rows and NULLs, by one scan of the new files."""
        path = f"{self.base}/data/{uuid.uuid4().hex}"
        table = f"retentia_stage_{uuid.uuid4().hex}"
        dated = rows.select(*schemas.SPINE_COLUMNS).withColumn(MONTH_COL, month_key("observation_date"))
        dated = dated if placed else dated.repartition(buckets, "account_id").sortWithinPartitions("account_id", "observation_date")
        write_buckets(dated, buckets, path, table)
        counts = self.spark.table(table).groupBy(MONTH_COL).agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in schemas.SPINE_COLUMNS])
        checks = {r[MONTH_COL]: {k: v for k, v in r.asDict().items() if k != MONTH_COL} for r in counts.collect()}
        self.spark.sql(f"DROP TABLE {table}")  # external: its files stay
        return path, checks

    def stage(self, recomputed: DataFrame, windows: Sequence[Window], placed: bool = False, buckets: int | None = None) -> Snapshot:
        """The next snapshot, written but not published: the windows' rows replaced by ``recomputed``'s.

        Months that lie in the windows whole aren't read.  ``placed``: the rows come hash-partitioned by account into the store's
        bucket count (see ``buckets``; of a new store it is the given one, where there is one), each part by account and day; months touched in part bring their other rows by a shuffle all the same."""
        last = self.snapshot()
        buckets = last.buckets if last else buckets or self.buckets()
        months = touched_months(windows)
        rows = recomputed.where(_inside(windows)).select(*schemas.SPINE_COLUMNS)
        whole = whole_months(windows)
        old = [m for m in months if last and m in last.months and m not in whole]
        if old:
            kept = self.read(last).where(F.col(MONTH_COL).isin(old) & ~_inside(windows)).drop(MONTH_COL)
            rows, placed = rows.unionByName(kept), False
        path, checks = self._write(rows, buckets, placed)
        now = {m: p for m, p in (last.months if last else {}).items() if m not in months}
        known = {m: c for m, c in (last.checks if last else {}).items() if m not in months}
        now.update({m: f"{path}/{MONTH_COL}={m}" for m in checks})
        return Snapshot((last.number if last else 0) + 1, buckets, now, known | checks)

    def refresh(self, recomputed: DataFrame, windows: Sequence[Window], placed: bool = False, buckets: int | None = None) -> Snapshot:
        """Replaces the windows' rows and publishes; reads and writes the touched months alone."""
        return self.publish(self.stage(recomputed, windows, placed, buckets))

    def buckets(self, rows: int | None = None) -> int:
        last = self.snapshot()
        return last.buckets if last else default_buckets(self.spark, rows)

    # -- what was counted while writing -----------------------------------------

    def row_count(self) -> int:
        last = self.snapshot()
        return sum(c["rows"] for c in last.checks.values()) if last else 0

    def null_counts(self) -> dict[str, int]:
        """NULLs of every column, from the snapshot alone."""
        last = self.snapshot()
        return {c: sum(m[c] for m in last.checks.values()) if last else 0 for c in schemas.SPINE_COLUMNS}
