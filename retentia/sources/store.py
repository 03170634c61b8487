"""Sinks and table lifecycle: materialised fact table, idempotent window
refresh, CSV export, score files.

The fact table is Parquet partitioned by observation month.  A window
refresh never rewrites in place: rows outside the window are kept, the
recomputed window is added, and the result goes to a new version folder
whose path is returned (the caller swaps its pointer).  Dynamic partition
overwrite is not used on purpose - it leaves stale partitions behind when
a recomputed window has become empty.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retentia import schemas
from retentia.session import scratch_path

MONTH_COL = "obs_ym"  # partition column: year * 100 + month of observation_date (int)


def month_key(day) -> "F.Column":
    """Integer yyyymm of a date column - the partition value of its month."""
    d = F.col(day) if isinstance(day, str) else day
    return (F.year(d) * 100 + F.month(d)).cast("int")


def _with_month(spine: DataFrame) -> DataFrame:
    return spine.withColumn(MONTH_COL, month_key("observation_date"))


def write_fact(spine: DataFrame, path: str) -> str:
    """Plain month-partitioned Parquet.  Rows are spread by (month, account)
    so no task writes a whole month; each task's rows are sorted by
    account and date, which keeps row-group statistics tight for lookups."""
    (
        _with_month(spine)
        .repartition(MONTH_COL, "account_id")
        .sortWithinPartitions(MONTH_COL, "account_id", "observation_date")
        .write.mode("errorifexists")
        .partitionBy(MONTH_COL)
        .parquet(path)
    )
    return path


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """Fact columns plus the ``obs_ym`` partition column (used for pruning)."""
    return spark.read.parquet(path).select(*schemas.SPINE_COLUMNS, MONTH_COL)


NAMESPACES = ("retentia_raw", "retentia_dimensions", "retentia_features")


def ensure_namespaces(spark: SparkSession) -> None:
    """The three databases (raw, dimensions, features)."""
    for ns in NAMESPACES:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {ns}")


ROWS_PER_BUCKET = 4_000_000  # ~100-200 MB of Parquet per bucket across all months


def default_buckets(spark: SparkSession, rows: int | None = None) -> int:
    """Buckets of the fact table: ``spark.retentia.fact.buckets`` if set;
    else rows / ROWS_PER_BUCKET, at least the default parallelism (so
    per-account scans keep every core busy) and at most the shuffle
    partition count (size that to the cluster)."""
    n = spark.conf.get("spark.retentia.fact.buckets", None)
    if n:
        return int(n)
    cap = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if rows is None:
        return cap
    floor_ = min(cap, spark.sparkContext.defaultParallelism)
    return max(floor_, min(cap, -(-rows // ROWS_PER_BUCKET)))


def backfill(spark: SparkSession, raw, period, current_path: str | None = None, mode: str = "window", path: str | None = None) -> str:
    """Refresh all windows of the period as one new version; returns its
    path.  One spine job covers all windows (in window mode each keeps its own
    churn cut, in as-of-run mode all share the period's), and the table is
    written once, whatever their number."""
    from retentia.operators.spine import daily_spine

    return refresh_windows(spark, current_path, daily_spine(raw, period, mode), list(period.windows), path)


OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
MONTH_FILES = 128  # a task's month files that are open at once; beyond them Spark sorts its rows by month


def write_buckets(rows: DataFrame, buckets: int, path: str, table: str) -> None:
    """Writes rows, hash-partitioned by account into ``buckets`` parts, as month folders of buckets.

    A task has one bucket, a file a month: it keeps these files open and writes its rows in the order they come in, without a
    sort of the panel."""
    before = rows.sparkSession.conf.get(OPEN_FILES, None)
    rows.sparkSession.conf.set(OPEN_FILES, MONTH_FILES)
    try:
        rows.write.mode("errorifexists").partitionBy(MONTH_COL).bucketBy(buckets, "account_id").option("path", path).saveAsTable(table)
    finally:
        rows.sparkSession.conf.unset(OPEN_FILES) if before is None else rows.sparkSession.conf.set(OPEN_FILES, before)


def materialize(
    spark: SparkSession, spine: DataFrame, name: str = "fact_daily_spine", buckets: int | None = None, rows: int | None = None, placed: bool = False
) -> DataFrame:
    """Write the fact table as an external table in a fresh folder under the
    shared checkpoint folder, partitioned by month and bucketed by account.

    * lineage is cut - later queries scan Parquet, not the spine plan;
    * month partitions are pruned by date filters (also at run time);
    * per-account operators (features, cohorts, survival, churned-account
      ARR) read the buckets already clustered by account_id and skip the
      shuffle.  Bucketing is skew-safe here: an account has at most one row
      per calendar day.

    ``placed``: the rows already come in ``buckets`` hash partitions by account (``daily_spine(partitions=buckets)``), so each task
    writes its bucket as it is, without a shuffle of the panel.
    """
    n = buckets or default_buckets(spark, rows)
    path = scratch_path(spark, name)
    table = "retentia_" + path.rsplit("/", 1)[-1].replace("-", "_")
    spread = _with_month(spine) if placed else _with_month(spine).repartition(n, "account_id").sortWithinPartitions("account_id", "observation_date")
    write_buckets(spread, n, path, table)
    return spark.table(table).select(*schemas.SPINE_COLUMNS, MONTH_COL)


def materialize_runs(spark: SparkSession, runs: DataFrame, buckets: int, name: str = "fact_runs") -> DataFrame:
    """Writes the panel's runs (``spine.spine_runs(partitions=buckets)``) as ``materialize`` writes its days, by month and bucket of
    accounts.  ``spine.spine_of_runs`` of what is read gives the daily fact table; a scan expands the months and columns that it takes."""
    path = scratch_path(spark, name)
    table = "retentia_" + path.rsplit("/", 1)[-1].replace("-", "_")
    write_buckets(runs.sortWithinPartitions("account_id", "first"), buckets, path, table)
    return spark.table(table)


def refresh_window(
    spark: SparkSession, current_path: str | None, recomputed: DataFrame, w_from: dt.date, w_to: dt.date
) -> str:
    """Replace rows with observation_date in [w_from, w_to] by ``recomputed``
    (restricted to that window); returns the path of the new version."""
    return refresh_windows(spark, current_path, recomputed, [(w_from, w_to)])


def refresh_windows(
    spark: SparkSession, current_path: str | None, recomputed: DataFrame, windows: list[tuple[dt.date, dt.date]], path: str | None = None
) -> str:
    """Replace the rows of several windows at once (one new version, at ``path`` or in the shared folder)."""
    def inside(c):
        cond = None
        for a, b in windows:
            x = c.between(F.lit(str(a)).cast("date"), F.lit(str(b)).cast("date"))
            cond = x if cond is None else cond | x
        return cond

    day = F.col("observation_date")
    new_rows = recomputed.where(inside(day))
    if current_path is None:
        combined = new_rows
    else:
        kept = read_fact(spark, current_path).drop(MONTH_COL).where(~inside(day))
        combined = kept.unionByName(new_rows)
    path = path or scratch_path(spark, "fact_daily_spine")
    write_fact(combined, path)
    return path


def export_spine_csv(spine: DataFrame, path: str) -> None:
    """Header first, rows ordered by account then date, every field quoted,
    CRLF line ends, NULL averages written as empty text.  The header is a row
    of its own that sorts before all others, and the global sort
    range-partitions the rows, so the part files one after another are one
    CSV with one header.  Only the first part has it: read the folder with
    ``read_spine_csv``, not with Spark's header option, which drops the first
    line of every part."""
    cols = schemas.SPINE_COLUMNS
    header = spine.sparkSession.range(1).select(F.lit(0).alias("_row"), *[F.lit(c).alias(c) for c in cols])
    rows = spine.select(F.lit(1).alias("_row"), *[F.col(c).cast("string").alias(c) for c in cols])
    (
        header.unionByName(rows)
        .orderBy("_row", "account_id", "observation_date")  # dates as text sort as dates
        .drop("_row")
        .write.mode("errorifexists")
        .option("header", False)
        .option("quoteAll", True)
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("lineSep", "\r\n")
        .csv(path)
    )


def read_spine_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read an exported spine back with the fact schema (no inference); the
    header is the only row whose first two fields are their columns' names."""
    names = schemas.SPINE_COLUMNS
    text = T.StructType([T.StructField(c, T.StringType()) for c in names])
    rows = spark.read.schema(text).option("header", False).option("lineSep", "\r\n").option("nullValue", "").csv(path)
    is_header = (F.col(names[0]) == names[0]) & (F.col(names[1]) == names[1])
    return rows.where(~F.coalesce(is_header, F.lit(False))).select(*[F.col(f.name).cast(f.dataType) for f in schemas.DAILY_SPINE])
