"""A month rollup beside the fact store: mergeable partial results, one slice a month, that the dashboard's sheets read alone.

Two kinds of slices, both exact:

* ``days``: a row per day and tier with the sums and counts of the panel's
  sheets.  An account has one row a day, so counts of rows are counts of
  accounts, and everything adds up over days, months and tiers.
* ``members``: a row per account with its last day in the month.  The first
  month of an account is its cohort; an account whose last day is the month's
  last observed one is there at the month's end.

The fact store never changes a written folder, so slices belong to data
folders: a refresh writes new folders for the months it touches, and only their
slices are built; all other months keep theirs, and older snapshots keep
reading their own.  Both kinds of a folder are published by one rename; what a
crash leaves unpublished is built again by the next update.

Sheets give the rows of ``plans.dashboard`` on the panel itself.  An empty
store gives empty slices, so single-row sheets are one row of nulls, as there;
a null tier is a tier of its own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from retentia import config, schemas
from retentia.functions.expressions import cents, half_up_ratio, money_double, month_bucket, sign_label
from retentia.plans import dashboard as dash
from retentia.plans.dashboard import DATE, MRR, YM
from retentia.sources.manifest import FactStore, Snapshot

_SUM = T.DecimalType(20, 2)
_FIELDS = {
    "days": [(DATE, T.DateType()), ("baseline_tier", T.StringType()), ("mrr", _SUM), ("paying", T.LongType()), ("delta", _SUM),
             ("app_secs", T.LongType()), ("rows", T.LongType()), ("churned_mrr", _SUM), ("churn_rows", T.LongType()),
             ("risk_mrr", _SUM), ("risk_accounts", T.LongType())],
    "members": [("account_id", T.StringType()), ("last_day", T.DateType())],
}
SCHEMAS = {k: T.StructType([T.StructField(YM, T.IntegerType()), *[T.StructField(*f) for f in v]]) for k, v in _FIELDS.items()}
_PANEL = T.StructType([*schemas.DAILY_SPINE, T.StructField(YM, T.IntegerType())])


def day_sums(panel: DataFrame) -> DataFrame:
    """The ``days`` rows of panel rows; combined map-side, so a day of any number of accounts is one row a tier and task."""
    risky = (F.col("daily_friction_events") > config.AT_RISK_FRICTION) | (F.col("avg_csat_score") < config.AT_RISK_CSAT)
    churn = F.col("target_churn_flag") == 1
    zero = F.lit(0).cast("decimal(10,2)")
    return panel.groupBy(YM, DATE, "baseline_tier").agg(
        F.sum(MRR).alias("mrr"),
        F.count(F.when(F.col(MRR) > 0, 1)).alias("paying"),
        F.sum("net_mrr_delta").alias("delta"),
        F.sum("daily_time_in_app").alias("app_secs"),
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.when(churn, F.col(MRR)).otherwise(zero)).alias("churned_mrr"),
        F.count(F.when(churn, 1)).alias("churn_rows"),
        F.sum(F.when(risky, F.col(MRR)).otherwise(zero)).alias("risk_mrr"),
        F.count(F.when(risky, 1)).alias("risk_accounts"),
    )


def month_members(panel: DataFrame) -> DataFrame:
    """The ``members`` rows of panel rows."""
    return panel.groupBy(YM, "account_id").agg(F.max(DATE).alias("last_day"))


class MonthRollup:
    """Slices of a fact store's months, kept under the store's own folder."""

    def __init__(self, store: FactStore):
        self.store, self.spark, self.base = store, store.spark, f"{store.base}/rollup"

    def _exists(self, path: str) -> bool:
        p, fs = self.store._path(path)
        return fs.exists(p)

    @staticmethod
    def _folder(month_path: str) -> str:
        """Name of the data folder that holds a month."""
        return month_path.rstrip("/").split("/")[-2]

    def update(self, snapshot: Snapshot | None = None) -> list[str]:
        """Builds the slices that a snapshot (default: the last one) still lacks; the data folders that were read for it."""
        snapshot = snapshot or self.store.snapshot()
        folders = sorted({self._folder(p) for p in snapshot.months.values()}) if snapshot else []
        missing = [f for f in folders if not self._exists(f"{self.base}/{f}")]
        for folder in missing:
            panel = self.spark.read.schema(_PANEL).parquet(f"{self.store.base}/data/{folder}")
            attempt = f"{self.base}/tries/{uuid.uuid4().hex}"
            for kind, rows in (("days", day_sums(panel)), ("members", month_members(panel))):
                rows.select(*SCHEMAS[kind].fieldNames(), F.col(YM).alias("slice")).write.partitionBy("slice").parquet(f"{attempt}/{kind}")
            done, fs = self.store._path(f"{self.base}/{folder}")
            if not fs.exists(done) and not fs.rename(self.store._path(attempt)[0], done):
                raise OSError(f"can't publish {done}")
        return missing

    def read(self, kind: str, snapshot: Snapshot | None = None) -> DataFrame:
        """``days`` or ``members`` of a snapshot's months, missing slices built first."""
        snapshot = snapshot or self.store.snapshot()
        self.update(snapshot)
        paths = [f"{self.base}/{self._folder(p)}/{kind}/slice={m}" for m, p in sorted(snapshot.months.items())] if snapshot else []
        return self.spark.read.schema(SCHEMAS[kind]).parquet(*paths) if paths else self.spark.createDataFrame([], SCHEMAS[kind])


# -- sheets: from ``days`` --------------------------------------------------------


def total_arr(days: DataFrame) -> DataFrame:
    """G1."""
    return dash.on_latest(days).agg(F.max(DATE).alias("latest_date"), money_double(F.sum("mrr") * 12).alias("total_arr"))


def arpa(days: DataFrame) -> DataFrame:
    """G2."""
    g = dash.on_latest(days).agg((F.sum("mrr") * 12).alias("arr"), F.coalesce(F.sum("paying"), F.lit(0)).alias("paying_accounts"))
    return g.select(
        money_double("arr").alias("current_arr"),
        "paying_accounts",
        half_up_ratio(cents("arr"), F.col("paying_accounts") * 100).alias("arpa"),
    )


def velocity_30d(days: DataFrame, trailing: int = config.TRAILING_SHORT_DAYS) -> DataFrame:
    """G3."""
    return dash.since(days, trailing).agg(money_double(F.sum("delta")).alias("net_mrr_velocity"))


def app_minutes_30d(days: DataFrame, trailing: int = config.TRAILING_SHORT_DAYS) -> DataFrame:
    """G4."""
    g = dash.since(days, trailing).agg(F.sum("app_secs").alias("secs"), F.sum("rows").alias("n"))
    return g.select(half_up_ratio("secs", F.col("n") * 60).alias("daily_app_minutes"))


def mrr_trajectory(days: DataFrame) -> DataFrame:
    """G5."""
    g = dash.month_end_rows(days).groupBy("obs_month").agg(F.sum("mrr").alias("mrr"))
    return g.select("obs_month", money_double("mrr").alias("snapshot_mrr"), money_double(F.col("mrr") * 12).alias("arr_run_rate")).orderBy("obs_month")


def velocity_by_month(days: DataFrame, tiers: list[str] | None = None, months: list[str] | None = None) -> DataFrame:
    """G6, also after selections of tiers and months."""
    g = dash.cross_filter(days, months=months, tiers=tiers).groupBy(month_bucket(DATE).alias("obs_month")).agg(F.sum("delta").alias("d"))
    return g.select("obs_month", money_double("d").alias("net_mrr_delta"), sign_label("d").alias("velocity_label")).orderBy("obs_month")


def at_risk_arr(days: DataFrame) -> DataFrame:
    """G-n."""
    g = dash.month_end_rows(days).groupBy("obs_month").agg(F.sum("risk_mrr").alias("mrr"), F.sum("risk_accounts").alias("at_risk_accounts"))
    return g.select("obs_month", money_double(F.col("mrr") * 12).alias("at_risk_arr"), "at_risk_accounts")


def churned_arr_by_tier(days: DataFrame, trailing: int = config.TRAILING_LONG_DAYS) -> DataFrame:
    """G7."""
    g = dash.since(days, trailing).groupBy("baseline_tier").agg((F.sum("churned_mrr") * 12).alias("arr"))
    total = F.sum("arr").over(W.partitionBy())  # over <= number of tiers rows
    return g.select(
        "baseline_tier",
        money_double("arr").alias("churned_arr_90d"),
        money_double(total).alias("total_churned_arr_90d"),
        half_up_ratio(cents("arr") * 100, cents(total)).alias("pct_of_total"),
    ).orderBy(F.desc("churned_arr_90d"), "baseline_tier")


def recognized_churned_arr(days: DataFrame) -> DataFrame:
    """G-i: tiers with a churn row."""
    g = days.where(F.col("churn_rows") > 0).groupBy("baseline_tier")
    return g.agg(money_double(F.sum("churned_mrr") * 12).alias("recognized_churned_arr"), F.sum("churn_rows").alias("churn_rows"))


# -- sheets: from ``members`` -----------------------------------------------------


def cohort_retention(members: DataFrame, max_months: int = config.COHORT_MAX_MONTHS) -> DataFrame:
    """One row an account, then one a cell; a month's last day is the last of its members' last days."""
    ends = members.groupBy(YM).agg(F.max("last_day").alias("month_end"))  # <= months in the calendar range
    there = F.when(F.col("last_day") == F.col("month_end"), F.col(YM))
    accounts = members.join(F.broadcast(ends), YM).groupBy("account_id").agg(F.min(YM).alias("first"), F.collect_set(there).alias("months"))
    # Place -1 counts the cohort, all other places its accounts that many months on.
    place = lambda m: F.floor(m / 100) * 12 + m % 100 - (F.floor(F.col("first") / 100) * 12 + F.col("first") % 100)
    cells = accounts.select("first", F.explode(F.array_append(F.transform("months", place), F.lit(-1).cast("bigint"))).alias("place"))
    n = cells.where(F.col("place") <= max_months).groupBy("first", "place").agg(F.count(F.lit(1)).alias("n"))
    size = F.max(F.when(F.col("place") == -1, F.col("n"))).over(W.partitionBy("first"))
    g = n.withColumn("cohort_size", size).where(F.col("place") >= 0)
    return g.select(
        F.make_date(F.floor(F.col("first") / 100).cast("int"), F.col("first") % 100, F.lit(1)).alias("cohort_month"),
        F.col("place").cast("int").alias("months_since"),
        F.col("n").alias("retained_accounts"),
        "cohort_size",
        half_up_ratio("n", "cohort_size").alias("retention_pct"),
    ).orderBy("cohort_month", "months_since")


#: Sheet -> (kind of slices it reads, function of them).
SHEETS = {
    **{f.__name__: ("days", f) for f in (total_arr, arpa, velocity_30d, app_minutes_30d, mrr_trajectory, velocity_by_month, at_risk_arr, churned_arr_by_tier, recognized_churned_arr)},
    "cohort_retention": ("members", cohort_retention),
}


def sheets(rollup: MonthRollup, snapshot: Snapshot | None = None) -> dict[str, DataFrame]:
    """All sheets that the rollup answers, of one snapshot."""
    snapshot = snapshot or rollup.store.snapshot()
    slices = {kind: rollup.read(kind, snapshot) for kind in SCHEMAS}
    return {name: f(slices[kind]) for name, (kind, f) in SHEETS.items()}
