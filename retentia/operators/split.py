"""Out-of-cohort split: order accounts by first-seen date (account_id breaks
ties), the oldest 60 % train, the next 20 % validate, the newest 20 % test.
Boundaries are ``floor(n * 0.6)`` and ``floor(n * 0.8)`` positions.

An exact global position without a one-partition window: the rows are
range-partitioned and sorted by the key (``orderBy``), each row gets
``monotonically_increasing_id`` whose upper bits are its partition index
and lower bits its position inside the partition; per-partition counts
(one row per partition) give each partition's starting offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from retentia import config
from retentia.functions.expressions import half_up_ratio
from retentia.session import shared_dir

_PART_BITS = 33  # monotonically_increasing_id = partition index << 33 | row in partition


def global_position(df: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``position`` (0-based rank in ``order``, which must be a total order)."""
    s = df.orderBy(*order).select(
        "*",
        F.spark_partition_id().alias("_pid"),
        F.monotonically_increasing_id().alias("_mid"),
    )
    s = s.withColumn("_local", F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), _PART_BITS))
    # Range boundaries are sampled; a reliable checkpoint (shared folder) makes
    # the count branch and the row branch read the very same partitions.
    shared_dir(df.sparkSession)
    s = s.checkpoint(eager=True)
    # One row per partition; the window runs over that small table only.
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid", (F.sum("_n").over(W.orderBy("_pid").rowsBetween(W.unboundedPreceding, -1))).alias("_off")
    ).fillna(0, ["_off"])
    s = s.join(F.broadcast(offsets), "_pid")
    return s.withColumn("position", F.col("_off") + F.col("_local")).drop("_pid", "_mid", "_local", "_off")


def cohort_split(
    features: DataFrame, train: float = config.SPLIT_TRAIN, valid_end: float = config.SPLIT_VALID_END
) -> DataFrame:
    """Adds ``position`` and ``split`` in {'train', 'valid', 'test'}."""
    n = features.select(F.count(F.lit(1))).scalar()
    p = global_position(features, ["first_seen_date", "account_id"])
    train_end = F.floor(n.cast("double") * F.lit(train))
    v_end = F.floor(n.cast("double") * F.lit(valid_end))
    return p.withColumn(
        "split",
        F.when(F.col("position") < train_end, "train").when(F.col("position") < v_end, "valid").otherwise("test"),
    )


def split_summary(split_df: DataFrame) -> DataFrame:
    """Accounts and churn rate per split."""
    return split_df.groupBy("split").agg(
        F.count(F.lit(1)).alias("accounts"),
        half_up_ratio(F.sum("target_churn_flag"), F.count(F.lit(1))).alias("churn_rate"),
    )
