"""Area under the ROC curve by average ranks (Mann-Whitney), as one distributed plan.

Rows are first reduced to one row a distinct score (positives, negatives),
combined map-side, so ties cost nothing and a score that most rows share is one
row.  Distinct scores are range-partitioned and sorted; a running sum inside
each partition and one offset a partition (the negatives of all lower
partitions, a table of one row a partition) give the negatives below each
score.  A positive beats each of them, and half of those it ties with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from retentia.session import shared_dir


def ranked_scores(rows: DataFrame) -> DataFrame:
    """(score, pos, neg, neg_below) for each distinct score of (score, label); null scores rank below all others, null labels don't count."""
    by_score = rows.where("label IS NOT NULL").groupBy("score").agg(F.count(F.when(F.col("label") == 1, 1)).alias("pos"), F.count(F.when(F.col("label") == 0, 1)).alias("neg"))
    s = by_score.orderBy(F.asc_nulls_first("score")).select("*", F.spark_partition_id().alias("_pid"))
    # Range bounds are sampled: the checkpoint makes both branches read the same partitions.
    shared_dir(s.sparkSession)
    s = s.checkpoint(eager=True)
    per_part = s.groupBy("_pid").agg(F.sum("neg").alias("_n"))
    below = per_part.select("_pid", F.coalesce(F.sum("_n").over(W.orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    inside = F.coalesce(F.sum("neg").over(W.partitionBy("_pid").orderBy(F.asc_nulls_first("score")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return s.withColumn("_own", inside).join(F.broadcast(below), "_pid").select("score", "pos", "neg", (F.col("_off") + F.col("_own")).alias("neg_below"))


def auc(rows: DataFrame, digits: int = 6) -> DataFrame:
    """One row: positives, negatives, roc_auc (rounded; null where either class is missing)."""
    # Twice the wins, a whole number, so that the sum is exact.
    twice = (F.col("pos") * (2 * F.col("neg_below") + F.col("neg"))).cast("decimal(38,0)")
    t = ranked_scores(rows).agg(F.coalesce(F.sum("pos"), F.lit(0)).alias("positives"), F.coalesce(F.sum("neg"), F.lit(0)).alias("negatives"), F.sum(twice).alias("w"))
    pairs = F.col("positives").cast("double") * F.col("negatives")
    return t.select("positives", "negatives", F.when(pairs > 0, F.round(F.col("w").cast("double") / (2 * pairs), digits)).alias("roc_auc"))
