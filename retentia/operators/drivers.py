"""Per-account risk drivers: the two features that push the churn score up
the most (by signed contribution, not magnitude), labelled
"1. Feature One | 2. Feature Two".

Two matched model/attribution pairs, never mixed:

* ``linear_drivers``: for a linear score, contribution = coefficient x value
  (against a zero baseline; categorical levels carry their own coefficient).
  Exact and additive, written as column expressions only.
* ``boosted_drivers`` and ``tree_drivers``: for boosted trees (of ``boosting``,
  or Spark ML's), Shapley values by the tree path algorithm with the training
  rows' node covers (``shapley``); a row's values add up to its margin less
  the base value.  Spark ML's trees come from the saved model's node table, whose size is bounded by the training parameters
  (trees x 2^(depth+1) nodes); they are shipped with the task closure and
  rows are handled in Arrow batches with numpy (``mapInPandas``).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia.operators import boosting, shapley
from retentia.operators.boosting import BoostedTrees
from retentia.operators.features import CATEGORICAL, MODEL_FEATURES
from retentia.operators.shapley import Tree
from retentia.session import scratch_path, ship_by_value


def label(name: str) -> str:
    """'net_mrr_delta' -> 'Net Mrr Delta'."""
    return name.replace("_", " ").title()


def driver_text(first: Column, second: Column) -> Column:
    return F.format_string("1. %s | 2. %s", first, second)


# Coefficients of the deterministic linear score used by the
# registered linear-driver and portfolio queries (a parameter, not fitted).
LINEAR_INTERCEPT = -1.0
LINEAR_NUMERIC = {
    "active_mrr_run_rate": -0.0002,
    "net_mrr_delta": -0.001,
    "downgrade_flag": 0.8,
    "auto_renew_flag": -0.6,
    "is_trial": 0.4,
    "daily_time_in_app": -0.0005,
    "daily_friction_events": 0.05,
    "beta_interactions": -0.02,
    "ticket_volume": 0.15,
    "avg_resolution_time": 0.01,
    "avg_csat_score": -0.3,
    "had_support_contact": 0.2,
    "app_usage_momentum": -0.5,
}
LINEAR_CATEGORICAL = {
    "baseline_tier": {"Basic": 0.2, "Pro": 0.0, "Enterprise": -0.2},
    "billing_frequency": {"monthly": 0.3, "annual": -0.3, "none": 0.5},
}


def linear_contributions(
    features: DataFrame,
    numeric: Mapping[str, float] = LINEAR_NUMERIC,
    categorical: Mapping[str, Mapping[str, float]] = LINEAR_CATEGORICAL,
) -> list[tuple[str, Column]]:
    """(feature, contribution column) in MODEL_FEATURES order; a NULL value
    contributes 0 (it sits on the baseline)."""
    out = []
    for c in MODEL_FEATURES:
        if c in numeric:
            # "+ 0.0" turns -0.0 into 0.0 so equal contributions tie on every engine.
            out.append((c, F.coalesce(F.col(c).cast("double") * F.lit(float(numeric[c])), F.lit(0.0)) + F.lit(0.0)))
        elif c in categorical:
            e = F.lit(0.0)
            for level, w in categorical[c].items():
                e = F.when(F.col(c) == level, F.lit(float(w))).otherwise(e)
            out.append((c, e))
        else:
            out.append((c, F.lit(0.0)))
    return out


def linear_score(features: DataFrame, intercept: float = LINEAR_INTERCEPT, **kw) -> Column:
    z = F.lit(float(intercept))
    for _, e in linear_contributions(features, **kw):
        z = z + e
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def top_two(contribs: list[tuple[str, Column]]) -> Column:
    """Label text of the two largest signed contributions (feature order breaks ties)."""
    arr = F.array(
        *[F.struct(e.alias("c"), F.lit(-i).alias("neg_pos"), F.lit(label(n)).alias("name")) for i, (n, e) in enumerate(contribs)]
    )
    s = F.sort_array(arr, asc=False)
    return driver_text(s[0]["name"], s[1]["name"])


def linear_drivers(
    features: DataFrame, keep: tuple[str, ...] = (), intercept: float = LINEAR_INTERCEPT, **kw
) -> DataFrame:
    """(account_id, flight_risk_score, primary_risk_drivers, *keep) for the
    linear score - one projection, no join back to the features."""
    contribs = linear_contributions(features, **kw)
    return features.select(
        "account_id",
        F.round(linear_score(features, intercept, **kw), 6).alias("flight_risk_score"),
        top_two(contribs).alias("primary_risk_drivers"),
        *keep,
    )


# --------------------------------------------------------------------------
# boosted trees
# --------------------------------------------------------------------------


def tree_table(spark: SparkSession, pipeline: PipelineModel) -> dict:
    """The fitted trees as flat numpy arrays (saved model -> Parquet node table)."""
    gbt = pipeline.stages[-1]
    path = scratch_path(spark, "gbt-model")
    gbt.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID",
        F.col("nodeData.id").alias("id"),
        F.col("nodeData.prediction").alias("prediction"),
        F.col("nodeData.rawCount").alias("cover"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.col("nodeData.split.leftCategoriesOrThreshold").alias("cats"),
        F.col("nodeData.split.numCategories").alias("num_categories"),
    )
    # treesMetadata rows are (treeID, metadata json, weight) tuples.
    meta = spark.read.parquet(f"{path}/treesMetadata")
    weights = meta.select(F.col(meta.columns[0]).alias("treeID"), F.col(meta.columns[-1]).alias("weights"))
    # Bounded by maxIter * (2^(maxDepth+1) - 1) rows: safe to bring to the driver.
    nd = nodes.toPandas().sort_values(["treeID", "id"])
    wd = weights.toPandas().set_index("treeID")["weights"].to_dict()
    # As many codes as the widest categorical split has.
    width = max(1, int(nd["num_categories"].max()))
    trees = []
    for tid, g in nd.groupby("treeID"):
        n = int(g["id"].max()) + 1
        pred, cover = np.zeros(n), np.zeros(n)
        left = -np.ones(n, dtype=np.int64)
        right = -np.ones(n, dtype=np.int64)
        feat = -np.ones(n, dtype=np.int64)
        thr = np.zeros(n)
        is_cat = np.zeros(n, dtype=bool)
        cat_left = np.zeros((n, width), dtype=bool)
        for r in g.itertuples(index=False):
            i = int(r.id)
            pred[i], left[i], right[i], cover[i] = r.prediction, r.left, r.right, r.cover
            if r.left >= 0:
                feat[i] = r.feature
                if r.num_categories is not None and r.num_categories > 0:
                    is_cat[i] = True
                    cat_left[i, [int(v) for v in r.cats]] = True
                else:
                    thr[i] = r.cats[0]
        trees.append(Tree(float(wd[tid]), pred, left, right, feat, thr, is_cat, cover, cat_left))
    return {"trees": trees, "n_features": len(MODEL_FEATURES)}


def tree_drivers(spark: SparkSession, pipeline: PipelineModel, scored: DataFrame) -> DataFrame:
    """(account_id, primary_risk_drivers) for rows of ``pipeline.transform``
    output (needs ``account_id`` and ``features``)."""
    ship_by_value(shapley)
    table = tree_table(spark, pipeline)
    labels = [label(n) for n in MODEL_FEATURES]
    rows = scored.select("account_id", vector_to_array("features").alias("x"))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ready = shapley.prepared(table["trees"])
        for pdf in batches:
            if pdf.empty:
                continue
            x = np.vstack(pdf["x"].to_numpy()).astype(float)
            c = shapley.shapley_values(table["trees"], x, table["n_features"], ready)
            # Largest signed contribution first; feature order breaks ties.
            order = np.lexsort((np.tile(np.arange(c.shape[1]), (c.shape[0], 1)), -c), axis=1)
            text = [f"1. {labels[o[0]]} | 2. {labels[o[1]]}" for o in order]
            yield pd.DataFrame({"account_id": pdf["account_id"], "primary_risk_drivers": text})

    return rows.mapInPandas(walk, "account_id string, primary_risk_drivers string")


def boosted_drivers(model: BoostedTrees, scored: DataFrame) -> DataFrame:
    """(account_id, primary_risk_drivers) of rows that carry the model's inputs; feature order breaks ties."""
    valued = boosting.attributions(model, scored, "_values")
    return valued.select("account_id", top_two([(c, F.get("_values", F.lit(model.inputs.index(c)))) for c in MODEL_FEATURES]).alias("primary_risk_drivers"))


# A small stored tree (not fitted) for the registered Shapley query. Splits are
# (feature, threshold, left, right), left if value <= threshold; leaves are values; each node has its cover.
STORED_FEATURES = ("daily_friction_events", "active_mrr_run_rate", "app_usage_momentum")
STORED_NODES = (
    (0, ("daily_friction_events", 3.0, 1, 2), 100),
    (1, ("active_mrr_run_rate", 900.0, 3, 4), 60),
    (2, ("app_usage_momentum", 1.0, 5, 6), 40),
    (3, ("daily_friction_events", 1.0, 7, 8), 25),
    (4, -0.8, 35),
    (5, 1.5, 30),
    (6, 0.25, 10),
    (7, -0.25, 10),
    (8, 0.5, 15),
)


def stored_tree() -> Tree:
    n = len(STORED_NODES)
    value, threshold, cover = np.zeros(n), np.zeros(n), np.zeros(n)
    left, right, feature = (-np.ones(n, np.int64) for _ in range(3))
    for node, what, rows in STORED_NODES:
        cover[node] = rows
        if isinstance(what, tuple):
            name, threshold[node], left[node], right[node] = what
            feature[node] = STORED_FEATURES.index(name)
        else:
            value[node] = what
    return Tree(1.0, value, left, right, feature, threshold, np.zeros(n, bool), cover, np.zeros((n, 1), bool))


def stored_tree_values(features: DataFrame) -> DataFrame:
    """(account_id, base_value, margin, one column a feature): the stored tree's Shapley values of each account."""
    ship_by_value(shapley)
    trees = [stored_tree()]
    base = shapley.base_value(trees)
    names = [f"shap_{c}" for c in STORED_FEATURES]
    rows = features.select("account_id", F.array(*[F.col(c).cast("double") for c in STORED_FEATURES]).alias("x"))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not pdf.empty:
                c = shapley.shapley_values(trees, np.vstack(pdf["x"].to_numpy()).astype(float), len(names))
                yield pd.DataFrame({"account_id": pdf["account_id"], "base_value": base, "margin": base + c.sum(axis=1), **dict(zip(names, c.T))})

    out = rows.mapInPandas(walk, "account_id string, base_value double, margin double, " + ", ".join(f"{n} double" for n in names))
    return out.select("account_id", *[F.round(c, 6).alias(c) for c in out.columns[1:]])
