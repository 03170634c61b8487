"""Churn classifier on the per-account features.

Protocol of the original notebook:
* inputs: the 17 model features (4 categorical, 13 numeric), means unrounded;
* out-of-cohort split by first-seen date (``retentia.operators.split``);
* ``fit_boosted``: histogram boosting (``boosting``), logistic loss, learning
  rate 0.05, up to 200 trees of depth 5 and 20 leaves, at least 10 rows per
  leaf; balanced class weights ``n / (2 * n_class)`` of the training rows;
  missing values as they are; stops 50 trees after the best validation AUC;
* held-out test rows: ROC-AUC plus precision / recall / F1 / support per
  class at threshold 0.5, accuracy, macro and weighted averages;
* scoring: accounts with label 0, probability of class 1.

``fit_gbt`` (Spark ML's boosted trees) and ``fit_logistic`` are alternatives on
``model_frame``.  Spark's GBT has no leaf-count cap and no native missing
values: there the two nullable means are filled with -1 (outside their
0..+inf / 1..5 ranges, so a tree can isolate "missing"), categoricals are
indexed alphabetically with an extra bucket for unseen values.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentia.functions.expressions import half_up_ratio
from retentia.operators import boosting, ranking
from retentia.operators.boosting import BoostedTrees, BoostParams
from retentia.operators.features import CATEGORICAL, MODEL_FEATURES, unrounded

NUMERIC_INPUTS = tuple(c for c in MODEL_FEATURES if c not in CATEGORICAL)
NULLABLE_INPUTS = ("avg_resolution_time", "avg_csat_score")
MISSING = -1.0


@dataclass(frozen=True)
class GbtParams:
    max_iter: int = 200
    max_depth: int = 5
    step_size: float = 0.05
    min_instances_per_node: int = 10
    seed: int = 42
    max_bins: int = 32  # at least; raised to the levels of the widest categorical
    # Spark stops when validation loss improves by less than this (relative);
    # 0 keeps adding trees while it improves at all.
    validation_tol: float = 0.0


def model_frame(features: DataFrame) -> DataFrame:
    """Numeric inputs as double with missing -> -1, label as double."""
    cols = [F.col(c) for c in ("account_id",) + CATEGORICAL]
    for c in NUMERIC_INPUTS:
        x = F.col(c).cast("double")
        cols.append((F.coalesce(x, F.lit(MISSING)) if c in NULLABLE_INPUTS else x).alias(c))
    return features.select(*cols, F.col("target_churn_flag").cast("double").alias("label"))


def boosted_frame(features: DataFrame) -> DataFrame:
    """Inputs with unrounded means (where the features carry them) and missing values, label, and what else a score needs."""
    keep = [c for c in ("split", "first_seen_date") if c in features.columns]
    return unrounded(features).select("account_id", *MODEL_FEATURES, F.col("target_churn_flag").cast("double").alias("label"), *keep)


def fit_boosted(split_df: DataFrame, params: BoostParams = BoostParams()) -> BoostedTrees:
    """``split_df`` = boosted_frame(features) with its ``split`` column."""
    return boosting.fit(split_df, list(NUMERIC_INPUTS), list(CATEGORICAL), params)


def _stages(classifier) -> list:
    idx = StringIndexer(
        inputCols=list(CATEGORICAL),
        outputCols=[f"{c}_idx" for c in CATEGORICAL],
        handleInvalid="keep",
        stringOrderType="alphabetAsc",
    )
    asm = VectorAssembler(
        inputCols=[f"{c}_idx" for c in CATEGORICAL] + list(NUMERIC_INPUTS), outputCol="features", handleInvalid="keep"
    )
    return [idx, asm, classifier]


def fit_gbt(split_df: DataFrame, params: GbtParams = GbtParams()) -> PipelineModel:
    """``split_df`` = model_frame(features) with a ``split`` column."""
    fit_rows = split_df.where(F.col("split").isin("train", "valid")).withColumn(
        "is_valid", F.col("split") == "valid"
    )
    # Balanced weights from the training rows only; validation rows get the same class weights.
    train = fit_rows.where(~F.col("is_valid"))
    n = train.select(F.count(F.lit(1))).scalar()
    n_pos = train.select(F.sum("label")).scalar()
    # Both classes present: n / (2 * n_class); otherwise unweighted (1.0).
    both = (n_pos > 0) & (n_pos < n)
    fit_rows = fit_rows.withColumn(
        "weight",
        F.when(~both, F.lit(1.0))
        .when(F.col("label") == 1.0, n / (F.lit(2.0) * n_pos))
        .otherwise(n / (F.lit(2.0) * (n - n_pos))),
    )
    idx, asm = _stages(None)[:2]
    idx = idx.fit(fit_rows)
    widest = max(len(levels) for levels in idx.labelsArray) + 1  # and the bucket of unseen values
    gbt = GBTClassifier(
        labelCol="label",
        featuresCol="features",
        weightCol="weight",
        validationIndicatorCol="is_valid",
        maxIter=params.max_iter,
        maxDepth=params.max_depth,
        stepSize=params.step_size,
        minInstancesPerNode=params.min_instances_per_node,
        seed=params.seed,
        maxBins=max(params.max_bins, widest),
        validationTol=params.validation_tol,
        lossType="logistic",
        featureSubsetStrategy="all",
    )
    return Pipeline(stages=[idx, asm, gbt]).fit(fit_rows)


def fit_logistic(split_df: DataFrame, reg: float = 0.01) -> PipelineModel:
    """Linear alternative whose attributions are exact (``drivers.linear_drivers``
    with ``logistic_coefficients``): categoricals one-hot encoded (every level
    kept), numeric inputs as in ``model_frame``."""
    train = split_df.where(F.col("split") == "train")
    idx = StringIndexer(
        inputCols=list(CATEGORICAL),
        outputCols=[f"{c}_idx" for c in CATEGORICAL],
        handleInvalid="keep",
        stringOrderType="alphabetAsc",
    )
    ohe = OneHotEncoder(
        inputCols=[f"{c}_idx" for c in CATEGORICAL], outputCols=[f"{c}_ohe" for c in CATEGORICAL], dropLast=False,
        handleInvalid="keep",
    )
    asm = VectorAssembler(
        inputCols=[f"{c}_ohe" for c in CATEGORICAL] + list(NUMERIC_INPUTS), outputCol="features", handleInvalid="keep"
    )
    lr = LogisticRegression(labelCol="label", featuresCol="features", regParam=reg, maxIter=100)
    return Pipeline(stages=[idx, ohe, asm, lr]).fit(train)


def logistic_coefficients(
    pipeline: PipelineModel, sample: DataFrame
) -> tuple[float, dict[str, float], dict[str, dict[str, float]]]:
    """(intercept, numeric coefficients, per-level categorical coefficients) of
    a ``fit_logistic`` model, in the form ``drivers.linear_drivers`` takes.
    Positions come from the assembled vector's ML attribute names (read from
    the schema of ``pipeline.transform(sample.limit(0))``, no data)."""
    lr = pipeline.stages[-1]
    coef = lr.coefficients.toArray()
    meta = pipeline.transform(sample.limit(0)).schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in meta.values() for a in group}
    numeric: dict[str, float] = {}
    categorical: dict[str, dict[str, float]] = {c: {} for c in CATEGORICAL}
    for i, name in names.items():
        if name in NUMERIC_INPUTS:
            numeric[name] = float(coef[i])
            continue
        for c in CATEGORICAL:
            prefix = f"{c}_ohe_"
            if name.startswith(prefix):
                categorical[c][name[len(prefix):]] = float(coef[i])
    return float(lr.intercept), numeric, categorical


def predict(model: PipelineModel | BoostedTrees, rows: DataFrame) -> DataFrame:
    """Adds ``flight_risk_score`` = P(class 1) and ``prediction``."""
    if isinstance(model, BoostedTrees):
        return boosting.probability(model, rows).withColumn("prediction", (F.col("flight_risk_score") >= 0.5).cast("double"))
    out = model.transform(rows)
    return out.withColumn("flight_risk_score", vector_to_array("probability")[1])


def evaluate(model: PipelineModel | BoostedTrees, split_df: DataFrame) -> DataFrame:
    """Held-out report as rows (metric, class, value) on the 'test' split."""
    test = predict(model, split_df.where(F.col("split") == "test"))
    auc_value = ranking.auc(test.select(F.col("flight_risk_score").alias("score"), "label")).first()["roc_auc"]
    pred = (F.col("flight_risk_score") >= 0.5).cast("double")
    conf = test.groupBy().agg(
        F.sum(F.when((pred == 1) & (F.col("label") == 1), 1).otherwise(0)).alias("tp"),
        F.sum(F.when((pred == 1) & (F.col("label") == 0), 1).otherwise(0)).alias("fp"),
        F.sum(F.when((pred == 0) & (F.col("label") == 1), 1).otherwise(0)).alias("fn"),
        F.sum(F.when((pred == 0) & (F.col("label") == 0), 1).otherwise(0)).alias("tn"),
    )
    return classification_report(conf, auc_value)


def classification_report(conf: DataFrame, auc_value: float | None) -> DataFrame:
    """Per-class precision/recall/F1/support, accuracy, macro and weighted
    averages from one row of confusion counts (tp, fp, fn, tn)."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def prf(t, f_pos, f_neg):
        p = half_up_ratio(t, t + f_pos)
        r = half_up_ratio(t, t + f_neg)
        f1 = half_up_ratio(2 * t, 2 * t + f_pos + f_neg)
        return p, r, f1

    p1, r1, f1_1 = prf(tp, fp, fn)
    p0, r0, f1_0 = prf(tn, fn, fp)
    s1, s0 = tp + fn, tn + fp
    n = s1 + s0
    rows = [
        ("class_1", "precision", p1), ("class_1", "recall", r1), ("class_1", "f1", f1_1),
        ("class_1", "support", s1.cast("double")),
        ("class_0", "precision", p0), ("class_0", "recall", r0), ("class_0", "f1", f1_0),
        ("class_0", "support", s0.cast("double")),
        ("all", "accuracy", half_up_ratio(tp + tn, n)),
        ("macro_avg", "precision", F.round((F.coalesce(p0, F.lit(0.0)) + F.coalesce(p1, F.lit(0.0))) / 2, 4)),
        ("macro_avg", "recall", F.round((F.coalesce(r0, F.lit(0.0)) + F.coalesce(r1, F.lit(0.0))) / 2, 4)),
        ("macro_avg", "f1", F.round((F.coalesce(f1_0, F.lit(0.0)) + F.coalesce(f1_1, F.lit(0.0))) / 2, 4)),
        ("weighted_avg", "precision", F.round((F.coalesce(p0, F.lit(0.0)) * s0 + F.coalesce(p1, F.lit(0.0)) * s1) / n, 4)),
        ("weighted_avg", "recall", F.round((F.coalesce(r0, F.lit(0.0)) * s0 + F.coalesce(r1, F.lit(0.0)) * s1) / n, 4)),
        ("weighted_avg", "f1", F.round((F.coalesce(f1_0, F.lit(0.0)) * s0 + F.coalesce(f1_1, F.lit(0.0)) * s1) / n, 4)),
        ("all", "roc_auc", F.lit(None if auc_value is None else round(float(auc_value), 4)).cast("double")),
    ]
    arr = F.array(*[F.struct(F.lit(a).alias("scope"), F.lit(m).alias("metric"), v.cast("double").alias("value")) for a, m, v in rows])
    return conf.select(F.explode(arr).alias("r")).select("r.scope", "r.metric", "r.value")


def score_active(model: PipelineModel | BoostedTrees, features: DataFrame) -> DataFrame:
    """Accounts that never churned, with their churn probability."""
    frame = boosted_frame if isinstance(model, BoostedTrees) else model_frame
    return predict(model, frame(features.where(F.col("target_churn_flag") == 0)))


def save_models(model: PipelineModel | BoostedTrees, curve: DataFrame, base: str) -> dict[str, str]:
    """The fitted model (boosted trees as Parquet, a pipeline in Spark ML format) and the survival curve (Parquet)."""
    paths = {"classifier": f"{base}/classifier", "survival_curve": f"{base}/survival_curve"}
    if isinstance(model, BoostedTrees):
        boosting.save(curve.sparkSession, model, paths["classifier"])
    else:
        model.write().overwrite().save(paths["classifier"])
    curve.write.mode("overwrite").parquet(paths["survival_curve"])
    return paths


def load_classifier(path: str) -> PipelineModel:
    return PipelineModel.load(path)
