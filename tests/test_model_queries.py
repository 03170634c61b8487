"""Model-based queries (row-count checked by the driver) run end to end."""

import os

import pytest

import __spark_entry__ as E
from retentia import config
from retentia.operators import shapley

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_model_report_scores_and_tree_drivers(spark):
    q = E.queries()
    report = {(r["scope"], r["metric"]): r["value"] for r in q["model_report"](spark, SF).collect()}
    assert ("all", "roc_auc") in report and ("class_1", "support") in report
    assert 0.0 <= report[("all", "accuracy")] <= 1.0
    scores = q["risk_scores"](spark, SF)
    assert tuple(scores.columns) == config.SCORE_COLUMNS
    rows = scores.collect()
    assert rows and all(0.0 <= r["flight_risk_score"] <= 1.0 and r["tenure_days"] >= 0 for r in rows)
    assert all(r["primary_risk_drivers"].startswith("1. ") and " | 2. " in r["primary_risk_drivers"] for r in rows)
    assert [r["flight_risk_score"] for r in rows] == sorted((r["flight_risk_score"] for r in rows), reverse=True)
    (kpis,) = q["portfolio_kpis_fitted"](spark, SF).collect()
    at_risk = [r for r in rows if r["flight_risk_score"] >= config.RISK_THRESHOLD]
    assert (kpis["accounts"], kpis["at_risk_accounts"]) == (len(rows), len(at_risk))
    assert abs(kpis["total_mrr"] - sum(r["active_mrr_run_rate"] for r in rows)) < 0.01
    assert abs(kpis["at_risk_mrr"] - sum(r["active_mrr_run_rate"] for r in at_risk)) < 0.01
    assert abs(kpis["avg_risk"] - sum(r["flight_risk_score"] for r in rows) / len(rows)) < 1e-4
    drivers = q["risk_drivers_tree"](spark, SF)
    assert drivers.count() == len(rows)


def test_tree_shapley_values_reconstruct_gbt_margin(spark):
    import numpy as np
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import vector_to_array

    from retentia.operators import drivers, model
    from retentia.operators.features import feature_window
    from retentia.plans.context import fact_table

    f = feature_window(fact_table(spark, SF))
    frame = model.model_frame(f)
    gbt = GBTClassifier(maxIter=8, maxDepth=3, seed=7, minInstancesPerNode=2)
    pipe = Pipeline(stages=model._stages(gbt)).fit(frame)
    out = pipe.transform(frame).select(vector_to_array("features").alias("x"), vector_to_array("rawPrediction").alias("raw"))
    rows = out.collect()
    x = np.array([r["x"] for r in rows])
    margin = np.array([r["raw"][1] for r in rows])
    table = drivers.tree_table(spark, pipe)
    got = shapley.shapley_values(table["trees"], x, table["n_features"]).sum(axis=1) + shapley.base_value(table["trees"])
    assert np.allclose(got, margin, atol=1e-9)


def test_logistic_attributions_reproduce_probability(spark):
    from pyspark.sql import functions as F

    from retentia.operators import drivers, model, split
    from retentia.operators.features import feature_window
    from retentia.plans.context import fact_table

    f = feature_window(fact_table(spark, SF))
    sp = split.cohort_split(f)
    frame = model.model_frame(sp).join(sp.select("account_id", "split"), "account_id")
    pipe = model.fit_logistic(frame)
    b, num, cat = model.logistic_coefficients(pipe, frame)
    prob = {r["account_id"]: r["flight_risk_score"] for r in model.predict(pipe, frame).collect()}
    # the linear score must see the same inputs as the model (missing means filled the same way)
    lin = drivers.linear_drivers(model.model_frame(f), intercept=b, numeric=num, categorical=cat)
    got = {r["account_id"]: r["flight_risk_score"] for r in lin.collect()}
    assert got and all(abs(got[a] - round(prob[a], 6)) <= 1e-6 for a in got)
    assert lin.where(~F.col("primary_risk_drivers").startswith("1. ")).count() == 0


def test_categorical_of_a_hundred_levels(spark):
    import random

    import numpy as np
    from pyspark.ml.functions import vector_to_array

    from retentia.operators import drivers, model

    rng = random.Random(3)
    rows = []
    for k in range(800):
        level = k % 100
        rows.append((f"a{k}", *[f"level{level:03d}" if c == "industry" else "x" for c in model.CATEGORICAL],
                     *[rng.random() for _ in model.NUMERIC_INPUTS], float(level % 2), "valid" if k % 5 == 0 else "train"))
    names = ", ".join(["account_id string", *[f"{c} string" for c in model.CATEGORICAL],
                       *[f"{c} double" for c in model.NUMERIC_INPUTS], "label double", "split string"])
    frame = spark.createDataFrame(rows, names)
    pipe = model.fit_gbt(frame, model.GbtParams(max_iter=5, max_depth=3))
    out = pipe.transform(frame).select(vector_to_array("features").alias("x"), vector_to_array("rawPrediction").alias("raw")).collect()
    table = drivers.tree_table(spark, pipe)
    assert max(t.category_left.shape[1] for t in table["trees"]) > 64
    x = np.array([r["x"] for r in out])
    values = shapley.shapley_values(table["trees"], x, table["n_features"])
    assert np.allclose(values.sum(axis=1) + shapley.base_value(table["trees"]), [r["raw"][1] for r in out], atol=1e-9)


def _random_tree(rng, features, depth):
    """A tree with covers from random rows; one feature is a category of five codes."""
    import numpy as np

    nodes = []

    def grow(rows, level):
        at = len(nodes)
        nodes.append([rng.normal(), -1, -1, -1, 0.0, False, len(rows), np.zeros(5, bool)])
        if level < depth and len(rows) > 1:
            f = int(rng.integers(features))
            if f == 0:
                codes = rng.random(5) < 0.5
                goes = codes[rows[:, 0].astype(int)]
                nodes[at][3:6], nodes[at][7] = [0, 0.0, True], codes
            else:
                threshold = float(rng.choice(rows[:, f]))
                goes = rows[:, f] <= threshold
                nodes[at][3:6] = [f, threshold, False]
            nodes[at][1] = grow(rows[goes], level + 1)
            nodes[at][2] = grow(rows[~goes], level + 1)
        return at

    rows = np.column_stack([rng.integers(0, 5, 60), rng.integers(0, 4, (60, features - 1))]).astype(float)
    grow(rows, 0)
    value, left, right, feature, threshold, is_category, cover, codes = (np.array(c) for c in zip(*nodes))
    return shapley.Tree(float(rng.uniform(0.1, 1)), value, left, right, feature, threshold, is_category.astype(bool), cover.astype(float), codes), rows


def test_shapley_values_equal_the_sum_over_all_feature_subsets():
    from itertools import combinations
    from math import factorial

    import numpy as np

    rng = np.random.default_rng(11)
    for features, depth in ((1, 3), (3, 4), (5, 5), (8, 4)):
        made = [_random_tree(rng, features, depth) for _ in range(3)]
        trees, x = [t for t, _ in made], made[0][1][:6]

        def expectation(t, row, known, node=0):
            if t.left[node] < 0:
                return t.value[node]
            l, r = t.left[node], t.right[node]
            if t.feature[node] in known:
                v = row[t.feature[node]]
                goes = t.category_left[node, int(v)] if t.is_category[node] else v <= t.threshold[node]
                return expectation(t, row, known, l if goes else r)
            share = t.cover[l] / t.cover[node]
            return share * expectation(t, row, known, l) + (1 - share) * expectation(t, row, known, r)

        value = lambda row, known: sum(t.weight * expectation(t, row, known) for t in trees)
        got = shapley.shapley_values(trees, x, features)
        for row, phi in zip(x, got):
            for i in range(features):
                others = [f for f in range(features) if f != i]
                want = sum(
                    factorial(k) * factorial(features - 1 - k) / factorial(features) * (value(row, {*s, i}) - value(row, set(s)))
                    for k in range(features) for s in combinations(others, k)
                )
                assert abs(phi[i] - want) < 1e-9
            assert abs(phi.sum() + shapley.base_value(trees) - value(row, set(range(features)))) < 1e-9


def test_auc_by_average_ranks(spark):
    import random

    from retentia.operators import ranking

    rng = random.Random(5)
    rows = [(rng.choice([None, 0.1, 0.2, 0.2, 0.5, rng.random()]), rng.choice([0, 1, 1, None])) for _ in range(600)]
    below = lambda x: -1.0 if x is None else x
    pos, neg = ([below(s) for s, y in rows if y == k] for k in (1, 0))
    want = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(rows, "score double, label int")
    r = ranking.auc(df.repartition(5)).first()
    assert (r.positives, r.negatives) == (len(pos), len(neg)) and abs(r.roc_auc - want) < 1e-6
    assert ranking.auc(df.where("label = 1")).first().roc_auc is None and ranking.auc(df.limit(0)).first().positives == 0
