"""Histogram boosting: splits against exhaustive search, missing values, stopping, odd inputs."""

import math
import random
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from retentia.operators import boosting
from retentia.operators.boosting import BoostParams

SCHEMA = "id long, kind string, a double, b double, label double, split string"
NUMERIC, CATEGORICAL = ["a", "b"], ["kind"]


def _rows(n, seed, noise=0.3, valid=0.3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        kind = rng.choice(["x", "y", "z", "w", None])
        a = rng.choice([None, *[k / 4 for k in range(20)]])
        b = rng.choice([-0.0, 0.0, 1.0, 2.5, float("nan"), 7.0])
        signal = (a is None) or (kind in ("x", "w") and a > 2) or b == 7.0
        y = float(signal if rng.random() > noise else rng.random() < 0.5)
        out.append((i, kind, a, b, y, "valid" if rng.random() < valid else rng.choice(["train"] * 9 + ["test"])))
    return out


def _missing(v):
    return v is None or v != v


def _score(sums):
    return sums[0] ** 2 / sums[1] if sums[1] else 0.0


def _best_gain(train, grad, p, categorical):
    """The greatest gain over every cut, level set and direction of the missing, on raw values."""
    sums = lambda rs: (sum(grad[r[0]][0] for r in rs), sum(grad[r[0]][1] for r in rs))
    kinds = sorted({r[1] for r in train if r[1] is not None}) if categorical else []
    tests = [(1, set(s)) for k in range(1, len(kinds) + 1) for s in combinations(kinds, k)]
    for col in (2, 3):
        tests += [(col, v) for v in sorted({r[col] for r in train if not _missing(r[col])})]
    found = 0.0
    for col, what in tests:
        for stray in (False, True):
            goes = [stray if _missing(r[col]) else (r[col] in what if col == 1 else r[col] <= what) for r in train]
            if p.min_rows <= sum(goes) <= len(train) - p.min_rows:
                l, o = ([r for r, g in zip(train, goes) if g is side] for side in (True, False))
                found = max(found, _score(sums(l)) + _score(sums(o)) - _score(sums(train)))
    return found


@pytest.mark.parametrize("seed,leaves,depth,min_rows,categorical", [(1, 6, 5, 1, ["kind"]), (2, 20, 3, 8, []), (3, 4, 2, 1, ["kind"]), (4, 7, 4, 8, [])])
def test_trees_equal_exhaustive_search(spark, seed, leaves, depth, min_rows, categorical):
    """Each split has the greatest gain of its node, and splits come best first.  Gains are compared, as equal ones are frequent.

    Level sets are searched in the order of their means, which is exhaustive where no set is ruled out for few rows: hence least rows of 1 there."""
    rows = _rows(260, seed, valid=0.0)
    p = BoostParams(trees=3, rate=0.3, leaves=leaves, depth=depth, min_rows=min_rows, min_hessian=0.0, level_smoothing=0.0)
    m = boosting.fit(spark.createDataFrame(rows, SCHEMA), NUMERIC, categorical, p)
    assert len(m.trees) == 3
    train = [r for r in rows if r[5] == "train"]
    codes = m.codes(pd.DataFrame(train, columns=["id", "kind", "a", "b", "label", "split"]))
    pos = sum(r[4] for r in train)
    weight = {1.0: len(train) / (2 * pos), 0.0: len(train) / (2 * (len(train) - pos))}
    margin = [0.0] * len(train)
    for t in m.trees:
        grad = {}
        for r, x in zip(train, margin):
            q = 1 / (1 + math.exp(-x))
            grad[r[0]] = ((q - r[4]) * weight[r[4]], q * (1 - q) * weight[r[4]])
        total = lambda at: tuple(sum(grad[train[i][0]][k] for i in at) for k in (0, 1))
        open_, n_leaves = [(0, list(range(len(train))), 0)], 1
        ready = []  # (gain, node, rows, depth) of nodes that could be split
        taken = []
        while open_ or ready:
            while open_:
                node, at, level = open_.pop()
                assert t.cover[node] == len(at)
                g, h = total(at)
                assert abs(t.value[node] + g / h) < 1e-6
                gain = _best_gain([train[i] for i in at], grad, p, categorical) if level < depth else 0.0
                if gain > 1e-9:
                    ready.append((gain, node, at, level))
                else:
                    assert t.left[node] < 0
            split = [x for x in ready if t.left[x[1]] >= 0]
            if not split:
                break
            gain, node, at, level = max(split)
            # The tree's next split is as good as any that was possible then, and as its node's best.
            assert gain > max(x[0] for x in ready) - 1e-6
            ready.remove((gain, node, at, level))
            l = [i for i in at if t.category_left[node, codes[i, t.feature[node]]]]
            o = [i for i in at if i not in set(l)]
            assert min(len(l), len(o)) >= p.min_rows
            assert abs(_score(total(l)) + _score(total(o)) - _score(total(at)) - gain) < 1e-6
            open_ += [(int(t.left[node]), l, level + 1), (int(t.right[node]), o, level + 1)]
            n_leaves += 1
            taken.append(gain)
        # Nodes stay whole only for want of leaves.
        assert n_leaves == (t.left < 0).sum() <= leaves and (not ready or n_leaves == leaves)
        leaf = boosting._leaf_of(t, codes)
        margin = [x + p.rate * t.value[k] for x, k in zip(margin, leaf)]


def test_partitions_do_not_change_the_trees(spark):
    df = spark.createDataFrame(_rows(900, 4), SCHEMA)
    p = BoostParams(trees=20, patience=99)
    one, seven = (boosting.fit(d, NUMERIC, CATEGORICAL, p) for d in (df.coalesce(1), df.repartition(7)))
    tiny, boosting.TASK_ROWS = boosting.TASK_ROWS, 100
    try:
        many = boosting.fit(df, NUMERIC, CATEGORICAL, p)
    finally:
        boosting.TASK_ROWS = tiny
    for other in (seven, many):
        assert other.valid_auc == one.valid_auc and len(other.trees) == len(one.trees)
        for a, b in zip(one.trees, other.trees):
            assert np.array_equal(a.value, b.value) and np.array_equal(a.category_left, b.category_left)


def test_stops_after_patience_and_keeps_the_best(spark):
    df = spark.createDataFrame(_rows(600, 5, noise=0.7), SCHEMA)
    p = BoostParams(trees=120, rate=0.3, patience=12)
    m = boosting.fit(df, NUMERIC, CATEGORICAL, p)
    top = max(m.valid_auc)
    assert len(m.trees) == m.valid_auc.index(top) + 1 and len(m.valid_auc) == len(m.trees) + 12 < 120
    q = [(round(r.q * boosting.AUC_STEPS), r.label) for r in boosting.probability(m, df, "q").where("split = 'valid'").collect()]
    pos, neg = ([s for s, y in q if y == k] for k in (1, 0))
    wins = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    assert abs(top - wins / (len(pos) * len(neg))) < 1e-12


def test_missing_values_are_not_a_number_on_the_scale(spark):
    # Missing goes with the low values in one input and with the high ones in the other.
    rows = [(i, "k", None if i % 3 == 0 else -5.0 if i % 3 == 1 else 5.0, None if i % 2 else 1.0, float(i % 3 != 2), "train") for i in range(300)]
    m = boosting.fit(spark.createDataFrame(rows, SCHEMA), ["a"], [], BoostParams(trees=1, rate=1.0))
    (t,) = m.trees
    assert list(t.category_left[0]) == [True, False, True]
    # A direction is learned at every split, but a null where training had none goes with more rows.
    full = [r for r in rows if r[2] is not None] + [(999, "k", -5.0, None, 1.0, "train")]
    (t,) = boosting.fit(spark.createDataFrame(full, SCHEMA), ["a"], [], BoostParams(trees=1)).trees
    assert list(t.category_left[0]) == [True, False, True]


def test_quantile_bins_and_many_levels(spark):
    rng = random.Random(6)
    rows = [(i, f"k{i % 701}", rng.random(), None, float(i % 701 < 300 or rng.random() < 0.1), "train" if i % 5 else "valid") for i in range(5000)]
    df = spark.createDataFrame(rows, SCHEMA)
    m = boosting.fit(df, NUMERIC, CATEGORICAL, BoostParams(trees=5, bins=32))
    assert len(m.numeric["a"]) == 31 and len(m.levels["kind"]) == 701 and m.numeric["b"] == []
    assert m.valid_auc[-1] > 0.9
    with pytest.raises(ValueError):
        boosting.fit(df, NUMERIC, CATEGORICAL, BoostParams(max_levels=700))


def test_odd_inputs(spark):
    df = spark.createDataFrame(_rows(400, 7), SCHEMA)
    p = BoostParams(trees=4)
    one = boosting.fit(df.where("label = 1"), NUMERIC, CATEGORICAL, p)
    none = boosting.fit(df.limit(0), NUMERIC, CATEGORICAL, p)
    assert not one.trees and not none.trees
    score = lambda m, d: [r.flight_risk_score for r in boosting.probability(m, d).collect()]
    assert min(score(one, df)) > 0.999 and set(score(none, df)) == {0.5} and score(none, df.limit(0)) == []
    # No validation rows: no AUC, all trees.  Null labels change nothing.
    m = boosting.fit(df.where("split = 'train'"), NUMERIC, CATEGORICAL, p)
    nulls = df.where("split = 'train'").withColumn("label", F.lit(None).cast("double"))
    with_nulls = boosting.fit(df.where("split = 'train'").union(nulls), NUMERIC, CATEGORICAL, p)
    assert m.valid_auc == [None] * 4 and len(m.trees) == 4
    assert score(m, df) == score(with_nulls, df)
    # Levels and values that training hadn't, and all inputs null.
    strange = spark.createDataFrame([(1, "new", 1e300, -1e300, None, None), (2, None, None, None, None, None)], SCHEMA)
    assert all(0 < s < 1 for s in score(m, strange))


def test_saved_model_and_attributions(spark, tmp_path):
    from retentia.operators import shapley

    df = spark.createDataFrame(_rows(500, 8), SCHEMA)
    m = boosting.fit(df, NUMERIC, CATEGORICAL, BoostParams(trees=6, patience=99))
    boosting.save(spark, m, f"{tmp_path}/model")
    back = boosting.load(spark, f"{tmp_path}/model")
    a, b = (boosting.probability(x, df).orderBy("id").select("id", "flight_risk_score").collect() for x in (m, back))
    assert a == b and back.valid_auc == m.valid_auc
    base = shapley.base_value(m.trees) + m.base
    for r in boosting.attributions(m, boosting.probability(m, df)).collect():
        s = r.flight_risk_score
        assert abs(sum(r["values"]) + base - math.log(s / (1 - s))) < 1e-9


def test_pattern_tables_serve_all_batches(monkeypatch):
    import numpy as np

    from retentia.operators import shapley
    from retentia.operators.drivers import stored_tree

    x = np.random.default_rng(2).uniform(0, 1000, (300, 3))
    ready = shapley.prepared([stored_tree()])
    made = []
    monkeypatch.setattr(shapley, "_leaf_values", lambda *a: made.append(a))
    tabled = np.concatenate([shapley.shapley_values([stored_tree()], x[k : k + 100], 3, ready) for k in (0, 100, 200)])
    assert not made  # nothing is computed again by batch
    monkeypatch.undo()
    monkeypatch.setattr(shapley, "TABLE_BITS", 0)
    assert np.array_equal(tabled, shapley.shapley_values([stored_tree()], x, 3))


def test_a_tree_is_added_to_the_margins_once(spark):
    import numpy as np

    from retentia.operators import boosting
    from retentia.operators.boosting import _Node, _tree

    boosting._ship()
    leaf = _tree([_Node(0, -2.0, 1.0, 4)], 2, 0.5)  # one leaf of value 2, weight 0.5
    rows = (np.zeros((4, 1), np.uint16), np.zeros(4, np.uint8), np.zeros(4, bool), np.zeros(4))
    cached = spark.sparkContext.parallelize([rows], 1)
    for _ in range(3):
        cached = boosting._grown(cached, leaf)
    assert cached.first()[3].tolist() == [3.0] * 4


def test_tasks_of_a_level_are_bounded_and_only_smaller_children_are_summed(spark, monkeypatch):
    assert [boosting._task_count(n, 12) for n in (0, 1, boosting.TASK_ROWS + 1, 10**6, 10**9)] == [1, 1, 2, 16, 24]
    real, asked = boosting._histograms, []

    def spy(cached, growing, slots, *rest):
        asked.append(len(slots))
        return real(cached, growing, slots, *rest)

    monkeypatch.setattr(boosting, "_histograms", spy)
    m = boosting.fit(spark.createDataFrame(_rows(900, 4), SCHEMA), NUMERIC, CATEGORICAL, BoostParams(trees=3, patience=99))
    assert len(m.valid_auc) == 3 and max(asked) <= 2 ** (BoostParams().depth - 2)
    left, right = boosting._Node(1, 0.0, 0.0, 7), boosting._Node(1, 0.0, 0.0, 3)
    nodes = [boosting._Node(0, 0.0, 0.0, 10, children=(1, 2)), left, right]
    assert boosting._smaller_children(nodes, [1]) == [2] and boosting._smaller_children(nodes, []) == []
    whole, part = np.array([[5, 6, 10]]), np.array([[1, 2, 3]])
    out = boosting._all_children(nodes, {0: whole}, {2: part})
    assert out[2].tolist() == part.tolist() and out[1].tolist() == [[4, 4, 7]]
