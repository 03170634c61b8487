"""Histogram boosting of decision trees (J5), with its histograms made in Spark tasks.

Logistic loss, class-balanced weights, trees grown best-first to a number of
leaves, missing values with a learned direction, categorical splits on sets of
levels, and a stop after ``patience`` trees without a better validation AUC.

* Binning: a numeric input of at most ``bins`` distinct training values gets a
  bin a value, others get ``bins`` quantile bounds; a categorical input gets a
  bin a level (at most ``max_levels``, else ``ValueError``).  NULL and NaN, and
  levels not seen in training, share one more bin, the missing one.
* Rows are packed into chunks of codes and written to the shared folder; the
  margins of the finished trees are cached beside them, each tree added to
  them once, and come again from the written chunks and the trees if an
  executor is lost.
* A level of a tree is one job: each task adds up gradient, hessian and rows by
  (node, input, bin), and the tables are summed tree-wise on the executors.
  Their size depends on nodes and bins, not on rows, and so does what the
  driver holds; their number is that of the tasks, at most ``TASKS`` a core.
  Gradients are whole numbers of a fixed small unit, so sums, and with them
  the trees, don't depend on how rows are partitioned, and of two children
  only the smaller is summed: the other is their parent less it, exactly.
* Best-first growth: a node's best split doesn't depend on other nodes, so all
  nodes down to ``depth`` are searched level by level (``depth`` jobs a tree)
  and the splits are then taken by falling gain until the tree has ``leaves``.
  The tree is that of one split at a time.
* Validation AUC after each tree comes with the next tree's first job, from
  counts of both classes by probability rounded to 1 / 65,536; rows of equal
  rounded probability are ties.

Odd inputs: no training rows, or one class alone, give a model without trees
(its probability is the share of positive weight, 0.5 without rows); validation
rows of one class, or none, give no AUC and no early stop; a null label isn't
trained on or validated.
"""

from __future__ import annotations

import heapq
import json
import sys
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia.operators import shapley
from retentia.operators.shapley import Tree
from retentia.session import scratch_path, ship_by_value

AUC_STEPS = 1 << 16
UNIT_BITS = 28  # a gradient of the largest class weight is 2**28 units
CHUNK = 1 << 14  # rows: a chunk's sums stay below 2**53, exact in a double
TASK_ROWS = 1 << 16
TASKS = 2  # a core at most: a level sends one table a task, however many rows there are
REFRESH = 16  # trees after which the margins are made from the written chunks again


@dataclass(frozen=True)
class BoostParams:
    trees: int = 200
    depth: int = 5
    leaves: int = 20
    rate: float = 0.05
    min_rows: int = 10
    min_hessian: float = 1e-3
    patience: int = 50
    bins: int = 254
    max_levels: int = 10_000
    level_smoothing: float = 10.0  # added to a level's hessian where levels are ordered


@dataclass
class BoostedTrees:
    """numeric: name -> inner bounds of its bins; levels: name -> sorted levels; inputs: names in code order."""

    inputs: list[str]
    numeric: dict[str, list[float]]
    levels: dict[str, list[str]]
    base: float
    trees: list[Tree] = field(default_factory=list)
    valid_auc: list[float | None] = field(default_factory=list)  # after each tree that was grown

    def widths(self) -> list[int]:
        """Bins of each input, the missing one (its last) included."""
        return [len(self.levels[c]) + 1 if c in self.levels else len(self.numeric[c]) + 2 for c in self.inputs]

    def codes(self, rows: pd.DataFrame) -> np.ndarray:
        out = np.empty((len(rows), len(self.inputs)), np.uint16)
        for j, c in enumerate(self.inputs):
            if c in self.levels:
                code = pd.Index(self.levels[c], dtype=object).get_indexer(rows[c].astype(object))
                out[:, j] = np.where(code < 0, len(self.levels[c]), code)
            else:
                x = rows[c].to_numpy(dtype=float, na_value=np.nan)
                out[:, j] = np.where(np.isnan(x), len(self.numeric[c]) + 1, np.searchsorted(self.numeric[c], x, side="left"))
        return out

    def margins(self, codes: np.ndarray) -> np.ndarray:
        return self.base + _added(self.trees, codes)


def _leaf_of(tree: Tree, codes: np.ndarray) -> np.ndarray:
    node = np.zeros(len(codes), np.int64)
    rows = np.arange(len(codes))
    while True:
        inner = tree.left[node] >= 0
        if not inner.any():
            return node
        left = tree.category_left[node, codes[rows, np.maximum(tree.feature[node], 0)]]
        node = np.where(inner, np.where(left, tree.left[node], tree.right[node]), node)


def _added(trees: list[Tree], codes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(codes))
    for t in trees:
        out += t.weight * t.value[_leaf_of(t, codes)]
    return out


def _probability(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-margin))


def _ship() -> None:
    """Python workers need not have this package."""
    ship_by_value(shapley, sys.modules[__name__])


# -- binning -------------------------------------------------------------------


def _bins(train: DataFrame, numeric: list[str], categorical: list[str], p: BoostParams) -> tuple[dict, dict]:
    """Bounds and levels from all training rows."""
    levels: dict[str, list[str]] = {}
    for c in categorical:
        seen = train.where(F.col(c).isNotNull()).select(F.col(c).cast("string").alias("v")).distinct()
        found = [r.v for r in seen.limit(p.max_levels + 1).collect()]
        if len(found) > p.max_levels:
            raise ValueError(f"{c} has more than {p.max_levels} levels")
        levels[c] = sorted(found)
    bounds: dict[str, list[float]] = {c: [] for c in numeric}
    if not numeric:
        return bounds, levels
    # -0.0 and 0.0 are one value; NaN is missing.
    train = train.select(*[F.when(~F.isnan(c), F.col(c) + F.lit(0.0)).alias(c) for c in numeric])
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in numeric])).alias("x")
    distinct = train.select(cells).select("x.*").where("v IS NOT NULL").distinct().persist()
    sizes = {r.c: r.n for r in distinct.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
    few = [c for c in numeric if 0 < sizes.get(c, 0) <= p.bins]
    if few:
        by_name: dict[str, list[float]] = {}
        for r in distinct.where(F.col("c").isin(few)).collect():  # at most bins values an input
            by_name.setdefault(r.c, []).append(r.v)
        for c, vs in by_name.items():
            vs = sorted(vs)
            bounds[c] = [a + (b - a) / 2 if a < a + (b - a) / 2 < b else a for a, b in zip(vs, vs[1:])]
    distinct.unpersist()
    many = [c for c in numeric if sizes.get(c, 0) > p.bins]
    if many:
        # As SQL text: a literal a cut through the DataFrame API takes seconds.
        cuts = ", ".join(f"{k / p.bins!r}D" for k in range(1, p.bins))
        row = train.agg(*[F.expr(f"percentile_approx(`{c}`, array({cuts}), {100 * p.bins})").alias(c) for c in many]).first()
        for c in many:
            bounds[c] = sorted(set(row[c]))
    return bounds, levels


def _task_count(rows: int, cores: int) -> int:
    """Tasks of a level's job: one for every ``TASK_ROWS`` rows, as long as the cores have no more than ``TASKS`` each."""
    return max(1, min(-(-rows // TASK_ROWS), TASKS * cores))


def _packed(model: BoostedTrees, rows: DataFrame, n: int) -> DataFrame:
    """Chunks (codes, labels, valid) of the rows, written to the shared folder."""
    _ship()

    def pack(batches):
        for pdf in batches:
            for at in range(0, len(pdf), CHUNK):
                part = pdf.iloc[at : at + CHUNK]
                yield pd.DataFrame(
                    {
                        "codes": [model.codes(part).tobytes()],
                        "labels": [part["label"].to_numpy(np.uint8).tobytes()],
                        "valid": [part["valid"].to_numpy(np.uint8).tobytes()],
                    }
                )

    spark = rows.sparkSession
    path = scratch_path(spark, "boosting-chunks")
    rows = rows.repartition(_task_count(n, spark.sparkContext.defaultParallelism))
    rows.mapInPandas(pack, "codes binary, labels binary, valid binary").write.parquet(path)
    return spark.read.parquet(path)


# -- splits --------------------------------------------------------------------


@dataclass
class _Node:
    """A node of a growing tree: sums, and the best split if it has one."""

    depth: int
    g: float
    h: float
    n: int
    gain: float = 0.0
    feature: int = -1
    goes_left: np.ndarray | None = None
    children: tuple[int, int] | None = None


def _score(g, h):
    return g * g / np.maximum(h, 1e-300)


def best_split(hist: np.ndarray, widths: list[int], categorical: list[bool], p: BoostParams):
    """(gain, input, goes-left by code, left sums) of the best split of one node, or None.

    Levels are ordered by mean gradient and cut once: the best of all sets of levels,
    unless ``min_rows`` or ``min_hessian`` rules out a cut of that order.
    ``hist``: (all bins, 3) sums of gradient, hessian and rows.  Equal gains go
    to the first input, then the lowest cut; missing rows go right unless left
    is better, and, where the node has none, to the side with more rows."""
    best = None
    start = 0
    for f, width in enumerate(widths):
        cell = hist[start : start + width]
        start += width
        total, missing, known = cell.sum(axis=0), cell[-1], cell[:-1]
        if categorical[f]:
            order = np.flatnonzero(known[:, 2] > 0)
            order = order[np.argsort(known[order, 0] / (known[order, 1] + p.level_smoothing), kind="stable")]
        else:
            order = np.arange(width - 1)
        if not len(order):
            continue
        below = np.cumsum(known[order], axis=0)
        for with_missing in (False, True) if missing[2] > 0 else (False,):
            left = below + missing if with_missing else below
            right = total - left
            ok = (np.minimum(left[:, 2], right[:, 2]) >= max(p.min_rows, 1)) & (np.minimum(left[:, 1], right[:, 1]) >= p.min_hessian)
            if not ok.any():
                continue
            gain = np.where(ok, _score(left[:, 0], left[:, 1]) + _score(right[:, 0], right[:, 1]) - _score(total[0], total[1]), -np.inf)
            k = int(np.argmax(gain))
            if gain[k] > (best[0] if best else 1e-12):
                side = np.zeros(width, bool)
                # Levels with no row here go where missing rows go.
                stray = with_missing if missing[2] > 0 else bool(left[k, 2] > right[k, 2])
                side[:] = stray
                side[order] = False
                side[order[: k + 1]] = True
                best = (float(gain[k]), f, side, left[k])
    return best


def _tree(nodes: list[_Node], width: int, rate: float, leaves: int | None = None) -> Tree:
    """The tree of the splits with the greatest gains, taken from the root on until it has ``leaves`` (all splits if None)."""
    taken: set[int] = set()
    heap = [(-nodes[0].gain, 0)] if nodes[0].children else []
    while heap and (leaves is None or len(taken) < leaves - 1):
        _, at = heapq.heappop(heap)
        taken.add(at)
        for child in nodes[at].children:
            if nodes[child].children:
                heapq.heappush(heap, (-nodes[child].gain, child))
    kept, number = [0], {0: 0}
    for at in kept:
        if at in taken:
            for child in nodes[at].children:
                number[child] = len(kept)
                kept.append(child)
    m = len(kept)
    left, right, feature = (-np.ones(m, np.int64) for _ in range(3))
    value, table = np.zeros(m), np.zeros((m, width), bool)
    for i, at in enumerate(kept):
        node = nodes[at]
        value[i] = -node.g / node.h if node.h > 0 else 0.0
        if at in taken:
            left[i], right[i] = (number[c] for c in node.children)
            feature[i] = node.feature
            table[i, : len(node.goes_left)] = node.goes_left
    return Tree(rate, value, left, right, feature, np.zeros(m), left >= 0, np.array([float(nodes[at].n) for at in kept]), table)


# -- jobs ----------------------------------------------------------------------


def _unpack(row, features: int):
    labels = np.frombuffer(bytes(row.labels), np.uint8)
    return np.frombuffer(bytes(row.codes), np.uint16).reshape(len(labels), features), labels, np.frombuffer(bytes(row.valid), np.uint8).astype(bool)


def _grown(cached, tree: Tree):
    """The cached chunks with a tree's leaves added to their margins, cached in turn."""
    return cached.map(lambda c: (*c[:3], c[3] + _added([tree], c[0]))).persist()


def _cached(chunks: DataFrame, base: float, trees: list[Tree], features: int):
    """RDD of (codes, labels, valid, margin): numpy arrays a chunk, margins by the trees so far."""

    def load(row):
        codes, labels, valid = _unpack(row, features)
        return codes, labels, valid, base + _added(trees, codes)

    return chunks.rdd.map(load).persist()


def _histograms(cached, growing: Tree, slots: dict[int, int], widths: list[int], weights: tuple[float, float], unit: float, with_auc: bool):
    """Sums of all rows: (nodes in question, bins, 3) whole numbers, and class counts by probability of the validation rows."""
    offsets = np.concatenate([[0], np.cumsum(widths)[:-1]]).astype(np.int64)
    bins = int(sum(widths))
    slot = -np.ones(len(growing.left), np.int64)
    for at, k in slots.items():
        slot[at] = k

    def sums(chunks):
        hist = np.zeros((len(slots), bins, 3), np.int64)
        auc = np.zeros((2, AUC_STEPS + 1 if with_auc else 0), np.int64)
        for codes, labels, valid, margin in chunks:
            prob = _probability(margin)
            if with_auc and valid.any():
                step = np.rint(prob[valid] * AUC_STEPS).astype(np.int64)
                for y in (0, 1):
                    auc[y] += np.bincount(step[labels[valid] == y], minlength=AUC_STEPS + 1)
            at = slot[_leaf_of(growing, codes)]
            use = ~valid & (at >= 0)
            at, part, y, prob = at[use], codes[use], labels[use], prob[use]
            w = np.where(y == 1, weights[1], weights[0])
            g, h = np.rint((prob - y) * w / unit), np.rint(prob * (1 - prob) * w / unit)
            for f in range(len(widths)):
                cell = at * widths[f] + part[:, f]
                own = hist[:, offsets[f] : offsets[f] + widths[f]]
                for k, v in enumerate((g, h, None)):
                    own[:, :, k] += np.bincount(cell, weights=v, minlength=len(slots) * widths[f]).astype(np.int64).reshape(-1, widths[f])
        yield hist, auc

    return cached.mapPartitions(sums).treeReduce(lambda a, b: (a[0] + b[0], a[1] + b[1]))


def _auc(counts: np.ndarray) -> float | None:
    neg, pos = counts
    if not neg.sum() or not pos.sum():
        return None
    below = np.cumsum(neg) - neg
    # Twice the wins: whole numbers, as Python integers so that they can't overflow.
    wins = sum(int(a) * (2 * int(b) + int(c)) for a, b, c in zip(*(v[pos > 0] for v in (pos, below, neg))))
    return wins / (2 * int(neg.sum()) * int(pos.sum()))


def fit(rows: DataFrame, numeric: list[str], categorical: list[str], params: BoostParams = BoostParams()) -> BoostedTrees:
    """``rows``: the inputs, ``label`` (0/1) and ``split``; 'train' rows grow the trees, 'valid' rows stop them, others aren't read."""
    p = params
    rows = rows.where(F.col("split").isin("train", "valid") & F.col("label").isin(0, 1))
    rows = rows.select(
        *[F.col(c).cast("string").alias(c) for c in categorical],
        *[F.col(c).cast("double").alias(c) for c in numeric],
        F.col("label").cast("int").alias("label"),
        (F.col("split") == "valid").cast("int").alias("valid"),
    )
    train = rows.where("valid = 0")
    c = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.expr("IF(valid = 0, 1, NULL)")).alias("t"), F.coalesce(F.sum(F.expr("IF(valid = 0, label, 0)")), F.lit(0)).alias("pos")).first()
    inputs = [*categorical, *numeric]
    if c.pos in (0, c.t):
        # One class or no rows: nothing to learn; a share of 1 or 0 as a large finite margin.
        return BoostedTrees(inputs, {x: [] for x in numeric}, {x: [] for x in categorical}, 0.0 if not c.t else 30.0 if c.pos else -30.0)
    bounds, levels = _bins(train, numeric, categorical, p)
    # Balanced weights, n / (2 * n_class): both classes weigh the same, so the first margin is 0.
    model = BoostedTrees(inputs, bounds, levels, 0.0)
    weights = (c.t / (2.0 * (c.t - c.pos)), c.t / (2.0 * c.pos))
    unit = max(weights) / (1 << UNIT_BITS)
    widths, is_cat = model.widths(), [x in levels for x in inputs]
    chunks = _packed(model, rows, c.n)

    cached, old = _cached(chunks, model.base, [], len(inputs)), None
    best, best_at = -1.0, 0
    stump = _tree([_Node(0, 0.0, 0.0, 0)], max(widths), p.rate)
    trees: list[Tree] = []
    while True:
        if trees:
            # A tree is added to the cached margins once; every REFRESH trees they start from the chunks, which keeps the lineage short.
            old, cached = cached, _cached(chunks, model.base, trees, len(inputs)) if len(trees) % REFRESH == 0 else _grown(cached, trees[-1])
        hist, counts = _histograms(cached, stump, {0: 0}, widths, weights, unit, True)
        if old is not None:
            old.unpersist()  # the job above has read it
        if trees:
            auc = _auc(counts)
            model.valid_auc.append(auc)
            if auc is not None and auc > best:
                best, best_at = auc, len(trees)
            if len(trees) >= p.trees or (auc is not None and len(trees) - best_at >= p.patience):
                break
        total = hist[0, : widths[0]].sum(axis=0)
        nodes = [_Node(0, total[0] * unit, total[1] * unit, int(total[2]))]
        level, tables = [0], {0: hist[0]}
        for depth in range(p.depth):
            if depth:
                summed = _smaller_children(nodes, level)
                hist, _ = _histograms(cached, _tree(nodes, max(widths), p.rate), _places(nodes, summed), widths, weights, unit, False)
                tables = _all_children(nodes, tables, dict(zip(summed, hist)))
            following = []
            for at in level:
                found = best_split(tables[at] * np.array([unit, unit, 1.0]), widths, is_cat, p)
                if found is None:
                    continue
                node = nodes[at]
                node.gain, node.feature, node.goes_left, left = found
                right = np.array([node.g, node.h, node.n]) - left
                node.children = (len(nodes), len(nodes) + 1)
                nodes += [_Node(depth + 1, side[0], side[1], int(round(side[2]))) for side in (left, right)]
                following += node.children
            level = [at for at in following if nodes[at].n >= 2 * p.min_rows]
            if not level:
                break
        if nodes[0].children is None:
            break
        trees.append(_tree(nodes, max(widths), p.rate, p.leaves))
    cached.unpersist()
    model.trees = trees[:best_at] if best_at else trees
    return model


def _smaller_children(nodes: list[_Node], level: list[int]) -> list[int]:
    """The smaller child of each pair that has a node in ``level``: the only ones whose rows are summed."""
    wanted = set(level)
    return [min(node.children, key=lambda at: nodes[at].n) for node in nodes if node.children and wanted & set(node.children)]


def _all_children(nodes: list[_Node], above: dict[int, np.ndarray], summed: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """The tables of both children where one was summed: the other's is the parent's less it, in whole numbers."""
    out = {}
    for at, node in enumerate(nodes):
        for own, other in (node.children, node.children[::-1]) if node.children else ():
            if own in summed:
                out[own], out[other] = summed[own], above[at] - summed[own]
    return out


def _places(nodes: list[_Node], level: list[int]) -> dict[int, int]:
    """Number in the flat tree (breadth first) -> slot, for the nodes of a level."""
    kept = [0]
    for at in kept:
        kept += nodes[at].children or ()
    number = {at: i for i, at in enumerate(kept)}
    return {number[at]: k for k, at in enumerate(level)}


# -- use -----------------------------------------------------------------------


def probability(model: BoostedTrees, rows: DataFrame, name: str = "flight_risk_score") -> DataFrame:
    """Adds the probability of class 1, by Arrow batch."""
    _ship()

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for x in batches:
            yield pd.Series(_probability(model.margins(model.codes(x))))

    return rows.withColumn(name, F.pandas_udf(score, "double")(_inputs(model)))


def _inputs(model: BoostedTrees):
    return F.struct(*[F.col(c).cast("string" if c in model.levels else "double").alias(c) for c in model.inputs])


def attributions(model: BoostedTrees, rows: DataFrame, name: str = "values") -> DataFrame:
    """Adds an array with the Shapley value of each input, in the order of ``model.inputs``; they add up to the margin less its base value."""
    _ship()

    def values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        ready = shapley.prepared(model.trees)
        for x in batches:
            yield pd.Series(list(shapley.shapley_values(model.trees, model.codes(x).astype(float), len(model.inputs), ready)))

    return rows.withColumn(name, F.pandas_udf(values, "array<double>")(_inputs(model)))


def save(spark: SparkSession, model: BoostedTrees, path: str) -> None:
    """One JSON document, written by Spark; size bounded by trees, leaves and bins."""
    doc = {k: v for k, v in asdict(model).items() if k != "trees"}
    doc["trees"] = [
        {"weight": t.weight, "value": t.value.tolist(), "left": t.left.tolist(), "right": t.right.tolist(), "feature": t.feature.tolist(),
         "cover": t.cover.tolist(), "width": t.category_left.shape[1], "goes_left": [np.flatnonzero(r).tolist() for r in t.category_left]}
        for t in model.trees
    ]
    spark.createDataFrame([(json.dumps(doc),)], "model string").coalesce(1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> BoostedTrees:
    doc = json.loads(spark.read.parquet(path).first().model)
    trees = []
    for t in doc.pop("trees"):
        left = np.array(t["left"], np.int64)
        table = np.zeros((len(left), t["width"]), bool)
        for i, codes in enumerate(t["goes_left"]):
            table[i, codes] = True
        trees.append(Tree(t["weight"], np.array(t["value"]), left, np.array(t["right"], np.int64), np.array(t["feature"], np.int64),
                          np.zeros(len(left)), left >= 0, np.array(t["cover"]), table))
    return BoostedTrees(**doc, trees=trees)
