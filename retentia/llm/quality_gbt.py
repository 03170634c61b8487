"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of a text (lengths, shares of byte classes, repetition, zstandard
ratio) come from vectorised passes over its bytes.  The trees are grown on a
bounded sample of labelled rows (``Settings.max_rows``, the smallest by a
hash of their id): features are cut into quantile bins once, and each level
of a tree sums gradients in histograms of (node, feature, bin).  The model
is flat arrays in heap order (children of node i at 2i + 1 and 2i + 2), so
that scoring is ``depth`` vectorised steps over all rows and trees.

Only the sample is brought to the driver (``max_rows`` rows of numbers);
scoring is a pass of Python tasks without a shuffle.

Defined cases: null and empty texts have all-zero statistics and get a score
like any other; labels that are null, or of ids without a document, teach
nothing; a repeated id teaches its least statistics once per label row;
without both classes the score is the known class's share (0.5 if no label);
repeated rows get equal scores; an empty table gives an empty result; other
columns are ignored and are never inputs.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentia.llm.quality_rules import repeated_in_windows
from retentia.session import ship_by_value


@dataclass(frozen=True)
class Settings:
    #: The most labelled rows that the trees are grown on.
    max_rows: int = 20_000
    trees: int = 80
    depth: int = 4
    rate: float = 0.15
    bins: int = 64
    l2: float = 1.0
    least_rows: int = 10


#: Byte classes, each a share of the text's bytes.
_CLASSES = {
    "space": b" \t",
    "line_end": b"\n\r",
    "lower": bytes(range(97, 123)),
    "upper": bytes(range(65, 91)),
    "digit": b"0123456789",
    "sentence_end": b".!?",
    "exclamation": b"!",
    "comma": b",;:",
    "bar": b"|",
    "symbol": b"#*$%&@^~_=+/\\",
    "bracket": b"<>{}[]()",
    "quote": b"\"'`",
    "beyond_ascii": bytes(range(128, 256)),
    "control": bytes(x for x in range(32) if x not in b"\t\n\r"),
}
_IN_CLASS = np.zeros((256, len(_CLASSES)))
for _k, _chars in enumerate(_CLASSES.values()):
    _IN_CLASS[list(_chars), _k] = 1

FEATURES = ("log_bytes", "log_words", "word_bytes", "log_lines", "line_bytes", "dup_lines", "repeat_words", "distinct_words", "zstd_ratio", "entropy", *_CLASSES)


def statistics(text: str, compress) -> np.ndarray:
    """FEATURES of one text."""
    raw = text.encode()
    out = np.zeros(len(FEATURES))
    if not raw:
        return out
    n = len(raw)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = counts[counts > 0] / n
    tokens = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    words = max(len(tokens), 1)
    out[:10] = (
        np.log1p(n),
        np.log1p(len(tokens)),
        sum(map(len, tokens)) / words,
        np.log1p(len(lines)),
        n / max(len(lines), 1),
        1 - len(set(lines)) / max(len(lines), 1),
        repeated_in_windows(tokens) / words,
        len(set(tokens)) / words,
        len(compress(raw)) / n,
        -(share * np.log2(share)).sum(),
    )
    out[10:] = counts @ _IN_CLASS / n
    return out


@dataclass(frozen=True)
class Trees:
    """feature, threshold: one row per tree, inner nodes in heap order; value: one row per tree, leaves from left to right."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        if not len(x) or not len(self.feature):
            return np.full(len(x), self.start)
        row, tree = np.arange(len(x))[:, None], np.arange(len(self.feature))[None, :]
        node = np.zeros((len(x), len(self.feature)), np.int64)
        inner = self.feature.shape[1]
        for _ in range(inner.bit_length()):
            node = 2 * node + 1 + (x[row, self.feature[tree, node]] > self.threshold[tree, node])
        return self.start + self.value[tree, node - inner].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def grow(x: np.ndarray, y: np.ndarray, s: Settings = Settings()) -> Trees:
    """Boosted trees of the logistic loss, each level by level."""
    inner, leaves = 2**s.depth - 1, 2**s.depth
    none = Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), 0.0)
    if not len(y):
        return none
    rate = min(max(y.mean(), 1e-3), 1 - 1e-3)
    start = float(np.log(rate / (1 - rate)))
    if y.min() == y.max():
        return Trees(none.feature, none.threshold, none.value, start)
    m = x.shape[1]
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, s.bins + 1)[1:-1], method="lower")) for j in range(m)]
    binned = np.stack([np.searchsorted(cuts[j], x[:, j], "left") for j in range(m)], axis=1)  # bin b: x <= cuts[b]
    flat = binned + np.arange(m) * s.bins
    margin = np.full(len(y), start)
    features, thresholds, values = [], [], []
    for _ in range(s.trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for d in range(s.depth):
            width = 2**d
            cell = (node[:, None] * (m * s.bins) + flat).ravel()
            size = width * m * s.bins
            shape = (width, m, s.bins)
            gl, hl, nl = (np.cumsum(np.bincount(cell, np.repeat(w, m), size).reshape(shape), axis=2) for w in (g, h, np.ones(len(y))))
            gt, ht, nt = gl[:, :, -1:], hl[:, :, -1:], nl[:, :, -1:]
            gain = gl**2 / (hl + s.l2) + (gt - gl) ** 2 / (ht - hl + s.l2) - gt**2 / (ht + s.l2)
            gain[(nl < s.least_rows) | (nt - nl < s.least_rows)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            best_gain = gain.reshape(width, -1)[np.arange(width), best]
            f, b = best // s.bins, best % s.bins
            split = best_gain > 1e-9
            at = width - 1 + np.arange(width)
            feature[at] = np.where(split, f, 0)
            threshold[at] = [cuts[j][k] if ok and k < len(cuts[j]) else np.inf for j, k, ok in zip(f, b, split)]
            side = binned[np.arange(len(y)), f[node]] > b[node]
            node = 2 * node + (side & split[node])
        gs, hs = np.bincount(node, g, leaves), np.bincount(node, h, leaves)
        value = -s.rate * gs / (hs + s.l2)
        margin += value[node]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Trees(np.array(features), np.array(thresholds), np.array(values), start)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that never teach: crc32 of the id as text divides by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    compress = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        rows = [statistics(x.as_py() or "", compress).tolist() for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "x"])


def training_rows(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of at most ``max_rows`` labelled rows that aren't held out."""
    taught = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("quality"))
    # Broadcast: at most max_rows rows of two numbers.
    sample = taught.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(s.max_rows)
    ids = F.broadcast(sample.select("doc_id").distinct())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id", "left_semi")
    x = texts.mapInArrow(_statistics, "doc_id long, x array<double>").groupBy("doc_id").agg(F.min("x").alias("x"))
    rows = sorted((r.doc_id, r.quality, r.x) for r in x.join(F.broadcast(sample), "doc_id").collect())
    return np.array([r[2] for r in rows]).reshape(-1, len(FEATURES)), np.array([float(r[1] > 0) for r in rows])


SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def _score(trees: Trees, cut: float):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compress = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            x = np.array([statistics(t.as_py() or "", compress) for t in batch.column(1)]).reshape(-1, len(FEATURES))
            score = np.concatenate([trees.score(x[i : i + 4096]) for i in range(0, len(x), 4096)] or [np.empty(0)])
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(2), pa.array(score), pa.array((score >= cut).astype(np.int32))], schema=schema)

    return run


def quality_scores(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), cut: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every document row."""
    trees = grow(*training_rows(docs, labels, s), s)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out().alias("held_out")).mapInArrow(_score(trees, cut), SCHEMA)


ship_by_value(sys.modules[__name__])
