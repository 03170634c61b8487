"""Embedding whitening: principal components of unit variance.

Every entry c of a vector becomes the whole number floor(256 * c).  The
components are fitted on the list of different vectors, each once, so copies
of a vector, however many, weigh no more than one:

1. different vectors, by an aggregation that drops copies map-side, written
   once to the shared folder;
2. their number n and exact sums per dimension (whole numbers);
3. the scatter matrix of the centred vectors: one partial matrix a task,
   sent row by row and added by dimension (d rows of d numbers a task, so
   what is gathered does not grow with the vectors);
4. on the driver, whose input is that d x d matrix alone, the largest
   eigenpairs by contour integration (``contour.largest``: quadrature of
   complex shifted solves, Rayleigh-Ritz, inertia counts);
5. every row's projections, in tasks of Arrow batches;
6. the whitened list's covariance, gathered as in 3, held against the identity.

Defined cases: rows whose vector is null or holds a null or a non-finite
entry are dropped; so are vectors of no entry, and, if lengths differ, those
whose length is not the most frequent one (the longer of equally frequent
ones); null ids and repeated rows are rows like others; an empty table, or
one whose vectors are all equal, has no component and gives an empty result;
components whose eigenvalue is below ``RANK`` of the trace are not whitened,
so there may be fewer than asked for; entries from 2**55 on are taken as the
largest whole number; a deviation that no long can hold is null; other
columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentia.llm import contour
from retentia.llm.common import shuffle_partitions
from retentia.session import scratch_path, ship_by_value

SCALE = 256
#: Eigenvalues below this share of the trace count as zero.
RANK = 1e-12


def whole_vectors(rows: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id and the vector x of whole numbers, of the rows that count."""
    finite = F.forall("e", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    own = rows.select("vec_id", F.transform(column, lambda c: c.cast("double")).alias("e")).where(F.col("e").isNotNull() & (F.size("e") > 0) & finite)
    length = own.groupBy(F.size("e").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).select("d").first()
    x = F.transform("e", lambda c: F.floor(c * float(SCALE)).cast("long"))
    return own.where(F.size("e") == (length.d if length else 0)).select("vec_id", x.alias("x"))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of one length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.empty((0, 0), np.int64)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dim, total, n): exact sums of the low and high halves of the numbers; totals as text."""
    total, n = None, 0
    for batch in batches:
        if batch.num_rows:
            x = matrix(batch.column(0))
            # Halves of 32 bits: their sums over a batch fit a long.
            own = [(int(h) << 32) + int(w) for h, w in zip((x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0))]
            total = own if total is None else [a + b for a, b in zip(total, own)]
            n += batch.num_rows
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([str(t) for t in total]), pa.array([n] * len(total), pa.int64())], names=["dim", "total", "n"])


class Centre:
    """n and the sums S of the fit list; n * x - S exactly, and x - S / n."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.small = max((abs(s) for s in sums), default=0) < 2**61

    def exact(self, x: np.ndarray) -> np.ndarray:
        """Longs where they hold it, else Python's whole numbers."""
        if self.small and int(max(x.max(initial=0), -x.min(initial=0))) < 2**61 // self.n:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        y = self.exact(x)
        return y / self.n if y.dtype != object else (y / Fraction(self.n)).astype(float)

    def deviations(self, x: np.ndarray) -> list:
        y = self.exact(x)
        if y.dtype != object and int(max(y.max(initial=0), -y.min(initial=0))) ** 2 * y.shape[1] < 2**63:
            return (y * y).sum(axis=1).tolist()
        return [d if d < 2**63 else None for d in (y.astype(object) ** 2).sum(axis=1)]


def centre(distinct: DataFrame) -> Centre:
    sums = distinct.select("x").mapInArrow(_sums, "dim int, total string, n long").groupBy("dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    rows = sorted(sums.collect())
    return Centre(int(rows[0].n) if rows else 0, [int(r.total) for r in rows])


_PART = "dim int, part binary"


def _as_parts(m: np.ndarray) -> pa.RecordBatch:
    m = np.ascontiguousarray(m)
    return pa.RecordBatch.from_arrays([pa.array(range(len(m)), pa.int32()), pa.array([r.tobytes() for r in m], pa.binary())], names=["dim", "part"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, part in zip(batch.column(0).to_pylist(), batch.column(1)):
            part = np.frombuffer(part.as_py(), float)
            total[k] = total[k] + part if k in total else part
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["dim", "part"])


def summed(parts: DataFrame) -> np.ndarray:
    """The sum of the tasks' matrices, whose rows are added apart."""
    n = min(64, shuffle_partitions(parts.sparkSession))
    rows = sorted(parts.repartition(n, "dim").mapInArrow(_added, _PART).collect())
    return np.stack([np.frombuffer(r.part, float) for r in rows])


def _products(values):
    """Each task's X'X and column sums of the rows X = values(x), the sums as a last row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            if batch.num_rows:
                y = values(matrix(batch.column(0)))
                total = total + np.vstack([y.T @ y, y.sum(axis=0)])
        if not np.isscalar(total):
            yield _as_parts(total)

    return run


def covariance(distinct: DataFrame, n: int, values) -> np.ndarray:
    """Of values(x) over the fit list, divisor n; the values are centred but for rounding, which the sums take off."""
    m = summed(distinct.select("x").mapInArrow(_products(values), _PART))
    mean = m[-1] / n
    return m[:-1] / n - np.outer(mean, mean)


def _whitened(fit: Centre, axes: np.ndarray, explained: list[float], error: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(explained)
        for batch in batches:
            x = matrix(batch.column(1))
            if not len(x):
                continue
            rows = len(x)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()).take(pa.array(np.repeat(np.arange(rows), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, fit.n, np.int64)),
                    pa.array(fit.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(rows), k))),
                    pa.array((fit.centred(x) @ axes).ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * k, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, components: int = 4, column: str = "embedding") -> DataFrame:
    """One row per counting row and component; rows: vec_id and the vector column."""
    spark = rows.sparkSession
    vectors = whole_vectors(rows, column)
    path = scratch_path(spark, "whitening")
    vectors.select("x").distinct().write.parquet(path)
    distinct = spark.read.parquet(path)
    fit = centre(distinct)
    if fit.n < 2:
        return spark.createDataFrame([], WHITENED)
    v = covariance(distinct, fit.n, fit.centred)
    trace = float(np.trace(v))
    values, vectors_ = contour.largest(v, components, RANK * trace)
    if not len(values):
        return spark.createDataFrame([], WHITENED)
    axes = vectors_ / np.sqrt(values)
    error = float(np.abs(covariance(distinct, fit.n, lambda x: fit.centred(x) @ axes) - np.eye(len(values))).max())
    return vectors.mapInArrow(_whitened(fit, axes, (values / trace).tolist(), error), WHITENED)


ship_by_value(sys.modules[__name__])
