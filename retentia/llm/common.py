"""Shared pieces of the corpus operators.

Row identity: a document row is known by ``(_rt_did, _rt_th)``, its id (a
null id counts as the largest one) and a hash of its text, so repeated ids
with different texts stay apart and repeated rows share one decision.
Internal columns start with ``_rt_``; extra input columns are never read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia.session import ship_by_value

#: Stands for a null document id in comparisons: the largest long.
NULL_ID = 2**63 - 1
#: ASCII white space as the contracts write it, [\x20\x09-\x0D].
SPACE = " \t\n\x0b\x0c\r"

_U = np.uint64


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


BATCH_BYTES = 1 << 22


def bound_batches(spark: SparkSession) -> None:
    """Rows pass between the JVM and Python tasks in batches of at most ``BATCH_BYTES`` (or one longer row), however long their texts
    are: both sides hold whole batches outside the heap."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def did(col: str = "doc_id") -> Column:
    return F.coalesce(F.col(col).cast("long"), F.lit(NULL_ID)).alias("_rt_did")


def text_hash(col: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(col), F.lit("")), F.col(col).isNull()).alias("_rt_th")


def keyed_texts(docs: DataFrame) -> DataFrame:
    """(_rt_did, _rt_th, doc_id, text), null texts as empty ones."""
    return docs.select(did(), text_hash(), "doc_id", F.coalesce("text", F.lit("")).alias("text"))


def with_keys(docs: DataFrame) -> DataFrame:
    """All input columns and the row identity."""
    return docs.select("*", did(), text_hash())


def keep_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The input rows whose (_rt_did, _rt_th) is in ``kept``; columns as in the input."""
    return with_keys(docs).join(kept.select("_rt_did", "_rt_th").distinct(), ["_rt_did", "_rt_th"], "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def replace_text(docs: DataFrame, new_text: Column) -> list[Column]:
    """The input's columns with ``text`` set and ``n_chars`` counted anew where the input has it."""
    out = []
    for c in docs.columns:
        if c == "text":
            out.append(new_text.alias("text"))
        elif c == "n_chars":
            out.append(F.char_length(new_text).cast(dict(docs.dtypes)["n_chars"]).alias("n_chars"))
        else:
            out.append(F.col(f"`{c}`"))
    return out


# --- numpy and Arrow helpers of Python tasks ---------------------------------


def string_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string or binary column; nulls count as empty."""
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64) if off is not None and off.size else np.zeros(len(col) + 1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return off - off[0], data[off[0] : off[-1]]


def portions(batches: Iterator[pa.RecordBatch], text: int, most: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """The rows again, in batches of about ``most`` bytes of text (or one long text)."""
    for batch in batches:
        offsets, _ = string_buffers(batch.column(text))
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
            yield batch.slice(i, j - i)
            i = j


def groups(batches: Iterator[pa.RecordBatch], keys: int, most: int = 1 << 16, most_bytes: int = 1 << 25) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows sorted by the first ``keys`` columns (no nulls there), in batches of whole groups with the groups' bounds.

    Rows wait only until their group is known to be whole and about ``most`` rows or ``most_bytes`` bytes are there."""
    held: list[pa.RecordBatch] = []
    rows = size = 0

    def whole(batch: pa.RecordBatch) -> np.ndarray:
        new = np.zeros(max(batch.num_rows - 1, 0), bool)
        for k in range(keys):
            c = batch.column(k).to_numpy(zero_copy_only=False)
            new |= c[1:] != c[:-1]
        return np.concatenate([[0], np.flatnonzero(new) + 1, [batch.num_rows]])

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
            size += batch.nbytes
        if rows >= most or size >= most_bytes:
            all_ = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            bounds = whole(all_)
            if len(bounds) > 2:
                yield all_.slice(0, int(bounds[-2])), bounds[:-1]
            held = [all_.slice(int(bounds[-2]))]
            # A group that goes on alone is looked at again when as many rows more are there.
            rows, size = (0, 0) if len(bounds) == 2 else (held[0].num_rows, held[0].nbytes)
    if held:
        all_ = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        yield all_, whole(all_)


def binary_array(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column whose i-th cell holds values[offsets[i]:offsets[i + 1]]."""
    width = values.dtype.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * width).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def spread(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of these lengths: the run of each element, and its place in the run."""
    run = np.repeat(np.arange(len(lengths)), lengths)
    ends = np.cumsum(lengths)
    return run, np.arange(len(run)) - np.repeat(ends - lengths, lengths)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base and of its inverse, modulo 2**64."""
    a = np.full(n, _BASE, np.uint64)
    b = np.full(n, _INVERSE, np.uint64)
    if n:
        a[0] = b[0] = 1
    return np.cumprod(a), np.cumprod(b)


def prefix_hash(symbols: np.ndarray, up: np.ndarray) -> np.ndarray:
    """Running polynomial sums: the hash of symbols[i:j] is (c[j] - c[i]) * down[i]."""
    c = np.empty(len(symbols) + 1, np.uint64)
    c[0] = 0
    np.cumsum(symbols * up[: len(symbols)], out=c[1:])
    return c


#: Random odd symbol values of the 256 bytes.
BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64)) | _U(1)

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACE.encode())] = True


def words(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, byte after the last, words before each document) of the words of all documents."""
    solid = ~_IS_SPACE[data]
    first = solid.copy()
    last = solid.copy()
    if len(data):
        first[1:] &= ~solid[:-1]
        last[:-1] &= ~solid[1:]
        inner = offsets[1:-1]
        inner = inner[(inner > 0) & (inner < len(data))]
        first[inner] = solid[inner]
        last[inner - 1] = solid[inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, block: int = 1 << 15) -> np.ndarray:
    """A 64-bit hash of each word's bytes, in blocks that stay in the processor's cache and share their powers."""
    out = np.empty(len(start), np.uint64)
    up, down = powers(min(block, len(data)))
    i = 0
    while i < len(start):
        stop = max(i + 1, int(np.searchsorted(end, start[i] + block, "right")))
        lo, hi = int(start[i]), int(end[stop - 1])
        if hi - lo > len(up):  # one long word
            up, down = powers(hi - lo)
        c = prefix_hash(BYTE_VALUE[data[lo:hi]], up)
        a, b = start[i:stop] - lo, end[i:stop] - lo
        out[i:stop] = mix((c[b] - c[a]) * down[a] + (b - a).astype(np.uint64))
        i = stop
    return out


def minimizer_runs(grams: np.ndarray, valid: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The leftmost smallest gram of each window of ``width`` grams.

    grams: hashes, fewer than 2**20; valid: whether the window that starts at
    a gram counts.  Returns (gram, first window, last window) for each run of
    valid windows that choose the same gram.  The choice depends on the
    window's own grams alone, so equal windows choose the same place anywhere.
    """
    n = len(grams) - width + 1
    if n <= 0 or not valid[:n].any():
        z = np.empty(0, np.int64)
        return z, z, z
    v = (grams >> _U(20) << _U(20)) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        v = np.minimum(v[:-span], v[span:])
        span *= 2
    if span < width:
        v = np.minimum(v[: len(v) - (width - span)], v[width - span :])
    at = np.where(valid[:n], (v & _U(2**20 - 1)).astype(np.int64), -1)
    cut = np.flatnonzero(np.diff(at)) + 1
    lo, hi = np.concatenate([[0], cut]), np.concatenate([cut, [n]]) - 1
    ok = at[lo] >= 0
    return at[lo][ok], lo[ok], hi[ok]


def covered(starts: np.ndarray, stops: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in any of the ranges."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, stops, -1)
    return np.cumsum(edge[:-1]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


ship_by_value(sys.modules[__name__])
