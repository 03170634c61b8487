"""Quality rules: word statistics of every text, and compression bands.

A text is compressed whole and in fixed chunks with zstandard.  Its ratio
(compressed / raw bytes) must lie between the limits of its length: below
them it repeats itself, above them it is noise (encoded or random data).
Chunks find the same in one part of a long text; a text goes when more
than ``max_bad_share`` of its chunked bytes lie outside the chunk limits.

The limits are fixed parameters: short texts compress less, so both ends
fall with the length.  Prose of several languages lies at 0.39-0.8.

Python tasks of Arrow batches, no shuffle, so no key can be hot and a lost
executor costs its own splits alone.

Defined cases: a null or empty text has no words, fails the base rule and
is not kept; any length is read whole; repeated rows get equal rows; an
empty table gives an empty result; ``filter_rows`` passes all columns on.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentia.llm.common import SPACE
from retentia.session import ship_by_value


@dataclass(frozen=True)
class Bands:
    """Length limits in bytes with the lowest and highest ratio below each."""

    upto: tuple[float, ...] = (100, 200, 400, 800, 1600, 6400, float("inf"))
    lowest: tuple[float, ...] = (0.50, 0.45, 0.42, 0.38, 0.32, 0.28, 0.25)
    highest: tuple[float, ...] = (2.50, 1.25, 1.00, 0.90, 0.80, 0.74, 0.72)
    level: int = 3
    chunk_bytes: int = 4096
    #: A shorter last chunk is not judged.
    least_chunk: int = 1024
    chunk_lowest: float = 0.25
    chunk_highest: float = 0.74
    max_bad_share: float = 0.2


_SPACES = SPACE.encode()
_SYMBOLS = b"#*$%&|<>"

SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, ratio double, bad_chunk_share double"
_ARROW = pa.schema(
    [("doc_id", pa.int64())]
    + [(c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [("base_failed", pa.bool_()), ("kept", pa.bool_()), ("ratio", pa.float64()), ("bad_chunk_share", pa.float64())]
)


def repeated_in_windows(tokens: list, size: int = 3) -> int:
    """How many words lie in a window of ``size`` words found at least twice."""
    n = len(tokens)
    if n <= size:
        return 0
    number: dict = {}
    ids = np.fromiter((number.setdefault(t, len(number)) for t in tokens), np.int64, n)
    key = ids[: n - size + 1]
    for k in range(1, size):
        # Exact: codes are renumbered before each product, so they stay below n * n.
        if k > 1:
            key = np.unique(key, return_inverse=True)[1]
        key = key * len(number) + ids[k : n - size + 1 + k]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    hit = np.zeros(n, bool)
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    starts = np.flatnonzero(again)
    for k in range(size):
        hit[starts + k] = True
    return int(hit.sum())


def base_statistics(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    raw = text.encode()
    tokens = raw.split()  # splits bytes at ASCII white space only
    spaces = len(raw) - len(raw.translate(None, _SPACES))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(tokens), len(text) - spaces, symbols, len(lines) - len(set(lines)), repeated_in_windows(tokens)


def within_bands(raw: bytes, compress, bands: Bands) -> tuple[bool, float, float]:
    """Verdict, ratio of the whole text, share of chunked bytes outside the chunk limits."""
    n = len(raw)
    if not n:
        return False, 0.0, 0.0
    ratio = len(compress(raw)) / n
    k = next(i for i, top in enumerate(bands.upto) if n < top)
    bad = judged = 0
    view = memoryview(raw)
    for i in range(0, n, bands.chunk_bytes):
        chunk = view[i : i + bands.chunk_bytes]
        if len(chunk) < bands.least_chunk:
            break
        judged += len(chunk)
        if not bands.chunk_lowest <= len(compress(chunk)) / len(chunk) <= bands.chunk_highest:
            bad += len(chunk)
    share = bad / judged if judged else 0.0
    return bands.lowest[k] <= ratio <= bands.highest[k] and share <= bands.max_bad_share, ratio, share


def _judge(bands: Bands):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compress = zstandard.ZstdCompressor(level=bands.level).compress
        for batch in batches:
            rows = []
            for x in batch.column(1):
                text = x.as_py() or ""
                n, *rest = base_statistics(text)
                failed = n < 50 or 100 * rest[3] > 50 * n
                good, ratio, share = within_bands(text.encode(), compress, bands)
                rows.append((n, *rest, failed, not failed and good, ratio, share))
            cols = list(zip(*rows)) if rows else [()] * 9
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *[pa.array(c, f.type) for c, f in zip(cols, list(_ARROW)[1:])]], schema=_ARROW)

    return run


def quality_report(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """One row per document row with its statistics and verdict."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_judge(bands), SCHEMA)


def _passing(bands: Bands, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compress = zstandard.ZstdCompressor(level=bands.level).compress
        for batch in batches:
            keep = []
            for x in batch.column(at):
                text = x.as_py() or ""
                n, *rest = base_statistics(text)
                keep.append(n >= 50 and 100 * rest[3] <= 50 * n and within_bands(text.encode(), compress, bands)[0])
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def filter_rows(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """The document rows that pass, all columns unchanged."""
    return docs.mapInArrow(_passing(bands, docs.columns.index("text")), docs.schema)


ship_by_value(sys.modules[__name__])
