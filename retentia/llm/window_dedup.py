"""Substring de-duplication: windows of words that occur more than once, found level by level.

A window of ``window`` words can only be repeated if shorter windows in it
are.  The first level looks at short windows (a sampled one in each window:
its smallest hash, which equal windows choose alike); those found anywhere
else survive.  The next level looks at windows of twice that length, only
where a survivor lies, and so on up to the full length; it stops early where
no candidate is left, as a batch without survivors sends nothing.  At the
full length every surviving window is compared, by 128 bits of hash.

Each level is one exchange of packed hashes (``repeats``) and one join of
the texts with the places that survive; Spark reuses the texts' shuffle.

A repeated window is removed wherever it starts, first occurrence included.

Defined cases: a null or empty text has no words; a text shorter than the
window keeps all; windows never cross documents; a row repeated with the
same id and text counts as another place, so its windows go in both; a null
id is an id like any other; an empty table gives an empty result; other
columns pass through ``remove_repeats`` and are ignored by the report.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentia.llm.common import covered, keyed_texts, mix, portions, replace_text, shuffle_partitions, string_buffers, with_keys, word_hashes, words
from retentia.llm.repeats import PLACED, anchor_steps, batch_name, found_again, is_in, one_each, placed, places_of, repeat_rows, settle, shard_count, window_starts
from retentia.session import ship_by_value

_KEYS = ["_rt_did", "_rt_th"]


def levels(window: int, least: int = 9) -> list[int]:
    """Window lengths, each at most twice the one before, up to ``window``: 35 gives 9, 18, 35."""
    out = [window]
    while out[0] > least:
        out.insert(0, max(least, -(-out[0] // 2)))
    return out


def _candidates(window: int, length: int, before: int | None, shards: int):
    """Sends the hashes of one level; ``before`` is the last level, whose survivors' places come with the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 3):
            offsets, data = string_buffers(batch.column(3))
            start, end, first = words(offsets, data)
            if not len(start):
                continue
            symbols = word_hashes(data, start, end)
            wanted = window_starts(first, window)
            if before is not None:
                survivors, alive = places_of(batch.column(4), first), np.zeros(len(symbols), bool)
                for s in anchor_steps(lambda i, j: symbols[i:j], len(symbols), window, before, wanted):
                    hit = is_in(s.at, survivors)
                    alive |= covered(s.first[hit], s.last[hit] + 1, len(symbols))
                wanted &= alive
            at, hashes, checks = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
            other = mix(symbols ^ np.uint64(0x5851F42D4C957F2D)) if length == window else None
            for s in anchor_steps(lambda i, j: symbols[i:j], len(symbols), window, length, wanted):
                at.append(s.at)
                hashes.append(s.grams)
            if other is not None:
                for s in anchor_steps(lambda i, j: other[i:j], len(symbols), window, length, wanted):
                    checks.append(s.grams)
            place, where = np.unique(np.concatenate(at), return_index=True)
            h = np.concatenate(hashes)[where]
            c = np.concatenate(checks)[where] if other is not None else None
            doc = np.searchsorted(first, place, "right") - 1
            dids, ths = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
            yield placed(repeat_rows(batch_name(dids, ths), dids, ths, doc, place - first[doc], h, c, shards))

    return run


def repeated_windows(texts: DataFrame, window: int) -> DataFrame:
    """(_rt_did, _rt_th, _rt_at: starts of repeated windows as int64 cells); texts: (_rt_did, _rt_th, doc_id, text), partitioned by the keys."""
    shards = shard_count(shuffle_partitions(texts.sparkSession))
    before, found = None, None
    for length in levels(window):
        rows = texts if found is None else texts.join(found.hint("shuffle_hash"), _KEYS)
        found = one_each(settle(rows.mapInArrow(_candidates(window, length, before, shards), PLACED), found_again))
        before = length
    return found


def _kept(raw: bytes, places: bytes | None, window: int) -> tuple[int, list[bytes]]:
    tokens = raw.split()
    if not places:
        return len(tokens), tokens
    at = np.frombuffer(places, np.int64)
    gone = covered(at, at + window, len(tokens))
    return len(tokens), [t for t, g in zip(tokens, gone.tolist()) if not g]


REPORT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
_REPORT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])


def _report(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, places in zip(*(batch.column(k) for k in range(3))):
                n, kept = _kept((text.as_py() or "").encode(), places.as_py(), window)
                rows.append((doc_id.as_py(), n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _REPORT)], schema=_REPORT)

    return run


def _placed_texts(docs: DataFrame) -> DataFrame:
    return keyed_texts(docs).repartition(shuffle_partitions(docs.sparkSession), *_KEYS)


def repeat_report(docs: DataFrame, window: int = 35) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each document row."""
    texts = _placed_texts(docs)
    found = repeated_windows(texts, window)
    joined = texts.join(found.hint("shuffle_hash"), _KEYS, "left")
    return joined.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "_rt_at").mapInArrow(_report(window), REPORT)


def remove_repeats(docs: DataFrame, window: int = 35) -> DataFrame:
    """The documents without the words of repeated windows; a text that loses any has its kept words joined by spaces."""
    found = repeated_windows(_placed_texts(docs), window)

    @F.pandas_udf("string")
    def kept(text, places):
        return text.combine(places, lambda t, p: b" ".join(_kept((t or "").encode(), p, window)[1]).decode())

    joined = with_keys(docs).join(found.hint("shuffle_hash"), _KEYS, "left")
    text = F.when(F.col("_rt_at").isNull(), F.col("text")).otherwise(kept("text", "_rt_at"))
    marked = joined.withColumn("_rt_kept", text)
    return marked.select(*[c for c in replace_text(docs, F.col("_rt_kept"))])


ship_by_value(sys.modules[__name__])
