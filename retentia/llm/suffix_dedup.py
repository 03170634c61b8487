"""Suffix-array de-duplication of bytes that an earlier document already holds.

A byte goes if a string of ``size`` bytes over it also starts in a document
of smaller id; the first document keeps it.

1. Exact filter.  The anchors (``repeats``) of all strings are compared by
   hash; only strings whose anchor occurs again can have an earlier copy.
2. Suffix order.  Each batch cuts the context of every surviving anchor:
   the bytes of all strings that choose it, without the gram.  Equal contexts
   are settled in the batch, then in the shard (the smallest id waits, the
   others are covered), so at most one of each goes on.  What differs within
   a gram is put in suffix order, to the depth of ``size`` bytes.
3. Longest previous factors.  In suffix order, the nearest earlier positions
   before and after a suffix (previous and next smaller value of its
   document's rank) share the longest prefixes with it that any earlier
   position does.  Where that longest previous factor reaches ``size``, the
   string is a later copy.  As factors beyond ``size`` decide nothing, the
   order is cut at that depth, which also bounds what a suffix needs.

Answers go back by batch and are joined to the texts, whose shuffle Spark
reuses.

Defined cases: a null or empty text has no bytes; a text shorter than
``size`` loses nothing; strings never cross documents; rows of one id are
the same document, so they never remove each other's bytes; a null id ranks
last; an empty table gives an empty result; other columns pass through
``remove_copies`` (a text that loses bytes keeps what decodes) and are
ignored by the report.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentia.llm.common import BYTE_VALUE, covered, keyed_texts, mix, portions, powers, prefix_hash, replace_text, runs, shuffle_partitions, spread, string_buffers, with_keys
from retentia.llm.repeats import ENTRY, PLACED, SETTLED, anchor_steps, batch_name, found_again, is_in, keys_row, one_each, pack, pack_sorted, placed, places_of, repeat_rows, settle, settled_row, shard_count, shard_slices, unpack, unpack_sorted, window_starts
from retentia.session import ship_by_value

_KEYS = ["_rt_did", "_rt_th"]
#: Strings of one anchor fit in this many bits of a place: first start << BITS | number of starts.
BITS = 16


def _anchors(size: int, gram: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 3):
            offsets, data = string_buffers(batch.column(3))
            at, hashes = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
            for s in anchor_steps(lambda i, j: BYTE_VALUE[data[i:j]], len(data), size, gram, window_starts(offsets, size)):
                at.append(s.at)
                hashes.append(s.grams)
            place, where = np.unique(np.concatenate(at), return_index=True)
            doc = np.searchsorted(offsets, place, "right") - 1
            dids, ths = _ids(batch)
            yield placed(repeat_rows(batch_name(dids, ths), dids, ths, doc, place - offsets[doc], np.concatenate(hashes)[where], None, shards))

    return run


def _ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))


def _contexts(size: int, gram: int, shards: int):
    """Sends each surviving anchor's context once, with the smallest id that has it in the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 3):
            offsets, data = string_buffers(batch.column(3))
            dids, ths = _ids(batch)
            name = batch_name(dids, ths)
            survivors = places_of(batch.column(4), offsets)
            parts: list[tuple] = []
            for s in anchor_steps(lambda i, j: BYTE_VALUE[data[i:j]], len(data), size, gram, window_starts(offsets, size)):
                hit = is_in(s.at, survivors)
                lo, hi = s.first[hit], s.last[hit]
                parts.append((s.grams[hit], s.hashes(lo, hi + size), lo, hi - lo + 1, s.at[hit] - lo))
            rows = [keys_row(name, dids, ths, shards)]
            if parts:
                grams, contexts, lo, count, ahead = (np.concatenate(x) for x in zip(*parts))
                doc = np.searchsorted(offsets, lo, "right") - 1
                order = np.lexsort((dids[doc], count, contexts, grams))
                grams, contexts, lo, count, ahead, doc = grams[order], contexts[order], lo[order], count[order], ahead[order], doc[order]
                new = np.ones(len(grams), bool)
                new[1:] = (grams[1:] != grams[:-1]) | (contexts[1:] != contexts[:-1]) | (count[1:] != count[:-1])
                least = dids[doc][np.flatnonzero(new)][np.cumsum(new) - 1]
                late = dids[doc] > least
                place = (lo - offsets[doc]) << BITS | count
                rows.append(settled_row(name, doc[late], place[late], shards))
                # Of equal contexts of the smallest id, all wait for one answer.
                wait = ~late
                grams, lo, count, ahead, doc, place, new = grams[wait], lo[wait], count[wait], ahead[wait], doc[wait], place[wait], new[wait]
                for k, i, j in shard_slices(grams, shards):
                    # The bytes before and after the gram; the gram itself is known by its hash.
                    head, before = new[i:j], ahead[i:j]
                    run_of, inside = spread(np.where(head, count[i:j] + size - 1 - gram, 0))
                    raw = data[lo[i:j][run_of] + inside + gram * (inside >= before[run_of])]
                    marks = np.where(head, before + 1, 0)
                    rows.append((k, ENTRY, name, pack_sorted(grams[i:j]), pack(doc[i:j].astype(np.int32)), pack(place[i:j]), pack(np.concatenate([dids[doc[i:j]], marks])), pack(raw)))
            yield placed(rows)

    return run


def suffix_order(raw: np.ndarray, starts: np.ndarray, group: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(order of the suffixes at these starts by group, then by their first ``size`` bytes, whether each equals the one before it to that depth)."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    order = np.argsort(group, kind="stable")
    same = np.zeros(len(starts), bool)
    same[1:] = group[order[1:]] == group[order[:-1]]
    # Most significant bytes first, eight at a time; only ties are sorted on.
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
    for depth in range(0, size, 8):
        tied = same.copy()
        tied[:-1] |= same[1:]
        t = np.flatnonzero(tied)
        if not len(t):
            break
        key = np.ascontiguousarray(eight[starts[order[t]] + depth]).view(">u8").ravel().astype(np.uint64)
        if size - depth < 8:
            key >>= np.uint64(8 * (8 - (size - depth)))
        cluster = np.cumsum(~same)[t]
        inner = np.lexsort((key, cluster))
        order[t], key = order[t][inner], key[inner]
        same[t[1:]] &= key[1:] == key[:-1]
    return order, same


def has_previous_factor(order: np.ndarray, same: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Whether the longest previous factor of each suffix reaches the order's depth.

    Within a run of suffixes that agree to that depth, the previous or next
    smaller rank exists exactly where the rank isn't the run's least one;
    outside the run, common prefixes are shorter.
    """
    out = np.zeros(len(order), bool)
    if len(order):
        head = np.flatnonzero(~same)
        r = rank[order]
        least = np.minimum.reduceat(r, head)
        out[order] = r > np.repeat(least, np.diff(np.append(head, len(order))))
    return out


#: Suffixes sorted at once, but for a gram with more.
SORTED = 1 << 19


def _compare(size: int, gram: int):
    """Entries of one shard: which starts of their contexts have earlier copies."""
    rest = size - gram

    def compare(entries: list[tuple]) -> list[tuple]:
        cols: list[list[np.ndarray]] = [[] for _ in range(7)]
        for k, (_, a, b, c, d, e) in enumerate(entries):
            g, both = unpack_sorted(a), unpack(d)
            for col, x in zip(cols, (g, unpack(b), unpack(c), both[: len(g)], both[len(g) :], unpack(e), np.full(len(g), k))):
                col.append(x)
        grams, doc, place, did, mark, raw, source = (np.concatenate(x) for x in cols)
        count, head = place & ((1 << BITS) - 1), mark > 0
        group = np.cumsum(head) - 1  # the head, and so the context, of each waiting entry
        h = np.flatnonzero(head)
        hg, hc, hd, ahead = grams[h], count[h], did[h], mark[h] - 1
        length = hc + rest - 1
        text = np.cumsum(length) - length  # where each context stands in raw
        up, down = powers(len(raw))
        sums = prefix_hash(BYTE_VALUE[raw], up)
        context = mix((sums[text + length] - sums[text]) * down[text] + (length << 8 | ahead).astype(np.uint64))
        # Equal contexts: all but those of the smallest id have an earlier copy at every start.
        order = np.lexsort((hd, context, hg))
        g, c = hg[order], context[order]
        new = np.ones(len(order), bool)
        new[1:] = (g[1:] != g[:-1]) | (c[1:] != c[:-1])
        first = order[new][np.cumsum(new) - 1]  # of each context, in order, its head of the smallest id
        stands = np.empty(len(h), np.int64)
        stands[order] = first
        late = hd > hd[stands]
        # Different contexts of one gram are compared suffix by suffix.
        reps = order[new]
        g = hg[reps]
        edge = np.concatenate([[True], g[1:] != g[:-1]])
        alone = edge & np.concatenate([edge[1:], [True]])
        reps, g = reps[~alone], g[~alone]
        base = np.zeros(len(h), np.int64)
        base[reps] = np.cumsum(hc[reps]) - hc[reps]
        gone = np.zeros(int(hc[reps].sum()) + 1, bool)
        edges = np.append(np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])), len(g)) if len(g) else np.zeros(1, np.int64)
        sizes = np.concatenate([[0], np.cumsum(hc[reps])])
        i = 0
        while i < len(reps):
            # A gram's contexts stay together; small grams are sorted in one go.
            j = int(edges[np.searchsorted(edges, max(int(np.searchsorted(sizes, sizes[i] + SORTED, "right")) - 1, i + 1))])
            part = reps[i:j]
            run_of, inside = spread(hc[part])
            # Equal strings have their gram at the same distance from their start.
            number = np.cumsum(np.concatenate([[True], g[i + 1 : j] != g[i : j - 1]]))
            so, same = suffix_order(raw, text[part][run_of] + inside, number[run_of] * (rest + 1) + ahead[part][run_of] - inside, rest)
            gone[base[part][run_of] + inside] = has_previous_factor(so, same, hd[part][run_of])
            i = j
        compared = np.zeros(len(h), bool)
        compared[reps] = True
        run_of, inside = spread(count)
        who = group[run_of]
        at = np.where(compared[stands[who]], base[stands[who]] + inside, len(gone) - 1)
        hit = late[who] | gone[at]
        begin = np.concatenate([[True], run_of[1:] != run_of[:-1]]) if len(run_of) else np.empty(0, bool)
        opened = np.flatnonzero(hit & (begin | ~np.concatenate([[False], hit[:-1]])))
        closed = np.flatnonzero(hit & (np.concatenate([begin[1:], [True]]) | ~np.concatenate([hit[1:], [False]])))
        entry = run_of[opened]
        value = ((place[entry] >> BITS) + inside[opened]) << BITS | (closed - opened + 1)
        cuts = np.searchsorted(source[entry], np.arange(len(entries) + 1))
        return [(entries[k][0], SETTLED, pack(doc[entry[a:b]]), pack(value[a:b])) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if a < b]

    return compare


def later_copies(texts: DataFrame, size: int = 50, gram: int = 24) -> DataFrame:
    """(_rt_did, _rt_th, _rt_at: starts of strings with earlier copies, as runs of first << BITS | number)."""
    shards = shard_count(shuffle_partitions(texts.sparkSession))
    survivors = one_each(settle(texts.mapInArrow(_anchors(size, gram, shards), PLACED), found_again))
    rows = texts.join(survivors.hint("shuffle_hash"), _KEYS)
    return one_each(settle(rows.mapInArrow(_contexts(size, gram, shards), PLACED), _compare(size, gram)))


def _gone(n: int, places: bytes | None, size: int) -> np.ndarray:
    at = np.frombuffer(places or b"", np.int64)
    start = at >> BITS
    return covered(start, start + (at & ((1 << BITS) - 1)) + size - 1, n)


REPORT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_REPORT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def _report(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, places in zip(*(batch.column(k) for k in range(3))):
                raw = np.frombuffer((text.as_py() or "").encode(), np.uint8)
                gone = _gone(len(raw), places.as_py(), size)
                rows.append((doc_id.as_py(), len(raw), int(gone.sum()), len(runs(gone)[0]), hashlib.sha256(raw[~gone].tobytes()).hexdigest()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _REPORT)], schema=_REPORT)

    return run


def _placed_texts(docs: DataFrame) -> DataFrame:
    return keyed_texts(docs).repartition(shuffle_partitions(docs.sparkSession), *_KEYS)


def copy_report(docs: DataFrame, size: int = 50, gram: int = 24) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each document row."""
    texts = _placed_texts(docs)
    found = later_copies(texts, size, gram)
    joined = texts.join(found.hint("shuffle_hash"), _KEYS, "left")
    return joined.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "_rt_at").mapInArrow(_report(size), REPORT)


def remove_copies(docs: DataFrame, size: int = 50, gram: int = 24) -> DataFrame:
    """The documents without bytes that earlier documents hold."""
    found = later_copies(_placed_texts(docs), size, gram)

    @F.pandas_udf("string")
    def kept(text, places):
        def one(t, p):
            raw = np.frombuffer((t or "").encode(), np.uint8)
            return raw[~_gone(len(raw), p, size)].tobytes().decode(errors="ignore")

        return text.combine(places, one)

    joined = with_keys(docs).join(found.hint("shuffle_hash"), _KEYS, "left")
    text = F.when(F.col("_rt_at").isNull(), F.col("text")).otherwise(kept("text", "_rt_at"))
    return joined.withColumn("_rt_kept", text).select(*replace_text(docs, F.col("_rt_kept")))


ship_by_value(sys.modules[__name__])
