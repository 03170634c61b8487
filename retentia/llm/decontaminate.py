"""Benchmark decontamination by latent semantic retrieval.

1. Words are runs of letters and digits in lower case (ASCII punctuation
   is a break).  Their document frequencies are counted over all
   documents in a hashed table of fixed size and give the IDF weights.
2. A randomised SVD of TF-IDF passages (``PASSAGE`` words, hashed to
   ``FEATURES`` columns) gives the latent space: tasks multiply their rows
   with a thin matrix, the products are added up, and two power iterations
   with orthonormalisation find the leading right singular vectors.  It is
   fitted on all passages of all documents and items, in whatever number; a text is folded in as
   d V diag(1 / s), which makes unrelated texts nearly orthogonal.
3. Every document is searched whole.  Sums of ``BLOCK`` words in the latent
   space make overlapping passages of 16, 32, 64 ... words; each item is
   compared with those of the first length that holds it.  Cosines of
   ``COSINE`` or more are candidates, and beside them, whatever their
   cosine, all passages whose surroundings hold enough of the item's words
   for a match (``shared_words``, an exact bound over an inverted index of
   the items' rarer words).  So no match of step 4 is lost to the latent
   space.
4. A candidate's surroundings are compared with the item word by word: the
   longest common subsequence must hold ``LCS_SHARE`` of the item's words,
   and of the IDF weight, and its answer part (the last quarter) must be
   there as well, by ``ANSWER_SHARE``.  So paraphrases that keep most words
   in order are found, and texts that share the usual words are not.

The search is a pass of Python tasks with no shuffle; what is broadcast is
the projection and one block of items (at most ``ITEMS`` items or ``ITEM_BYTES``
bytes of them, or one longer item; more items mean more passes, with the same
result).  The driver holds one block at a time.  In a task, passages are
compared with ``AT_ONCE`` items at once.

Defined cases: null and empty texts match nothing; items without a word
(null and empty ones too) match nothing; items of under ``LEAST_WORDS`` words
are too short for a latent vector or a subsequence and match where all their
words stand side by side (cosine and shares are 1); ``drop_contaminated`` leaves
documents that hold such an item alone, as a few usual words prove nothing;
equal items are each reported; repeated rows get equal rows; any length is
searched whole; empty tables give an empty result; other columns are
ignored by ``contaminated_pairs`` and passed on by ``drop_contaminated``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentia.llm.common import bound_batches, mix, portions, shuffle_partitions, spread, string_buffers, word_hashes, words
from retentia.llm.repeats import pack, unpack
from retentia.session import scratch_path, ship_by_value

_U = np.uint64
CELL_BITS = 18
FEATURES = 4096
RANK, OVERSAMPLE, POWER = 96, 8, 2
PASSAGE = 64
#: Passages that are multiplied at once; a written row holds no more.
PASSAGES_AT_ONCE = 4096
BLOCK = 8
SHORTEST = 16
LEAST_WORDS = 5
ITEMS, ITEM_BYTES = 20_000, 1 << 24
AT_ONCE = 1024
COSINE = 0.40
LCS_SHARE = 0.6
#: Share of an item's weight whose words, the commonest, are not in the index of words.
COMMON = 0.2
ANSWER_SHARE = 0.5

_TABLE = np.arange(256, dtype=np.uint8)
for _c in range(128):
    if not chr(_c).isalnum():
        _TABLE[_c] = 32


def lowered(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of the texts in lower case."""
    return string_buffers(pc.utf8_lower(pc.fill_null(col.cast(pa.string()), "")))


def word_keys(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, words before each document)."""
    plain = _TABLE[data]
    start, end, first = words(offsets, plain)
    return word_hashes(plain, start, end), first


def cell(h: np.ndarray) -> np.ndarray:
    return (h >> _U(64 - CELL_BITS)).astype(np.int64)


def feature(h: np.ndarray) -> np.ndarray:
    return (h & _U(FEATURES - 1)).astype(np.int64)


_PART = 1 << 13


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, docs = np.zeros(1 << CELL_BITS, np.int64), 0
    for batch in portions(batches, 0, 1 << 21):
        docs += batch.num_rows
        h, first = word_keys(*lowered(batch.column(0)))
        doc = np.repeat(np.arange(batch.num_rows, dtype=np.uint64), np.diff(first))
        key = np.sort(doc << _U(CELL_BITS) | h >> _U(64 - CELL_BITS))
        if len(key):
            key = key[np.concatenate([[True], key[1:] != key[:-1]])]
        total += np.bincount((key & _U((1 << CELL_BITS) - 1)).astype(np.int64), minlength=len(total))
    parts = [(k, pack(total[k * _PART : (k + 1) * _PART])) for k in range(len(total) // _PART)] + [(-1, pack(np.array([docs])))]
    yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in parts], pa.int32()), pa.array([x for _, x in parts], pa.binary())], names=["part", "sums"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, x in zip(batch.column(0).to_pylist(), batch.column(1)):
            x = unpack(x.as_py())
            total[k] = total[k] + x if k in total else x
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([pack(x) for x in total.values()], pa.binary())], names=["part", "sums"])


_SUMS = "part int, sums binary"


def _sum_parts(sums: DataFrame) -> dict[int, np.ndarray]:
    """Adds packed arrays by part; their number and size are fixed by parameters."""
    n = min(32, shuffle_partitions(sums.sparkSession))
    return {r.part: unpack(r.sums) for r in sums.repartition(n, "part").mapInArrow(_added, _SUMS).collect()}


def idf_weights(docs: DataFrame) -> np.ndarray:
    """The weight of each cell of words."""
    parts = _sum_parts(docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_frequencies, _SUMS))
    n = max(int(parts.get(-1, np.zeros(1, np.int64))[0]), 1)
    share = np.concatenate([parts.get(k, np.zeros(_PART, np.int64)) for k in range((1 << CELL_BITS) // _PART)]) / n
    return np.log((1 + 1e-3) / (share + 1e-3)).astype(np.float32)


def passage_bounds(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end word of each document's passages: ``PASSAGE`` words each, and the last one a rest of up to a quarter more."""
    doc, inside = spread(np.where(np.diff(first) > 0, np.maximum(-(-(np.diff(first) - PASSAGE // 4) // PASSAGE), 1), 0))
    start = first[doc] + inside * PASSAGE
    last = np.concatenate([doc[1:] != doc[:-1], [True]])[: len(doc)]
    return start, np.where(last, first[doc + 1], start + PASSAGE)


_PASSAGES = "sizes binary, features binary, weights binary"


def _weighed_passages(idf: np.ndarray):
    """Blocks of the texts' passages as TF-IDF rows of length 1, sparse: entries of each row, their columns and their values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 0, 1 << 20):
            h, first = word_keys(*lowered(batch.column(0)))
            start, end = passage_bounds(first)
            for i in range(0, len(start), PASSAGES_AT_ONCE):
                lengths = (end - start)[i : i + PASSAGES_AT_ONCE]
                row, inside = spread(lengths)
                own = h[start[i : i + PASSAGES_AT_ONCE][row] + inside]
                # Sorted with their weights in the lower half.
                entry = np.sort((row * FEATURES + feature(own)).astype(np.uint64) << _U(32) | idf[cell(own)].view(np.uint32))
                key = (entry >> _U(32)).astype(np.int64)
                new = np.flatnonzero(np.diff(key, prepend=-1))
                weight = np.add.reduceat(entry.astype(np.uint32).view(np.float32).astype(np.float64), new)
                key = key[new]
                row = key // FEATURES
                norm = np.sqrt(np.bincount(row, weight * weight, len(lengths)))
                columns = np.bincount(row, minlength=len(lengths)), key % FEATURES, weight / np.maximum(norm, 1e-9)[row]
                packed = [pack(x.astype(t)) for x, t in zip(columns, (np.uint16, np.uint16, np.float32))]
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in packed], names=["sizes", "features", "weights"])

    return run


#: Rows of a table that are gathered at once, so that they stay in the processor's cache.
ROWS_AT_ONCE = 1 << 11


def weighed_sums(table: np.ndarray, row: np.ndarray, weight: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """The sum of table[row] * weight over each run of entries; runs follow each other, have these sizes and aren't empty.

    Runs are cut into groups of ``width`` entries, the last one filled up with weights of zero; a small product adds up each group."""
    cut = -(-sizes // width)
    first = np.cumsum(cut) - cut
    run, inside = spread(sizes)
    place = first[run] * width + inside
    n = int(cut.sum())
    rows, weights = np.zeros(n * width, np.int64), np.zeros(n * width, table.dtype)
    rows[place], weights[place] = row, weight
    sums = np.empty((n, 1, table.shape[1]), table.dtype)
    step = max(ROWS_AT_ONCE // width, 1)
    some = np.empty((min(step, n) * width, table.shape[1]), table.dtype)
    for i in range(0, n, step):
        part, k = slice(i * width, (i + step) * width), min(step, n - i)
        np.take(table, rows[part], axis=0, out=some[: k * width], mode="clip")
        np.matmul(weights[part].reshape(k, 1, width), some[: k * width].reshape(k, width, -1), out=sums[i : i + k])
    return sums[:, 0] if n == len(sizes) else np.add.reduceat(sums[:, 0], first, axis=0)


def _products(q: np.ndarray, gram: bool):
    """A'AQ (in parts of rows), or (AQ)'AQ, over the task's passages A."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((q.shape[1], q.shape[1]) if gram else q.shape, np.float64)
        for batch in batches:
            for sizes, features, weights in zip(*(batch.column(k) for k in range(3))):
                sizes, features, weights = (unpack(x.as_py()) for x in (sizes, features, weights))
                sizes = sizes.astype(np.int64)
                y = weighed_sums(q, features, weights, sizes, int(sizes.max()))
                if gram:
                    total += y.T @ y
                    continue
                order = np.argsort(features, kind="stable")
                counts = np.bincount(features, minlength=FEATURES)
                there = np.flatnonzero(counts)
                sums = weighed_sums(y, np.repeat(np.arange(len(sizes)), sizes)[order], weights[order], counts[there], 16)
                total[slice(None) if len(there) == FEATURES else there] += sums
        parts = np.split(total.ravel(), q.shape[1] if gram else 32)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([pack(x) for x in parts], pa.binary())], names=["part", "sums"])

    return run


def latent_space(docs: DataFrame, items: DataFrame, idf: np.ndarray) -> np.ndarray:
    """FEATURES x rank: the projection V diag(1 / s), fitted on all passages of all rows of both tables."""
    spark = docs.sparkSession
    path = scratch_path(spark, "latent")
    for table in (docs, items):
        table.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_weighed_passages(idf), _PASSAGES).write.mode("append").parquet(path)
    passages_ = spark.read.schema(_PASSAGES).parquet(path)
    size = RANK + OVERSAMPLE
    q = np.linalg.qr(np.random.default_rng(5).standard_normal((FEATURES, size)))[0].astype(np.float32)
    for _ in range(POWER):
        parts = _sum_parts(passages_.mapInArrow(_products(q, False), _SUMS))
        z = np.concatenate([parts[k] for k in sorted(parts)]).reshape(FEATURES, size) if parts else np.zeros((FEATURES, size))
        # Directions that the passages lack stay random.
        q = np.linalg.qr(z + 1e-9 * np.random.default_rng(6).standard_normal(z.shape))[0].astype(np.float32)
    parts = _sum_parts(passages_.mapInArrow(_products(q, True), _SUMS))
    value, vector = np.linalg.eigh(np.concatenate([parts[k] for k in sorted(parts)]).reshape(size, size) if parts else np.zeros((size, size)))
    value, vector = value[::-1][:RANK], vector[:, ::-1][:, :RANK]
    good = value > max(value[0], 1e-12) * 1e-6
    return (q @ vector[:, good] / np.sqrt(value[good])).astype(np.float32)


@dataclass(frozen=True)
class Items:
    """Benchmark items in the latent space, by the passage length that they are compared with."""

    ids: list
    words: list[np.ndarray]
    weights: list[np.ndarray]
    idf: np.ndarray
    table: np.ndarray
    by_length: dict[int, tuple[np.ndarray, np.ndarray]]  # length -> (items, unit vectors)
    units: dict[int, np.ndarray]
    index: Index
    short: list[tuple[object, np.ndarray]]  # (id, words) of the items that are matched as phrases


@dataclass(frozen=True)
class Index:
    """The items' rarer words: word number first[w] to first[w + 1] stands in these items, with these weights."""

    vocabulary: np.ndarray
    cells: np.ndarray
    first: np.ndarray
    item: np.ndarray
    weight: np.ndarray
    least: np.ndarray  # weight of rarer words that a match of the item has at least
    length: np.ndarray
    margin: np.ndarray


def index_words(words: list[np.ndarray], weights: list[np.ndarray]) -> Index:
    rows, least = [], np.zeros(len(words))
    for k, (h, w) in enumerate(zip(words, weights)):
        own, at = np.unique(h, return_inverse=True)
        sums = np.bincount(at, w)
        order = np.argsort(w[np.unique(h, return_index=True)[1]], kind="stable")
        # The commonest words, of COMMON of the weight at most, are not looked up; a match may have them all.
        common = np.cumsum(sums[order]) <= COMMON * w.sum()
        least[k] = LCS_SHARE * w.sum() - sums[order][common].sum() - 1e-6
        rare = order[~common]
        rows.append((own[rare], np.full(len(rare), k), sums[rare]))
    h, item, weight = (np.concatenate([np.empty(0, t), *x]) for t, x in zip((np.uint64, np.int64, np.float64), zip(*rows))) if rows else (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0))
    order = np.argsort(h, kind="stable")
    vocabulary, counts = np.unique(h, return_counts=True)
    cells = np.zeros(1 << CELL_BITS, bool)
    cells[cell(vocabulary)] = True
    n = np.array([len(x) for x in words], np.int64)
    return Index(vocabulary, cells, np.concatenate([[0], np.cumsum(counts)]), item[order], weight[order], least, np.array([passage_length(x) for x in n], np.int64), n // 2 + BLOCK)


def passage_length(n: int) -> int:
    return max(SHORTEST, 1 << (int(n) - 1).bit_length())


def passages(blocks: np.ndarray, length) -> np.ndarray:
    """How many passages of this length a text of so many blocks has."""
    width = length // BLOCK
    return np.where(blocks > 0, np.maximum(-(-(blocks - width) // np.maximum(width // 2, 1)), 0) + 1, 0)


def shared_words(h: np.ndarray, first: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, item, passage) of all passages whose surroundings hold so many of an item's words that it can match."""
    none = np.empty(0, np.int64)
    if not len(index.vocabulary):
        return none, none, none
    place = np.flatnonzero(index.cells[cell(h)])
    word = np.minimum(np.searchsorted(index.vocabulary, h[place]), len(index.vocabulary) - 1)
    own = index.vocabulary[word] == h[place]
    place, word = place[own], word[own]
    hit, inside = spread(index.first[word + 1] - index.first[word])
    entry = index.first[word][hit] + inside
    place = place[hit]
    item, doc = index.item[entry], np.searchsorted(first, place, "right") - 1

    def enough(group: np.ndarray, entry: np.ndarray) -> np.ndarray:
        """Which rows' groups have the weight, each word counted once."""
        numbers, group = np.unique(group, return_inverse=True)
        pair, at = np.unique(group * len(index.item) + entry, return_index=True)
        sums = np.bincount(group[at], index.weight[entry[at]], len(numbers))
        least = np.zeros(len(numbers))
        least[group] = index.least[index.item[entry]]
        return (sums >= least)[group]

    if not len(place):
        return none, none, none
    ok = enough(doc * len(index.least) + item, entry)  # in the whole document first
    place, doc, item, entry = place[ok], doc[ok], item[ok], entry[ok]
    length, margin = index.length[item], index.margin[item]
    stride = np.maximum(length // BLOCK // 2, 1) * BLOCK
    inner = place - first[doc]
    low = np.maximum(-(-(inner - length - margin + 1) // stride), 0)
    high = np.minimum((inner + margin) // stride, passages(-(-np.diff(first)[doc] // BLOCK), length) - 1)
    row, inside = spread(np.maximum(high - low + 1, 0))
    if not len(row):
        return none, none, none
    doc, item, entry, passage = doc[row], item[row], entry[row], low[row] + inside
    most = int(passage.max()) + 1
    key = (doc * len(index.least) + item) * most + passage
    key = np.unique(key[enough(key, entry)])
    return key // most // len(index.least), key // most % len(index.least), key % most


def prepare(items: list[tuple], idf: np.ndarray, space: np.ndarray) -> Items:
    ids, keys, found, short = [], [], {}, []
    for item_id, text in items:
        h, _ = word_keys(*lowered(pa.array([text or ""], pa.string())))
        if len(h) >= LEAST_WORDS:
            ids.append(item_id)
            keys.append(h)
        elif len(h):
            short.append((item_id, h))
    for k, h in enumerate(keys):
        length = passage_length(len(h))
        v = (space[feature(h)] * idf[cell(h)][:, None]).sum(axis=0)
        found.setdefault(length, []).append((k, v / max(float(np.linalg.norm(v)), 1e-9)))
    weights = [idf[cell(h)].astype(np.float64) + 1e-3 for h in keys]
    units = {k: v for x in found.values() for k, v in x}
    return Items(ids, keys, weights, idf, space, {n: (np.array([k for k, _ in x]), np.stack([v for _, v in x])) for n, x in sorted(found.items())}, units, index_words(keys, weights), short)


def phrases(h: np.ndarray, first: np.ndarray, short: list[tuple[object, np.ndarray]]) -> Iterator[tuple[int, object]]:
    """(document, item id) of each short item whose words stand side by side in the document."""
    by_first: dict[int, list[tuple[object, np.ndarray]]] = {}
    for item_id, words_ in short:
        by_first.setdefault(int(words_[0]), []).append((item_id, words_))
    for at in np.flatnonzero(np.isin(h, np.array(list(by_first), np.uint64))).tolist() if by_first else ():
        d = int(np.searchsorted(first, at, "right")) - 1
        for item_id, words_ in by_first[int(h[at])]:
            if at + len(words_) <= first[d + 1] and (h[at : at + len(words_)] == words_).all():
                yield d, item_id


#: Cells of a table of lengths; larger ones are split in two, so that memory stays linear.
CELLS = 1 << 22


def _lengths(item: np.ndarray, text: np.ndarray, keep: bool) -> np.ndarray:
    """Lengths of the longest common subsequences of prefixes: of all prefixes of the text, or of the whole text alone."""
    rows = np.zeros((len(text) + 1 if keep else 2, len(item) + 1), np.int32)
    for i, w in enumerate(text):
        a, b = (rows[i], rows[i + 1]) if keep else (rows[i % 2], rows[(i + 1) % 2])
        # The classic recurrence; the running maximum carries the row's left neighbour.
        b[1:] = np.maximum(a[1:], np.where(item == w, a[:-1] + 1, 0))
        np.maximum.accumulate(b, out=b)
    return rows if keep else rows[len(text) % 2]


def common_subsequence(item: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Which places of ``item`` lie on a longest common subsequence with ``text``."""
    text = text[np.isin(text, item)]
    n = len(item)
    if n > 1 and len(text) > 1 and n * len(text) > CELLS:
        middle = len(text) // 2
        both = _lengths(item, text[:middle], False) + _lengths(item[::-1], text[middle:][::-1], False)[::-1]
        k = int(np.argmax(both))
        return np.concatenate([common_subsequence(item[:k], text[:middle]), common_subsequence(item[k:], text[middle:])])
    table = _lengths(item, text, True)
    on = np.zeros(n, bool)
    i, j = len(text), n
    while i and j:
        if table[i, j] == table[i - 1, j]:
            i -= 1
        elif table[i, j] == table[i, j - 1]:
            j -= 1
        else:
            on[j - 1] = True
            i, j = i - 1, j - 1
    return on


def check_match(item: np.ndarray, weight: np.ndarray, text: np.ndarray) -> tuple[float, float, float] | None:
    """(share of the item's words on the common subsequence, the same by IDF weight, the same of its answer part) of a match."""
    on = common_subsequence(item, text)
    answer = slice(len(item) - max(3, len(item) // 4), None)
    shares = on.mean(), weight[on].sum() / weight.sum(), on[answer].mean()
    return shares if shares[0] >= LCS_SHARE and shares[1] >= LCS_SHARE and shares[2] >= ANSWER_SHARE else None


def pairs_added(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For runs of rows of these sizes: the sums of each run's neighbours in pairs, an odd last row alone."""
    run, inside = spread(-(-sizes // 2))
    at = (np.cumsum(sizes) - sizes)[run] + 2 * inside
    out = rows[at]
    two = np.flatnonzero(2 * inside + 1 < sizes[run])
    out[two] += rows[at[two] + 1]
    return out


def search(offsets: np.ndarray, data: np.ndarray, items: Items) -> Iterator[tuple[int, int, float, float, float, float]]:
    """(document, item, cosine, and the shares of ``check_match``) of each match."""
    h, first = word_keys(offsets, data)
    n = np.diff(first)
    doc_of, inside = spread(-(-n // BLOCK))
    if not len(doc_of):
        return
    starts = first[doc_of] + inside * BLOCK
    blocks = np.bincount(doc_of, minlength=len(n))
    before = np.concatenate([[0], np.cumsum(blocks)])
    sums = weighed_sums(items.table, feature(h), items.idf[cell(h)], np.diff(starts, append=len(h)), BLOCK)
    best: dict[tuple[int, int], list[tuple[int, int, float]]] = {}
    # Sums of each document's halves of passages: lengths are powers of two and overlap by half.
    half, halves, size = sums, blocks, 1
    for length, (which, vectors) in items.by_length.items():
        stride = max(length // BLOCK // 2, 1)
        while size < stride:
            half, halves, size = pairs_added(half, halves), -(-halves // 2), size * 2
        doc, k = spread(passages(blocks, length))
        s = before[doc] + k * stride
        at_half = (np.cumsum(halves) - halves)[doc] + k
        two = k + 1 < halves[doc]
        for i in range(0, len(s), 1 << 11):
            part = slice(i, i + (1 << 11))
            v = half[at_half[part]]
            more = np.flatnonzero(two[part])
            v[more] += half[at_half[part][more] + 1]
            norm = np.maximum(np.sqrt(np.einsum("ij,ij->i", v, v)), 1e-9)[:, None]
            for c0 in range(0, len(vectors), AT_ONCE):
                product = v @ vectors[c0 : c0 + AT_ONCE].T
                for w, c in zip(*(x.tolist() for x in np.divmod(np.flatnonzero(product >= COSINE * norm), product.shape[1]))):
                    d = int(doc[i + w])
                    at = int(first[d] + (s[i + w] - before[d]) * BLOCK)
                    best.setdefault((d, int(which[c0 + c])), []).append((at, min(at + length, int(first[d + 1])), float(product[w, c] / norm[w, 0])))
    for d, k, j in zip(*(x.tolist() for x in shared_words(h, first, items.index))):
        width = int(items.index.length[k]) // BLOCK
        s = int(before[d]) + j * max(width // 2, 1)
        at = int(first[d]) + (s - int(before[d])) * BLOCK
        found = best.setdefault((d, k), [])
        if all(at != x[0] for x in found):
            v = sums[s : min(s + width, int(before[d + 1]))].sum(axis=0)
            found.append((at, min(at + width * BLOCK, int(first[d + 1])), float(v @ items.units[k] / max(float(np.linalg.norm(v)), 1e-9))))
    names = h.tolist() if best else []
    for (d, k), found in best.items():
        item, weight, done = items.words[k], items.weights[k], None
        own, need = list(zip(item.tolist(), weight.tolist())), LCS_SHARE * weight.sum()
        margin = len(item) // 2 + BLOCK
        for a, b, c in sorted(found, key=lambda x: -x[2]):
            a, b = max(a - margin, int(first[d])), min(b + margin, int(first[d + 1]))
            there = set(names[a:b])
            # No subsequence holds more than the words in common.
            if sum([w for x, w in own if x in there]) < need:
                continue
            shares = check_match(item, weight, h[a:b])
            if shares and (done is None or shares[0] > done[1]):
                done = (c, *map(float, shares))
                if shares[0] == 1:
                    break
        if done:
            yield (d, k, *done)


HITS = "doc_id long, item_id long, cosine double, lcs_share double, weight_share double, answer_share double"
_HITS = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), *[(x, pa.float64()) for x in ("cosine", "lcs_share", "weight_share", "answer_share")]])


def _pairs(items: Items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 1, 1 << 20):
            ids = batch.column(0).to_pylist()
            texts = lowered(batch.column(1))
            rows = [(ids[d], items.ids[k], *rest) for d, k, *rest in search(*texts, items)]
            if items.short:
                rows += [(ids[d], item_id, 1.0, 1.0, 1.0, 1.0) for d, item_id in dict.fromkeys(phrases(*word_keys(*texts), items.short))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _HITS)], schema=_HITS)

    return run


def _clean(items: Items, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, at, 1 << 20):
            hit = {d for d, *_ in search(*lowered(batch.column(at)), items)}
            yield batch.filter(pa.array([d not in hit for d in range(batch.num_rows)], pa.bool_()))

    return run


def item_blocks(docs: DataFrame, benchmark: DataFrame) -> Iterator[Items]:
    """The benchmark in blocks, folded into one latent space of the documents and all items."""
    spark = docs.sparkSession
    bound_batches(spark)
    path = scratch_path(spark, "items")
    benchmark.select("item_id", "text").orderBy("item_id", "text").write.parquet(path)
    written = spark.read.parquet(path)
    if written.isEmpty():
        return
    idf = idf_weights(docs)
    space = latent_space(docs, written, idf)
    block, size = [], 0
    for r in written.toLocalIterator():  # one file's rows at a time
        more = len((r.text or "").encode())
        if block and (len(block) == ITEMS or size + more > ITEM_BYTES):
            yield prepare(block, idf, space)
            block, size = [], 0
        block.append((r.item_id, r.text))
        size += more
    yield prepare(block, idf, space)


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document row and benchmark item that it holds."""
    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    path, done, last = scratch_path(spark, "hits"), 0, None
    for items in item_blocks(docs, benchmark):
        if last is not None:  # all blocks but the last are written, so that the plan holds one
            last.write.parquet(f"{path}/{done}")
            done += 1
        last = own.mapInArrow(_pairs(items), HITS)
    if last is None:
        return spark.createDataFrame([], HITS)
    return last.unionByName(spark.read.schema(HITS).parquet(*[f"{path}/{k}" for k in range(done)])) if done else last


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The document rows that hold no benchmark item, all columns unchanged."""
    out = docs
    for items in item_blocks(docs, benchmark):
        out = out.mapInArrow(_clean(items, docs.columns.index("text")), docs.schema)
    return out


ship_by_value(sys.modules[__name__])
