"""Near-duplicate documents by improved consistent weighted sampling.

A document is a weighted set: its shingles of five words, weighed by TF-IDF.
Document frequencies are counted over all documents in a hashed table of
fixed size.  With p a table cell's share of the documents,

    weight = count in the text * (1 + ln((1 + P0) / (p + P0)))

so that weights don't depend on the corpus size: a shingle of every document
weighs half of a rare one, and one that thousands of copies hold among many
documents about as much as a rare one, so large groups keep their links.

Improved consistent weighted sampling draws, for each of ``bands * rows``
samples, a shingle and a level of its weight; two documents agree in a
sample with the probability of their weighted Jaccard similarity.  Samples
are banded; documents that share a band are candidates, in buckets of any
size alike.  Pairs whose samples agree in less than ``AGREE`` of all are set
aside (a pair of similarity 0.8 does so once in 20,000), all others are
verified by their exact weighted Jaccard similarity over whole texts.

Pairs are compared and verified inside a task and never leave it.  A bucket
is dealt out in pairs of blocks of about ``PART`` texts or ``PART_BYTES`` bytes,
so a hot bucket spreads over tasks and none holds more than two blocks of it.
A first pass compares samples and keeps the texts that have a candidate; a
second one gets their texts, each once for a pair of blocks, weighs all
candidate pairs at once (products of shingle matrices, or shingle by shingle
where that is less work) and returns one row a text: its number of near
texts, the most similar one, and the least text that the block's links reach.
A pair that shares several bands is compared in the first of them alone, so
numbers of links add up.  Links make groups (``components``).

Exact copies are one class from the start: their smallest id stands for
them, and they take its group.

Defined cases: null and empty texts are copies of each other; texts with
no words are grouped with equal texts alone; a text of one to four words is
one shingle; rows of one id are one document; a null id names no document,
so rows with null ids and different texts are different documents; it ranks
after all others and comes back as null; very long texts are weighed whole; an
empty table gives an empty result; other columns are ignored, or passed through
by ``keep_one``, which keeps one defined row of rows that differ in them alone.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentia.llm.common import NULL_ID, groups, keyed_texts, mix, portions, powers, prefix_hash, shuffle_partitions, spread, string_buffers, with_keys, word_hashes, words
from retentia.llm.components import components
from retentia.llm.repeats import pack, unpack
from retentia.session import scratch_path, ship_by_value

_U = np.uint64
SHINGLE = 5
#: Cells of the document frequency table: 2**CELL_BITS.
CELL_BITS = 18
P0 = 0.5
BANDS, ROWS = 10, 3
AGREE = 0.5
#: Texts, and bytes of text, of a bucket that one block holds.
PART, PART_BYTES = 1024, 1 << 25

_HASH_BITS = 50
_MASK = (1 << _HASH_BITS) - 1


def shingles(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, hash of 50 bits, count) of each document's different shingles; at most 2**14 documents."""
    start, end, first = words(offsets, data)
    symbols = word_hashes(data, start, end)
    n = np.diff(first)
    up, down = powers(len(symbols) + 1)
    sums = prefix_hash(symbols, up)
    doc, inside = spread(np.where(n > 0, np.maximum(n - SHINGLE + 1, 1), 0))
    a = first[doc] + inside
    size = np.minimum(n[doc], SHINGLE)
    h = mix((sums[a + size] - sums[a]) * down[a] + size.astype(np.uint64))
    key = np.sort(doc.astype(np.uint64) << _U(_HASH_BITS) | h >> _U(64 - _HASH_BITS))
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    count = np.diff(np.append(new, len(key)))
    return (key[new] >> _U(_HASH_BITS)).astype(np.int64), key[new] & _U(_MASK), count


def cell(h: np.ndarray) -> np.ndarray:
    return (h >> _U(_HASH_BITS - CELL_BITS)).astype(np.int64)


_BLOCK = 1 << 12


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One packed row per block of the table, and one of the number of documents (block -1)."""
    total, docs = np.zeros(1 << CELL_BITS, np.int64), 0
    for batch in portions(batches, 0, 1 << 21):
        docs += batch.num_rows
        _, h, _ = shingles(*string_buffers(batch.column(0)))
        total += np.bincount(cell(h), minlength=len(total))
    rows = [(k, pack(total[k * _BLOCK : (k + 1) * _BLOCK])) for k in range(len(total) // _BLOCK) if total[k * _BLOCK : (k + 1) * _BLOCK].any()]
    rows.append((-1, pack(np.array([docs], np.int64))))
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["block", "counts"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, x in zip(batch.column(0).to_pylist(), batch.column(1)):
            x = unpack(x.as_py())
            total[k] = total[k] + x if k in total else x
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([pack(x) for x in total.values()], pa.binary())], names=["block", "counts"])


def shingle_weights(docs: DataFrame) -> np.ndarray:
    """The IDF weight of each table cell: 2**CELL_BITS numbers, whatever the corpus."""
    schema = "block int, counts binary"
    counts = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_frequencies, schema)
    blocks = {r.block: unpack(r.counts) for r in counts.repartition(min(32, shuffle_partitions(docs.sparkSession)), "block").mapInArrow(_added, schema).collect()}
    n = max(int(blocks.get(-1, np.zeros(1, np.int64))[0]), 1)
    share = np.concatenate([blocks.get(k, np.zeros(_BLOCK, np.int64)) for k in range((1 << CELL_BITS) // _BLOCK)]) / n
    return (1 + np.log((1 + P0) / (share + P0))).astype(np.float32)


class Sampler:
    """Improved consistent weighted sampling; variates come from tables of 2**16 draws, by 16 bits of a shingle's hash each."""

    def __init__(self, samples: int, seed: int = 11, before: int = 0):
        rng = np.random.default_rng(seed)
        self.r, c = rng.gamma(2.0, 1.0, (2, 1 << 16)).astype(np.float32)
        self.log_c, self.beta = np.log(c), rng.random(1 << 16, dtype=np.float32)
        self.salt = mix(np.arange(before + 1, before + samples + 1, dtype=np.uint64) * _U(0xD1342543DE82EF95))

    def samples(self, h: np.ndarray, weight: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The chosen (shingle, level) of each sample, hashed: one row per document, whose shingles begin at ``starts``."""
        out = np.empty((len(starts), len(self.salt)), np.uint64)
        log_weight = np.log(weight).astype(np.float32)
        lengths = np.diff(np.append(starts, len(h)))
        low = _U(0xFFFF)
        for k, salt in enumerate(self.salt):
            x = (h ^ salt) * _U(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> _U(31))) * _U(0x94D049BB133111EB)
            r, beta = self.r[(x >> _U(48))], self.beta[x >> _U(32) & low]
            level = np.floor(log_weight / r + beta)
            log_a = self.log_c[x >> _U(16) & low] - r * (level - beta) - r
            best = np.flatnonzero(log_a == np.repeat(np.minimum.reduceat(log_a, starts), lengths))
            # Of equal values, the first shingle in hash order.
            best = best[np.searchsorted(best, starts)]
            out[:, k] = mix(h[best] ^ level[best].astype(np.int64).astype(np.uint64) * _U(0xA24BAED4963EE407))
        return out


SIGNED = "_rt_did long, _rt_th long, _rt_c2 long, size long, sig binary, bands array<long>"


def _signatures(weights: np.ndarray, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(bands * rows)
        for batch in portions(batches, 3, 1 << 20):
            doc, h, count = shingles(*string_buffers(batch.column(3)))
            n = batch.num_rows
            sig, keys = [None] * n, [None] * n
            if len(h):
                starts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
                s = sampler.samples(h, count * weights[cell(h)], starts)
                short = (s >> _U(32)).astype(np.uint32)
                key = np.zeros((len(s), bands), np.uint64)
                for j in range(rows):
                    key = mix(key * _U(0x2545F4914F6CDD1D) + s[:, j::rows])
                key = mix(key + np.arange(bands, dtype=np.uint64)).view(np.int64)
                for i, d in enumerate(doc[starts].tolist()):
                    sig[d], keys[d] = short[i].tobytes(), key[i]
            size = pa.array(np.diff(string_buffers(batch.column(3))[0]))
            yield pa.RecordBatch.from_arrays([*(c.cast(pa.int64()) for c in batch.columns[:3]), size, pa.array(sig, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], names=["_rt_did", "_rt_th", "_rt_c2", "size", "sig", "bands"])

    return run


#: Numbers of documents in the graph: ids as they are, then the texts of null ids, from 2**63 on.
NODE = "decimal(20,0)"


def node(did: str, th: str) -> Column:
    """The document of a row in the graph: its id, or, if that is null, its text."""
    return F.when(F.col(did) != NULL_ID, F.col(did).cast(NODE)).otherwise((F.col(th).cast(NODE) + F.lit(str(2**64)).cast(NODE)).cast(NODE))


def bucket_rows(reps: DataFrame) -> DataFrame:
    """(key, low, high, _rt_did, _rt_th, parts, own, band, sig, bands): the texts of each pair of blocks of each bucket of two texts or more."""
    keys = reps.where("sig IS NOT NULL").select("_rt_did", "_rt_th", "size", F.posexplode("bands").alias("band", "key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).where("n > 1")
    parts = F.greatest(F.ceil(F.col("n") / PART), F.ceil(F.col("bytes") / PART_BYTES)).alias("parts")
    dealt = keys.join(shared.select("key", parts), "key").withColumn("own", F.pmod(F.xxhash64("_rt_did", "_rt_th"), "parts"))
    # Each block meets every other one; a bucket of one block meets itself.
    zero = F.lit(0).cast("long")
    other = F.explode(F.when(F.col("parts") == 1, F.array(zero)).otherwise(F.filter(F.sequence(zero, F.col("parts") - 1), lambda x: x != F.col("own"))))
    pairs = dealt.join(reps.select("_rt_did", "_rt_th", "sig", "bands"), ["_rt_did", "_rt_th"]).withColumn("other", other)
    return pairs.select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "_rt_did", "_rt_th", "parts", "own", "band", "sig", "bands")


BUCKET = "key long, low long, high long, _rt_did long, _rt_th long, parts long, own long, band int, sig binary, bands array<long>"
_WHERE = ["key", "low", "high"]


def block_pairs(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (i < j) of a pair of blocks that agree in enough samples, share no earlier band, and are not another pair of blocks' to compare."""
    low, high, parts, band = (rows.column(k)[0].as_py() for k in (1, 2, 5, 7))
    own = rows.column(6).to_numpy()
    sig = np.stack([np.frombuffer(x.as_py(), np.uint32) for x in rows.column(8)])
    bands = rows.column(9).flatten().to_numpy().reshape(len(sig), -1)[:, :band]
    # Pairs inside a block belong to it and the next one, those inside the last to it and the one before.
    inside = {low} if high == low + 1 else set()
    inside |= {high} if high == parts - 1 and low >= high - 1 else set()
    mine = np.isin(own, list(inside))
    i, j = [], []
    for k in range(len(sig) - 1):
        near = np.count_nonzero(sig[k + 1 :] == sig[k], axis=1) >= AGREE * sig.shape[1]
        near &= (own[k + 1 :] != own[k]) | mine[k]
        at = np.flatnonzero(near) + k + 1
        if len(at):
            at = at[~(bands[at] == bands[k]).any(axis=1)]
            i.append(np.full(len(at), k))
            j.append(at)
    return (np.concatenate(i), np.concatenate(j)) if i else (np.empty(0, np.int64), np.empty(0, np.int64))


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted bucket rows those whose text has a candidate in its pair of blocks."""
    for batch, bounds in groups(batches, 3):
        keep = np.zeros(batch.num_rows, bool)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a > 1:
                for side in block_pairs(batch.slice(a, b - a)):
                    keep[a + side] = True
        if keep.any():
            yield batch.filter(pa.array(keep))


def similarities(doc: np.ndarray, h: np.ndarray, count: np.ndarray, idf: np.ndarray, i: np.ndarray, j: np.ndarray, columns: int = 4096) -> np.ndarray:
    """The weighted Jaccard similarity of the texts i and j of shingle sets (doc, hash, count, weight of one), sorted by doc and hash."""
    n = int(doc[-1]) + 1 if len(doc) else 0
    n = max(n, int(max(i.max(initial=-1), j.max(initial=-1))) + 1)
    total = np.bincount(doc, count * idf, n)
    # Every occurrence of a shingle is a feature; the least of two weights is the sum over the occurrences that both have.
    feature, level = spread(count)
    number = np.unique(h, return_inverse=True)[1][feature]
    order = np.lexsort((level, number))
    new = np.concatenate([[True], (np.diff(number[order]) != 0) | (np.diff(level[order]) != 0)]) if len(order) else np.empty(0, bool)
    held = np.diff(np.append(np.flatnonzero(new), len(order)))
    common = np.repeat(held > 1, held)
    row, weight = doc[feature][order][common], idf[feature][order][common]
    column = np.cumsum(new[common]) - 1
    features = int(column[-1]) + 1 if len(column) else 0
    both = np.zeros(len(i))
    # Seconds by rough unit costs: products of n x n x features, or pair by pair.
    if n * n * features * 1e-10 < len(i) * (3e-5 + 1e-8 * len(h) / max(n, 1)):
        cut = np.searchsorted(column, np.arange(0, features, columns))
        for k, (a, b) in enumerate(zip(cut, [*cut[1:], len(column)])):
            x = np.zeros((n, columns))
            x[row[a:b], column[a:b] - k * columns] = np.sqrt(weight[a:b])
            both += (x @ x.T)[i, j]
    else:
        edge = np.searchsorted(doc, np.arange(n + 1))
        least = lambda a, b: (slice(edge[a], edge[a + 1]), slice(edge[b], edge[b + 1]))
        for k, (a, b) in enumerate(zip(i.tolist(), j.tolist())):
            x, y = least(a, b)
            _, p, q = np.intersect1d(h[x], h[y], assume_unique=True, return_indices=True)
            both[k] = (np.minimum(count[x][p], count[y][q]) * idf[x][p]).sum()
    out = np.zeros(len(i))
    union = total[i] + total[j] - both
    np.divide(both, union, out=out, where=union > 0)
    return out


def least_reached(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least number that each of n numbers reaches over the links a - b."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            return label
        label = new


#: One row a text and pair of blocks: the least text that its links there reach, their number, and the most similar text (the least of equals).
LINKED = "_rt_did long, _rt_th long, to_did long, to_th long, links long, near_did long, near_th long, similarity double"
_LINKED = [f.split()[0] for f in LINKED.split(", ")]


def _verify(weights: np.ndarray, least: float):
    """Batches of sorted bucket rows with their texts: the rows of LINKED of the pairs whose similarity is ``least`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, bounds in groups(batches, 3):
            parts: list[list[np.ndarray]] = []
            did, th = (batch.column(k).to_numpy() for k in (3, 4))
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                if b - a < 2:
                    continue
                rows = batch.slice(a, b - a)
                i, j = block_pairs(rows)
                if not len(i):
                    continue
                doc, h, count = shingles(*string_buffers(rows.column(10)))
                s = similarities(doc, h, count, weights[cell(h)].astype(float), i, j)
                near = s >= least
                i, j, s = i[near], j[near], s[near]
                if not len(i):
                    continue
                n = b - a
                links = np.bincount(i, minlength=n) + np.bincount(j, minlength=n)
                one, two, both = np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([s, s])
                order = np.lexsort((two, -both, one))
                first = order[np.concatenate([[True], np.diff(one[order]) != 0])]
                own, to, best = one[first] + a, least_reached(n, i, j)[one[first]] + a, two[first] + a
                parts.append([did[own], th[own], did[to], th[to], links[one[first]], did[best], th[best], both[first]])
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], names=_LINKED)

    return run


def linked_texts(reps: DataFrame, texts: DataFrame, weights: np.ndarray, threshold: float) -> DataFrame:
    """LINKED rows of all verified pairs; reps: _rt_did, _rt_th, size, sig, bands; texts: _rt_did, _rt_th, text."""
    n = shuffle_partitions(reps.sparkSession)
    order = [*_WHERE, "_rt_did", "_rt_th"]
    met = lambda rows: rows.repartition(n, *_WHERE).sortWithinPartitions(*order)
    live = met(bucket_rows(reps)).mapInArrow(_candidates, BUCKET)
    names = [f.split()[0] for f in BUCKET.split(", ")]
    return met(live.join(texts, ["_rt_did", "_rt_th"]).select(*names, "text")).mapInArrow(_verify(weights, threshold), LINKED)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of (hashes in order, weights) twice."""
    (ha, wa), (hb, wb) = a, b
    if not len(ha) or not len(hb):
        return 0.0
    at = np.minimum(np.searchsorted(hb, ha), len(hb) - 1)
    both = np.where(hb[at] == ha, np.minimum(wa, wb[at]), 0.0).sum(dtype=np.float64)
    return float(both / (wa.sum(dtype=np.float64) + wb.sum(dtype=np.float64) - both))


def near_classes(docs: DataFrame, threshold: float = 0.8, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row for each different (id, text): _rt_did, _rt_th; class_did, the least id of its group; first, whether it is the document that the
    group keeps; links, near_did and similarity: the number of different texts near its own, and the most similar one's id and similarity."""
    weights = shingle_weights(docs)
    spark = docs.sparkSession
    path = scratch_path(spark, "near")
    plain = keyed_texts(docs)
    signed = plain.select("_rt_did", "_rt_th", F.xxhash64(F.lit(1), "text").alias("_rt_c2"), "text").mapInArrow(_signatures(weights, bands, rows), SIGNED)
    signed.write.parquet(f"{path}/signed")
    signed = spark.read.parquet(f"{path}/signed")
    # One representative of each text; th and c2 together are 128 bits of its hash (a null and an empty text differ in th).
    classes = signed.groupBy("_rt_c2", "sig").agg(F.min(F.struct("_rt_did", "_rt_th")).alias("rep"), F.first("bands").alias("bands"), F.first("size").alias("size"))
    reps = classes.select("rep._rt_did", "rep._rt_th", "size", "sig", "bands")
    # A representative that stands in several rows is one text.
    texts = plain.select("_rt_did", "_rt_th", "text").join(reps.select("_rt_did", "_rt_th"), ["_rt_did", "_rt_th"], "left_semi").dropDuplicates(["_rt_did", "_rt_th"])
    linked_texts(reps, texts, weights, threshold).write.parquet(f"{path}/linked")
    linked = spark.read.parquet(f"{path}/linked")
    links = linked.select(node("_rt_did", "_rt_th").alias("u"), node("to_did", "to_th").alias("v"))
    rep_of = classes.select("_rt_c2", "sig", F.col("rep._rt_did").alias("rep_did"), F.col("rep._rt_th").alias("rep_th"))
    same = (signed["_rt_c2"] == rep_of["_rt_c2"]) & signed["sig"].eqNullSafe(rep_of["sig"])
    members = signed.join(rep_of, same).select("_rt_did", "_rt_th", node("_rt_did", "_rt_th").alias("own"), "rep_did", "rep_th", node("rep_did", "rep_th").alias("rep")).distinct()
    # An id with several texts ties their groups together; a null id doesn't.
    several = members.groupBy("own").agg(F.min("rep").alias("v"), F.max("rep").alias("most")).where("v <> most").select("own", "v")
    tied = members.join(several, "own").select(F.col("rep").alias("u"), "v").where("u <> v").distinct()
    roots = components(links.unionByName(tied))
    best = F.max(F.struct("similarity", (-F.col("near_did")).alias("near_did"))).alias("best")
    counts = linked.groupBy(F.col("_rt_did").alias("rep_did"), F.col("_rt_th").alias("rep_th")).agg(F.sum("links").alias("links"), best)
    found = members.join(roots, members["rep"] == roots["node"], "left").withColumn("class", F.coalesce("root", "rep")).join(counts, ["rep_did", "rep_th"], "left")
    return found.select(
        "_rt_did", "_rt_th", F.when(F.col("class") < F.lit(str(2**63)).cast(NODE), F.col("class").cast("long")).otherwise(NULL_ID).alias("class_did"), (F.col("own") == F.col("class")).alias("first"),
        F.coalesce("links", F.lit(0).cast("long")).alias("links"), (-F.col("best.near_did")).alias("near_did"), F.col("best.similarity").alias("similarity"),
    )


def class_report(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """One row per document row: doc_id; class_id, the least doc_id of its near-duplicates; n_links, the number of different texts near its own;
    nearest_id and similarity, the most similar one of them (null where there is none)."""
    own = docs.select("doc_id", "text")
    joined = with_keys(own).select("doc_id", "_rt_did", "_rt_th").join(near_classes(own, threshold), ["_rt_did", "_rt_th"])
    known = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return joined.select(F.col("doc_id").cast("long").alias("doc_id"), known("class_did").alias("class_id"), F.col("links").alias("n_links"), known("near_did").alias("nearest_id"), "similarity")


def keep_one(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """The documents without near-duplicates of a smaller id; columns as they are.

    A kept row that stands several times stays once (if other columns differ,
    the row whose columns as JSON have the least hash); of an id's different texts the
    one of the least hash stays, of a null id's all that have no near-duplicates before them.
    """
    classes = near_classes(docs, threshold)
    own = F.when(F.col("_rt_did") == NULL_ID, F.col("_rt_th"))
    kept = classes.where("first").groupBy("_rt_did", own.alias("own")).agg(F.min("_rt_th").alias("_rt_th"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = with_keys(docs).select("_rt_did", "_rt_th", row.alias("row")).join(kept.select("_rt_did", "_rt_th").hint("shuffle_hash"), ["_rt_did", "_rt_th"], "left_semi")
    one = rows.groupBy("_rt_did", "_rt_th").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return one.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


ship_by_value(sys.modules[__name__])
