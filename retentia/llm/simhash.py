"""Near-duplicates by SimHash fingerprints.

A fingerprint has 64 bits; bit b is set if it is set in more than half of
the XXH64 hashes (seed 42) of the text's shingles of three words, repeats
included.  Fingerprints that differ in at most ``distance`` bits are linked,
and documents reachable over links share a component.

Pigeonhole: the 64 bits are split into ``BLOCKS`` blocks.  Two fingerprints
with at most ``distance`` different bits agree in ``BLOCKS - distance`` blocks
at least, so there is a table for each choice of that many blocks, and its
key is the fingerprint's bits in them (for 3 bits and 6 blocks 20 tables of
31 to 33 key bits, which unrelated fingerprints seldom share).  Every pair of
different fingerprints that share a key in a table is compared by its Hamming
distance, so no link is lost.

Copies cost nothing: equal fingerprints are one node.  A key that many
different fingerprints share is dealt out in pairs of blocks of about
``PART`` fingerprints, so its work spreads over tasks and none holds more than
two blocks; from each pair of blocks only links that join what is not yet
joined there go on (fewer than its fingerprints), never all pairs.  Links
make components by alternating stars (``components``).

Defined cases: null, empty and wordless texts have fingerprint zero, which is
linked like any other; a text of one or two words is one shingle; repeated
rows get equal rows; rows of one id with different texts have each their own
fingerprint; a null id ranks after all others and comes back as null; any
length is read whole; an empty table gives an empty result; other columns are
ignored, or passed through by ``keep_one``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentia.llm.common import NULL_ID, did, groups, keep_rows, shuffle_partitions, text_hash
from retentia.llm.components import components
from retentia.session import scratch_path, ship_by_value

_U = np.uint64
SHINGLE, SEED, DISTANCE = 3, 42, 3
BLOCKS = 6
#: Different fingerprints of a key that one block holds.
PART = 1024


def shingle_hashes(text: bytes, digest, size: int = SHINGLE) -> list[int]:
    """XXH64 of the space-joined shingles of a text (A-Z lowered); one of all words if they are fewer."""
    words = text.lower().split()  # bytes: ASCII letters and ASCII white space alone
    if not words:
        return []
    whole = b" ".join(words)
    if len(words) <= size:
        return [digest(whole, SEED)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[: len(words) - size] + 1])
    return [digest(whole[a:b], SEED) for a, b in zip(starts.tolist(), ends[size - 1 :].tolist())]


def majority(hashes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For runs of 64-bit hashes the bits set in over half of each run."""
    counts = np.empty((len(starts), 64), np.int64)
    for k in range(8):
        # Bits k, k + 8, ... as byte counters; runs are cut so that no counter passes 255.
        lanes = (hashes >> _U(k)) & _U(0x0101010101010101)
        counts[:, k::8] = _lane_sums(lanes, starts, lengths)
    weight = _U(1) << np.arange(64, dtype=np.uint64)
    return np.where(2 * counts > lengths[:, None], weight, _U(0)).sum(axis=1, dtype=np.uint64)


def _lane_sums(lanes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, most: int = 255) -> np.ndarray:
    pieces = -(-lengths // most)
    run = np.repeat(np.arange(len(starts)), pieces)
    inside = np.arange(len(run)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    sums = np.add.reduceat(lanes, starts[run] + inside * most)
    return np.add.reduceat(sums.astype("<u8").view(np.uint8).reshape(-1, 8), np.cumsum(pieces) - pieces, axis=0, dtype=np.int64)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    digest = xxhash.xxh64_intdigest
    for batch in batches:
        out = np.zeros(batch.num_rows, np.uint64)
        hashes, rows, held = [], [], 0
        for k, x in enumerate(batch.column(2)):
            h = shingle_hashes((x.as_py() or "").encode(), digest)
            if h:
                hashes.append(np.array(h, np.uint64))
                rows.append(k)
                held += len(h)
            if rows and (held > 1 << 17 or k == batch.num_rows - 1):
                lengths = np.array([len(h) for h in hashes])
                out[rows] = majority(np.concatenate(hashes), np.cumsum(lengths) - lengths, lengths)
                hashes, rows, held = [], [], 0
        if rows:
            lengths = np.array([len(h) for h in hashes])
            out[rows] = majority(np.concatenate(hashes), np.cumsum(lengths) - lengths, lengths)
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(out.view(np.int64))], names=["_rt_did", "_rt_th", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(_rt_did, _rt_th, fp) per row; fp holds the 64 bits as a long."""
    return docs.select(did(), text_hash(), "text").mapInArrow(_fingerprints, "_rt_did long, _rt_th long, fp long")


def masks(distance: int = DISTANCE, blocks: int = BLOCKS) -> list[int]:
    """The bits of each table's key: every choice of blocks - distance blocks."""
    if not 0 <= distance < blocks <= 64:
        raise ValueError("distance must be below the number of blocks, at most 64")
    edge = [64 * k // blocks for k in range(blocks + 1)]
    part = [(1 << b) - (1 << a) for a, b in zip(edge, edge[1:])]
    return [sum(part[k] for k in chosen) for chosen in combinations(range(blocks), blocks - distance)]


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def spanning_links(fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of at most ``distance`` bits that join all that such links join, fewer than the fingerprints: a breadth-first forest."""
    left = np.arange(len(fp))
    u, v = [], []
    while len(left):
        wave, left = [left[0]], left[1:]
        while wave and len(left):
            at = wave.pop()
            near = np.bitwise_count(fp[left] ^ fp[at]) <= distance
            if near.any():
                found, left = left[near], left[~near]
                u.append(np.full(len(found), at))
                v.append(found)
                wave.extend(found.tolist())
    return (np.concatenate(u), np.concatenate(v)) if u else (np.empty(0, np.int64), np.empty(0, np.int64))


def _linked(distance: int):
    """Links inside the groups of batches (table, key, low, high, fp) sorted by the first four."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, bounds in groups(batches, 4):
            fp = batch.column(4).to_numpy().view(np.uint64)
            size = np.diff(bounds)
            two = bounds[:-1][size == 2]
            two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= distance]
            u, v = [two], [two + 1]
            for k in np.flatnonzero(size > 2).tolist():
                a, b = spanning_links(fp[bounds[k] : bounds[k + 1]], distance)
                u.append(a + bounds[k])
                v.append(b + bounds[k])
            u, v = np.concatenate(u), np.concatenate(v)
            yield pa.RecordBatch.from_arrays([pa.array(fp[u].view(np.int64)), pa.array(fp[v].view(np.int64))], names=["u", "v"])

    return run


def links(different: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, part: int = PART) -> DataFrame:
    """Links (u, v) between different fingerprints (fp, each once) that join all fingerprints within ``distance`` bits of each other."""
    tables = F.array(*[F.struct(F.lit(t).cast("byte").alias("table"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in enumerate(masks(distance, blocks))])
    keys = different.select("fp", F.inline(tables))
    shared = keys.groupBy("table", "key").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / part)
    dealt = keys.join(shared, ["table", "key"]).withColumn("own", F.pmod(F.xxhash64("fp"), parts))
    # Each block meets every other one; a key of one block meets itself.
    other = F.explode(F.when(parts == 1, F.array(F.lit(0).cast("long"))).otherwise(F.filter(F.sequence(F.lit(0).cast("long"), parts - 1), lambda x: x != F.col("own"))))
    pairs = dealt.withColumn("other", other).select("table", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fp")
    n = shuffle_partitions(different.sparkSession)
    met = pairs.repartition(n, "table", "key", "low", "high").sortWithinPartitions("table", "key", "low", "high", "fp")
    return met.mapInArrow(_linked(distance), "u long, v long").distinct()


def document_components(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(_rt_did, _rt_th, fp, least, least_th) per row; least is the smallest id of the component, least_th the least hash among that id's texts in it."""
    spark = docs.sparkSession
    path = scratch_path(spark, "simhash")
    fingerprints(docs).write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    rows.groupBy("fp").agg(F.min(F.struct("_rt_did", "_rt_th")).alias("first")).write.parquet(f"{path}/different")
    different = spark.read.parquet(f"{path}/different")
    roots = components(links(different.select("fp"), distance))
    rooted = different.join(roots, different["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    found = rooted.join(least, "root").select("fp", F.col("least._rt_did").alias("least"), F.col("least._rt_th").alias("least_th"))
    return rows.join(found, "fp")


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def simhash_report(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint, component_id: one row per document row."""
    own = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return document_components(docs, distance).select(own("_rt_did").alias("doc_id"), hexadecimal(F.col("fp")).alias("fingerprint"), own("least").alias("component_id"))


def keep_one(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """The rows of each component's smallest id; of its texts in the component the one of the least hash. Columns as in the input."""
    found = document_components(docs, distance)
    return keep_rows(docs, found.where((F.col("_rt_did") == F.col("least")) & (F.col("_rt_th") == F.col("least_th"))))


ship_by_value(sys.modules[__name__])
