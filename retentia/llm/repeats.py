"""Finding strings of symbols (bytes or word hashes) that occur more than once.

A task reads whole Arrow batches of documents as one array of symbols.  For
strings of ``size`` symbols it samples anchors: of each string, the place of
its smallest ``gram``-symbol hash.  Equal strings choose the same place, so a
string can only be repeated where its anchor's gram is.  Anchor hashes go to
shards (ranges of the hash) as sorted, packed arrays; a shard tells each
batch which of its anchors are found again.

What a batch holds twice is settled in the batch, and one entry for it goes
to the shard, so a gram that a third of all documents share costs one entry
a batch, not one a document.

Batches are known by a hash of their documents' keys: a task that runs again
gives the same name, and equal batches give equal answers.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentia.llm.common import binary_array, minimizer_runs, mix, powers, prefix_hash, shuffle_partitions
from retentia.session import ship_by_value

_U = np.uint64
#: Starts per step; the working memory of a step is about 100 bytes each.
STEP = 1 << 18
#: Kinds of exchanged rows: a batch's document keys, settled places, entries to compare.
KEYS, SETTLED, ENTRY = 0, 1, 2

PLACED = "shard int, kind int, batch long, a binary, b binary, c binary, d binary, e binary"
_PLACED = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("batch", pa.int64()), *[(x, pa.binary()) for x in "abcde"]])
ANSWER = "batch long, kind int, a binary, b binary"
_ANSWER = pa.schema([("batch", pa.int64()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary())])
FOUND = "_rt_did long, _rt_th long, _rt_at binary"
_FOUND = pa.schema([("_rt_did", pa.int64()), ("_rt_th", pa.int64()), ("_rt_at", pa.binary())])


def pack(x: np.ndarray) -> bytes:
    """An array as its type, and its bytes plane by plane, compressed."""
    import zstandard

    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T
    return x.dtype.str.encode().ljust(4) + zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    import zstandard

    kind = np.dtype(data[:4].decode().strip())
    raw = np.frombuffer(zstandard.decompress(data[4:]), np.uint8)
    return np.ascontiguousarray(raw.reshape(kind.itemsize, -1).T).view(kind).ravel()


def pack_sorted(x: np.ndarray) -> bytes:
    return pack(np.diff(x, prepend=x.dtype.type(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    x = unpack(data)
    return np.cumsum(x, dtype=x.dtype)


def window_starts(offsets: np.ndarray, size: int) -> np.ndarray:
    """Where a string of ``size`` symbols starts that lies in one document."""
    edge = np.zeros(offsets[-1] + 1, np.int32)
    long = np.diff(offsets) >= size
    np.add.at(edge, offsets[:-1][long], 1)
    np.add.at(edge, offsets[1:][long] - size + 1, -1)
    return np.cumsum(edge[:-1], dtype=np.int32) > 0


class Step:
    """Some neighbouring symbols with the anchors of the strings that start there."""

    def __init__(self, begin: int, sums: np.ndarray, down: np.ndarray, at: np.ndarray, first: np.ndarray, last: np.ndarray, grams: np.ndarray):
        self.begin, self.sums, self.down = begin, sums, down
        self.at, self.first, self.last, self.grams = at, first, last, grams

    def hashes(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Hashes of the symbols from start to stop, in the batch's places."""
        a, b = start - self.begin, stop - self.begin
        return mix((self.sums[b] - self.sums[a]) * self.down[a] + (b - a).astype(np.uint64))


def anchor_steps(symbols: Callable[[int, int], np.ndarray], total: int, size: int, gram: int, wanted: np.ndarray) -> Iterator[Step]:
    """Anchors (at) of the wanted strings, with the runs of starts (first to last) that choose them."""
    up, down = powers(min(STEP + size, total + 1))
    for begin in range(0, total, STEP):
        here = wanted[begin : begin + STEP]
        if not here.any():
            continue
        end = min(total, begin + STEP + size - 1)
        sums = prefix_hash(symbols(begin, end), up)
        n = end - begin - gram + 1
        grams = mix((sums[gram:] - sums[:n]) * down[:n])
        valid = np.zeros(n, bool)
        valid[: len(here)] = here[:n]
        at, first, last = minimizer_runs(grams, valid, size - gram + 1)
        # Anchors have small hashes; mixed again, they fill the range evenly.
        yield Step(begin, sums, down, at + begin, first + begin, last + begin, mix(grams[at] ^ _U(0xA5A5A5A5A5A5A5A5)))


def batch_name(dids: np.ndarray, ths: np.ndarray) -> int:
    h = hashlib.blake2b(dids.tobytes() + ths.tobytes(), digest_size=8).digest()
    return int.from_bytes(h, "little", signed=True)


def placed(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * 8
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _PLACED)], schema=_PLACED)


def keys_row(name: int, dids: np.ndarray, ths: np.ndarray, shards: int) -> tuple:
    return name % shards, KEYS, name, pack(dids), pack(ths), None, None, None


def settled_row(name: int, doc: np.ndarray, value: np.ndarray, shards: int) -> tuple:
    return name % shards, SETTLED, name, pack(doc.astype(np.int32)), pack(value.astype(np.int64)), None, None, None


def shard_count(n: int) -> int:
    """A power of two, one to two for each partition."""
    return 1 << max(1, n - 1).bit_length()


def shard_slices(sorted_hashes: np.ndarray, shards: int) -> Iterator[tuple[int, int, int]]:
    """(shard, from, to) of sorted hashes; a shard holds an equal range of them."""
    shift = _U(64 - shards.bit_length() + 1)
    cuts = np.searchsorted(sorted_hashes, np.arange(shards, dtype=np.uint64) << shift)
    for k, (i, j) in enumerate(zip(cuts, [*cuts[1:], len(sorted_hashes)])):
        if i < j:
            yield k, int(i), int(j)


def repeat_rows(name: int, dids: np.ndarray, ths: np.ndarray, doc: np.ndarray, place: np.ndarray, hashes: np.ndarray, checks: np.ndarray | None, shards: int) -> list[tuple]:
    """What a batch sends so that it learns which of its entries' hashes occur again anywhere."""
    order = np.lexsort((checks, hashes)) if checks is not None else np.argsort(hashes)
    h, c = hashes[order], checks[order] if checks is not None else None
    if checks is None:  # a filter alone: 48 bits are enough, and take less room
        h = h >> _U(16) << _U(16)
    same = h[1:] == h[:-1]
    if c is not None:
        same &= c[1:] == c[:-1]
    twice = np.zeros(len(h), bool)
    twice[1:] |= same
    twice[:-1] |= same
    rows = []
    if len(h):
        head = np.concatenate([[True], ~same])
        rows.append(settled_row(name, doc[order[twice]], place[order[twice]], shards))
        order, single, h = order[head], ~twice[head], h[head]
        c = c[head] if c is not None else None
        d = np.where(single, doc[order], -1).astype(np.int32)  # -1: settled already
        p = np.where(single, place[order], 0).astype(np.int64)
        for k, i, j in shard_slices(h, shards):
            sent = h[i:j] if c is not None else h[i:j] >> _U(16)
            rows.append((k, ENTRY, name, pack_sorted(sent), pack(d[i:j]), pack(p[i:j]), pack(c[i:j]) if c is not None else None, None))
    rows.append(keys_row(name, dids, ths, shards))
    return rows


def answer(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(cols, _ANSWER)], schema=_ANSWER)


def by_shard(compare: Callable[[list[tuple]], list[tuple]]):
    """Rows sorted by shard: passes keys and settled places on, gives each shard's entries to ``compare``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []
        for batch in batches:
            out = []
            for row in zip(*(c for c in batch.columns)):
                k, kind, name = row[0].as_py(), row[1].as_py(), row[2].as_py()
                if kind != ENTRY:
                    out.append((name, kind, row[3].as_py(), row[4].as_py()))
                    continue
                if k != shard and held:
                    out += compare(held)
                    held = []
                shard = k
                held.append((name, *(x.as_py() for x in row[3:])))
            if out:
                yield answer(out)
        if held and (out := compare(held)):
            yield answer(out)

    return run


def found_again(entries: list[tuple]) -> list[tuple]:
    """Of one shard's entries, those whose hash occurs at least twice, for each batch."""
    h = np.concatenate([unpack_sorted(e[1]) for e in entries])
    doc = np.concatenate([unpack(e[2]) for e in entries])
    place = np.concatenate([unpack(e[3]) for e in entries])
    source = np.repeat(np.arange(len(entries)), [len(unpack(e[2])) for e in entries])
    checks = np.concatenate([unpack(e[4]) for e in entries]) if entries[0][4] is not None else None
    order = np.argsort(h, kind="stable") if checks is None else np.lexsort((checks, h))
    same = h[order[1:]] == h[order[:-1]]
    if checks is not None:
        same &= checks[order[1:]] == checks[order[:-1]]
    again = np.zeros(len(h), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    again &= doc >= 0
    pick = np.flatnonzero(again)
    out = []
    cuts = np.searchsorted(source[pick], np.arange(len(entries) + 1))
    for k, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])):
        if i < j:
            out.append((entries[k][0], SETTLED, pack(doc[pick[i:j]]), pack(place[pick[i:j]])))
    return out


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (batch, kind): one row per document with its places in order."""
    name, keys, docs, places = None, None, [], []

    def close() -> pa.RecordBatch | None:
        if keys is None or not docs:
            return None
        d, p = np.concatenate(docs), np.concatenate(places)
        order = np.lexsort((p, d))
        d, p = d[order], p[order]
        new = np.ones(len(d), bool)
        new[1:] = (d[1:] != d[:-1]) | (p[1:] != p[:-1])
        d, p = d[new], p[new]
        if not len(d):
            return None
        first = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
        cells = binary_array(p.astype(np.int64), np.append(first, len(d)))
        return pa.RecordBatch.from_arrays([pa.array(keys[0][d[first]]), pa.array(keys[1][d[first]]), cells], schema=_FOUND)

    for batch in batches:
        for k, kind, a, b in zip(*(c.to_pylist() for c in batch.columns)):
            if k != name:
                if (out := close()) is not None:
                    yield out
                name, keys, docs, places = k, None, [], []
            if kind == KEYS:
                keys = (unpack(a), unpack(b))
            else:
                docs.append(unpack(a))
                places.append(unpack(b))
    if (out := close()) is not None:
        yield out


def settle(sent: DataFrame, compare: Callable[[list[tuple]], list[tuple]]) -> DataFrame:
    """FOUND rows from PLACED rows: compares entries by shard, then gathers the answers by batch."""
    n = shuffle_partitions(sent.sparkSession)
    answers = sent.repartition(n, "shard").sortWithinPartitions("shard").mapInArrow(by_shard(compare), ANSWER)
    return answers.repartition(n, "batch").sortWithinPartitions("batch", "kind").mapInArrow(_resolve, FOUND)


def one_each(found: DataFrame) -> DataFrame:
    """One row per document: a row that stands in several batches is told the same in each."""
    return found.groupBy("_rt_did", "_rt_th").agg(F.max("_rt_at").alias("_rt_at"))


def places_of(column: pa.Array, offsets: np.ndarray) -> np.ndarray:
    """The int64 cells of a binary column, moved by their documents' offsets, in order."""
    out = [np.frombuffer(x.as_py() or b"", np.int64) + o for x, o in zip(column, offsets[:-1])]
    return np.concatenate(out) if out else np.empty(0, np.int64)


def is_in(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


ship_by_value(sys.modules[__name__])
