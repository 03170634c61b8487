"""Byte-level BPE by corpus-level merge replay.

A task takes its share of the corpus batch by batch.  The distinct
pre-tokens that are new in a batch form one symbol list with links to the
neighbours; an inverted index leads from each token pair to the positions
that hold it.  Pairs are then replayed in rank order over all these words
at once: a merge rewrites its positions and indexes the pairs of the two
touched neighbours, nothing else.  So each word goes through the merges that
it would go through alone, but for one case that some vocabularies allow: a
merge makes a pair of a rank already replayed.  Such words (few) are
encoded alone.

Texts are cut at single spaces: with the pattern ``SPACE_LED`` a pre-token
starts at a space unless white space stands on both sides of it, so the piece
after a space can be looked up whole.  Texts with such runs take the
pattern over the whole text.

No shuffle and no state beyond a task, so skew and lost executors cost one
split; the word cache is bounded by ``cache_words``.

Defined cases: a null text counts as empty (no ids); any length is encoded
whole; repeated rows give equal rows; an empty table gives an empty result;
other columns are ignored (``encode``) or kept (``encode_rows``).
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retentia.llm.common import bound_batches, portions
from retentia.session import ship_by_value

#: A space amid white space: pre-tokens may run across it.
_RUN = re.compile(r"\s \s")


#: Fixed value: the pattern for which ``pieces`` may cut; texts go whole through any other.
SPACE_LED = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def load_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file (base64 token, rank) in rank order; ids are ranks."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    ranks = {int(r): base64.b64decode(t) for t, r in pairs}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"{path}: ranks are not 0..n-1")
    return [ranks[i] for i in range(len(ranks))]


class MergeReplay:
    """Encodes sets of words together; arrays hold one entry for each byte of each word."""

    def __init__(self, tokens: list[bytes]):
        rank = {t: i for i, t in enumerate(tokens)}
        missing = [i for i in range(256) if bytes([i]) not in rank]
        if missing:
            raise ValueError(f"no token for the bytes {missing}")
        self.rank, self.size = rank, len(tokens)
        self.byte_id = np.array([rank[bytes([i])] for i in range(256)], np.int32)
        # Every way to put a token together from two others, as a sorted table of pair codes.
        code, merged = [], []
        for r, t in enumerate(tokens):
            for k in range(1, len(t)):
                x, y = rank.get(t[:k]), rank.get(t[k:])
                if x is not None and y is not None:
                    code.append(x * self.size + y)
                    merged.append(r)
        code_array = np.array(code + [self.size * self.size], np.int64)
        order = np.argsort(code_array)
        self.code, self.merged = code_array[order], np.array(merged + [-1], np.int32)[order]
        ids = np.repeat(self.byte_id, 256), np.tile(self.byte_id, 256)
        self.byte_pairs = self.pair_ranks(*ids).reshape(256, 256)

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The id that two tokens make together, or -1."""
        want = a.astype(np.int64) * self.size + b
        at = np.searchsorted(self.code, want)
        return np.where(self.code[at] == want, self.merged[at], -1)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, where each word's ids begin)."""
        whole = list(map(self.rank.get, words))
        todo = [k for k, r in enumerate(whole) if r is None]
        count = np.ones(len(words) + 1, np.int64)
        ids = np.array([0 if r is None else r for r in whole], np.int32)
        if todo:
            lengths = np.array([len(words[k]) for k in todo], np.int64)
            raw = np.frombuffer(b"".join([words[k] for k in todo]), np.uint8)
            word = np.repeat(np.arange(len(todo), dtype=np.int32), lengths)
            symbol = self.byte_id[raw]
            alone = self._replay(symbol, word, raw)
            live = symbol >= 0
            some, sizes = symbol[live], np.bincount(word[live], minlength=len(todo))
            if alone:
                parts = np.split(some, np.cumsum(sizes)[:-1])
                for k in alone:
                    parts[k] = np.array(self.encode_alone(words[todo[k]]), np.int32)
                    sizes[k] = len(parts[k])
                some = np.concatenate(parts)
            count[np.array(todo) + 1] = sizes
            full = np.empty(int(count[1:].sum()), np.int32)
            mine = np.repeat(np.isin(np.arange(len(words)), todo, assume_unique=True), count[1:])
            full[mine], full[~mine] = some, ids[[k for k, r in enumerate(whole) if r is not None]]
            ids = full
        count[0] = 0
        return ids, np.cumsum(count)

    def _replay(self, symbol: np.ndarray, word: np.ndarray, raw: np.ndarray) -> list[int]:
        """Merges in place (taken symbols become -1); returns the words to encode alone."""
        n = len(symbol)
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        ends = np.flatnonzero(np.diff(word, append=-1))
        after[ends] = -1
        before[np.concatenate([[0], ends[:-1] + 1])] = -1
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []
        alone: set[int] = set()

        def put(at: np.ndarray, r: np.ndarray, current: int) -> None:
            """Index the pairs of these ranks that start at these symbols."""
            at, r = at[r >= 0], r[r >= 0]
            if not len(at):
                return
            if len(at) == 1:
                cuts, ranks = [at], [int(r[0])]
            else:
                order = np.argsort(r, kind="stable")
                at, r = at[order], r[order]
                edge = np.flatnonzero(np.diff(r)) + 1
                cuts, ranks = np.split(at, edge), [int(r[0]), *r[edge].tolist()]
            for x, k in zip(cuts, ranks):
                if k <= current:  # a word alone would go back to this pair before its next one of the current rank
                    alone.update(word[x].tolist())
                elif k in index:
                    index[k].append(x)
                else:
                    index[k] = [x]
                    heapq.heappush(heap, k)

        starts = np.flatnonzero(after >= 0).astype(np.int32)
        put(starts, self.byte_pairs[raw[starts], raw[starts + 1]], -1)
        while heap:
            r = heapq.heappop(heap)
            found = index.pop(r)
            at = found[0] if len(found) == 1 else np.concatenate(found)
            if len(at) > 1:
                at = np.sort(at)
                at = at[np.concatenate([[True], at[1:] != at[:-1]])]
            nxt = after[at]
            ok = (nxt >= 0) & (symbol[at] >= 0)
            at, nxt = at[ok], nxt[ok]
            # Earlier merges may have changed either symbol.
            ok = self.pair_ranks(symbol[at], symbol[nxt]) == r
            at, nxt = at[ok], nxt[ok]
            if not len(at):
                continue
            if len(at) > 1:  # of overlapping pairs, every other one from the left
                chained = np.concatenate([[False], nxt[:-1] == at[1:]])
                if chained.any():
                    head = np.maximum.accumulate(np.where(chained, 0, np.arange(len(at))))
                    odd = (np.arange(len(at)) - head) % 2 == 1
                    at, nxt = at[~odd], nxt[~odd]
            symbol[at], symbol[nxt] = r, -1
            beyond = after[nxt]
            after[at], after[nxt] = beyond, -1
            inner = beyond >= 0
            before[beyond[inner]] = at[inner]
            behind = before[at]
            left, right = np.concatenate([at, behind[behind >= 0]]), np.concatenate([beyond, at[behind >= 0]])
            left, right = left[right >= 0], right[right >= 0]
            put(left, self.pair_ranks(symbol[left], symbol[right]), r)
        return sorted(alone)

    def encode_alone(self, w: bytes) -> list[int]:
        """One word, the smallest rank first and the leftmost of equals."""
        if w in self.rank:
            return [self.rank[w]]
        parts = [bytes([c]) for c in w]
        after, before = [*range(1, len(w)), -1], [-1, *range(len(w) - 1)]
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(len(w) - 1) if (r := self.rank.get(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, x, y = heapq.heappop(heap)
            j = after[i]
            if parts[i] != x or j < 0 or parts[j] != y:
                continue
            parts[i], parts[j] = x + y, b""
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for p in (i, before[i]):
                if p >= 0 and after[p] >= 0 and (r := self.rank.get(parts[p] + parts[after[p]])) is not None:
                    heapq.heappush(heap, (r, p, parts[p], parts[after[p]]))
        return [self.rank[p] for p in parts if p]


def pieces(text: str, cuts: bool = True) -> tuple[str, list[str]]:
    """The text cut at spaces where the pattern surely starts a new match: the first piece, and the others without the space before them."""
    if not cuts or _RUN.search(text):
        return text, []
    head, *tail = text.split(" ")
    return head, tail


class Encoder:
    """Encodes groups of texts; keeps the pieces seen of late.

    A text's first piece (or a whole text that can't be cut) is encoded as it
    is, the others with the space before them.
    """

    def __init__(self, tokens: list[bytes], pattern: str, cache_words: int):
        import regex

        self.find = regex.compile(pattern).findall
        self.tokens, self.replay, self.most = tokens, MergeReplay(tokens), cache_words
        self.id_text = list(map(str, range(len(tokens))))
        self.cuts = pattern == SPACE_LED
        # piece -> ids joined by spaces, piece -> the bytes that they decode to; two generations, so frequent pieces stay
        self.ids: dict[str, str] = {}
        self.raw: dict[str, bytes] = {}
        self.old_ids: dict[str, str] = {}
        self.old_raw: dict[str, bytes] = {}

    def learn(self, texts: list[str]) -> dict[str, tuple[str, bytes]]:
        """Encodes the new pieces of the texts; returns what the first pieces encode and decode to."""
        if len(self.ids) > self.most // 2:
            self.old_ids, self.old_raw, self.ids, self.raw = self.ids, self.raw, {}, {}
        wanted: set[str] = set()
        heads: set[str] = set()
        for t in texts:
            head, tail = pieces(t, self.cuts)
            heads.add(head)
            wanted.update(tail)
        wanted.difference_update(self.ids)
        for p in wanted & self.old_ids.keys():
            self.ids[p], self.raw[p] = self.old_ids[p], self.old_raw[p]
        wanted.difference_update(self.old_ids)
        # Matched in one go: pieces cut apart safely give the same words side by side, and each starts with its space.
        plain = [p for p in wanted if p and not p[0].isspace()]
        words = self.find(" " + " ".join(plain)) if plain else []
        begin = [k for k, w in enumerate(words) if w[0] == " "]
        odd = [p for p in wanted if not p or p[0].isspace()]
        first = list(heads)
        for p in [" " + p for p in odd] + first:
            begin.append(len(words))
            words += self.find(p)
        begin.append(len(words))
        ids, offsets = self.replay.encode([w.encode() for w in words])
        flat = ids.tolist()
        shown, meant = list(map(self.id_text.__getitem__, flat)), list(map(self.tokens.__getitem__, flat))
        cut = offsets[np.array(begin)].tolist()
        pairs = [(" ".join(shown[i:j]), b"".join(meant[i:j])) for i, j in zip(cut, cut[1:])]
        for p, (i, r) in zip(plain + odd, pairs):
            self.ids[p], self.raw[p] = i, r
        return dict(zip(first, pairs[len(plain) + len(odd) :]))

    def encode(self, texts: list[str]) -> Iterator[tuple[str, int, bytes]]:
        """(ids joined by spaces, how many, decoded bytes) of each text."""
        heads = self.learn(texts)
        ids_of, raw_of = self.ids.__getitem__, self.raw.__getitem__
        for t in texts:
            head, tail = pieces(t, self.cuts)
            first, raw = heads[head]
            ids = " ".join([first, *map(ids_of, tail)] if first else map(ids_of, tail))
            yield ids, ids.count(" ") + 1 if ids else 0, raw + b"".join(map(raw_of, tail))


def groups(column: pa.Array, most: int = 1 << 23) -> Iterator[list[str]]:
    """The texts of a column in groups of about ``most`` characters."""
    out: list[str] = []
    size = 0
    for x in column:
        out.append(x.as_py() or "")
        size += len(out[-1])
        if size >= most:
            yield out
            out, size = [], 0
    if out:
        yield out


def decode(tokens: list[bytes], ids: list[int]) -> bytes:
    """The bytes of token ids."""
    return b"".join([tokens[i] for i in ids])


REPORT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def _report(tokens: list[bytes], pattern: str, cache_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokens, pattern, cache_words).encode
        for batch in batches:
            rows = [(n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(raw).hexdigest()) for texts in groups(batch.column(1)) for ids, n, raw in encode(texts)]
            cols = list(zip(*rows)) if rows else [()] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *[pa.array(c, f.type) for c, f in zip(cols, list(REPORT)[1:])]], schema=REPORT)

    return run


def token_report(docs: DataFrame, rank_file: str, pattern: str, cache_words: int = 400_000) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the bytes that decode from them."""
    tokens = load_ranks(rank_file)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_report(tokens, pattern, cache_words), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _ids(tokens: list[bytes], pattern: str, cache_words: int, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokens, pattern, cache_words).encode
        for batch in portions(batches, at, 1 << 22):
            ids, counts, decoded = [], [], []
            for texts in groups(batch.column(at)):
                for found, n, raw in encode(texts):
                    ids.append(found)
                    counts.append(n)
                    decoded.append(hashlib.sha256(raw).hexdigest())
            values = np.fromstring(" ".join([x for x in ids if x]), np.int32, sep=" ")
            lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), pa.array(values))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(counts, pa.int64()), pa.array(decoded, pa.string())], names=[*batch.schema.names, "token_ids", "n_tokens", "decoded_sha256"])

    return run


def encode_rows(docs: DataFrame, rank_file: str, pattern: str, cache_words: int = 100_000) -> DataFrame:
    """The document rows with token_ids (array of int), n_tokens and the digest of the decoded bytes; input columns of these names are replaced."""
    tokens = load_ranks(rank_file)
    bound_batches(docs.sparkSession)
    kept = docs.drop("token_ids", "n_tokens", "decoded_sha256")
    schema = T.StructType(kept.schema.fields + [T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()), T.StructField("decoded_sha256", T.StringType())])
    return kept.mapInArrow(_ids(tokens, pattern, cache_words, kept.columns.index("text")), schema)


ship_by_value(sys.modules[__name__])
