"""Operators on documents against brute force: awkward texts, ties, repeated rows, empty tables, clashing columns."""

import base64
import zlib

import numpy as np
import pytest
from llm_helpers import DOCS, awkward, collected, copy_rows, in_order, line_rows, sha, table, window_rows, words
from pyspark.sql import functions as F

from retentia.llm import bpe, line_dedup, quality_gbt, quality_rules, suffix_dedup, window_dedup

CLASH = ["pos", "key", "h1", "salt", "bitmap", "least", "n_dropped", "n_words", "token_ids", "shard", "batch", "kind", "x", "a", "sig", "bands", "u", "v", "class_did", "m"]


def clashing(df):
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASH])


@pytest.mark.parametrize("seed", [3, 4])
def test_line_dedup(spark, seed):
    rows = awkward(seed)
    assert collected(line_dedup.line_report(clashing(table(spark, rows)))) == in_order(line_rows(rows))


def test_line_dedup_texts(spark):
    rows = [(2, "A line to keep\nshort\nOther line"), (1, "  a LINE to keep\t\nshort"), (3, None), (4, "x\n" * 200 + "a line to keep")]
    out = {r.doc_id: (r.text, r.n_chars, r.pos) for r in line_dedup.dedup_lines(clashing(table(spark, rows))).collect()}
    assert out[2] == ("short\nOther line", 16, "own pos")
    assert out[1][0] == "  a LINE to keep\t\nshort" and out[3][0] is None
    assert out[4][0] == "x\n" * 199 + "x"


@pytest.mark.parametrize("seed", [3, 5])
def test_suffix_dedup(spark, seed):
    rows = awkward(seed)
    assert collected(suffix_dedup.copy_report(clashing(table(spark, rows)))) == in_order(copy_rows(rows))


def test_suffix_dedup_of_few_letters(spark):
    rng = np.random.default_rng(1)
    rows = [(k, "".join(rng.choice(list("ab"), rng.integers(0, 400)))) for k in range(60)] + [(60 + k, "ab" * k) for k in range(60)]
    assert collected(suffix_dedup.copy_report(table(spark, rows), size=20, gram=8)) == in_order(copy_rows(rows, 20))


@pytest.mark.parametrize("seed", [3, 5])
def test_window_dedup(spark, seed):
    rows = awkward(seed)
    assert collected(window_dedup.repeat_report(clashing(table(spark, rows)))) == in_order(window_rows(rows))


def test_window_dedup_of_few_words(spark):
    rng = np.random.default_rng(2)
    rows = [(k, " ".join(rng.choice(list("abc"), rng.integers(0, 60)))) for k in range(40)]
    assert collected(window_dedup.repeat_report(table(spark, rows), window=10)) == in_order(window_rows(rows, 10))
    assert window_dedup.levels(35) == [9, 18, 35] and window_dedup.levels(9) == [9] and window_dedup.levels(100) == [9, 13, 25, 50, 100]


def test_removed_texts(spark):
    shared = " ".join(f"w{k}" for k in range(40))
    rows = [(1, f"one {shared}"), (2, f"{shared} two"), (3, None)]
    texts = lambda df: {r.doc_id: r.text for r in df.collect()}
    assert texts(window_dedup.remove_repeats(clashing(table(spark, rows)))) == {1: "one", 2: "two", 3: None}
    assert texts(suffix_dedup.remove_copies(clashing(table(spark, rows)))) == {1: rows[0][1], 2: " two", 3: None}


def plain_rules(text):
    w = words(text)
    t = text or ""
    lines = [x for x in t.split("\n") if words(x)]
    tri = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    hit = {k + j for k, g in enumerate(tri) if tri.count(g) > 1 for j in range(3)}
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit), failed


def test_quality_rules(spark):
    rows = [r for r in awkward(7) if len(r[1] or "") < 5000] + [(900, "word " * 300), (901, "\x85  a\x1cb * | <"), (902, base64.b64encode(zlib.compress(bytes(np.random.default_rng(0).integers(0, 256, 6000, dtype=np.uint8)))).decode().replace("A", " "))]
    got = quality_rules.quality_report(clashing(table(spark, rows))).collect()
    assert in_order([tuple(r)[:7] for r in got]) == in_order([(i, *plain_rules(t)) for i, t in rows])
    assert not any(r.kept for r in got if r.base_failed) and not any(r.kept for r in got if r.doc_id in (900, 902))
    prose = "It is a truth that every clean text of some length holds many different words, told in plain order; none of them comes back too often, and so neither rule nor ratio finds a fault. " \
        "Rivers run east while merchants count silver, children climb orchard walls, and late in autumn the ferryman paints his boat green again before snow shuts the northern pass for months."
    docs = table(spark, [(1, prose), (2, "word " * 300), (3, None)])
    kept = quality_rules.filter_rows(clashing(docs))
    assert [r.doc_id for r in kept.collect()] == [1] and kept.columns == clashing(docs).columns


def test_bpe(spark):
    P = pytest.importorskip("public_tokenizers")
    tiktoken = pytest.importorskip("tiktoken")
    path = P.path("byte_bpe_50k.tiktoken")
    tokens = bpe.load_ranks(path)
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    odd = [(700, "a  b   c \n \n d's we'll 12३ \x1c\x85 !!"), (701, "z" * 20_000), (702, "<|endoftext|> 😀😀"), (703, " lead and trail ")]
    rows = awkward(9) + odd
    want = [(i, len(x), sha(" ".join(map(str, x))), sha(t or "")) for i, t in rows for x in [own.encode_ordinary(t or "")]]
    assert collected(bpe.token_report(clashing(table(spark, rows)), path, P.PATTERN)) == in_order(want)
    got = bpe.encode_rows(clashing(table(spark, odd)), path, P.PATTERN).collect()
    assert all(bpe.decode(tokens, r.token_ids).decode() == r.text and r.n_tokens == len(r.token_ids) and r.pos == "own pos" for r in got)
    other = r"\s+|\S+"
    own = tiktoken.Encoding("own", pat_str=other, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    assert [list(map(int, i.split())) for i, _, _ in bpe.Encoder(tokens, other, 100).encode([t for _, t in odd])] == [own.encode_ordinary(t) for _, t in odd]


def test_replay_of_an_unordered_vocabulary():
    # "abc" ranks below "ab", so a merge makes a pair that comes before it; words must still merge as they do alone.
    tokens = [bytes([i]) for i in range(256)] + [b"bc", b"abc", b"ab", b"cab", b"aa", b"abcab"]
    r = bpe.MergeReplay(tokens)
    rng = np.random.default_rng(0)
    todo = ["".join(rng.choice(list("abc"), rng.integers(1, 14))).encode() for _ in range(500)]
    ids, at = r.encode(todo)
    assert [ids[i:j].tolist() for i, j in zip(at, at[1:])] == [r.encode_alone(w) for w in todo]
    assert r.encode_alone(b"abab") == [258, 258]


def test_quality_trees(spark):
    good = "The ferry left at noon, and nobody on the quay had seen the captain since the storm."
    rows = [(k, f"{good} {k} " * (1 + k % 3) if k % 3 else f"BUY NOW!!! {k} $$$ " * 5) for k in range(400)] + [(400, None), (401, ""), (None, good)]
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(0, 400)] + [(1, None), (5000, 1), (None, 1)], "doc_id long, quality int").withColumn("toxic", F.lit(0))
    got = quality_gbt.quality_scores(clashing(table(spark, rows)), clashing(labels)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert np.mean([r.predicted == int(r.doc_id % 3 > 0) for r in held if r.doc_id < 400]) > 0.97
    one = labels.where("quality = 1")
    assert all(r.score > 0.9 for r in quality_gbt.quality_scores(table(spark, rows[:5]), one).collect())
    assert [r.score for r in quality_gbt.quality_scores(table(spark, rows[:1]), labels.limit(0)).collect()] == [0.5]


def test_held_out_labels_teach_nothing(spark):
    rows = [(k, f"text number {k} " * (k % 7 + 1)) for k in range(200)]
    held = [k for k in range(200) if zlib.crc32(str(k).encode()) % 5 == 0]
    scores = []
    for flip in (0, 1):
        labels = spark.createDataFrame([(k, (k % 2) ^ (flip if k in held else 0)) for k in range(200)], "doc_id long, quality int")
        scores.append(collected(quality_gbt.quality_scores(table(spark, rows), labels)))
    assert scores[0] == scores[1]


def test_empty_tables(spark):
    P = pytest.importorskip("public_tokenizers")
    docs = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for df in (line_dedup.line_report(docs), line_dedup.dedup_lines(docs), suffix_dedup.copy_report(docs), window_dedup.repeat_report(docs), quality_rules.quality_report(docs), quality_rules.filter_rows(docs), bpe.token_report(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN), quality_gbt.quality_scores(docs, labels)):
        assert df.collect() == []
