"""Near-duplicates, components, decontamination, and the pipeline against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import DOCS, awkward, collected, order_id, table
from test_texts import clashing

import corpus_pipeline
from retentia.llm import decontaminate, minhash
from retentia.llm.components import components


def roots(nodes, edges):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(100, 160)] + [(200, k) for k in range(201, 400)] + [(rng.randrange(500, 700), rng.randrange(500, 700)) for _ in range(90)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = roots({x for e in edges for x in e}, edges)
    assert got == {n: r for n, r in want.items() if n != r}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def edited(text, n, rng):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
    return " ".join(w)


def near_rows():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6)))
    rows = [r for r in awkward(11) if r[0] is None or r[0] < 30]
    for base in range(100, 700, 20):
        text = " ".join(word() for _ in range(rng.randint(60, 400)))
        rows += [(base, text), (base + 1, text)] + [(base + 2 + k, edited(text, rng.randint(1, 12), rng)) for k in range(8)]
    return rows


def test_near_duplicates(spark):
    rows = near_rows()
    docs = table(spark, rows)
    weights = minhash.shingle_weights(docs)
    sets = []
    for i, t in rows:
        raw = np.frombuffer((t or "").encode(), np.uint8)
        _, h, c = minhash.shingles(np.array([0, len(raw)]), raw)
        sets.append((order_id(i), t or "", (h, (c * weights[minhash.cell(h)]).astype(float))))
    edges = [(a[0], b[0]) for k, a in enumerate(sets) for b in sets[:k] if a[1] == b[1] or minhash.weighted_jaccard(a[2], b[2]) >= 0.8]
    want = roots({s[0] for s in sets}, edges)
    assert len(edges) > 200
    got = {order_id(r.doc_id): order_id(r.class_id) for r in minhash.class_report(clashing(docs)).collect()}
    assert got == want
    kept = minhash.keep_one(clashing(docs)).collect()
    assert sorted(order_id(r.doc_id) for r in kept) == sorted(set(want.values())) and kept[0].pos == "own pos"


def test_large_bucket_keeps_every_link(spark):
    rng = random.Random(8)
    text = " ".join(f"w{rng.randrange(9999)}" for _ in range(300))
    rows = [(k, edited(text, rng.randint(0, 2), rng)) for k in range(400)] + [(1000 + k, f"{text[:40]} " + " ".join(f"q{rng.randrange(9999)}" for _ in range(80))) for k in range(100)]
    got = {r.doc_id: r.class_id for r in minhash.class_report(table(spark, rows)).collect()}
    assert all(got[k] == 0 for k in range(400)) and all(got[k] == k for k in range(1000, 1100))


def test_pairs_in_large_buckets_whose_first_text_is_not_near(spark):
    rng = random.Random(24)
    fresh = lambda n: [f"f{rng.randrange(10**7)}" for _ in range(n)]
    template = fresh(340)
    rows = []
    for k in range(300):
        one = template + fresh(50)
        rows.append((k, " ".join(one)))
        if k >= 100:  # a near-copy
            cut = rng.randrange(366)
            rows.append((1000 + k, " ".join(one[:cut] + fresh(24) + one[cut + 24 :])))
    weights = minhash.shingle_weights(table(spark, rows))
    sets = []
    for _, t in rows:
        raw = np.frombuffer(t.encode(), np.uint8)
        _, h, c = minhash.shingles(np.array([0, len(raw)]), raw)
        sets.append((h, (c * weights[minhash.cell(h)]).astype(float)))
    edges = [(rows[a][0], rows[b][0]) for a in range(len(rows)) for b in range(a) if minhash.weighted_jaccard(sets[a], sets[b]) >= 0.8]
    assert len(edges) >= 150 and all(abs(a - b) == 1000 for a, b in edges)
    got = {r.doc_id: r.class_id for r in minhash.class_report(table(spark, rows)).collect()}
    assert got == roots([i for i, _ in rows], edges)


def test_null_ids_are_different_documents(spark):
    rng = random.Random(31)
    texts = [" ".join(f"n{rng.randrange(10**6)}" for _ in range(100)) for _ in range(6)]
    # Unrelated texts of null ids; two of them near to good ids, one twice near to another.
    rows = [(None, t) for t in texts] + [(1, edited(texts[0], 1, rng)), (2, edited(texts[1], 1, rng)), (None, edited(texts[5], 1, rng)), (None, texts[4])]
    got = sorted((order_id(r.doc_id), order_id(r.class_id)) for r in minhash.class_report(table(spark, rows)).collect())
    assert got == [(1, 1), (2, 2)] + sorted([(order_id(None), 1), (order_id(None), 2)] + [(order_id(None), order_id(None))] * 6)
    kept = [(r.doc_id, r.text) for r in minhash.keep_one(table(spark, rows)).collect()]
    assert sorted(i for i, _ in kept if i is not None) == [1, 2]
    none = sorted(t for i, t in kept if i is None)
    assert len(none) == 4 and set(texts[2:5]) <= set(none) and len({texts[5], rows[8][1]} & set(none)) == 1


def test_decontamination(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijk") for _ in range(rng.randint(3, 7)))
    prose = lambda n: " ".join(word() if rng.random() < 0.7 else rng.choice(["the", "of", "and"]) for _ in range(n))
    items = [(k, prose(rng.randint(12, 60))) for k in range(20)] + [(90, None), (91, ""), (92, "too short")]
    benchmark = spark.createDataFrame([(k, t, "own") for k, t in items], "item_id long, text string, shard string")
    rows, want = [(0, None), (1, "")], set()
    for k in range(20):
        t = items[k][1]
        rows.append((100 + k, prose(rng.randint(0, 300))))
        rows.append((200 + k, f"{prose(rng.randint(0, 300))} {t.upper().replace(' ', ', ')} {prose(rng.randint(0, 300))}"))
        w = t.split()
        for j in rng.sample(range(len(w)), len(w) // 6):  # a paraphrase: some words replaced
            w[j] = word()
        rows.append((300 + k, f"{prose(40)} {' '.join(w)} {prose(2000)}"))
        want |= {(200 + k, k), (300 + k, k)}
    docs = clashing(table(spark, rows))
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated_pairs(docs, benchmark).collect()}
    assert {p for p in got if p[0] < 200} == set()
    assert {p for p in want if p[0] < 300} <= got and len(want & got) >= 0.9 * len(want)
    kept = {r.doc_id for r in decontaminate.drop_contaminated(docs, benchmark).collect()}
    assert kept == {i for i, _ in rows} - {d for d, _ in got}
    assert decontaminate.contaminated_pairs(docs, benchmark.limit(0)).collect() == []
    assert decontaminate.contaminated_pairs(spark.createDataFrame([], DOCS), benchmark).collect() == []


def test_every_match_is_found_whatever_its_cosine(spark):
    rng = random.Random(9)
    usual = [f"usual{k}" for k in range(300)]
    rare = lambda n: [f"rare{rng.randrange(10**7)}" for _ in range(n)]
    items = [(k, " ".join(rng.choice(usual) for _ in range(rng.choice([17, 20, 33, 40])))) for k in range(40)]
    rows = [(k, " ".join(rng.sample(usual, 60) + rare(100))) for k in range(200)]
    want = set()
    for n in range(400):
        k = rng.randrange(40)
        w = items[k][1].split()
        if n >= 200:  # a paraphrase: a fifth of the words replaced
            for j in rng.sample(range(len(w)), len(w) // 5):
                w[j] = rare(1)[0]
        else:
            want.add((1000 + n, k))
        rows.append((1000 + n, " ".join(rare(rng.randint(0, 200)) + w + rare(rng.randint(0, 200)))))
    docs, benchmark = table(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    idf = decontaminate.idf_weights(docs)
    keys = lambda t: decontaminate.word_keys(*decontaminate.lowered(pa.array([t])))[0]
    item_keys = [keys(t) for _, t in items]
    for i, t in rows[200:]:  # brute force over all passages
        h = keys(t)
        for k, own in enumerate(item_keys):
            weight = idf[decontaminate.cell(own)].astype(float) + 1e-3
            length = 1 << (len(own) - 1).bit_length()
            margin = len(own) // 2 + 8
            places = range(0, max(len(h) - length, 0) + length // 2, length // 2)
            if np.isin(own, h).mean() >= 0.6 and any(decontaminate.check_match(own, weight, h[max(a - margin, 0) : a + length + margin]) for a in places):
                want.add((i, k))
    assert len(want) > 350
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated_pairs(docs, benchmark).collect() if r.doc_id >= 1000} == want


def test_matches_are_found_in_a_space_without_their_directions():
    rng = random.Random(10)
    word = lambda: f"w{rng.randrange(3000)}"
    items = [(k, " ".join(word() for _ in range(rng.randint(17, 54)))) for k in range(50)]
    prepared = decontaminate.prepare(items, np.full(1 << decontaminate.CELL_BITS, 3, np.float32), np.zeros((decontaminate.FEATURES, 4), np.float32))
    texts = [" ".join([word() for _ in range(rng.randint(0, 300))] + items[k % 50][1].split() + [word() for _ in range(rng.randint(0, 300))]) for k in range(500)]
    got = {(d, k) for d, k, *_ in decontaminate.search(*decontaminate.lowered(pa.array(texts)), prepared)}
    assert {(d, d % 50) for d in range(500)} <= got


@pytest.mark.parametrize("cells", [1 << 22, 8])
def test_common_subsequence(monkeypatch, cells):
    monkeypatch.setattr(decontaminate, "CELLS", cells)
    rng = np.random.default_rng(0)
    for _ in range(50):
        a, b = rng.integers(0, 5, rng.integers(1, 12)).astype(np.uint64), rng.integers(0, 5, rng.integers(0, 15)).astype(np.uint64)
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
        on = decontaminate.common_subsequence(a, b)
        assert on.sum() == t[-1][-1]
        rest = iter(b.tolist())
        assert all(x in rest for x in a[on].tolist())


def test_pipeline_on_awkward_documents(spark, tmp_path):
    def prose(k):
        rng = random.Random(k)
        return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(120))

    bench = " ".join(f"item{j}" for j in range(30))
    rows = awkward(13) + [(1000 + k, prose(k)) for k in range(20)] + [(2000, prose(3)), (2001, f"{prose(50)} {bench} {prose(51)}")]
    clashing(table(spark, rows)).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = [r.doc_id for r in out]
    assert {1000 + k for k in range(20)} <= set(ids) and not {2001, 0, 1, 2, 3} & set(ids) and len(ids) == len(set(ids))
    # Line de-duplication empties a whole copy; of the emptied documents one stays.
    assert sum(r.text == "" for r in out) <= 1 and all(r.text == "" for r in out if r.doc_id == 2000)
    assert all(r.n_chars == len(r.text) and r.pos == "own pos" for r in out)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
    assert collected(corpus_pipeline.STAGES[0][1](spark, docs.limit(0), str(tmp_path))) == []


def brute_links(spark, rows):
    """The similarities of all pairs of different texts of 0.8 and more, by their places in ``rows``."""
    weights = minhash.shingle_weights(table(spark, rows))
    sets = []
    for _, t in rows:
        raw = np.frombuffer((t or "").encode(), np.uint8)
        _, h, c = minhash.shingles(np.array([0, len(raw)]), raw)
        sets.append((h, (c * weights[minhash.cell(h)]).astype(float)))
    found = {(a, b): minhash.weighted_jaccard(sets[a], sets[b]) for a in range(len(rows)) for b in range(a) if len(sets[a][0]) and len(sets[b][0])}
    return {p: s for p, s in found.items() if s >= 0.8}


def test_links_and_nearest_texts(spark, monkeypatch):
    rng = random.Random(12)
    rows = [(-1, None), (-2, ""), (-3, " ")]
    for base in range(0, 300, 100):
        text = " ".join(f"w{rng.randrange(10**6)}" for _ in range(120))
        rows += [(base + k, edited(text, rng.randint(0, 3), rng) if k else text) for k in range(40)]
    rows = list({t: (i, t) for i, t in rows}.values())  # different texts
    links = brute_links(spark, rows)
    for part in (1024, 13):  # whole buckets, and many pairs of blocks a bucket
        monkeypatch.setattr(minhash, "PART", part)
        got = {r.doc_id: r for r in minhash.class_report(table(spark, rows)).collect()}
        for k, (i, _) in enumerate(rows):
            own = {b if a == k else a: s for (a, b), s in links.items() if k in (a, b)}
            # A pair of 0.8 shares a band in 0.9992 of cases; here all links show.
            assert got[i].n_links == len(own)
            assert (got[i].nearest_id is None) == (not own)
            if own:
                assert abs(got[i].similarity - max(own.values())) < 1e-9 and abs(own[[x for x, _ in rows].index(got[i].nearest_id)] - got[i].similarity) < 1e-9


def test_similarities_by_products_and_by_pairs():
    rng = np.random.default_rng(5)
    for size in (2, 30, 120):
        docs = [np.unique(rng.integers(0, 300, rng.integers(0, 120))).astype(np.uint64) for _ in range(size)]
        counts = [rng.integers(1, 4, len(d)) for d in docs]
        idf = [1 + (d % 7).astype(float) for d in docs]
        i, j = np.triu_indices(size, 1)
        flat = (np.repeat(np.arange(size), [len(d) for d in docs]), np.concatenate(docs), np.concatenate(counts), np.concatenate(idf))
        want = [minhash.weighted_jaccard((docs[a], counts[a] * idf[a]), (docs[b], counts[b] * idf[b])) for a, b in zip(i, j)]
        few = slice(0, 3)
        assert np.abs(minhash.similarities(*flat, i, j, columns=64) - want).max() < 1e-12
        assert np.abs(minhash.similarities(*flat, i[few], j[few]) - want[few]).max() < 1e-12


def test_a_large_group_of_near_copies_and_planted_pairs(spark):
    rng = random.Random(77)
    fresh = lambda n: [f"f{rng.randrange(10**7)}" for _ in range(n)]
    base = fresh(220)
    rows = []
    for k in range(3000):  # near copies of one text, some beyond 0.8 of each other
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = fresh(1)[0]
        rows.append((k, " ".join(w)))
    for k in range(500):  # pairs that share the group's first half but are near to each other alone
        one = base[:60] + fresh(160)
        cut = rng.randrange(200)
        rows += [(10_000 + k, " ".join(one)), (20_000 + k, " ".join(one[:cut] + fresh(2) + one[cut + 2 :]))]
    got = {r.doc_id: r.class_id for r in minhash.class_report(table(spark, rows)).collect()}
    assert all(got[k] == 0 for k in range(3000))
    assert sum(got[20_000 + k] == 10_000 + k for k in range(500)) >= 499 and all(got[10_000 + k] == 10_000 + k for k in range(500))


def test_near_duplicates_of_empty_and_very_long_texts(spark):
    assert minhash.class_report(table(spark, [])).collect() == [] and minhash.keep_one(table(spark, [])).collect() == []
    rng = random.Random(2)
    long = " ".join(f"w{rng.randrange(5000)}" for _ in range(200_000))
    rows = [(1, long), (2, edited(long, 3000, rng)), (3, long[: len(long) // 2]), (4, "one"), (5, "one"), (6, None), (7, "")]
    got = {r.doc_id: r.class_id for r in minhash.class_report(table(spark, rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4, 6: 6, 7: 6}


def test_the_kept_row_of_equal_texts_is_defined(spark):
    text = " ".join(f"w{k}" for k in range(80))
    rows = [(1, text, "en", f"source {k}", k) for k in range(40)]
    kept = {tuple(minhash.keep_one(spark.createDataFrame(rows, DOCS).repartition(n)).collect()[0]) for n in (1, 3, 8)}
    assert len(kept) == 1


def test_decontamination_of_short_equal_and_long_items(spark, monkeypatch):
    rng = random.Random(41)
    word = lambda: "".join(rng.choice("abcdefghijk") for _ in range(rng.randint(3, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    long, mid = prose(6000), prose(40)
    items = [(1, mid), (2, mid), (3, long), (4, "red Herring, blue"), (5, "zebra"), (6, "..."), (7, None), (8, ""), (9, prose(30))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [(k, prose(120)) for k in range(40)]
    rows += [(100, f"{prose(50)} {mid} {prose(50)}"), (101, f"{prose(90_000)} {mid}"), (102, f"{prose(30)} {long} {prose(30)}"), (103, f"{prose(9)} RED herring blue {prose(9)}"), (104, "red herring is blue zebra zebra")]
    rows += [rows[40], (None, f"a {mid} b")]
    want = sorted([(100, 1), (100, 2), (100, 1), (100, 2), (101, 1), (101, 2), (102, 3), (103, 4), (104, 5), (None, 1), (None, 2)], key=str)
    docs = clashing(table(spark, rows))
    for most in (20_000, 2):  # one block of items, and five with one latent space
        monkeypatch.setattr(decontaminate, "ITEMS", most)
        got = [(r.doc_id, r.item_id) for r in decontaminate.contaminated_pairs(docs, benchmark).collect()]
        assert sorted(got, key=str) == want
        kept = [r.doc_id for r in decontaminate.drop_contaminated(docs, benchmark).collect()]
        assert sorted(kept, key=str) == sorted([*range(40), 103, 104], key=str)


def test_latent_space_is_fitted_on_every_passage(spark):
    import numpy as np
    import pyarrow as pa

    # 40 passages of words that no other has; a rest of 10 words is in the last one's row.
    text = [" ".join(f"w{k}x{j}" for j in range(64 if k < 39 else 74)) for k in range(40)]
    docs = spark.createDataFrame([(1, " ".join(text)), (None, "nulls count too " * 30), (2, None), (3, "")], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    idf = decontaminate.idf_weights(docs)
    space = decontaminate.latent_space(docs, items, idf)
    assert space.shape[1] >= 41
    for t in [*text, "w39x70 w39x71 w39x72 w39x73", "nulls count too"]:
        h, _ = decontaminate.word_keys(*decontaminate.lowered(pa.array([t])))
        v = (space[decontaminate.feature(h)] * idf[decontaminate.cell(h)][:, None]).sum(axis=0)
        assert np.linalg.norm(v) > 0.5


def test_passage_bounds():
    import numpy as np

    start, end = decontaminate.passage_bounds(np.cumsum([0, 0, 1, 64, 80, 81, 0]))
    assert list(zip(start.tolist(), end.tolist())) == [(0, 1), (1, 65), (65, 145), (145, 209), (209, 226)]
    start, end = decontaminate.passage_bounds(np.array([0, 0]))
    assert not len(start) and not len(end)


def test_sums_of_runs():
    rng = np.random.default_rng(3)
    table_ = rng.standard_normal((50, 7)).astype(np.float32)
    for sizes in ([], [1], [8, 8, 3], rng.integers(1, 40, 300), [5000, 1]):
        sizes = np.array(sizes, np.int64)
        row, weight = rng.integers(0, 50, sizes.sum()), rng.random(sizes.sum()).astype(np.float32)
        ends = np.cumsum(sizes)
        want = [(table_[row[a:b]] * weight[a:b, None]).sum(axis=0) for a, b in zip(ends - sizes, ends)]
        for width in (1, 8, 64):
            got = decontaminate.weighed_sums(table_, row, weight, sizes, width)
            assert got.shape == (len(sizes), 7) and np.allclose(got, np.reshape(want, (-1, 7)), rtol=1e-3, atol=1e-3)
    sizes = np.array([0, 1, 2, 5, 0])
    assert decontaminate.pairs_added(np.arange(8.0)[:, None], sizes).ravel().tolist() == [0, 3, 7, 11, 7]


def test_products_of_sparse_passages():
    rng = np.random.default_rng(4)
    texts = pa.array([" ".join(f"w{k}" for k in rng.integers(0, 900, n)) for n in (0, 1, 63, 64, 500, 3000)])
    idf = rng.random(1 << decontaminate.CELL_BITS).astype(np.float32)
    rows = []  # each passage on its own, plainly
    for t in texts:
        h, first = decontaminate.word_keys(*decontaminate.lowered(pa.array([t])))
        for a, b in zip(*decontaminate.passage_bounds(first)):
            x = np.bincount(decontaminate.feature(h[a:b]), idf[decontaminate.cell(h[a:b])], decontaminate.FEATURES)
            rows.append(x / np.linalg.norm(x))
    dense = np.array(rows)
    q = rng.standard_normal((decontaminate.FEATURES, 9)).astype(np.float32)
    packed = list(decontaminate._weighed_passages(idf)([pa.RecordBatch.from_arrays([texts], names=["text"])]))
    for gram, want in ((False, dense.T @ (dense @ q)), (True, (dense @ q).T @ (dense @ q))):
        [out] = decontaminate._products(q, gram)(iter(packed))
        got = np.concatenate([decontaminate.unpack(x.as_py()) for x in out.column("sums")]).reshape(want.shape)
        assert np.allclose(got, want, atol=1e-3 * np.abs(want).max())


def test_steps_take_batches_of_few_bytes(spark):
    docs = spark.range(1, 9, 1, 1).selectExpr("id as doc_id", "repeat('many words ', 200000) as text")
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["size"])

    corpus_pipeline.encoding(spark, docs, "")
    assert max(r.size for r in docs.mapInArrow(sizes, "size long").collect()) < 5 << 20
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
