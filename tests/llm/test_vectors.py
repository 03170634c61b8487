"""Fill-in-middle, whitening and SimHash against brute force."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from llm_helpers import awkward, collected, in_order, order_id, sha, table, words
from pyspark.sql import functions as F
from test_pairs import edited, roots
from test_texts import clashing

from retentia.llm import contour, fim, simhash, whitening

# --- fill in the middle -------------------------------------------------------


def fim_expected(rows):
    out = []
    for i, t in rows:
        t = t or ""
        h = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
        a, b = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
        pre, mid, suf = t[:a], t[a:b], t[b:]
        if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
            out.append((i, len(t), "plain", None, None, sha(t), sha(t)))
        elif h4 % 100 < 20:
            out.append((i, len(t), "spm", a, b - a, sha(f"<S>{suf}<P>{pre}<M>{mid}"), sha(t)))
        else:
            out.append((i, len(t), "psm", a, b - a, sha(f"<P>{pre}<S>{suf}<M>{mid}"), sha(t)))
    return out


def fim_texts():
    rng = random.Random(4)
    pieces = ["a", "é", "日本", "😀", "<", "P>", "<S", ">", "M", "\n", " ", "\x00", "é", "<P", "S>", "\U0010ffff", "<x>"]
    rows = [(1000 + k, "".join(rng.choice(pieces) for _ in range(rng.choice([1, 2, 7, 8, 9, 40, 200])))) for k in range(300)]
    return awkward() + rows + [(2000, "x<P>y"), (2001, "<M>"), (2002, "<S>😀"), (None, None), (2003, "日" * 300_000 + "a" * 200_001)]


def test_fim_report(spark):
    rows = fim_texts()
    want = in_order(fim_expected(rows))
    assert {r[2] for r in want} == {"plain", "psm", "spm"}
    assert collected(fim.fim_report(clashing(table(spark, rows)))) == want
    assert collected(fim.fim_report(table(spark, rows).repartition(7))) == want
    assert fim.fim_report(table(spark, [])).collect() == []


def test_fim_rows_keep_columns_and_texts(spark):
    rows = fim_texts()
    docs = table(spark, rows).withColumn("fim_n", F.lit("own")).withColumn("output", F.lit(5))
    out = fim.fim_rows(docs, seed=9)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "output", *fim.ADDED]
    got = out.withColumn("again", fim.restored(F.col("fim_output"), F.col("fim_form"))).collect()
    assert sorted((order_id(r.doc_id), r.text or "") for r in got) == sorted((order_id(i), t or "") for i, t in rows)
    assert all(r.again == (r.text or "") and r.output == 5 and r.fim_n == len(r.text or "") for r in got)
    assert {r.fim_form for r in fim.fim_rows(docs, fim_percent=0).collect()} == {"plain"}
    assert "psm" not in {r.fim_form for r in fim.fim_rows(docs, fim_percent=100, spm_percent=100).collect()}


def test_units_rank_and_select():
    rng = random.Random(2)
    for _ in range(200):
        text = "".join(rng.choice("aé日😀\x7f\u0080") for _ in range(rng.randint(0, 40)))
        raw = text.encode()
        units = fim.Units(np.frombuffer(raw, np.uint8))
        ends = [len(text[:k].encode()) for k in range(len(text) + 1)]
        assert units.select(np.arange(len(text) + 1)).tolist() == ends
        assert units.rank(np.array(ends)).tolist() == list(range(len(text) + 1))


# --- whitening ------------------------------------------------------------------


def test_inertia_and_eigenpairs():
    rng = np.random.default_rng(1)
    for _ in range(150):
        a = rng.integers(-2, 3, (rng.integers(1, 9),) * 2).astype(float)
        a = a + a.T
        w = np.linalg.eigvalsh(a)
        if np.abs(w).min() > 1e-9:
            assert contour.negatives(a) == (w < 0).sum()
    q, _ = np.linalg.qr(rng.standard_normal((40, 40)))
    spectra = [rng.uniform(0, 5, 40), np.r_[3, 3, 3, np.ones(37)], np.r_[7, 7 - 1e-9, 2, np.full(37, 2 - 1e-6)], np.r_[1e6, 1, 1e-4, np.zeros(37)], 10.0 ** -np.arange(40), np.zeros(40) + 2]
    for w in spectra:
        a = (q * w) @ q.T
        a = (a + a.T) / 2
        least = 1e-12 * np.trace(a)
        e, v = contour.largest(a, 4, least)
        want = np.sort(w[w > least])[::-1][:4]
        assert len(e) == len(want) and np.abs(e - want).max() < 1e-13 * want[0]
        assert np.abs(a @ v - v * e).max() < 1e-12 * want[0] and np.abs(v.T @ v - np.eye(len(e))).max() < 1e-9


def test_a_missed_eigenvalue_is_an_error():
    with pytest.raises(ArithmeticError):
        contour.feast(np.diag([5.0, 4.0, 1.0, 0.5]), 3.0, 6.0, 3)


def vectors():
    rng = np.random.default_rng(3)
    # A mean far from zero.
    x = rng.standard_normal((300, 6)) @ rng.standard_normal((6, 6)) + 40
    rows = [(k, [float(c) for c in v], "e") for k, v in enumerate(x)]
    rows += [(1000 + k, rows[k % 3][1], "copy") for k in range(200)]
    rows += [(2000, None, ""), (2001, [1.0] * 5 + [None], ""), (2002, [1.0] * 5 + [math.nan], ""), (2003, [1.0] * 5 + [math.inf], ""), (2004, [], ""), (2005, [1.0, 2.0], ""), (None, rows[5][1], ""), (7, rows[7][1], ""), (2006, [-0.0] * 6, ""), (2007, [c + 0.001 for c in rows[0][1]], "")]
    return rows


def test_whitening(spark):
    rows = vectors()
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x string").withColumn("n", F.lit("clash")).withColumn("component", F.lit(1))
    got = whitening.whiten(docs).collect()
    good = [(i, tuple(math.floor(256 * c) for c in v)) for i, v, _ in rows if v is not None and len(v) == 6 and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({x for _, x in good})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, sums)] for x in fit])
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1][:4], v[:, ::-1][:, :4]
    assert len(got) == 4 * len(good) and {r.n for r in got} == {n}
    assert max(r.identity_error for r in got) < 1e-9 and len({r.identity_error for r in got}) == 1
    deviation = {x: sum((n * a - s) ** 2 for a, s in zip(x, sums)) for x in fit}
    assert sorted((order_id(r.vec_id), r.deviation) for r in got if r.component == 1) == sorted((order_id(i), deviation[x]) for i, x in good)
    for k in range(4):
        own = sorted((order_id(r.vec_id), r.whitened) for r in got if r.component == k + 1)
        want = sorted((order_id(i), float((np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums)]) @ v[:, k]) / math.sqrt(e[k]))) for i, x in good)
        a, b = np.array([w for _, w in own]), np.array([w for _, w in want])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-7
        assert all(r.explained == pytest.approx(e[k] / (centred**2).sum() * n, rel=1e-9) for r in got if r.component == k + 1)


def test_whitening_of_awkward_tables(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert whitening.whiten(make([])).collect() == []
    assert whitening.whiten(make([(1, None), (2, [])])).collect() == []
    assert whitening.whiten(make([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    # One direction only: one component; the deviation of the huge entries fits no long.
    got = whitening.whiten(make([(1, [0.0, 0.0]), (2, [1.0, 2.0]), (3, [2.0, 4.0])])).collect()
    assert {(r.vec_id, r.component) for r in got} == {(1, 1), (2, 1), (3, 1)} and all(abs(r.explained - 1) < 1e-12 for r in got)
    huge = whitening.whiten(make([(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [1e12, 5.0])])).collect()
    assert huge and all(r.deviation is None for r in huge if r.vec_id < 3)


# --- SimHash --------------------------------------------------------------------


def lowered(w):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)


def fingerprint(text):
    w = [lowered(x) for x in words(text)]
    shingles = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def simhash_rows():
    rng = random.Random(6)
    rows = [r for r in awkward(17) if r[0] is None or r[0] < 60]
    for base in range(100, 1100, 50):
        text = " ".join(f"Wort{rng.randrange(500)}" for _ in range(rng.randint(40, 400)))
        rows += [(base, text), (base + 1, text.upper())] + [(base + 2 + k, edited(text, rng.randint(1, 4), rng)) for k in range(12)]
    return rows


def test_fingerprints_and_components(spark):
    rows = simhash_rows()
    fp = [fingerprint(t) for _, t in rows]
    edges = [(a, b) for k, a in enumerate(set(fp)) for b in list(set(fp))[:k] if (a ^ b).bit_count() <= 3]
    assert len(edges) > 60
    root = roots(set(fp), edges)
    least = {}
    for (i, _), f in zip(rows, fp):
        least[root[f]] = min(least.get(root[f], 2**64), order_id(i))
    back = lambda i: None if i == 2**63 - 1 else i
    want = in_order([(i, f"{f:016x}", back(least[root[f]])) for (i, _), f in zip(rows, fp)])
    assert collected(simhash.simhash_report(clashing(table(spark, rows)))) == want
    kept = simhash.keep_one(clashing(table(spark, rows))).collect()
    assert {order_id(r.doc_id) for r in kept} == set(least.values()) and kept[0].pos == "own pos"
    assert simhash.simhash_report(table(spark, [])).collect() == [] and simhash.keep_one(table(spark, [])).collect() == []


def linked_as(spark, fps, **kw):
    df = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in fps], "fp long")
    found = [(r.u % 2**64, r.v % 2**64) for r in simhash.links(df, **kw).collect()]
    assert all((a ^ b).bit_count() <= kw.get("distance", 3) for a, b in found)
    return found


def test_hot_keys_lose_no_link_and_stay_small(spark):
    rng = random.Random(9)
    # One dense cloud that shares most blocks (hot in every table), chains of 3-bit steps, and strangers.
    centre = rng.getrandbits(64)
    fps = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 7))) for _ in range(1500)}
    for _ in range(30):
        x = rng.getrandbits(64)
        for _ in range(12):
            fps.add(x)
            x ^= sum(1 << b for b in rng.sample(range(64), 3))
    fps = sorted(fps | {rng.getrandbits(64) for _ in range(500)} | {0, 1, 7, 2**63})
    want = roots(fps, [(a, b) for k, a in enumerate(fps) for b in fps[:k] if (a ^ b).bit_count() <= 3])
    for part in (100, 1024):
        found = linked_as(spark, fps, part=part)
        assert roots(fps, found) == want
    assert len(found) < 20 * len(fps)
    few = fps[:300] + fps[-300:]
    assert roots(few, linked_as(spark, few, distance=1, blocks=3)) == roots(few, [(a, b) for k, a in enumerate(few) for b in few[:k] if (a ^ b).bit_count() <= 1])


def test_majority_of_long_runs():
    rng = np.random.default_rng(8)
    runs = [rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, n, dtype=np.uint64) for n in (1, 2, 255, 256, 257, 3000)]
    lengths = np.array([len(r) for r in runs])
    got = simhash.majority(np.concatenate(runs), np.cumsum(lengths) - lengths, lengths)
    for r, g in zip(runs, got.tolist()):
        assert g == sum(1 << b for b in range(64) if 2 * sum(int(x) >> b & 1 for x in r) > len(r))
