"""Brute-force forms of the operators, and small awkward tables."""

import hashlib
import random
import re
from collections import Counter

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SPACES = re.compile(r"[\x20\x09-\x0D]+")


def sha(x) -> str:
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def words(text):
    return [w for w in SPACES.split(text or "") if w]


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def awkward(seed=3, docs=40):
    """Null, empty, long, tied, repeated and overlapping texts."""
    rng = random.Random(seed)
    voc = ["ab", "c", "déf", "Gh", "i!", "the", "日本", "x" * 30]
    line = lambda n: " ".join(rng.choice(voc) for _ in range(n))
    shared = [line(rng.randint(5, 60)) for _ in range(6)]
    rows = [(0, None), (1, ""), (2, "\n"), (3, " \t\n \x0b"), (4, "a" * 5000), (5, "a" * 400)]
    for k in range(6, docs):
        parts = [rng.choice(shared) if rng.random() < 0.5 else line(rng.randint(1, 50)) for _ in range(rng.randint(1, 6))]
        rows.append((k, rng.choice(["\n", " ", "\r\n", "  \n\t"]).join(parts)))
    rows += [(docs, rows[10][1]), (docs + 1, rows[10][1]), (12, rows[12][1]), (13, "another text of one id " + (rows[14][1] or "")), (None, rows[11][1]), (docs + 2, line(30_000))]
    rng.shuffle(rows)
    return rows


def order_id(i):
    return 2**63 - 1 if i is None else i


def line_rows(rows, least=10):
    key = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    first = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            first[key(x)] = min(first.get(key(x), 2**64), order_id(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least or first[key(x)] == order_id(i)]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def copy_rows(rows, size=50):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - size + 1):
            first[b[k : k + size]] = min(first.get(b[k : k + size], 2**64), order_id(i))
    out = []
    for i, t in rows:
        b, gone = (t or "").encode(), set()
        for k in range(len(b) - size + 1):
            if first[b[k : k + size]] < order_id(i):
                gone.update(range(k, k + size))
        out.append((i, len(b), len(gone), sum(k - 1 not in gone for k in gone), sha(bytes(x for k, x in enumerate(b) if k not in gone))))
    return out


def window_rows(rows, size=35):
    count = Counter()
    for _, t in rows:
        w = words(t)
        count.update(tuple(w[k : k + size]) for k in range(len(w) - size + 1))
    out = []
    for i, t in rows:
        w, gone = words(t), set()
        for k in range(len(w) - size + 1):
            if count[tuple(w[k : k + size])] > 1:
                gone.update(range(k, k + size))
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def collected(df):
    return in_order([tuple(r) for r in df.collect()])
