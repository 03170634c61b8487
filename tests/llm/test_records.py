"""Chat formatting and WARC archives: round trips, and the queries against their SQL."""

import hashlib
import tracemalloc

import duckdb
import pyarrow as pa
import pytest
from llm_helpers import collected, in_order, sha

from retentia.llm import chat_format, queries, warc

SF = "/root/testdata/sf0.001"


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>assistant\n", "<\\|im_start|> [\\\\INST]", "", None, "plain\n", "<<SYS>><</SYS>>", "é😀\\", "x" * 100_000]
    rows = [(c, k, r, t) for c in (1, 2, None) for k, (r, t) in enumerate(zip(["user", "assistant", "system", None, "as\nsist\\n", "assistant", "<s>", "assistant", "user"], nasty))]
    rows += [(3, 0, "user", "same"), (3, 0, "user", "same"), (3, None, "assistant", "first"), (4, 5, "b", "2"), (4, 5, "a", "1")]
    df = spark.createDataFrame([(*r, "own") for r in rows], "conv_id long, turn long, role string, text string, seq string")
    formatted = chat_format.format_turns(df)
    for r in formatted.collect():
        assert len(chat_format.parse_turns(r.formatted)) == 1
        inner = r.formatted[len(chat_format.START) : -len(chat_format.END) - 1]
        assert not any(c in inner for c in chat_format.CONTROL)
    first = lambda x: (x is not None, x)
    want = []
    for c in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == c), key=lambda r: (first(r[1]), first(r[2]), first(r[3])))
        loss = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        want.append((c, len(mine), sha("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)), len(loss), sha(loss)))
    assert in_order([tuple(r)[:5] for r in chat_format.read_back(formatted).collect()]) == in_order(want)
    assert chat_format.read_back(chat_format.format_turns(df.limit(0))).collect() == []


def test_long_texts_are_formatted_in_bounded_memory():
    texts = ["é<s>" * 400_000 + str(k) for k in range(64)]  # 2 MB each
    batch = pa.RecordBatch.from_arrays([pa.array([1] * 64), pa.array(range(64)), pa.array(["assistant"] * 64), pa.array(texts), pa.array(range(64))], names=["conv_id", "turn", "role", "text", "seq"])
    tracemalloc.start()
    for k, out in enumerate(chat_format._format(iter([batch]))):
        assert out.num_rows == 1 and (k % 20 or chat_format.parse_turns(out.column(3)[0].as_py()) == [("assistant", texts[k])])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert k == 63 and peak < 100 << 20


def test_equal_turns_in_text_order_over_partitions(spark):
    # Many texts of one turn, alike in their beginnings: text order across range partitions.
    rows = [(1, 0, "user", ("a" * 70 if k % 2 else f"{k % 7}" * 70) + f"{k * 7919 % 1000:04d}" + "\U0001F600" * (k % 3)) for k in range(400)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat_format.read_back(chat_format.format_turns(df)).collect()
    assert [(r.n_turns, r.turns_sha256) for r in got] == [(400, sha("".join(f"user\n{t}\n" for t in sorted((r[3] for r in rows), key=lambda t: t.encode()))))]


def test_warc_round_trip(spark):
    big = "".join(chr(0x100 + k % 5000) for k in range(90_000))
    crlf = "\r\n\r\nWARC/1.1\r\n\r\n0\r\n\r\n" * 50
    rows = [(1, "u", None), (2, "u", ""), (3, "a\nb", "x" * 99), (4, None, "x" * 99), (9, "u", "y" * 100), (7, "u", "y" * 100), (8, "u", "y" * 100), (10, "u", big), (11, "u", big), (12, "u", crlf), (13, "u", crlf * 100), (13, "u", crlf * 100), (None, "u", "y" * 100), (14, "u", "é" * 50), (15, "u", "z" * 16384)]
    df = spark.createDataFrame([(*r, "own") for r in rows], "page_id long, url string, html string, digest string")
    want = []
    for p, _, h in rows:
        b = (h or "").encode()
        first = min((q if q is not None else 2**63 - 1) for q, _, g in rows if (g or "") == (h or ""))
        revisit = len(b) >= 100 and first != (2**63 - 1 if p is None else p)
        want.append((p, len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    assert collected(warc.archive_round_trip(df, segment_bytes=1000)) == in_order(want)
    assert collected(warc.archive_round_trip(df)) == in_order(want)
    assert warc.archive_round_trip(df.limit(0)).collect() == []


def test_broken_archives():
    whole = list(warc.page_records(1, "u", "body " * 400, "d", None, 500))
    text = lambda records: "".join(r + "\r\n\r\n" for r in records).encode()
    assert len(whole) > 3 and len(list(warc.parse_records(iter([text(whole)])))) == len(whole)
    assert len(list(warc.parse_records(iter([text(whole)[k : k + 7] for k in range(0, len(text(whole)), 7)])))) == len(whole)
    with pytest.raises(ValueError):
        list(warc.parse_records(iter([text(whole)[:-10]])))
    reader = warc.BodyReader()
    reader.add(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n5\r\nhel")
    with pytest.raises(ValueError):
        reader.finish()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    cur = con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.ORACLE[name]})")
    assert collected(df) == in_order([tuple(r) for r in cur.fetchall()])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_query_returns_its_rows(spark, name):
    df = queries.QUERIES[name](spark, SF)
    n = df.count()
    if name == "op12_whitening":
        assert n == 4 * spark.read.parquet(f"{SF}/embeddings.parquet").count()
    else:
        assert n == spark.read.parquet(f"{SF}/documents.parquet").count() or name == "op7_decontaminate" and n > 0
