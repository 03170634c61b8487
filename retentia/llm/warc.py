"""WARC archives: written from pages, read back, segments put together.

Writing.  A page is a response record, or a revisit record where a page of
smaller id has an equal payload of at least ``min_payload`` bytes.  The
HTTP body goes out in chunked transfer framing.  A block longer than
``segment_bytes`` is cut: the first segment is the response, the others are
continuation records with the origin's identifier and their number, and the
last one carries the total length.  Archives are text files of bounded
record counts (``lineSep`` is a record's closing CRLF CRLF, and cuts fall
between characters), gzipped, written by Spark's own writer into the shared
folder; a retried task's files are dropped by the commit.

Reading.  Archives are binary files, decompressed and parsed as a stream.
Whole records are decoded on the spot; segments are shuffled with their bytes by
origin, ordered by number, checked against the total length, and decoded
from the chunked framing.

Equal payloads are found by digest with a map-side minimum, so a payload
that a third of the pages share costs one row a task; the join that marks
the revisits carries ids alone and Spark splits its hot partitions.

Defined cases: a null or empty html is an empty payload; a null page id
ranks after all ids; rows of one page id and one payload are all responses
or all revisits, a record and a result row each; any length is segmented;
an empty table gives an empty result; other columns but ``url`` are ignored.
"""

from __future__ import annotations

import hashlib
import sys
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia.llm.common import NULL_ID, shuffle_partitions
from retentia.session import scratch_path, ship_by_value

CRLF = "\r\n"
BREAK = b"\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"


def with_revisits(pages: DataFrame, min_payload: int = 100) -> DataFrame:
    """page_id, url, html, digest, refers_to (null for a response)."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", F.coalesce(F.col("page_id").cast("long"), F.lit(NULL_ID)).alias("pid"), "url", html.alias("html"), F.sha2(html, 256).alias("digest"))
    large = rows.where(F.octet_length("html") >= min_payload).select("pid", "digest")
    first = large.groupBy("digest").agg(F.min("pid").alias("least"), F.max("pid").alias("most")).where("least < most").select("digest", "least")
    revisits = large.join(first, "digest").where("pid > least").select("pid", "digest", F.col("least").alias("refers_to")).distinct()
    return rows.join(revisits.hint("shuffle_hash"), ["pid", "digest"], "left").select("page_id", "url", "html", "digest", "refers_to")


def chunked(body: bytes, size: int = 16384) -> bytes:
    """Chunked transfer framing; cuts fall between characters."""
    out, i = [], 0
    while i < len(body):
        j = cut(body, i, size)
        out += [b"%x\r\n" % (j - i), body[i:j], b"\r\n"]
        i = j
    return b"".join([*out, b"0\r\n\r\n"])


def cut(data: bytes, start: int, size: int) -> int:
    """The end of a piece of at most ``size`` bytes (at least one character) that splits no character."""
    end = start + max(size, 4)
    if end >= len(data):
        return len(data)
    while data[end] & 0xC0 == 0x80:
        end -= 1
    return end


def record_id(kind: str, page_id: int | None, digest: str, number: int) -> str:
    h = hashlib.md5(f"{kind}|{page_id}|{digest}|{number}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def record(fields: list[tuple[str, str]], block: bytes) -> str:
    """A record without its closing CRLF CRLF, which the writer puts between records."""
    head = "WARC/1.1" + CRLF + "".join(f"{k}: {v}{CRLF}" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return head + CRLF + block.decode()


def page_records(page_id: int | None, url: str | None, html: str, digest: str, refers_to: int | None, segment_bytes: int) -> Iterator[str]:
    """The records of one page."""
    own = [("WARC-Date", DATE), ("WARC-Target-URI", " ".join((url or "").split())), ("WARC-Page-ID", "" if page_id is None else str(page_id)), ("WARC-Payload-Digest", f"sha256:{digest}")]
    body = html.encode()
    if refers_to is not None:
        status = [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", record_id("response", refers_to, digest, 1)), ("WARC-Refers-To-Page-ID", str(refers_to)), ("WARC-Payload-Length", str(len(body)))]
        yield record([("WARC-Type", "revisit"), ("WARC-Record-ID", record_id("revisit", page_id, digest, 1)), *own, *status], b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(body)
    origin = record_id("response", page_id, digest, 1)
    kind = [("Content-Type", "application/http;msgtype=response")]
    if len(block) <= segment_bytes:
        yield record([("WARC-Type", "response"), ("WARC-Record-ID", origin), *own, *kind], block)
        return
    i, number = 0, 0
    while i < len(block):
        j, number = cut(block, i, segment_bytes), number + 1
        place = [("WARC-Segment-Number", str(number))]
        if number > 1:
            place.append(("WARC-Segment-Origin-ID", origin))
        if j == len(block):
            place.append(("WARC-Segment-Total-Length", str(len(block))))
        yield record([("WARC-Type", "response" if number == 1 else "continuation"), ("WARC-Record-ID", record_id("response", page_id, digest, number)), *own, *(kind if number == 1 else []), *place], block[i:j])
        i = j


def _write(segment_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("value", pa.string())])
        for batch in batches:
            out, size = [], 0
            for row in zip(*(c for c in batch.columns)):
                for r in page_records(*(x.as_py() for x in row), segment_bytes):
                    out.append(r)
                    size += len(r)
                if size > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], schema=schema)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], schema=schema)

    return run


def write_archives(pages: DataFrame, path: str, min_payload: int = 100, segment_bytes: int = 16384, records_per_file: int = 4096) -> None:
    """Gzipped archives of at most ``records_per_file`` records, so of bounded size, under ``path``."""
    records = with_revisits(pages, min_payload).mapInArrow(_write(segment_bytes), "value string")
    records.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", records_per_file).text(path)


# --- reading -----------------------------------------------------------------

PARSED = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, origin string, number int, total long, block binary"
_PARSED = pa.schema(
    [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("block", pa.binary())]
)
RESULT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
_RESULT = pa.schema(list(_PARSED)[:5])


def stream(content: bytes, step: int = 1 << 18) -> Iterator[bytes]:
    """The decompressed content of an archive of one or more gzip members, piece by piece."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    while content:
        z = zlib.decompressobj(31)
        rest = content
        while not z.eof and rest:
            yield z.decompress(rest, step)
            rest = z.unconsumed_tail
        if not z.eof:
            yield z.flush()
        content = z.unused_data


def parse_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(named fields in lower case, block) of each record; lengths alone delimit blocks."""
    buffer, at = b"", 0

    def fill(until: int) -> bool:
        nonlocal buffer, at
        if len(buffer) - at >= until:
            return True
        held, size = [buffer[at:]], len(buffer) - at
        at = 0
        while size < until and (p := next(pieces, None)) is not None:
            held.append(p)
            size += len(p)
        buffer = b"".join(held)
        return size >= until

    while fill(1):
        want = 1024
        while (end := buffer.find(BREAK, at)) < 0:
            if not fill(want):
                if buffer.find(BREAK, at) < 0:
                    raise ValueError("a record's header doesn't end")
            want *= 2
        version, *lines = buffer[at:end].decode().split(CRLF)
        if not version.startswith("WARC/"):
            raise ValueError(f"not a record: {version[:40]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        at, length = end + 4, int(fields["content-length"])
        if not fill(length + 4):
            raise ValueError("a record is cut short")
        if buffer[at + length : at + length + 4] != BREAK:
            raise ValueError("a record's length is wrong")
        yield fields, buffer[at : at + length]
        at += length + 4


class BodyReader:
    """Takes an HTTP response's bytes piece by piece; digests the body, out of its chunked framing."""

    def __init__(self) -> None:
        self.held, self.state, self.left, self.size, self.sha = b"", "head", 0, 0, hashlib.sha256()
        self.chunked = False

    def _body(self, data: bytes) -> None:
        self.size += len(data)
        self.sha.update(data)

    def add(self, data: bytes) -> None:
        data = self.held + data if self.held else data
        self.held, at = b"", 0
        while True:
            if self.state == "head":
                end = data.find(BREAK, at)
                if end < 0:
                    break
                self.chunked = b"transfer-encoding: chunked" in data[at:end].lower()
                self.state, at = "size" if self.chunked else "plain", end + 4
            elif self.state == "plain":
                self._body(data[at:])
                return
            elif self.state == "size":
                end = data.find(b"\r\n", at)
                if end < 0:
                    break
                self.left = int(data[at:end].split(b";")[0], 16)
                at, self.state = end + 2, "data" if self.left else "trailer"
            elif self.state == "data":
                part = data[at : at + self.left]
                if not part:
                    break
                self._body(part)
                at, self.left = at + len(part), self.left - len(part)
                if not self.left:
                    self.state = "gap"
            elif self.state == "gap":
                if len(data) - at < 2:
                    break
                if data[at : at + 2] != b"\r\n":
                    raise ValueError("a chunk's size is wrong")
                at, self.state = at + 2, "size"
            elif self.state == "trailer":
                end = data.find(b"\r\n", at)
                if end < 0:
                    break
                self.state, at = ("done", end + 2) if end == at else ("trailer", end + 2)
            else:
                if at < len(data):
                    raise ValueError("bytes after the last chunk")
                break
        self.held = data[at:]

    def finish(self) -> tuple[int, str]:
        if self.state not in ("plain", "done"):
            raise ValueError("a response is cut short")
        return self.size, self.sha.hexdigest()


def _number(x: str | None) -> int | None:
    return int(x) if x else None


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            out, size = [], 0
            for f, block in parse_records(stream(content.as_py())):
                kind, page = f["warc-type"], _number(f.get("warc-page-id"))
                if kind == "revisit":
                    row = (page, int(f["warc-payload-length"]), f["warc-payload-digest"].partition(":")[2], "revisit", int(f["warc-refers-to-page-id"]), None, None, None, None)
                elif "warc-segment-number" in f:
                    row = (page, None, None, "response", None, f.get("warc-segment-origin-id", f["warc-record-id"]), int(f["warc-segment-number"]), _number(f.get("warc-segment-total-length")), block)
                    size += len(block)
                else:
                    reader = BodyReader()
                    reader.add(block)
                    row = (page, *reader.finish(), "response", None, None, None, None, None)
                out.append(row)
                if size > 1 << 22 or len(out) >= 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), _PARSED)], schema=_PARSED)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), _PARSED)], schema=_PARSED)


def _reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (origin, number); copies of a record come as equal rows, as often as its page does."""
    origin = None
    page, reader, copies, last, length, total = None, BodyReader(), 0, 0, 0, None

    def close() -> list[tuple]:
        if length != total:
            raise ValueError(f"{origin}: {length} bytes in its segments, {total} announced")
        return [(page, *reader.finish(), "response", None)] * copies

    for batch in batches:
        out = []
        for p, size, digest, kind, refers_to, o, number, t, block in zip(*(c.to_pylist() for c in batch.columns)):
            if o is None:  # a whole record
                out.append((p, size, digest, kind, refers_to))
                continue
            if o != origin:
                if origin is not None:
                    out += close()
                origin, page, reader, copies, last, length, total = o, p, BodyReader(), 0, 0, 0, None
            if number == last:  # the same segment of a repeated page
                copies += number == 1
                continue
            if number != last + 1:
                raise ValueError(f"{o}: segment {last + 1} is missing")
            copies += number == 1
            last, length, total = number, length + len(block), t if t is not None else total
            reader.add(block)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _RESULT)], schema=_RESULT)
    if origin is not None:
        out = close()
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _RESULT)], schema=_RESULT)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per page record of the archives: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    parsed = files.select("content").mapInArrow(_parse, PARSED)
    # Whole records go along as small rows, spread by page, so that the archives are parsed once.
    key = F.coalesce("origin", F.col("page_id").cast("string"), F.lit(""))
    placed = parsed.repartition(shuffle_partitions(spark), key).sortWithinPartitions("origin", "number")
    return placed.mapInArrow(_reassemble, RESULT)


def archive_round_trip(pages: DataFrame, min_payload: int = 100, segment_bytes: int = 16384) -> DataFrame:
    """Writes archives into the shared folder, and what they say when read back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, min_payload, segment_bytes)
    return read_archives(spark, path)


ship_by_value(sys.modules[__name__])
