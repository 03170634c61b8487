"""Chat formatting by columnar byte assembly.

Rows are range-partitioned by (conversation, turn) and sorted, so that even
one conversation with most of the rows spreads over the partitions.  A task
formats a batch at once: the segments' lengths (header, text, footer) give
cumulative offsets, and scatter indices copy all headers and texts into one
preallocated buffer, which becomes an Arrow column as it is.  Each turn is
one row of the output, made in portions of 2 MB of text (or one long text);
``read_back`` streams a conversation's turns in
order and keeps digests only, so a long conversation needs no memory.

Template of a turn:

    <|im_start|>ROLE \\n TEXT <|im_end|> \\n

A control string inside a text gets a backslash after its first character
(one more where backslashes already stand there); taking one away restores
the text.  No escaped text holds a control string.  Roles are escaped in
the same way after their own backslashes and line ends.

The loss mask marks, in code points of the formatted turn, the text of each
assistant turn as it stands there (escaped).

Defined cases: a null or empty text is empty; a null role reads as the
empty role; equal turn numbers follow each other by role, then text;
repeated rows are repeated turns; null conversation ids are one conversation;
null turns come first; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentia.llm.common import portions, shuffle_partitions, spread, string_buffers
from retentia.session import ship_by_value

START, END = "<|im_start|>", "<|im_end|>"
#: Control strings of common chat templates; none may stand in a formatted text but as markup.
CONTROL = (START, END, "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

_TAILS = "|".join(re.escape(c[1:]) for c in CONTROL)
_ESCAPE = rf"([<\[])(\\*)({_TAILS})"
_UNESCAPE = re.compile(rf"([<\[])\\(\\*)({_TAILS})")
_CONTROL = re.compile(rf"([<\[])(\\*)({_TAILS})")
_TURN = re.compile(rf"{re.escape(START)}([^\n]*)\n(.*?){re.escape(END)}\n", re.S)

FORMATTED = "conv_id long, turn long, seq long, formatted string, mask_start int, mask_end int"
_FORMATTED = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("seq", pa.int64()), ("formatted", pa.string()), ("mask_start", pa.int32()), ("mask_end", pa.int32())])


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def escaped_column(col: pa.Array) -> pa.Array:
    """The column with its control strings escaped."""
    return pc.replace_substring_regex(pc.fill_null(col.cast(pa.string()), ""), pattern=_ESCAPE, replacement=r"\1\\\2\3")


#: Code points of a text that rows are range-partitioned by, after conversation, turn and role.
RANGE_CHARS = 64
#: Longer segments are copied as slices, shorter ones by scatter indices.
LONG = 4096


def assemble(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of the rows' concatenations of these columns, given as (offsets, bytes)."""
    lengths = np.stack([np.diff(o) for o, _ in parts], axis=1)
    starts = np.concatenate([[0], np.cumsum(lengths.ravel())])
    buffer = np.empty(int(starts[-1]), np.uint8)
    place = starts[:-1].reshape(lengths.shape)
    for k, (offsets, data) in enumerate(parts):
        n = lengths[:, k]
        for row in np.flatnonzero(n > LONG).tolist():
            buffer[place[row, k] : place[row, k] + n[row]] = data[offsets[row] : offsets[row + 1]]
        short = np.flatnonzero(n <= LONG)
        run, inside = spread(n[short])
        buffer[place[short, k][run] + inside] = data[offsets[short][run] + inside]
    return starts[:: len(parts)], buffer


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in portions(batches, 3, 1 << 21):
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            n = part.num_rows
            roles = ["" if r is None else r for r in part.column(2).to_pylist()]
            known = {r: f"{START}{escape_role(r)}\n" for r in set(roles)}
            header = pa.array([known[r] for r in roles], pa.string())
            text = escaped_column(part.column(3))
            footer = pa.array([f"{END}\n"] * n, pa.string())
            offsets, data = assemble([string_buffers(x) for x in (header, text, footer)])
            formatted = pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]).cast(pa.string())
            start = pc.utf8_length(header).to_numpy()
            stop = start + pc.utf8_length(text).to_numpy()
            loss = np.array([r == "assistant" for r in roles], bool)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).cast(pa.int64()), part.column(1).cast(pa.int64()), part.column(4).cast(pa.int64()), formatted, pa.array(start, pa.int32(), mask=~loss), pa.array(stop, pa.int32(), mask=~loss)], schema=_FORMATTED
            )


def format_turns(conversations: DataFrame) -> DataFrame:
    """One row per turn: conv_id, turn, seq (order among equal turns of a partition), formatted, mask_start, mask_end (null where there is no loss)."""
    n = shuffle_partitions(conversations.sparkSession)
    rows = conversations.select("conv_id", "turn", "role", "text")
    # The bounds of ranges go to the driver and every task, so of a text only its beginning is a key; texts that begin alike stay together.
    ordered = rows.repartitionByRange(n, "conv_id", "turn", "role", F.substring("text", 1, RANGE_CHARS)).sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.withColumn("seq", F.monotonically_increasing_id()).mapInArrow(_format, FORMATTED)


READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted string; raises where it isn't one."""
    out, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError("text between turns")
        out.append((unescape_role(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError("text after the last turn")
    return out


class _Reader:
    """Digests of one conversation, turn by turn."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, start: int | None, stop: int | None) -> None:
        self.chars += len(formatted)
        for role, text in parse_turns(formatted):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
        if start is not None:
            text = unescape(formatted[start:stop])
            self.loss_chars += len(text)
            self.loss.update(text.encode())

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: _Reader | None = None
    done: list[tuple] = []

    def flush() -> pa.RecordBatch:
        cols = list(zip(*done))
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _READ)], schema=_READ)

    for batch in batches:
        for conv, formatted, start, stop in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if now is None or conv != now.conv_id:
                if now is not None:
                    done.append(now.row())
                now = _Reader(conv)
            now.add(formatted, start, stop)
        if len(done) >= 1000:
            yield flush()
    if now is not None:
        done.append(now.row())
    if done:
        yield flush()


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, what its formatted turns say; its turns stream through one task in order, as a digest must."""
    n = shuffle_partitions(formatted.sparkSession)
    ordered = formatted.repartition(n, "conv_id").sortWithinPartitions("conv_id", "turn", "seq")
    return ordered.select("conv_id", "formatted", "mask_start", "mask_end").mapInArrow(_read, READ)


ship_by_value(sys.modules[__name__])
