"""Fill-in-middle transformation: a text's middle moved behind its prefix and suffix.

A text of n code points is cut after two of them, drawn from its id alone:
with h1..h4 the first four 32-bit groups of sha256("<seed>:<id>"), the cuts
are h1 and h2 modulo n + 1.  ``h3 % 100 >= fim_percent`` leaves the text plain,
``h4 % 100 < spm_percent`` writes the suffix first (spm) instead of the prefix
(psm).

Cuts are found in the UTF-8 bytes with SWAR words, eight bytes a step: the
buffer of a whole Arrow batch is viewed as uint64, bytes that begin a code
point are marked arithmetically (one bit a byte), shifted by one byte to mark
those that end one, and counted by ``bitwise_count`` per word.  The k-th end
of a text is found by a search in the running counts for its word, and in the
word by comparing the marks' byte-wise prefix sums with the rest of k.  No
code point is ever decoded.

The texts must not hold the marks themselves: such texts stay plain, so the
other forms are split at the marks without doubt, and ``restored`` rebuilds
every text from output and form alone.

No shuffle: rows are independent, so no key is hot and a lost executor costs
its own splits.

Defined cases: a null or empty text is empty and plain; any length is cut
whole; repeated rows give equal rows, whatever the partitions; a null id is
drawn as the empty id; an empty table gives an empty result; other columns
are ignored by ``fim_report`` and passed through by ``fim_rows``, which adds
its own under the names in ``ADDED`` (an input column of such a name is
replaced).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentia.llm.common import portions, string_buffers
from retentia.session import ship_by_value

_U = np.uint64
#: The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FIM_PERCENT, SPM_PERCENT, SEED = 90, 20, 1
ADDED = ("fim_form", "fim_n", "fim_prefix_chars", "fim_middle_chars", "fim_output")

_ONES = _U(0x0101010101010101)
_HIGHS = _U(0x8080808080808080)


def end_marks(data: np.ndarray) -> np.ndarray:
    """Words of eight bytes of valid UTF-8 whose byte is 1 where a code point ends, else 0."""
    n = len(data)
    padded = np.zeros(-(-n // 8) * 8 + 8, np.uint8)
    padded[:n] = data
    word = padded.view("<u8")
    # A byte begins a code point unless it is 10xxxxxx; so do the zeros behind the last one.
    begins = ~((word >> _U(7)) & ~(word >> _U(6))) & _ONES
    ends = (begins[:-1] >> _U(8)) | (begins[1:] << _U(56))
    if n % 8:
        ends[-1] &= (_U(1) << _U(8 * (n % 8))) - _U(1)
    return ends


class Units:
    """Rank and select over the code points of a byte buffer."""

    def __init__(self, data: np.ndarray):
        self.marks = end_marks(data)
        counts = np.bitwise_count(self.marks)
        self.before = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Code points that end before byte ``at``."""
        word, byte = at >> 3, (at & 7).astype(np.uint64)
        inside = np.append(self.marks, _U(0))[word] & ((_U(1) << (byte * _U(8))) - _U(1))
        return self.before[word] + np.bitwise_count(inside)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The byte after the k-th code point, k from 1; byte 0 for k = 0."""
        word = np.maximum(np.searchsorted(self.before, k, "left") - 1, 0)
        rest = (k - self.before[word]).astype(np.uint64)
        if not len(self.marks):
            return np.zeros(len(k), np.int64)
        sums = self.marks[word] * _ONES  # byte i: the marks in bytes 0 to i
        reached = ((sums | _HIGHS) - rest * _ONES) & _HIGHS
        return np.where(k > 0, word * 8 + 9 - np.bitwise_count(reached).astype(np.int64), 0)


NEW = ("form", "n", "a", "m", "output")


def _cut(own: int, new: tuple[str, ...] = NEW):
    """Batches of ``own`` columns, then text, form, h1, h2: instead of the last four, form, code points, prefix, middle (code points) and output."""
    form_at = own + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, own):
            offsets, data = string_buffers(batch.column(own))
            units = Units(data)
            first = units.rank(offsets)
            n = np.diff(first)
            one, two = (batch.column(form_at + k).to_numpy() % (n + 1) for k in (1, 2))
            a, b = np.minimum(one, two), np.maximum(one, two)
            cut_a = np.maximum(units.select(first[:-1] + a), offsets[:-1])
            cut_b = np.maximum(units.select(first[:-1] + b), offsets[:-1])
            raw = data.tobytes()
            form = batch.column(form_at).to_pylist()
            out = []
            for f, lo, x, y, hi in zip(form, offsets[:-1].tolist(), cut_a.tolist(), cut_b.tolist(), offsets[1:].tolist()):
                if f == "plain":
                    out.append(raw[lo:hi])
                elif f == "psm":
                    out.append(b"".join((PREFIX.encode(), raw[lo:x], SUFFIX.encode(), raw[y:hi], MIDDLE.encode(), raw[x:y])))
                else:
                    out.append(b"".join((SUFFIX.encode(), raw[y:hi], PREFIX.encode(), raw[lo:x], MIDDLE.encode(), raw[x:y])))
            plain = np.array([f == "plain" for f in form], bool)
            added = [pa.array(n), pa.array(a, mask=plain), pa.array(b - a, mask=plain), pa.array(out, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:own], batch.column(form_at), *added], names=[*batch.schema.names[:own], *new])

    return run


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """h1 to h4 of an id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def form_of(text: Column, h3: Column, h4: Column, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> Column:
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    plain = (text == "") | marked | (h3 % 100 >= fim_percent)
    return F.when(plain, "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm")


def restored(output: Column, form: Column) -> Column:
    """The text of an output and its form."""
    part = F.split(output, "<[PSM]>", -1)
    return F.when(form == "plain", output).when(form == "psm", F.concat(part[1], part[3], part[2])).otherwise(F.concat(part[2], part[3], part[1]))


def fim_rows(docs: DataFrame, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT, seed: int = SEED) -> DataFrame:
    """The input rows and the columns in ``ADDED``: code points, form, code points of prefix and middle (null if plain), output."""
    own = [c for c in docs.columns if c not in ADDED]
    text = F.coalesce(F.col("text"), F.lit(""))
    h1, h2, h3, h4 = draws(F.col("doc_id"), seed)
    sent = docs.select(*[F.col(f"`{c}`") for c in own], text.alias("_rt_text"), form_of(text, h3, h4, fim_percent, spm_percent).alias("_rt_form"), h1.alias("_rt_h1"), h2.alias("_rt_h2"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*[F.col(f"`{c}`") for c in own]).schema)
    new = tuple(f"_rt_{c}" for c in NEW)
    done = sent.mapInArrow(_cut(len(own), new), f"{kinds}{', ' * bool(own)}_rt_form string, _rt_n long, _rt_a long, _rt_m long, _rt_output string")
    return done.toDF(*own, *ADDED)


def fim_report(docs: DataFrame, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT, seed: int = SEED) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 per row; the text is rebuilt from the output."""
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    h1, h2, h3, h4 = draws(F.col("doc_id"), seed)
    sent = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text, form_of(text, h3, h4, fim_percent, spm_percent).alias("form"), h1.alias("h1"), h2.alias("h2"))
    done = sent.mapInArrow(_cut(1), "doc_id long, form string, n long, a long, m long, output string")
    return done.select(
        "doc_id", "n", "form", F.col("a").alias("prefix_chars"), F.col("m").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


ship_by_value(sys.modules[__name__])
