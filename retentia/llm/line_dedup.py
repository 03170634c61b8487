"""Line de-duplication, on DataFrame functions alone.

Every line's key (the line without ASCII white space at its ends, A-Z
lowered) becomes a 128-bit hash.  Hashes are range-partitioned and sorted
within partitions by (hash, document, position); a running window over that
order streams the first occurrences.  A key held by a large share of the
rows would meet in one partition, so the range also takes a salt of the
document: each (hash, salt) run yields its first document, and a second,
small pass over one row per run finds the first document of the whole key.

The result is a compressed bitmap per document, not text: 64-bit words of
dropped positions in order, words without a drop left out and counted as
``gap``.  ``dedup_lines`` reads the texts once more and drops the lines.

Defined cases: a null or empty text is one empty line; keys shorter than
``min_chars`` code points never count; a key is dropped everywhere but in
the smallest id that holds it (there all its copies stay, in every row of
that id); a null id ranks after all ids; repeated rows get the same bitmap;
an empty table gives an empty result; other columns are passed through
untouched by ``dedup_lines`` and ignored by the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from retentia.llm.common import did, keyed_texts, replace_text, shuffle_partitions, text_hash

#: ASCII white space, [\x20\x09-\x0D].
STRIPPED = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    """ASCII letters only: ``lower`` is right for pure ASCII lines and fast; others go through ``translate``."""
    bare = F.btrim(line, F.lit(STRIPPED))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, UPPER.lower()))


def line_hashes(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """(_rt_did, _rt_th, pos, h1, h2) of every line long enough to count."""
    lines = keyed_texts(docs).select("_rt_did", "_rt_th", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keys = lines.select("_rt_did", "_rt_th", "pos", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= min_chars)
    return keys.select("_rt_did", "_rt_th", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def dropped_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """(_rt_did, _rt_th, pos) of the lines to drop."""
    n = shuffle_partitions(docs.sparkSession)
    salted = line_hashes(docs, min_chars).withColumn("salt", F.pmod(F.xxhash64("_rt_did"), F.lit(n)).cast("int"))
    ordered = salted.repartitionByRange(n, "h1", "h2", "salt").sortWithinPartitions("h1", "h2", "salt", "_rt_did", "pos")
    stream = W.partitionBy("h1", "h2", "salt").orderBy("_rt_did", "pos")
    seen = ordered.withColumn("first_did", F.first("_rt_did").over(stream.rowsBetween(W.unboundedPreceding, W.currentRow)))
    # Within a run, every later document is dropped at once; the run's first document still waits for the other salts.
    # The group by (hash, document) is one row per document of a run's head, so a hot key has at most n of them.
    late = seen.where("_rt_did > first_did").select("_rt_did", "_rt_th", "pos")
    heads = seen.where("_rt_did = first_did").groupBy("h1", "h2", "salt", "_rt_did").agg(F.collect_list(F.struct("_rt_th", "pos")).alias("at"))
    whole = heads.withColumn("least", F.min("_rt_did").over(W.partitionBy("h1", "h2")))
    beaten = whole.where("_rt_did > least").select("_rt_did", F.inline("at")).select("_rt_did", "_rt_th", "pos")
    return late.unionByName(beaten)


def keep_bitmaps(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """(_rt_did, _rt_th, _rt_bitmap): an ordered array of (gap, bits); a set bit is a dropped line."""
    word = F.shiftright("pos", 6)
    # bit_or: a repeated row gives the same positions again.
    words = dropped_lines(docs, min_chars).groupBy("_rt_did", "_rt_th", word.alias("word")).agg(F.expr("bit_or(shiftleft(1L, pos & 63))").alias("bits"))
    packed = words.groupBy("_rt_did", "_rt_th").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("w"))
    gaps = F.transform("w", lambda x, i: F.struct((x["word"] - F.when(i > 0, F.get("w", i - 1)["word"]).otherwise(F.lit(-1)) - 1).alias("gap"), x["bits"].alias("bits")))
    return packed.select("_rt_did", "_rt_th", gaps.alias("_rt_bitmap"))


def dense_bits(bitmap: Column) -> Column:
    """The bitmap's words with the gaps filled, so that a lookup is one array access."""
    return F.flatten(F.transform(bitmap, lambda x: F.concat(F.array_repeat(F.lit(0).cast("long"), x["gap"]), F.array(x["bits"]))))


def kept_lines(lines: Column, dense: Column) -> Column:
    """The lines whose bit is not set."""

    def dropped(i: Column) -> Column:
        bits = F.coalesce(F.get(dense, F.shiftright(i, 6)), F.lit(0).cast("long"))
        return F.call_function("shiftright", bits, i.bitwiseAND(F.lit(63))).bitwiseAND(F.lit(1).cast("long"))

    return F.filter(lines, lambda x, i: dropped(i) == 0)


def line_decisions(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """All input rows with ``_rt_lines`` (kept lines) and ``_rt_n`` (lines before)."""
    bitmaps = keep_bitmaps(docs, min_chars).hint("shuffle_hash")
    joined = docs.select("*", did(), text_hash()).join(bitmaps, ["_rt_did", "_rt_th"], "left")
    split = joined.withColumn("_rt_all", F.split(F.coalesce("text", F.lit("")), "\n", -1)).withColumn("_rt_dense", dense_bits(F.col("_rt_bitmap")))
    kept = F.when(F.col("_rt_bitmap").isNull(), F.col("_rt_all")).otherwise(kept_lines(F.col("_rt_all"), F.col("_rt_dense")))
    return split.select("*", F.size("_rt_all").alias("_rt_n"), kept.alias("_rt_lines"))


def dedup_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """The documents with their later copies of lines removed; a text that loses nothing (a null one too) is unchanged."""
    text = F.when(F.col("_rt_bitmap").isNull(), F.col("text")).otherwise(F.array_join("_rt_lines", "\n"))
    return line_decisions(docs, min_chars).select(*replace_text(docs, text))


def line_report(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 per row."""
    d = line_decisions(docs.select("doc_id", "text"), min_chars)
    return d.select(
        "doc_id",
        F.col("_rt_n").cast("long").alias("n_lines"),
        (F.col("_rt_n") - F.size("_rt_lines")).cast("long").alias("n_dropped"),
        F.sha2(F.array_join("_rt_lines", "\n"), 256).alias("kept_sha256"),
    )
