"""The corpus pipeline over the table ``documents``: each stage takes what the one before it kept.

A stage is (spark, docs, sf_dir) -> DataFrame; ``run`` writes each result as
Parquet into the shared folder and rereads it as the next one's documents.
All but the last return the columns of ``documents``.

1. quality_rules: documents that fail a rule go.
2. line_dedup: later copies of lines go.
3. near_dedup: of near-duplicates, the document of the smallest id stays.
4. decontamination: documents that hold a benchmark item go.
5. encoding: byte-level BPE ids, their number, and the digest of what they
   decode to.

Null and empty texts fail the quality rules; an empty table passes through
all stages as an empty table; other columns are kept; rows that stand
several times stand once after near_dedup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from retentia.llm import bpe, decontaminate, line_dedup, minhash, quality_rules
from retentia.llm.common import read_table
from retentia.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.filter_rows(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs, min_chars=10)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs, threshold=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    return bpe.encode_rows(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: Compression ratios, near-duplicates, retrieval and merges have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{k}_{name}")
        docs = spark.read.parquet(f"{path}/{k}_{name}")
    return docs
