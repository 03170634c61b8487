"""The operators' queries over the given tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from retentia.llm import bpe, chat_format, decontaminate, fim, line_dedup, minhash, quality_gbt, quality_rules, simhash, suffix_dedup, warc, whitening, window_dedup
from retentia.llm.common import read_table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(read_table(spark, sf_dir, "documents"), min_chars=10)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(read_table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    return bpe.token_report(read_table(spark, sf_dir, "documents"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


def op4_quality_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gbt.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turn = F.col("id").cast("long")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), turn.alias("turn"), F.when(turn == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat_format.read_back(chat_format.format_turns(given.unionByName(extra)))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(read_table(spark, sf_dir, "pages"), min_payload=100)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated_pairs(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.class_report(read_table(spark, sf_dir, "documents"), threshold=0.8)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.copy_report(read_table(spark, sf_dir, "documents"), size=50)


def op10_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_dedup.repeat_report(read_table(spark, sf_dir, "documents"), window=35)


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.fim_report(read_table(spark, sf_dir, "documents"), fim_percent=90, spm_percent=20, seed=1)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"), components=4)


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_report(read_table(spark, sf_dir, "documents"), distance=3)


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_quality_gbt": op4_quality_gbt,
    "op5_chat_format": op5_chat_format,
    "op6_warc": op6_warc,
    "op7_decontaminate": op7_decontaminate,
    "op8_minhash": op8_minhash,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_window_dedup": op10_window_dedup,
    "op11_fim": op11_fim,
    "op12_whitening": op12_whitening,
    "op13_simhash": op13_simhash,
}

ORACLE = {
    "op1_line_dedup": r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i, unnest(string_split(coalesce(text, ''), chr(10))) AS line
  FROM documents),
k AS (SELECT *, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first_id FROM k WHERE length(key) >= 10 GROUP BY key),
j AS (SELECT k.*, f.first_id IS NULL OR f.first_id = k.doc_id AS stays FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (NOT stays)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (stays), '')) AS kept_sha256
FROM j GROUP BY doc_id""",
    "op5_chat_format": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, regexp_replace(text, '([<\[])(\\*)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|\|system\|>|\|user\|>|\|assistant\|>|s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)', '\1\\\2\3', 'g') AS escaped FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|im_start|>') + length(role) + 1 + length(escaped) + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id""",
    "op6_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM q WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT q.page_id, payload_bytes, q.payload_digest,
       CASE WHEN first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id < page_id THEN first_id END AS refers_to
FROM q LEFT JOIN f ON q.payload_digest = f.payload_digest""",
    "op11_fim": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
h AS (SELECT doc_id, t, length(t)::BIGINT AS n, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2, ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substring(t, 1, a) AS pre, substring(t, a + 1, b - a) AS mid, substring(t, b + 1) AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p""",
}
