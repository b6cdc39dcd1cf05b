"""Queries of this subpackage's operators over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, divergence, exact_dedup, jaccard_join, language_id, line_dedup, lm_scoring, mixing, packing, suffix_dedup, token_counts, toxicity, whitening


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.deduplicate_lines(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2("text", 256).alias("kept_sha256"))


def _digests(raw: bytes, spans: list[list[int]]) -> tuple[int, int, int, str]:
    kept = suffix_dedup.without(raw, spans)
    return len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    digests = suffix_dedup.Output("n_bytes long, n_removed long, n_spans long, kept_sha256 string", _digests)
    return suffix_dedup.deduplicate(_read(spark, sf_dir, "documents"), output=digests)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(_read(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, _read(spark, sf_dir, "labels")))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(_read(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(_read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(_read(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.learn(docs))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_read(spark, sf_dir, "embeddings"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = packing.pack(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_read(spark, sf_dir, "documents"))


OPERATORS = (
    op1_line_dedup, op2_suffix_dedup, op3_mixing, op4_jaccard_join, op5_toxicity, op6_exact_dedup, op7_token_counts,
    op8_decontamination, op9_lm_scoring, op10_language_id, op11_whitening, op12_packing, op13_divergence,
)
QUERIES = {f.__name__: f for f in OPERATORS}

ORACLE_SQL = {
    "op1_line_dedup": line_dedup.SQL.format(docs="documents"),
    "op13_divergence": divergence.SQL.format(docs="documents"),
    "op2_suffix_dedup": suffix_dedup.SQL.format(docs="documents"),
    "op3_mixing": mixing.SQL.format(docs="documents"),
    "op6_exact_dedup": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
}
