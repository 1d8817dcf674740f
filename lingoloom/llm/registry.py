"""Queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import sql
from .bpe import encode_documents
from .fingerprints import fingerprint_documents, fingerprint_report
from .lines import dedup_lines
from .mixing import mix_sources
from .neardup import near_duplicates
from .negatives import hard_negatives
from .passages import score_quality
from .quality import quality_rules
from .secrets import scan_secrets, secret_report
from .token_files import token_file_report
from .toxicity import score_toxicity
from .urls import judge_urls
from .whitening import whitened_embeddings


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(scan_secrets(_table(spark, sf_dir, "documents")))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=False)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without near-duplicate lines: doc_id, text, n_lines, n_dropped."""
    return dedup_lines(_table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_dropped")


def op5_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents replicated to the square root of their sources' sizes, in global random order."""
    return mix_sources(_table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_report(fingerprint_documents(_table(spark, sf_dir, "documents")))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_embeddings(_table(spark, sf_dir, "embeddings"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(_table(spark, sf_dir, "embeddings"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_file_report(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_secret_scan, op2_quality_rules, op3_byte_bpe, op4_line_dedup, op5_minhash_neardup, op6_toxicity, op7_url_filters, op8_source_mixing, op9_quality_classifier, op10_fingerprints, op11_whitening, op12_hard_negatives, op13_token_files)}


def oracle_sql() -> dict[str, str]:
    return {"op1_secret_scan": sql.SECRETS, "op7_url_filters": sql.URLS, "op8_source_mixing": sql.MIXING, "op12_hard_negatives": sql.NEGATIVES}
