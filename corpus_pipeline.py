"""The corpus pipeline: quality, line dedup, near-dedup, mixing and tokens, each a table that the next one reads."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lingoloom.llm.bpe import encode_documents
from lingoloom.llm.lines import dedup_lines
from lingoloom.llm.mixing import mix_sources
from lingoloom.llm.neardup import without_near_duplicates
from lingoloom.llm.passages import accepted, fit_quality
from lingoloom.llm.scratch import Scratch


def _free(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the passage model scores 0.5 or more; those without words go."""
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return accepted(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the lines that repeat or nearly repeat an earlier one; n_chars follows the text. A document whose lines all go is a copy and goes too."""
    n_lines, n_dropped = _free(docs, "n_lines"), _free(docs, "n_dropped")
    out = dedup_lines(docs, percent=80, counts=(n_lines, n_dropped)).where((F.col(n_dropped) == 0) | (F.col(n_dropped) < F.col(n_lines)))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-duplicates."""
    return without_near_duplicates(docs, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated to the square root of their sources' sizes, in random order."""
    return mix_sources(docs, copy_col=None)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the digests of ids and decoded bytes."""
    return encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("tokens", tokens)]

#: The classifier's training and MinHash aren't SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them is written to the shared folder and read again."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
