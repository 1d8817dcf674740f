"""Test harness: Latin tables as pseudo-Cyrillic text with pseudo-labels.

The shared test tables hold no Cyrillic, so the queries over them rewrite each
character by one fixed translation. No operator depends on this module.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lingoloom.sources.tables import spread

SOURCE = "abcdefghijklmnopqrstuvwxyzäöüßñçéèàáíóúêôû"
TARGET = "абҗдефгһижклмнопәрстувүхызәөүщңцяюьәиоуюөү"


def bridged(text: Column) -> Column:
    return F.translate(F.lower(F.coalesce(text, F.lit(""))), SOURCE, TARGET)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, text, source): pseudo-Cyrillic documents."""
    rows = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))
    return rows.select(F.col("doc_id").alias("id"), bridged(F.col("text")).alias("text"), "source")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, n, sentence): pieces of documents between line breaks and full stops, with words."""
    pieces = documents(spark, sf_dir).select("id", F.posexplode(F.split("text", r"[.\n]")).alias("n", "piece"))
    return pieces.select("id", "n", F.trim("piece").alias("sentence")).where("sentence <> ''")


def label(word: Column) -> Column:
    """N, RL or U by the first hex digit of the word's MD5."""
    digit = F.substring(F.md5(word), 1, 1)
    return F.when(digit < "a", "N").when(digit < "d", "RL").otherwise("U")


LINES_SQL = f"""
docs AS (SELECT doc_id AS id, translate(lower(coalesce(text, '')), '{SOURCE}', '{TARGET}') AS text FROM documents),
raw AS (SELECT id, string_split_regex(text, '[.\\n]') AS pieces FROM docs),
lines AS (SELECT id, n - 1 AS n, trim(pieces[n], ' ') AS sentence FROM (SELECT id, pieces, unnest(generate_series(1, len(pieces))) AS n FROM raw) WHERE trim(pieces[n], ' ') <> '')"""
