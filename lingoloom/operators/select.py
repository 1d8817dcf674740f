"""Choosing sentences: static quotas, pools, and greedy selection with diminishing returns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lingoloom.functions.profile import TATAR, LanguageProfile
from lingoloom.functions.text import stable_sort_key

from .features import document_frequencies, weight_of
from .greedy import BLOCK, greedy_choice
from .ranges import running_total


def _best(scores: DataFrame, cls: Column, limit: int) -> DataFrame:
    """The best ``limit`` rows of each class by (score, sort_key), in one pass: tasks hand on no more than that."""
    rank = F.row_number().over(Window.partitionBy("cls").orderBy(F.desc("score"), "sort_key"))
    return scores.withColumn("cls", cls).withColumn("rank", rank).where(F.col("rank") <= limit).drop("rank", "cls")


def _place(test: Column) -> Column:
    """The row's place by (score, sort_key) among those that pass the test, over a bounded table."""
    return F.sum(F.when(test, 1).otherwise(0)).over(Window.orderBy(F.desc("score"), "sort_key").rowsBetween(Window.unboundedPreceding, 0))


def quota_selection(scores: DataFrame, target: int, conditional_ratio: float = 0.85, multi_ratio: float = 0.5) -> DataFrame:
    """The best rows of (key, score, sort_key, conditional_letter_count, ...), with rank.

    First rows with two conditional letters or more until the multi quota is
    filled, then rows with one until the conditional quota is, then any. Of
    each class (none, one, more) the best ``target`` rows are picked in one
    pass; the quotas are filled from those 3 * target rows.
    """
    letters = F.col("conditional_letter_count")
    multi_quota, conditional_quota = min(target, round(target * multi_ratio)), min(target, round(target * conditional_ratio))
    rows = _best(scores, F.least(letters, F.lit(2)), target)
    of_all = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    for stage, (test, quota) in enumerate(((letters >= 2, multi_quota), (letters >= 1, conditional_quota), (F.lit(True), target)), 1):
        if stage == 1:
            rows = rows.withColumn("stage", F.lit(None).cast("int")).withColumn("taken", F.lit(0))
        free = test & F.col("stage").isNull()
        rows = rows.withColumn("stage", F.when(free & (_place(free) <= F.greatest(F.lit(0), quota - F.col("taken"))), stage).otherwise(F.col("stage")))
        rows = rows.withColumn("taken", F.count("stage").over(of_all))
    rank = F.row_number().over(Window.orderBy("stage", F.desc("score"), "sort_key"))
    return rows.where("stage is not null").withColumn("rank", rank).drop("stage", "taken")


def shortlist(scores: DataFrame, target: int, size: int) -> DataFrame:
    """The union of four pools, best first, ``size`` rows at most.

    Pools: two conditional letters or more, one or more, a word with mixed
    harmony (``mixed_harmony_count``), and all; each is a true top-k. The best
    rows of the six classes that the pools are made of are picked in one pass.
    """
    limit = max(2 * target, max(1, size // 4))
    letters, mixed = F.col("conditional_letter_count"), F.col("mixed_harmony_count") >= 1
    rows = _best(scores, F.least(letters, F.lit(2)) * 2 + mixed.cast("int"), limit)
    in_pool = [test & (_place(test) <= limit) for test in (letters >= 2, letters >= 1, mixed, F.lit(True))]
    pooled = rows.withColumn("pooled", in_pool[0] | in_pool[1] | in_pool[2] | in_pool[3]).where("pooled").drop("pooled")
    return pooled.orderBy(F.desc("score"), "sort_key").limit(size)


def shuffled(rows: DataFrame, seed: int, *parts: Column) -> DataFrame:
    """``rows`` plus place (from 1) in an order that the seed and the parts alone decide."""
    keyed = rows.withColumn("sort_key", stable_sort_key(seed, *parts))
    return running_total(keyed, [F.col("sort_key")], F.lit(1), "before").withColumn("place", F.col("before") + 1).drop("before", "sort_key")


def adaptive_selection(short: DataFrame, features: DataFrame, n_sentences: int, target: int, conditional_ratio: float = 0.85, multi_ratio: float = 0.5, source_penalty: float = 0.15, profile: LanguageProfile = TATAR, frequencies: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """(key, rank, gain) chosen from a shortlist (key, source, text_key, sort_key, conditional_letter_count).

    A feature is worth weight * count * rarity / sqrt(1 + times chosen before),
    a sentence less if its source was chosen before; sentences without
    features are worth nothing and come last. ``features`` need hold only the
    shortlist's where ``frequencies`` (feature, df) are given, else they are
    counted in ``features``. The table stays distributed, so the shortlist may
    be as large as one likes: rounds compute all gains in the tasks, and
    ``block`` rows at most are fetched and chosen from (see ``greedy``). The
    choice equals a plain greedy loop; it runs when this is called.
    """
    df = document_frequencies(features) if frequencies is None else frequencies
    if frequencies is None:  # the features are those of all sentences
        features = features.join(short.select("key"), "key", "left_semi")
    worth = df.select(F.xxhash64("feature").alias("f"), weight_of(F.col("feature"), profile).alias("weight"), (F.log((n_sentences + 1) / (F.col("df") + 1)) + 1).alias("rarity")).where("weight > 0")
    rows = features.select("key", F.xxhash64("feature").alias("f"), "n").join(worth, "f")
    packed = rows.select("key", "f", (F.col("weight") * F.col("n") * F.col("rarity")).alias("c"), "n").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("f", "c", "n"))).alias("v"))
    items = short.join(packed, "key", "left").select("key", "source", "text_key", "sort_key", F.col("conditional_letter_count").alias("letters"), F.col("v.f").alias("ids"), F.col("v.c").alias("coefs"), F.col("v.n").alias("counts"))
    quotas = [(least, min(target, round(target * ratio))) for least, ratio in ((2, multi_ratio), (1, conditional_ratio), (0, 1))]
    return short.sparkSession.createDataFrame(greedy_choice(items, quotas, source_penalty, block), "key string, rank int, gain double")
