"""What the review of round 3 found to write too much or to take too long on large tables, each case small."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from lingoloom.functions.translit import convert_dsl
from lingoloom.operators import dictionary
from lingoloom.operators import features as feats
from lingoloom.plans.queries import QUERIES


def _sentences(spark, n=120):
    draw = random.Random(5)
    words = ["".join(draw.choice("аәбвгеёикуүцюяъьтлнң") for _ in range(draw.randint(1, 9))) for _ in range(90)]
    return words, spark.createDataFrame([(f"s{i}", " ".join(draw.choices(words, k=draw.randint(0, 14))) + draw.choice(["", ", 1"])) for i in range(n)], "key string, sentence string").repartition(3).persist()


def test_features_read_side_by_side(spark):
    """features read off all words of a sentence are those that the words have one by one."""
    words, _ = _sentences(spark)
    rows = spark.createDataFrame([(words[i : i + 7], i % 2 == 0) for i in range(0, 90, 7)] + [([], True), (["я", "к", "ккаа"], True)], "words array<string>, allowed boolean")
    each = F.flatten(F.transform("words", lambda w: feats.word_features(w, F.col("allowed"))))
    apart = F.concat(feats.letter_features(F.col("words")), F.flatten(F.transform("words", lambda w: feats.band_features(w, F.col("allowed")))))
    for r in rows.select(each.alias("each"), apart.alias("apart"), F.sort_array(feats.letter_features(F.col("words"), distinct=True)).alias("once"), feats.letter_features(F.col("words")).alias("all")).collect():
        assert Counter(r.each) == Counter(r.apart)
        assert r.once == sorted(set(r.all))


def test_document_frequencies_without_pairs(spark):
    """no row a sentence and feature is shuffled, with every band of frequencies; the numbers are the table's."""
    _, sentences = _sentences(spark)
    for low, high in ((2, 10_000), (3, 9)):
        table = feats.feature_table(sentences, "key", low, high)
        want = {r.feature: r.df for r in feats.document_frequencies(table).collect()}
        got = feats.corpus_document_frequencies(sentences, low, high, key="key")
        rows = got.collect()
        assert {r.feature: r.df for r in rows} == want and len(rows) == len(want)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert not re.search(r"Aggregate \[nth#\d+L?, (id|feature)#", plan)
        weighted = {r.feature: r.df for r in feats.corpus_document_frequencies(sentences, low, high, weighted_only=True, key="key").collect()}
        assert weighted == {f: n for f, n in want.items() if not f.startswith(("cond_bigram", "cond_position"))}
        assert {(r.key, r.feature, r.n) for r in feats.feature_table(sentences, "key", low, high, weighted_only=True).collect()} == {(r.key, r.feature, r.n) for r in table.collect() if r.feature in weighted}
    spark.catalog.clearCache()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_texts_are_labelled_once(spark):
    """hashes and patterns of words run over counted texts, not over occurrences."""
    lines = optimized(QUERIES["word_statistics"](spark, "/root/testdata/sf0.001")).splitlines()
    counted = max(i for i, x in enumerate(lines) if "Aggregate [text#" in x)
    assert not any("md5" in x or "regexp_extract(" in x for x in lines[counted + 1 :])
    tokens = spark.createDataFrame([("a", 0, "«Ат»", "N", False), ("a", 1, "ат", "RL", True), ("b", 0, "ат", "RL", True), ("b", 1, "—", "N", False)], "sample_id string, position int, text string, label string, homonym boolean")
    for rows, n in ((tokens, 1), (tokens.withColumn("times", F.lit(3)), 3)):
        (r,) = dictionary.word_stats(rows).collect()
        assert (r.word, r.frequency, r.n_n, r.n_rl, r.n_u, r.label, r.homonym_count) == ("ат", 3 * n, n, 2 * n, 0, "RL", 2 * n)


def test_letters_are_converted_once(spark):
    """a word's letters are converted once an origin, and most without a look around."""
    words = spark.createDataFrame([("кагыйдә",)], "word string")
    assert optimized(words.select(convert_dsl(F.col("word"), "N").alias("x"))).count("transform(split(word") == 1
    assert optimized(words.select(convert_dsl(F.col("word"), "RL").alias("x"))).count("transform(split(word") <= 2  # the other one is parts between hyphens
