"""Coverage reports of selected sentences, as long tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lingoloom.functions.profile import TATAR, LanguageProfile
from lingoloom.functions.text import count_specific, harmony_class, let, words_in

HARMONIES = ("front_only", "back_only", "mixed_front_back", "no_vowels")


def _words(sentences: DataFrame, profile: LanguageProfile) -> DataFrame:
    """(word, times): a row a distinct word; tasks add up before anything is shuffled."""
    return sentences.select(F.explode(words_in(F.col("sentence"), profile)).alias("word")).groupBy("word").agg(F.count("*").alias("times"))


def _letters(text: Column, letters: str) -> Column:
    """array<string>: which of the letters the text has."""
    return let(text, lambda t: F.filter(F.array(*map(F.lit, letters)), lambda c: t.contains(c)))


def letter_coverage(sentences: DataFrame, key: str, profile: LanguageProfile = TATAR) -> DataFrame:
    """(letter, sentence_count, word_occurrence_count, unique_words) of each conditional letter, zeros included."""
    letters = sentences.sparkSession.createDataFrame([(c,) for c in profile.conditional], "letter string")
    own = _words(sentences, profile).select("word", "times", F.explode(_letters(F.col("word"), profile.conditional)).alias("letter"))
    inside = F.length("word") - F.length(F.replace("word", F.col("letter"), F.lit("")))
    found = own.groupBy("letter").agg(F.sum(F.col("times") * inside).alias("word_occurrence_count"), F.count("*").alias("unique_words"))
    joined = F.array_join(words_in(F.col("sentence"), profile), "")
    having = sentences.select(key, F.explode(_letters(joined, profile.conditional)).alias("letter")).groupBy("letter").agg(F.count_distinct(key).alias("sentence_count"))
    return letters.join(having, "letter", "left").join(found, "letter", "left").na.fill(0)


def top_words_by_letter(sentences: DataFrame, key: str, k: int = 50, profile: LanguageProfile = TATAR) -> DataFrame:
    """(letter, place, word, n): the k most frequent words of each conditional letter, ties by word."""
    counts = _words(sentences, profile).withColumnRenamed("times", "n")
    own = counts.select("word", "n", F.explode(F.array_distinct(F.regexp_extract_all("word", F.lit(f"[{profile.conditional}]"), F.lit(0)))).alias("letter"))
    # ranked within (letter, hash) first, so that no task ranks all words of a letter
    spread = own.withColumn("part", F.pmod(F.xxhash64("word"), F.lit(64)))
    order = (F.desc("n"), "word")
    some = spread.withColumn("r", F.row_number().over(Window.partitionBy("letter", "part").orderBy(*order))).where(F.col("r") <= k)
    place = F.row_number().over(Window.partitionBy("letter").orderBy(*order))
    return some.withColumn("place", place).where(F.col("place") <= k).select("letter", "place", "word", "n")


def harmony_coverage(sentences: DataFrame, key: str, profile: LanguageProfile = TATAR) -> DataFrame:
    """(harmony, sentence_count, word_count, unique_words) of the four classes, zeros included."""
    classes = sentences.sparkSession.createDataFrame([(c,) for c in HARMONIES], "harmony string")
    found = _words(sentences, profile).groupBy(harmony_class(F.col("word"), profile).alias("harmony")).agg(F.sum("times").alias("word_count"), F.count("*").alias("unique_words"))
    own = let(F.array_join(words_in(F.col("sentence"), profile), " "), lambda t: F.filter(F.array(*[F.when(t.rlike(_having(h, profile)), F.lit(h)) for h in HARMONIES]), lambda h: h.isNotNull()))
    having = sentences.select(key, F.explode(own).alias("harmony")).groupBy("harmony").agg(F.count_distinct(key).alias("sentence_count"))
    return classes.join(having, "harmony", "left").join(found, "harmony", "left").select("harmony", "sentence_count", "word_count", "unique_words").na.fill(0)


def _having(harmony: str, profile: LanguageProfile, also: str = "") -> str:
    """A pattern of words, joined by spaces, of which one is in the class and has one of the letters ``also``."""
    wants = {"front": harmony in ("front_only", "mixed_front_back"), "back": harmony in ("back_only", "mixed_front_back")}
    tests = "".join(f"(?{'=' if wants[side] else '!'}[^ ]*[{letters}])" for side, letters in (("front", profile.front), ("back", profile.back)))
    return rf"(?:\A| ){tests}" + (f"(?=[^ ]*[{also}])" if also else "") + "[^ ]"


def merged_counters(rows: DataFrame, json_col: str) -> DataFrame:
    """(value, n): JSON counters of all rows added up."""
    return rows.select(F.explode(F.from_json(json_col, "map<string,bigint>")).alias("value", "count")).groupBy("value").agg(F.sum("count").alias("n"))


def top(counts: DataFrame, k: int) -> DataFrame:
    """The k greatest of (value, n), ties by value."""
    return counts.orderBy(F.desc("n"), "value").limit(k)


def saturation(counts: DataFrame) -> DataFrame:
    """One row: unique, max_count, top_10_total, top_10_share of (value, n)."""
    ten = top(counts, 10).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("top_10_total"))
    whole = counts.agg(F.count("*").alias("unique"), F.coalesce(F.max("n"), F.lit(0)).alias("max_count"), F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    share = F.when(F.col("total") > 0, F.round(F.col("top_10_total") / F.col("total"), 6)).otherwise(0.0)
    return whole.withColumn("k", F.lit(1)).join(ten.withColumn("k", F.lit(1)), "k").select("unique", "max_count", "top_10_total", share.alias("top_10_share"))


def distribution(rows: DataFrame, value: Column) -> DataFrame:
    return rows.groupBy(value.alias("value")).agg(F.count("*").alias("n"))


def quality_summary(rows: DataFrame) -> DataFrame:
    """(name, n): sentences with a penalty, with reasons, per 25-point bucket and per reason."""
    penalty, reasons = F.coalesce("quality_penalty", F.lit(0.0)), F.filter(F.split(F.coalesce("quality_reasons", F.lit("")), ","), lambda r: r != "")
    bucket = F.when(penalty <= 0, F.lit(0)).otherwise(F.floor(penalty / 25) * 25).cast("string")
    names = F.concat(
        F.when(penalty > 0, F.array(F.lit("with_penalty"))).otherwise(F.array().cast("array<string>")),
        F.when(F.size(reasons) > 0, F.array(F.lit("with_reasons"))).otherwise(F.array().cast("array<string>")),
        F.array(F.concat(F.lit("penalty:"), bucket)),
        F.transform(reasons, lambda r: F.concat(F.lit("reason:"), r)),
    )
    return rows.select(F.explode(names).alias("name")).groupBy("name").agg(F.count("*").alias("n"))


def headline(rows: DataFrame, profile: LanguageProfile = TATAR) -> DataFrame:
    """One row: sentences, sources, sentences with 1, 2 and 3 conditional letters or more, and with mixed harmony (and a conditional letter in it)."""
    rows = rows.withColumn("_words", F.array_join(words_in(F.col("sentence"), profile), " "))
    mixed = lambda also="": F.count_if(F.col("_words").rlike(_having("mixed_front_back", profile, also)))
    n = F.coalesce("conditional_letter_count", F.lit(0))
    return rows.agg(
        F.count("*").alias("selected_sentence_count"),
        F.count_distinct("id").alias("source_count"),
        *[F.count_if(n >= k).alias(f"with_{k}_conditional") for k in (1, 2, 3)],
        mixed().alias("mixed_harmony_sentence_count"),
        mixed(profile.conditional).alias("mixed_harmony_conditional_sentence_count"),
    )


def _pairs(counts: DataFrame, k: int) -> list[list]:
    return [[r["value"], r["n"]] for r in top(counts, k).collect()]


def _named(rows: DataFrame, name: str) -> dict:
    """Rows of a small table by the text of their first column."""
    return {str(r[name]): {c: r[c] for c in rows.columns if c != name} for r in sorted(rows.collect(), key=lambda r: r[name])}


def _counts(rows: DataFrame) -> dict[str, int]:
    return {str(r["value"]): r["n"] for r in sorted(rows.collect(), key=lambda r: r["value"])}


def selection_report(rows: DataFrame, features: DataFrame, seed: int, config: dict, profile: LanguageProfile = TATAR) -> dict:
    """Everything a reviewer of a selection asks for, as one document.

    ``rows`` are the selected sentences (id, sentence, conditional_letter_count,
    quality_penalty, quality_reasons, tatar_specific_letter_count), ``features``
    their feature table (key, feature, n). Only top-k lists, the classes' rows
    and distributions over small numbers reach the driver.
    """
    named = lambda prefix: features.where(F.col("feature").startswith(prefix + ":")).groupBy(F.substring_index("feature", ":", -1).alias("value")).agg(F.sum("n").alias("n"))
    words, contexts, mixed = named("cond_word"), named("cond_ctx"), named("vowel_harmony_word")
    mixed_conditional = mixed.where(F.col("value").rlike(f"[{profile.conditional}]"))
    letters = _named(letter_coverage(rows, "id", profile), "letter")
    for r in top_words_by_letter(rows, "id", 50, profile).orderBy("letter", "place").collect():  # 50 a letter
        letters[r["letter"]].setdefault("top_words", []).append([r["word"], r["n"]])
    quality = {r["name"]: r["n"] for r in quality_summary(rows).collect()}
    behind = lambda prefix, order: {k: quality[prefix + k] for k in sorted((n.removeprefix(prefix) for n in quality if n.startswith(prefix)), key=order)}
    head = headline(rows, profile).first()
    one = lambda counts: saturation(counts).first().asDict()
    specific = F.coalesce(F.col("tatar_specific_letter_count"), count_specific(F.col("sentence"), profile)) if "tatar_specific_letter_count" in rows.columns else count_specific(F.col("sentence"), profile)
    by_source = distribution(rows, F.coalesce(F.col("id").cast("string"), F.lit("")))
    return {
        "selected_sentence_count": head["selected_sentence_count"],
        "seed": seed,
        "config": dict(config),
        "selection_strategy": config.get("selection_strategy", "static_rank"),
        "language_filter": config.get("language_filter", "none"),
        "tatar_specific_letter_filter": {"min_count": int(config.get("min_tatar_specific_letters") or 0), "distribution": _counts(distribution(rows, specific))},
        "quality_filter": {
            "selected_with_quality_penalty": quality.get("with_penalty", 0),
            "selected_with_artifact_reasons": quality.get("with_reasons", 0),
            "quality_penalty_distribution": behind("penalty:", int),
            "artifact_reason_distribution": behind("reason:", str),
        },
        "conditional_letter_coverage": {k: {"top_words": [], **v} for k, v in letters.items()},
        "vowel_harmony_coverage": _named(harmony_coverage(rows, "id", profile), "harmony"),
        "mixed_harmony_sentence_count": head["mixed_harmony_sentence_count"],
        "mixed_harmony_conditional_sentence_count": head["mixed_harmony_conditional_sentence_count"],
        "top_conditional_words_selected": _pairs(words, 100),
        "top_conditional_contexts_selected": _pairs(contexts, 100),
        "unique_conditional_words_selected": words.count(),
        "unique_conditional_contexts_selected": contexts.count(),
        "conditional_word_saturation": one(words),
        "conditional_context_saturation": one(contexts),
        "top_mixed_harmony_words_selected": _pairs(mixed, 100),
        "top_mixed_harmony_conditional_words_selected": _pairs(mixed_conditional, 100),
        "sentences_with_at_least_one_conditional_letter": head["with_1_conditional"],
        "sentences_with_two_or_more_conditional_letters": head["with_2_conditional"],
        "sentences_with_three_or_more_conditional_letters": head["with_3_conditional"],
        "conditional_letter_count_distribution": _counts(distribution(rows, F.coalesce("conditional_letter_count", F.lit(0)))),
        "source_count": head["source_count"],
        "source_repetition_summary": one(by_source),
        "top_features": _pairs(features.groupBy(F.col("feature").alias("value")).agg(F.sum("n").alias("n")), 100),
    }


def specific_letter_distribution(rows: DataFrame, profile: LanguageProfile = TATAR) -> DataFrame:
    return distribution(rows, count_specific(F.col("sentence"), profile))
