"""Aligned sentence pairs: every token of a sentence replaced by its resolved conversion."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingoloom.functions.dsl import PREFERRED, dsl_error, resolve
from lingoloom.functions.profile import TATAR
from lingoloom.functions.text import harmony_class, let, normalize_word, restore_case
from lingoloom.functions.translit import convert_dsl

from .dictionary import labelled_tokens


def aligned(sentence: Column, texts: Column) -> Column:
    """array<struct<start,gap,text>>: where each token begins, and what lies before it; start 0 where it isn't found after the one before."""

    def step(acc: Column, token: Column) -> Column:
        at = F.call_function("locate", token, acc["sentence"], acc["cursor"])
        gap = F.when(at > 0, F.substring(acc["sentence"], acc["cursor"], at - acc["cursor"]))
        out = F.concat(acc["out"], F.array(F.struct(at.alias("start"), gap.alias("gap"), token.alias("text"))))
        return F.struct(acc["sentence"].alias("sentence"), F.when(at > 0, at + F.length(token)).otherwise(acc["cursor"]).alias("cursor"), out.alias("out"))

    zero = F.struct(sentence.alias("sentence"), F.lit(1).alias("cursor"), F.array().cast("array<struct<start:int,gap:string,text:string>>").alias("out"))
    return F.aggregate(texts, zero, step, lambda acc: F.struct(acc["out"].alias("tokens"), F.substring(acc["sentence"], acc["cursor"], F.length(acc["sentence"])).alias("rest")))


def token_conversions(tokens: DataFrame, reviewed: DataFrame, policy: Mapping[str, str] = PREFERRED) -> DataFrame:
    """``tokens`` plus word, zamanalif, reason: the resolved and recased conversion, or why the token isn't ready.

    Reviewed words use the dictionary; others are ready if both origins, or
    their label's, give one conversion: native and loan agree. Conversions run
    once per distinct word.
    """
    worded = tokens.withColumn("word", normalize_word(F.col("text")))
    words = worded.select("word").where("word <> ''").distinct()
    w = F.col("word")
    dimension = words.join(reviewed.select(F.col("normalized_word").alias("word"), F.col("zamanalif_dsl").alias("reviewed_dsl")), "word", "left").select("word", "reviewed_dsl", convert_dsl(w, "N").alias("native"), convert_dsl(w, "RL").alias("loan"))
    agreed = F.when((F.col("native") == F.col("loan")) & (F.col("native") != ""), F.col("native"))
    dimension = dimension.select("word", resolve(F.col("reviewed_dsl"), policy).alias("reviewed_text"), resolve(agreed, policy).alias("agreed_text"))
    known = worded.join(dimension, "word", "left")
    reason = (
        F.when(w == "", None)
        .when(F.col("homonym"), "contextual_homonym")
        .when(F.col("reviewed_text").isNotNull(), None)
        .when((F.col("label") == "N") & (harmony_class(w) == "mixed_front_back"), "mixed_harmony_word")
        .when(F.col("agreed_text").isNull(), "unreviewed_word")
    )
    text = F.coalesce("reviewed_text", "agreed_text")
    surface = F.regexp_extract("text", rf"(?s)[{TATAR.letters}](?:.*[{TATAR.letters}])?", 0)
    around = F.struct(surface.alias("s"), F.instr("text", surface).alias("at"))
    recased = let(around, lambda a: F.concat(F.substring(F.col("text"), F.lit(1), a["at"] - 1), restore_case(a["s"], text), F.substring(F.col("text"), a["at"] + F.length(a["s"]), F.length("text"))))
    return known.withColumn("reason", reason).withColumn("zamanalif", F.when(w == "", F.col("text")).otherwise(recased)).drop("reviewed_text", "agreed_text")


def training_pairs(samples: DataFrame, state: DataFrame, reviewed: DataFrame, policy: Mapping[str, str] = PREFERRED) -> DataFrame:
    """(id, cyrillic, zamanalif, reason, error) of every annotated Tatar sample.

    reason is the first token's that isn't ready; error says that a token has no
    text or an unknown label, that it isn't
    in the text in order, that a word has no token, or that the result still
    holds Cyrillic letters or choices. Both are null where a pair is usable.
    """
    tokens = labelled_tokens(samples, state, strict=True)
    converted = token_conversions(tokens, reviewed, policy)
    text = F.coalesce("text", F.lit("")).alias("text")
    per_sample = converted.groupBy("sample_id").agg(F.sort_array(F.collect_list(F.struct("position", text, "zamanalif", "reason", "error"))).alias("t"))
    rows = samples.join(state.where("status = 'annotated' and tatar = 1").select("sample_id"), F.col("id") == F.col("sample_id")).select("id", "text").join(per_sample, F.col("id") == F.col("sample_id"), "left")
    empty = F.array().cast(per_sample.schema["t"].dataType)
    rows = rows.select("id", F.col("text").alias("cyrillic"), F.coalesce("t", empty).alias("t"))
    rows = rows.withColumn("a", aligned(F.col("cyrillic"), F.col("t.text")))
    reason = F.get(F.filter(F.col("t.reason"), lambda r: r.isNotNull()), F.lit(0))
    gaps = F.concat(F.array_join(F.transform("a.tokens", lambda x: F.coalesce(x["gap"], F.lit(""))), "\n"), F.lit("\n"), F.col("a.rest"))
    built = F.concat(F.array_join(F.zip_with("a.tokens", "t", lambda x, y: F.concat(x["gap"], F.coalesce(y["zamanalif"], x["text"]))), ""), F.col("a.rest"))
    rows = rows.withColumn("reason", reason).withColumn("built", built)
    invalid = F.get(F.filter("t", lambda x: x["error"].isNotNull()), F.lit(0))
    error = (
        F.when(invalid.isNotNull(), F.concat(F.lit("token "), invalid["position"].cast("string"), F.lit(": "), invalid["error"]))
        .when(F.col("reason").isNotNull(), None)
        .when(F.exists("a.tokens", lambda x: x["start"] == 0), "token not in text")
        .when(gaps.rlike(f"[{TATAR.letters}]"), "word without token")
        .when(F.col("built").rlike(rf"\{{\{{|\}}\}}|[{TATAR.letters}]"), "unresolved text")
    )
    return rows.select("id", "cyrillic", F.when(F.col("reason").isNull(), F.col("built")).alias("zamanalif"), "reason", error.alias("error"))


def manifest(samples: DataFrame, state: DataFrame, pairs: DataFrame) -> DataFrame:
    """(name, n): annotated, tatar, non_tatar_ignored, exported, skipped_not_ready and skipped:reason counts."""
    annotated = state.where("status = 'annotated'").select(F.coalesce(F.col("tatar") == 1, F.lit(False)).alias("tatar"))
    counts = annotated.select(F.explode(F.when(F.col("tatar"), F.array(F.lit("annotated"), F.lit("tatar"))).otherwise(F.array(F.lit("annotated"), F.lit("non_tatar_ignored")))).alias("name"))
    made = pairs.select(F.explode(F.when(F.col("reason").isNull(), F.array(F.lit("exported"))).otherwise(F.array(F.lit("skipped_not_ready"), F.concat(F.lit("skipped:"), F.col("reason"))))).alias("name"))
    return counts.unionByName(made).groupBy("name").agg(F.count("*").alias("n"))


def manifest_document(counts: DataFrame, policy: Mapping[str, str], overrides: Mapping[str, str]) -> dict:
    """The manifest as one document: the policy in force, what was chosen otherwise, and the counts of ``manifest``."""
    n = {r["name"]: r["n"] for r in counts.collect()}  # a row a counter
    named = (("annotated_sentences", "annotated"), ("tatar_sentences", "tatar"), ("non_tatar_sentences_ignored", "non_tatar_ignored"), ("exported_sentences", "exported"), ("skipped_not_ready_sentences", "skipped_not_ready"))
    return {
        "effective_policy": dict(sorted(policy.items())),
        "overrides": dict(sorted(overrides.items())),
        "counts": {k: n.get(v, 0) for k, v in named},
        "skipped_by_reason": {k.removeprefix("skipped:"): n[k] for k in sorted(n) if k.startswith("skipped:")},
    }


def check_reviewed(reviewed: DataFrame) -> None:
    """Raises if the dictionary holds invalid notation."""
    bad = reviewed.select("normalized_word", dsl_error(F.col("zamanalif_dsl")).alias("e")).where("e is not null").limit(5).collect()
    if bad:
        raise ValueError("; ".join(f"{r.normalized_word}: {r.e}" for r in bad))
