"""The word dictionary: aggregation of labelled tokens, review tasks, imports and upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingoloom.functions import variant as V
from lingoloom.functions.dsl import dsl_error, rule_ids
from lingoloom.functions.profile import TATAR
from lingoloom.functions.text import display_word, harmony_class, let, normalize_word
from lingoloom.functions.translit import suggestion, word_dimension

from .kept import Kept
from .ranges import running_total

TOKENS = "array<struct<text:string,label:string,homonym:boolean>>"


def labelled_tokens(samples: DataFrame, state: DataFrame, strict: bool = False) -> DataFrame:
    """(sample_id, position, text, label, homonym, error): tokens of annotated Tatar samples.

    An unknown label counts as U and a token without text is left out; with
    ``strict`` both stay as they are and ``error`` says what is wrong, as it
    does of tokens that aren't a JSON list (position -1).
    """
    annotated = samples.join(state.where("status = 'annotated' and tatar = 1"), F.col("id") == F.col("sample_id")).select("sample_id", "tokens_json", F.from_json("tokens_json", TOKENS).alias("tokens"))
    known = F.col("t.label").isin("N", "RL", "U")
    text, label = F.col("t.text"), F.col("t.label")
    error = F.when(F.coalesce(text, F.lit("")) == "", "invalid text").when(~F.coalesce(known, F.lit(False)), "invalid label")
    rows = annotated.select("sample_id", F.posexplode("tokens").alias("position", "t"))
    rows = rows.select("sample_id", "position", text.alias("text"), F.when(known | F.lit(strict), label).otherwise("U").alias("label"), F.coalesce("t.homonym", F.lit(False)).alias("homonym"), error.alias("error"))
    if not strict:
        return rows.where("text is not null").drop("error")
    unread = annotated.where("tokens is null or not trim(tokens_json) like '[%'").select("sample_id", F.lit(-1).alias("position"), F.lit("").alias("text"), F.lit("U").alias("label"), F.lit(False).alias("homonym"), F.lit("tokens aren't a list").alias("error"))
    return rows.unionByName(unread)


def word_stats(tokens: DataFrame) -> DataFrame:
    """(word, frequency, n_n, n_rl, n_u, label, homonym_count, display, first_seen) of each normalised word.

    The label of a word is U if any token has it, else RL, else N. Tokens are
    counted by text first, so each text is normalised once. A row stands for
    ``times`` tokens, if there is such a column.
    """
    times = F.col("times") if "times" in tokens.columns else F.lit(1)
    texts = tokens.groupBy("text", "label", "homonym").agg(F.sum(times).alias("times"), F.min(F.struct("sample_id", "position")).alias("first"))
    # an exploded array, as a filter would be moved below the counting and run once a token
    words = texts.select("*", F.explode(F.filter(F.array(normalize_word(F.col("text"))), lambda w: w != "")).alias("word"))
    count = lambda label: F.sum(F.when(F.col("label") == label, F.col("times")).otherwise(0))
    grouped = words.groupBy("word").agg(F.sum("times").alias("frequency"), count("N").alias("n_n"), count("RL").alias("n_rl"), count("U").alias("n_u"), F.sum(F.col("homonym").cast("long") * F.col("times")).alias("homonym_count"), F.min_by("text", "first").alias("surface"))
    label = F.when(F.col("n_u") > 0, "U").when(F.col("n_rl") > 0, "RL").otherwise("N")
    return grouped.withColumn("label", label).withColumn("display", display_word(F.col("surface"), F.col("word"))).drop("surface")


def held_back(stats: DataFrame, reviewed: DataFrame, exported: DataFrame, include_rl: bool = True, include_unknown: bool = True) -> DataFrame:
    """``stats`` with disposition: the first rule that holds a word back whatever its conversions are; null for the others."""
    known = stats.join(reviewed.select(F.col("normalized_word").alias("word"), F.lit(True).alias("is_reviewed")).distinct(), "word", "left").join(exported.select(F.col("normalized_word").alias("word"), F.lit(True).alias("is_exported")).distinct(), "word", "left")
    mixed = harmony_class(F.col("word")) == "mixed_front_back"
    early = (
        F.when(F.col("homonym_count") > 0, "homonym")
        .when(F.col("is_reviewed"), "reviewed")
        .when(F.col("is_exported"), "already_exported")
        .when((F.col("label") == "RL") & ~F.lit(include_rl), "rl_excluded")
        .when((F.col("label") == "U") & ~F.lit(include_unknown), "u_excluded")
        .when((F.col("label") == "N") & mixed, "mixed_harmony")
    )
    return known.withColumn("disposition", early).drop("is_reviewed", "is_exported")


def dispositions(stats: DataFrame, reviewed: DataFrame, exported: DataFrame, include_rl: bool = True, include_unknown: bool = True, min_frequency: int = 1, all_states: bool = True) -> DataFrame:
    """``stats`` with both conversions, state and disposition: ``keep``, or the first rule that holds a word back.

    Conversions are what costs: without ``all_states`` only the words that no
    other rule holds back are converted, and the others' states are null.
    """
    known = held_back(stats, reviewed, exported, include_rl, include_unknown)
    rare = F.when(F.col("frequency") < min_frequency, "below_min_frequency").otherwise("keep")
    late = F.when(F.col("state") == "origin_independent", "origin_independent").otherwise(rare)
    if all_states:
        return known.join(word_dimension(stats), "word").withColumn("disposition", F.coalesce("disposition", late))
    wanted = known.where("disposition is null")
    converted = wanted.join(word_dimension(wanted), "word").withColumn("disposition", late)
    return converted.unionByName(known.where("disposition is not null"), allowMissingColumns=True)


def review_tasks(judged: DataFrame, max_items: int | None = None, sort_by: str = "frequency_desc") -> DataFrame:
    """(number, word, id, cyrl_word, auto_zamanalif, origin, frequency, hints_html) of the kept words, numbered in order."""
    if sort_by not in ("frequency_desc", "word"):
        raise ValueError(f"unknown order: {sort_by}")
    order = [-F.col("frequency"), F.col("word")] if sort_by == "frequency_desc" else [F.col("word")]
    kept = judged.where("disposition = 'keep'")
    if max_items is not None:
        kept = kept.orderBy(*order).limit(max_items)
    kept = Kept()(kept)  # numbering reads it several times, and conversions are dear
    numbered = running_total(kept, order, F.lit(1), "before").withColumn("number", F.col("before") + 1)
    return numbered.select("number", "word", F.format_string("word_%06d", "number").alias("id"), F.col("display").alias("cyrl_word"), suggestion(F.col("label")).alias("auto_zamanalif"), F.col("label").alias("origin"), "frequency", hints_html(F.col("word"), F.col("label"), F.col("frequency"), F.col("state")).alias("hints_html"))


def escaped(text: Column) -> Column:
    # fixed values
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(char), F.lit(name))
    return text


def hints_html(word: Column, label: Column, frequency: Column, state: Column) -> Column:
    """A short list for the reviewer: what the labels and letters leave open."""
    letters = F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all(word, F.lit(f"[{TATAR.conditional}{TATAR.review}]"), F.lit(0)))), ", ")
    items = F.array(F.concat(F.lit("origin: "), label), F.concat(F.lit("conversions: "), state), F.concat(F.lit("letters: "), letters), F.concat(F.lit("frequency: "), frequency.cast("string")))
    return F.concat(F.lit("<ul>"), F.array_join(F.transform(items, lambda x: F.concat(F.lit("<li>"), escaped(x), F.lit("</li>"))), ""), F.lit("</ul>"))


def export_report(judged: DataFrame, tokens: DataFrame, samples: int) -> DataFrame:
    """One row of counts over all unique words and the exported ones."""
    n = lambda test: F.count_if(test)
    kept = F.col("disposition") == "keep"
    total = tokens.agg(F.count("*").alias("n")).first()["n"]
    return judged.agg(
        F.lit(samples).alias("total_input_sentences"),
        F.lit(total).alias("total_tokens"),
        F.count("*").alias("unique_word_forms"),
        n(kept).alias("exported_word_count"),
        n(kept & (F.col("label") == "RL")).alias("rl_exported_word_count"),
        n(kept & (F.col("label") == "U")).alias("u_exported_word_count"),
        n(F.col("disposition") == "mixed_harmony").alias("mixed_harmony_n_word_skipped_count"),
        n(F.col("disposition") == "already_exported").alias("already_exported_skipped_count"),
        n(F.col("disposition") == "reviewed").alias("reviewed_words_skipped_count"),
        F.sum("homonym_count").alias("homonym_occurrences_skipped_count"),
        n(F.col("homonym_count") > 0).alias("homonym_words_deferred_count"),
        *[n(F.col("state") == s).alias(f"{s}_word_count") for s in ("origin_independent", "origin_dependent", "unconvertible")],
    )


def full_export_report(judged: DataFrame, tokens: DataFrame, samples: int) -> dict:
    """``export_report`` with the exported words' letters, rules and the 50 most frequent of them, as one document."""
    head = export_report(judged, tokens, samples).first().asDict()
    kept = judged.where("disposition = 'keep'")
    letters = {r["letter"]: r["words"] for r in letter_counts(judged).orderBy("letter").collect()}  # a row a letter
    rules = judged.where("disposition = 'keep'").agg(F.coalesce(F.sum(F.size(rule_ids(F.when(F.col("label") == "N", F.col("native_dsl")).otherwise(F.col("loanword_dsl"))))), F.lit(0)).alias("n")).first()["n"]
    words = [{"word": r["word"], "frequency": r["frequency"]} for r in kept.orderBy(F.desc("frequency"), "word").limit(50).collect()]
    return head | {"count_by_conditional_letter": letters, "dsl_rule_occurrence_count": rules, "top_50_exported_words_by_frequency": words}


def exported_now(exported: DataFrame, judged: DataFrame, max_items: int | None, sort_by: str, now: str) -> DataFrame:
    """``exported`` (normalized_word, exported_at) plus the words that ``review_tasks`` puts out."""
    words = review_tasks(judged, max_items, sort_by).select(F.col("word").alias("normalized_word"), F.lit(now).alias("exported_at"))
    return insert_or_ignore(exported, words, "normalized_word")


def save_reviewed_word(reviewed: DataFrame, word: str, zamanalif_dsl: str, origin: str, now: str) -> DataFrame:
    """``reviewed`` with one human-approved conversion, new or in place of an older one; ValueError if the word isn't in its normal form, the origin unknown or the notation invalid."""
    row = reviewed.sparkSession.createDataFrame([(word, zamanalif_dsl, origin, now)], "normalized_word string, zamanalif_dsl string, origin string, updated_at string")
    seen = row.select(normalize_word(F.col("normalized_word")).alias("word"), dsl_error(F.col("zamanalif_dsl")).alias("error")).first()
    if not word or seen["word"] != word:
        raise ValueError("the word must be in lower case, from its first to its last letter")
    if origin not in ("N", "RL", "U"):
        raise ValueError("the origin must be N, RL or U")
    if seen["error"] is not None:
        raise ValueError(f"invalid notation: {seen['error']}")
    return insert_or_replace(reviewed, row, "normalized_word")


def without_prefix(table: DataFrame, column: str, prefix: str) -> DataFrame:
    """``table`` less the rows whose ``column`` begins with ``prefix``."""
    return table.where(~F.coalesce(F.col(column).startswith(prefix), F.lit(False)))


def letter_counts(judged: DataFrame) -> DataFrame:
    """(letter, words): exported words with each conditional letter."""
    letters = F.array_distinct(F.regexp_extract_all("word", F.lit(f"[{TATAR.conditional}]"), F.lit(0)))
    return judged.where("disposition = 'keep'").select(F.explode(letters).alias("letter")).groupBy("letter").agg(F.count("*").alias("words"))


def rule_counts(judged: DataFrame) -> DataFrame:
    """(rule_id, occurrences) in the suggestions of exported words."""
    return judged.where("disposition = 'keep'").select(F.explode(rule_ids(suggestion(F.col("label")))).alias("rule_id")).groupBy("rule_id").agg(F.count("*").alias("occurrences"))


# tables that change


def insert_or_ignore(table: DataFrame, rows: DataFrame, *keys: str) -> DataFrame:
    """``table`` plus the rows whose keys it lacks, one of each key."""
    fresh = rows.join(table.select(*keys), list(keys), "left_anti").dropDuplicates(list(keys)).select(*table.columns)
    return table.unionByName(fresh)


def insert_or_replace(table: DataFrame, rows: DataFrame, *keys: str, newest: str | None = None) -> DataFrame:
    """``table`` with ``rows`` in place of those with the same keys; of several new rows the one with the greatest ``newest`` (all columns if none is named)."""
    others = [c for c in table.columns if c not in keys]
    order = F.struct(*([newest] if newest else []), *others)
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("r")).select(*keys, *[F.col(f"r.{c}").alias(c) for c in others])
    return table.join(latest.select(*keys), list(keys), "left_anti").unionByName(latest.select(*table.columns))


def _decision(result: Column, j: Column) -> Column:
    """struct<name, error, text> of one result of an annotation: its control, what is wrong with it, the origin or conversion it holds."""
    name, kind = V.string(V.get(result, "from_name")), F.coalesce(V.string(V.get(result, "type")), F.lit(""))
    chosen, texts = V.items(V.get(result, "value.choices")), V.items(V.get(result, "value.text"))
    origin, text = V.string(V.get(result, "value.choices[0]")), V.string(V.get(result, "value.text[0]"))
    error = F.when(~V.is_object(result), " must be an object").when(
        name == "reviewed_origin",
        F.when(kind != "choices", " origin type must be 'choices'").when(F.coalesce(F.size(chosen) != 1, F.lit(True)), " must select exactly one origin").when(~F.coalesce(origin.isin("N", "RL", "U"), F.lit(False)), F.concat(F.lit(" has invalid origin: "), V.shown(V.get(result, "value.choices[0]")))),
    ).when(
        name == "corrected_zamanalif",
        F.when(kind != "textarea", " conversion type must be 'textarea'").when(F.coalesce(F.size(texts) != 1, F.lit(True)) | text.isNull(), " must contain exactly one text value").when(text == "", " conversion must not be empty"),
    )
    return F.struct(name.alias("name"), F.concat(F.lit(" result "), j.cast("string"), error).alias("error"), F.when(name == "reviewed_origin", origin).otherwise(text).alias("text"))


def _annotation(annotation: Column, i: Column) -> Column:
    """struct<error, origin, dsl> of one annotation; all null where it doesn't count: cancelled, or without results."""
    given = V.get(annotation, "result")
    off = F.coalesce(V.boolean(V.get(annotation, "was_cancelled")), F.lit(False)) | V.absent(given) | F.coalesce(F.size(V.items(given)) == 0, F.lit(False))

    def outcome(error: Column, origin: Column | None = None, dsl: Column | None = None) -> Column:
        null = F.lit(None).cast("string")
        return F.struct(F.concat(F.lit("annotation "), i.cast("string"), error).alias("error"), (null if origin is None else origin).alias("origin"), (null if dsl is None else dsl).alias("dsl"))

    def judged(found: Column) -> Column:
        named = lambda name: F.filter(found, lambda r: F.coalesce(r["name"] == name, F.lit(False)))
        first = F.get(F.filter(found["error"], lambda e: e.isNotNull()), F.lit(0))
        number = F.when(F.size(named("reviewed_origin")) != 1, " must contain exactly one 'reviewed_origin' result").when(F.size(named("corrected_zamanalif")) != 1, " must contain exactly one 'corrected_zamanalif' result")
        return outcome(F.coalesce(first, number), F.get(named("reviewed_origin"), F.lit(0))["text"], F.get(named("corrected_zamanalif"), F.lit(0))["text"])

    wrong = F.when(~V.is_object(annotation), " must be an object").when(~off & V.items(given).isNull(), ".result must be a list")
    return F.when(wrong.isNotNull(), outcome(wrong)).when(off, outcome(F.lit(None).cast("string"))).otherwise(let(F.transform(V.items(given), _decision), judged))


def completed_reviews(tasks: DataFrame) -> DataFrame:
    """(nth, word, origin, zamanalif_dsl, n_decisions, error) of an export of review tasks (nth, task variant).

    JSON types count: nothing is coerced. Cancelled annotations and those
    without results don't count, and a task without any other is left out.
    Annotations that agree count as one. error is null where a task is usable,
    else the first thing that is wrong with it; of tasks that share a word the
    later ones are wrong. A negative nth is an export that is no list.
    """
    task = F.col("task")
    rows = tasks.select("nth", "task", V.get(task, "annotations").alias("given"), V.string(V.get(task, "data.cyrl_word")).alias("surface"))
    rows = rows.withColumn("word", normalize_word(F.col("surface"))).withColumn("list", F.when(V.absent(F.col("given")), F.array().cast("array<variant>")).otherwise(V.items(F.col("given"))))
    first = lambda values: F.get(F.filter(values, lambda e: e.isNotNull()), F.lit(0))

    def decided(found: Column) -> Column:
        decisions = F.array_distinct(F.transform(F.filter(found, lambda a: a["error"].isNull() & a["dsl"].isNotNull()), lambda a: F.struct(a["origin"].alias("origin"), a["dsl"].alias("dsl"))))
        return F.struct(first(found["error"]).alias("error"), decisions.alias("decisions"))

    def judged(d: Column) -> Column:
        error = (
            F.when(F.col("nth") < 0, "export must be a JSON array")
            .when(~V.is_object(task), "task must be an object")
            .when(~V.is_object(V.get(task, "data")), "data must be an object")
            .when(F.coalesce("surface", F.lit("")) == "", "invalid data.cyrl_word")
            .when(F.coalesce("word", F.lit("")) == "", "no Cyrillic word in data.cyrl_word")
            .when(F.col("list").isNull(), "annotations must be a list")
            .otherwise(F.coalesce(d["error"], F.concat(F.lit("invalid notation: "), first(F.transform(d["decisions"], lambda x: dsl_error(x["dsl"])))), F.when(F.size(d["decisions"]) > 1, "conflicting completed annotations")))
        )
        return F.struct(error.alias("error"), d["decisions"].alias("decisions"))

    # one expression from annotations to the outcome, what is left out included: a filter of its own would run all of it again
    outcome = let(let(F.transform("list", _annotation), decided), judged)
    counts = F.filter(F.array(outcome), lambda o: o["error"].isNotNull() | F.coalesce(F.size(o["decisions"]) > 0, F.lit(False)))
    out = rows.select("nth", "word", F.explode(counts).alias("o"))
    one = F.get("o.decisions", F.lit(0))
    out = out.select("nth", "word", one["origin"].alias("origin"), one["dsl"].alias("zamanalif_dsl"), F.size("o.decisions").alias("n_decisions"), F.col("o.error").alias("error"))
    out = Kept()(out)  # a short row a task; read for the earliest of each word too
    earliest = out.where("error is null").groupBy("word").agg(F.min("nth").alias("earliest"))
    later = F.col("error").isNull() & (F.col("nth") > F.col("earliest"))
    return out.join(earliest, "word", "left").withColumn("error", F.when(later, "duplicate normalized word").otherwise(F.col("error"))).select("nth", "word", "origin", "zamanalif_dsl", "n_decisions", "error")


def import_reviews(reviewed: DataFrame, tasks: DataFrame, now: str) -> DataFrame:
    """``reviewed`` plus the completed reviews; any malformed or conflicting one is an error and nothing is imported."""
    rows = completed_reviews(tasks)
    bad = rows.where("error is not null").limit(5).collect()
    if bad:
        raise ValueError("; ".join(f"task {r.nth}: {r.error}" for r in bad))
    joined = rows.join(reviewed.select(F.col("normalized_word").alias("word"), F.col("zamanalif_dsl").alias("old_dsl"), F.col("origin").alias("old_origin")), "word")
    clash = joined.where("old_dsl <> zamanalif_dsl or old_origin <> origin").limit(5).collect()
    if clash:
        raise ValueError("already reviewed otherwise: " + ", ".join(r.word for r in clash))
    fresh = rows.select(F.col("word").alias("normalized_word"), "zamanalif_dsl", "origin", F.lit(now).alias("updated_at"))
    return insert_or_ignore(reviewed, fresh, "normalized_word")
