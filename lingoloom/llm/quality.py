"""Quality rules on whole texts: repetition counts and distribution divergence from language references."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingoloom.operators.ranges import join_split

from .scratch import Scratch

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Words of the windows in which repetition is sought.
SPAN = 8
#: Character classes of the histogram; all other characters are a class of their own. Each is sought in what the ones before it leave.
CLASSES = ("lower", "blank", "upper", "digit", "point", "symbol")
LOWER = r"[\p{Ll}\p{Lo}]+"
RARE = (r"\p{Lu}+", r"[0-9]+", r"""[.,;:!?'"()\-]+""", f"[{SYMBOLS}]+")
BLANK, SYMBOL = 1, 5
#: A word is common when it has this share of its language's words; a language then has 100 such words at most.
COMMON = 0.01
#: Words from which a language has a reference of its own; texts of others are compared with the whole corpus.
REFERENCE_WORDS = 2_000


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeated_words(words: Column, span: int = SPAN) -> Column:
    """Words inside windows of ``span`` words that occur twice or more in the text, the first included.

    Windows are compared by 64-bit hashes. Equal ones are found by sorting, so
    the work is n log n in the text's length.
    """

    def positions(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twin = lambda s: F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]))
        return _let(pairs, lambda s: F.sort_array(F.transform(twin(s), lambda x: x["i"])))

    def covered(at: Column) -> Column:
        return F.aggregate(F.transform(at, lambda p, k: F.least(F.coalesce(F.get(at, k + 1) - p, F.lit(span)), F.lit(span))), F.lit(0), lambda a, b: a + b)

    def ahead(h: Column, by: int) -> Column:
        return _let(h, lambda v: F.zip_with(F.slice(v, 1, F.size(v) - by), F.slice(v, 1 + by, F.size(v) - by), lambda a, b: F.xxhash64(a, b)))

    hashes, size = F.transform(words, lambda w: F.xxhash64(w)), 1
    while size < span:  # a window's hash from those of its halves; ``span`` is a power of two
        hashes, size = ahead(hashes, size), 2 * size
    count = _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(_let(positions(h), covered)))
    return F.when(F.size(words) <= span, 0).otherwise(count)


def base_counts(docs: DataFrame) -> DataFrame:
    """``docs`` plus words, the base rules' counts, and classes: the characters of each class."""
    text = F.coalesce(F.col("text"), F.lit(""))
    counted = docs.withColumn("words", F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).withColumn("classes", class_counts(text))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    long = lambda c: c.cast("long")
    return counted.select(
        "*",
        long(F.size("words")).alias("n_words"),
        long(F.length(text) - F.col("classes")[BLANK]).alias("word_chars"),
        long(F.col("classes")[SYMBOL]).alias("n_symbols"),
        long(_let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a)))).alias("n_dup_lines"),
        long(repeated_words(F.col("words"))).alias("n_repeat_words"),
    )


def class_counts(text: Column) -> Column:
    """array<double>: characters of each of CLASSES, then all others."""
    n = F.length(text)
    unspaced = lambda r: F.regexp_replace(F.replace(F.replace(r, F.lit(" "), F.lit("")), F.lit("\n"), F.lit("")), r"[\x09-\x0D]+", "")
    of = lambda r, s: [n - F.length(r), F.length(r) - F.length(s), *(F.length(s) - F.length(F.regexp_replace(s, p, "")) for p in RARE)]
    counts = _let(F.regexp_replace(text, LOWER, ""), lambda r: _let(unspaced(r), lambda s: F.array(*[c.cast("double") for c in of(r, s)])))
    return _let(counts, lambda a: F.concat(a, F.array(n - F.aggregate(a, F.lit(0.0), lambda x, y: x + y))))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (0 to 1) of two count arrays; null if either sums to 0."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)

    def term(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    def divergence(s: Column) -> Column:
        share = F.zip_with(s["p"], s["q"], lambda x, y: _let(F.struct((x / s["tp"]).alias("x"), (y / s["tq"]).alias("y")), lambda v: (term(v["x"], (v["x"] + v["y"]) / 2) + term(v["y"], (v["x"] + v["y"]) / 2)) / 2))
        return F.when((s["tp"] > 0) & (s["tq"] > 0), F.sqrt(F.greatest(total(share), F.lit(0.0))))

    return _let(F.struct(p.alias("p"), q.alias("q"), total(p).alias("tp"), total(q).alias("tq")), divergence)


def word_histogram(words: Column, common: Column) -> Column:
    """Occurrences of each common word, then of all others.

    Each word becomes one character that stands for its place, so that the
    counts are differences of string lengths.
    """
    alphabet = "".join(chr(0x100 + k) for k in range(int(1 / COMMON) + 1))
    longest = F.coalesce(F.array_max(F.transform(common, F.length)), F.lit(0))
    place = lambda w, most: F.when(F.length(w) <= most, F.array_position(common, w).cast("int") + 1).otherwise(1)
    coded = _let(longest, lambda most: F.array_join(F.transform(words, lambda w: F.substring(F.lit(alphabet), place(w, most), F.lit(1))), ""))
    count = lambda s, k: (F.length(s) - F.length(F.replace(s, F.substring(F.lit(alphabet), k, F.lit(1))))).cast("double")
    return _let(coded, lambda s: F.concat(F.transform(common, lambda _, k: count(s, k + 2)), F.array(count(s, F.lit(1)))))


def language_references(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(lang, common array<string>, word_ref array<double>, class_ref array<double>, frequent) of each language with REFERENCE_WORDS words, and of the whole corpus (null).

    Counts cover every document. A row holds 100 common words at most.
    ``frequent`` languages have a thousandth of all documents, so there are a
    thousand at most.
    """
    known = docs.select("lang", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    classes = scratch.save(known.select("lang", F.posexplode(class_counts(F.col("text"))).alias("k", "n")).groupBy("lang", "k").agg(F.sum("n").alias("n")))
    words = scratch.save(known.select("lang", F.explode(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n")))

    def arrays(classes: DataFrame, words: DataFrame) -> DataFrame:
        totals = words.groupBy("key").agg(F.sum("n").alias("all"), F.max("n").alias("most"))
        grand = totals.agg(F.sum("all").alias("n")).first()["n"] or 0
        totals = totals.where((F.col("key") == "") | (F.col("all") >= REFERENCE_WORDS)).select("key", "all", (F.col("all") * 1000 > grand).alias("frequent"))
        common = join_split(words, totals, "key").where(F.col("n") >= COMMON * F.col("all")).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("w"))
        rest = F.col("all") - F.aggregate("w.n", F.lit(0).cast("long"), lambda x, y: x + y)
        word_ref = totals.join(common, "key", "left").select("key", F.col("w.word").alias("common"), F.concat(F.transform("w.n", lambda n: n.cast("double")), F.array(rest.cast("double"))).alias("word_ref"))
        class_ref = classes.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("k", "n"))).alias("c"))
        return class_ref.join(word_ref, "key").select("key", "common", "word_ref", F.col("c.n").alias("class_ref"))

    # a language's key is its name behind a colon, the corpus' is empty
    named = lambda t: t.where("lang is not null").withColumn("key", F.concat(F.lit(":"), "lang"))
    corpus = lambda t, *by: t.groupBy(*by).agg(F.sum("n").alias("n")).withColumn("key", F.lit(""))
    own = arrays(named(classes), named(words))
    everything = arrays(corpus(classes, "k"), corpus(words, "word"))
    sizes = docs.groupBy("lang").agg(F.count("*").alias("n"))
    total = docs.count()
    own = own.select(F.expr("substring(key, 2)").alias("lang"), "common", "word_ref", "class_ref").join(sizes, "lang").withColumn("frequent", F.col("n") * 1000 > total).drop("n")
    return scratch.save(own.unionByName(everything.select(F.lit(None).cast("string").alias("lang"), "common", "word_ref", "class_ref", F.lit(False).alias("frequent"))))


def _with_reference(docs: DataFrame, named: DataFrame) -> DataFrame:
    """``docs`` left joined to the references: by a broadcast of the frequent ones, and of all where there are no others."""
    if named.where("not frequent").isEmpty():
        return docs.join(F.broadcast(named.drop("frequent")), "lang", "left")
    known = join_split(docs.where("lang is not null"), named, "lang", "left")
    return known.unionByName(docs.where("lang is null"), allowMissingColumns=True)


def quality_rules(docs: DataFrame, class_bound: tuple[float, float] = (0.17, 0.8), word_bound: tuple[float, float] = (0.19, 0.7), min_chars: int = 100, min_words: int = 20, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row a document: doc_id, counts of the base rules, base_failed, kept, class_distance, word_distance.

    A document fails the base rules with fewer than 20 words, or if more than
    30 % of its words lie in repeated 8-word windows. Otherwise its histograms
    of character classes and of its language's common words are compared with
    the language's own (Jensen-Shannon distance). A distance may be a + b /
    sqrt(n_words) at most, (a, b) being its bound: short texts stray further by
    chance. A histogram of fewer than ``min_chars`` characters or ``min_words``
    words is too short to judge and passes.

    Null and empty texts have no words and fail. A document whose language is
    null or has fewer than REFERENCE_WORDS words is compared with the whole corpus. Rows that repeat an id are
    judged one by one. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    refs = language_references(docs, scratch)
    fallback = refs.where("lang is null").select(F.struct("common", "word_ref", "class_ref").alias("r")).first()
    whole = fallback["r"] if fallback else None
    default = F.struct(
        F.array(*map(F.lit, (whole["common"] if whole else None) or [])).cast("array<string>").alias("common"),
        F.array(*map(F.lit, (whole["word_ref"] if whole else None) or [])).cast("array<double>").alias("word_ref"),
        F.array(*map(F.lit, (whole["class_ref"] if whole else None) or [])).cast("array<double>").alias("class_ref"),
    )
    named = refs.where("lang is not null").select("lang", F.struct("common", "word_ref", "class_ref").alias("ref"), "frequent")
    judged = _with_reference(docs, named).withColumn("ref", F.coalesce("ref", default))
    judged = base_counts(judged)
    text = F.coalesce(F.col("text"), F.lit(""))
    class_distance = F.when(F.length(text) >= min_chars, js_distance(F.col("classes"), F.col("ref.class_ref")))
    word_distance = F.when(F.col("n_words") >= min_words, js_distance(word_histogram(F.col("words"), F.col("ref.common")), F.col("ref.word_ref")))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    out = judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), class_distance.alias("class_distance"), word_distance.alias("word_distance"))
    most = lambda bound: bound[0] + bound[1] / F.sqrt(F.greatest(F.col("n_words"), F.lit(1)))
    fits = (F.coalesce("class_distance", F.lit(0.0)) <= most(class_bound)) & (F.coalesce("word_distance", F.lit(0.0)) <= most(word_bound))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & fits).alias("kept"), "class_distance", "word_distance")
