"""Dictionary pages: listings, full outer alignment of two editions, word pairs and converter coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lingoloom.functions.dsl import resolutions
from lingoloom.functions.profile import TATAR
from lingoloom.functions.text import canonical_apostrophes, casefold, cell_text, harmony_class, html_text, let, normalize_headword, paragraph_text, query_value, strip
from lingoloom.functions.translit import convert_dsl

from .ranges import running_total

# fixed values: parts of speech, as the pages abbreviate them, in either case
POS_WORDS = ("n", "v", "a", "adv", "pref", "pron", "pl", "gr", "reflex", "past", "prep", "cj", "conj", "int", "num")
POS = rf"\b(?:{'|'.join(POS_WORDS)})\.?\b"
# fixed values: letters of the two editions, signs inside words
CYRILLIC, LATIN, JOINING = "а-яА-Я[ЁёӘәӨөҮүҖҗҢңҺһ]", "A-Za-zÄÖÜÑĞŞÇİıäöüñğşçƏə", "'’ʼ-"
#: Letters that reviewers look at.
REVIEW_LETTERS = TATAR.conditional + TATAR.review
# fixed values: English words of the entries that aren't translations
ENGLISH_NOISE = ("against", "as", "from", "into", "of", "one", "out", "over", "smth", "somebody", "something", "the", "to", "with")


def parse_listings(pages: DataFrame) -> DataFrame:
    """(source_id, page, position, entry_id, headword, entry_url) of the accepted rows of (source_id, page, html)."""
    row = F.posexplode(F.regexp_extract_all("html", F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))).alias("row_no", "row")
    cells = pages.select("source_id", "page", row).withColumn("cells", F.regexp_extract_all("row", F.lit(r"(?is)<td\b[^>]*>(.*?)</td>"), F.lit(1))).where("size(cells) >= 2")
    link = F.regexp_extract("row", r"""(?is)<a\b[^>]*href\s*=\s*["']([^"']+)["']""", 1)
    linked = cells.withColumn("entry_url", F.replace(link, F.lit("&amp;"), F.lit("&"))).where("entry_url <> ''")
    entry = linked.withColumn("entry_id", query_value(F.col("entry_url"), "id")).withColumn("headword", cell_text(F.col("cells")[0]))
    accepted = entry.where(F.col("entry_id").isNotNull() & (F.col("entry_id") != "") & (query_value(F.col("entry_url"), "sourname") == F.col("source_id").cast("string")) & (query_value(F.col("entry_url"), "kind") == "1") & (F.col("headword") != ""))
    position = F.row_number().over(Window.partitionBy("source_id", "page").orderBy("row_no"))
    return accepted.select("source_id", "page", position.alias("position"), "entry_id", "headword", "entry_url")


def entry_pages(fetched: DataFrame) -> DataFrame:
    """``fetched`` (source_id, entry_id, html) plus plain_text."""
    return fetched.withColumn("plain_text", html_text(F.col("html")))


def align_editions(left: DataFrame, right: DataFrame) -> DataFrame:
    """(align_id, headword_key, headword, page, position, left_entry_id, right_entry_id, status): full outer by headword.

    Of rows that share a headword on a side the last by (page, position)
    counts; status is aligned, headword_mismatch where a side has several, or
    missing_side. align_id follows the key's order.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        keyed = df.withColumn("headword_key", normalize_headword(F.col("headword")))
        last = F.max_by(F.struct("entry_id", "headword", "page", "position"), F.struct("page", "position", "entry_id"))
        return keyed.groupBy("headword_key").agg(last.alias(name), F.count("*").alias(f"{name}_n"))

    both = side(left, "l").join(side(right, "r"), "headword_key", "full_outer")
    status = F.when(F.col("l").isNull() | F.col("r").isNull(), "missing_side").when((F.col("l_n") > 1) | (F.col("r_n") > 1), "headword_mismatch").otherwise("aligned")
    pick = lambda c: F.coalesce(F.col(f"l.{c}"), F.col(f"r.{c}"))
    rows = both.select("headword_key", pick("headword").alias("headword"), pick("page").alias("page"), pick("position").alias("position"), F.col("l.entry_id").alias("left_entry_id"), F.col("r.entry_id").alias("right_entry_id"), status.alias("status"))
    return running_total(rows, [F.col("headword_key")], F.lit(1), "before").withColumn("align_id", F.col("before") + 1).drop("before")


def _body(html: Column) -> Column:
    """Paragraph text behind the headword and part of speech; where none is near the front, without the Latin words and signs it begins with."""

    def cut(text: Column) -> Column:
        tag = F.regexp_instr(F.substring(text, 1, 100), F.lit(rf"(?iuU){POS}"))  # the front, and what follows a tag there
        rest = F.when((tag > 0) & (tag <= 80), F.regexp_replace(text, rf"(?iuUs)\A.*?{POS}", "")).otherwise(F.regexp_replace(text, rf"(?U)\A[{LATIN},.\s{JOINING}]+", " "))
        return strip(F.regexp_replace(rest, r"(?U)\s+", " "))

    return let(paragraph_text(html), cut)


def _tokens(html: Column, letters: str) -> Column:
    """Words of two letters or more, which signs may join."""
    return F.filter(F.regexp_extract_all(_body(html), F.lit(f"[{letters}]++(?:[{JOINING}][{letters}]++)*+"), F.lit(0)), lambda t: F.length(t) > 1)


def cyrillic_tokens(html: Column) -> Column:
    """array<string>: the Cyrillic words of an entry's translation, in lower case."""
    return F.transform(_tokens(html, CYRILLIC), F.lower)


def latin_tokens(html: Column) -> Column:
    """array<string>: the Latin words of an entry's translation, case folded, without parts of speech."""
    words = F.filter(_tokens(html, LATIN), lambda t: ~t.rlike(rf"(?iuU)\A(?:{'|'.join(POS_WORDS)})\z"))
    return let(words, lambda w: F.when(F.size(w) > 0, F.split(casefold(F.array_join(w, " ")), " ")).otherwise(w))  # folded together, as no letter folds to a space


def antat_label(word: Column, review_letters: str = REVIEW_LETTERS) -> Column:
    """RL for letters that only loanwords have, or for mixed harmony with a letter that reviewers look at; else N."""
    return F.when(word.rlike("[ёьъщ]"), "RL").when(word.rlike(f"[{review_letters}]") & (harmony_class(word) == "mixed_front_back"), "RL").otherwise("N")


def word_pairs(alignment: DataFrame, left_pages: DataFrame, right_pages: DataFrame) -> DataFrame:
    """(align_id, headword, position, cyrillic, latin, label): tokens that face each other in aligned entries with equally many."""
    # Tokens are read on either side of the joins, once a page: what is shuffled is shorter, and no join's condition repeats them.
    side = lambda pages, name, tokens: pages.select(F.col("entry_id").alias(f"{name}_entry_id"), tokens(F.col("html")).alias(name))
    rows = alignment.where("status = 'aligned'").where(~F.col("headword").startswith("-"))
    rows = rows.join(side(left_pages, "left", cyrillic_tokens), "left_entry_id").join(side(right_pages, "right", latin_tokens), "right_entry_id")
    facing = F.when(F.size("left") == F.size("right"), F.arrays_zip("left", "right"))
    same = rows.select("align_id", "headword", F.posexplode(facing).alias("position", "p"))
    return same.select("align_id", "headword", "position", F.col("p.left").alias("cyrillic"), F.col("p.right").alias("latin"), antat_label(F.col("p.left")).alias("label"))


def distinct_pairs(pairs: DataFrame) -> DataFrame:
    """``pairs`` less English words, one row of each (cyrillic, latin, label): the first by (align_id, position)."""
    clean = pairs.where(~F.col("latin").isin(*ENGLISH_NOISE))
    others = [c for c in pairs.columns if c not in ("cyrillic", "latin", "label")]
    first = clean.groupBy("cyrillic", "latin", "label").agg(F.min(F.struct("align_id", "position", *[c for c in others if c not in ("align_id", "position")])).alias("f"))
    return first.select(*[F.col(c) if c in ("cyrillic", "latin", "label") else F.col(f"f.{c}").alias(c) for c in pairs.columns])


def with_entry_texts(alignment: DataFrame, left_pages: DataFrame, right_pages: DataFrame) -> DataFrame:
    """``alignment`` plus left_text and right_text: the entries' plain texts, empty where a side or its page is missing."""
    side = lambda pages, name: pages.groupBy(F.col("entry_id").alias(f"{name}_entry_id")).agg(F.max("plain_text").alias(f"{name}_text"))
    both = alignment.join(side(left_pages, "left"), "left_entry_id", "left").join(side(right_pages, "right"), "right_entry_id", "left")
    return both.select(*alignment.columns, F.coalesce("left_text", F.lit("")).alias("left_text"), F.coalesce("right_text", F.lit("")).alias("right_text"))


def coverage(pairs: DataFrame) -> DataFrame:
    """``pairs`` plus native and loanword, both conversions in notation, and coverage: both, native, loanword or gap, by which of them can spell the attested word."""
    w = F.col("cyrillic")
    words = pairs.select("cyrillic").distinct().select("cyrillic", convert_dsl(w, "N").alias("native"), convert_dsl(w, "RL").alias("loanword"))
    same = lambda text: casefold(canonical_apostrophes(text))
    fits = lambda c: F.exists(resolutions(F.col(c)), lambda s: same(s) == same(F.col("latin")))
    joined = pairs.join(words, "cyrillic").withColumn("n", fits("native")).withColumn("l", fits("loanword"))
    kind = F.when(F.col("n") & F.col("l"), "both").when(F.col("n"), "native").when(F.col("l"), "loanword").otherwise("gap")
    return joined.withColumn("coverage", kind).drop("n", "l")


def rule_gaps(covered: DataFrame) -> DataFrame:
    """What ``coverage`` found no rule for: the pair, both conversions and ``letters``, the review letters of the word in order, by align_id."""
    letters = F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all("cyrillic", F.lit(f"[{REVIEW_LETTERS}]"), F.lit(0)))), "")
    return covered.where("coverage = 'gap'").withColumn("letters", letters).drop("coverage")


def listed(rows: DataFrame, line: Column, limit: int = 50) -> DataFrame:
    """(line): the first ``limit`` rows as text by (align_id, position), then how many more there are, if any."""
    lines = rows.select("align_id", "position", line.alias("line"))
    first = lines.orderBy("align_id", "position", "line").limit(limit)
    more = lines.agg(F.count("*").alias("n")).where(F.col("n") > limit).select(F.lit(None).cast("long").alias("align_id"), F.lit(None).cast("int").alias("position"), F.format_string("... %d more", F.col("n") - limit).alias("line"))
    return first.unionByName(more).orderBy(F.asc_nulls_last("align_id"), "position", "line").select("line")


def gap_lines(covered: DataFrame, limit: int = 50) -> DataFrame:
    """(line): uncovered pairs for a reviewer."""
    line = F.format_string("%s -> expected %s, N got %s, RL got %s, letters=%s, headword=%s, align_id=%d", "cyrillic", "latin", "native", "loanword", "letters", "headword", "align_id")
    return listed(rule_gaps(covered), line, limit)


def mismatch_lines(pairs: DataFrame, limit: int = 50) -> DataFrame:
    """(line): pairs that the preferred conversion spells otherwise, for a reviewer."""
    line = F.format_string("%s -> expected %s, got %s, label=%s, headword=%s, align_id=%d", "cyrillic", "latin", "actual", "label", "headword", "align_id")
    return listed(mismatches(pairs), line, limit)


def coverage_summary(covered: DataFrame) -> DataFrame:
    return covered.groupBy("coverage").agg(F.count("*").alias("n"))


def mismatches(pairs: DataFrame) -> DataFrame:
    """Pairs whose label's preferred conversion isn't the attested spelling."""
    from lingoloom.functions.dsl import resolve

    w = F.col("cyrillic")
    words = pairs.select("cyrillic").distinct().select("cyrillic", resolve(convert_dsl(w, "N")).alias("n"), resolve(convert_dsl(w, "RL")).alias("l"))
    actual = F.when(F.col("label") == "N", F.col("n")).otherwise(F.col("l"))
    return pairs.join(words, "cyrillic").withColumn("actual", actual).where(casefold(F.col("actual")) != casefold(F.col("latin"))).drop("n", "l")


def missing(wanted: DataFrame, stored: DataFrame, *keys: str) -> DataFrame:
    """Rows of ``wanted`` not stored yet."""
    return wanted.join(stored.select(*keys), list(keys), "left_anti")
