"""Character windows of long documents, cleaning and sentence segmentation, all in built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .profile import TATAR, LanguageProfile
from .text import let, strip

END, CLOSING = ".!?…", "\"'»”’)\\]}"
CUT, DOT = "\u0001", "\u0002"
LINE_BREAK = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85  ]"


def document_windows(text: Column, max_doc_chars: int = 20_000, window_chars: int = 4_000, windows_per_doc: int = 5, exhaustive: bool = False) -> Column:
    """array<struct<index,start,text>>: the whole text, or evenly spread windows of a longer one."""
    length = F.length(text)
    whole = F.array(F.struct(F.lit(0).alias("index"), F.lit(0).alias("start"), text.alias("text")))
    if exhaustive:
        return whole
    none = F.array_remove(F.array(F.struct(F.lit(0).alias("index"), F.lit(0).alias("start"), F.lit("").alias("text"))), F.struct(F.lit(0).alias("index"), F.lit(0).alias("start"), F.lit("").alias("text")))
    if window_chars <= 0:
        return F.when(length <= max_doc_chars, whole).otherwise(none)
    budget = min(max_doc_chars, window_chars * windows_per_doc)
    count = max(1, min(windows_per_doc, -(-budget // window_chars)))
    last = F.greatest(F.lit(0), length - window_chars)
    starts = F.array(F.lit(0)) if count == 1 else F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.bround(last * i / (count - 1)).cast("int")))
    spread = F.transform(starts, lambda s, i: F.struct(i.alias("index"), s.alias("start"), F.substring(text, s + 1, F.lit(window_chars)).alias("text")))
    return F.when(length <= max_doc_chars, whole).otherwise(spread)


def clean_text(text: Column) -> Column:
    """No tags or URLs, single spaces, no blank lines."""
    bare = F.regexp_replace(text, r"<[^>]+>", " ")
    bare = F.translate(F.regexp_replace(bare, r"(?U)https?://\S+", " "), " ", " ")
    lines = F.transform(F.split(bare, LINE_BREAK), lambda x: strip(F.regexp_replace(x, r"[ \t\r\f\x0B]+", " ")))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def sentence_spans(cleaned: Column, profile: LanguageProfile = TATAR) -> Column:
    """array<string>: the pieces of a cleaned text between sentence boundaries, untrimmed, blank ones included.

    Dots that end no sentence are masked first (inside numbers, after initials
    and abbreviations); then a mark is put behind every end of a sentence, and
    in place of every line break that follows one or precedes a capital. Each
    pattern begins with the sign it is about and looks back from there, so that
    letters cost no look behind.
    """
    low, up, letters = profile.lower, profile.upper, profile.letters
    masked = F.regexp_replace(cleaned, r"(?U)\.(?<=\d\.)(?=\d)", DOT)
    for _ in range(2):  # chains overlap
        masked = F.regexp_replace(masked, rf"(?U)(?=.[.{DOT}])(?<![\p{{L}}.{DOT}])((?:[{letters}][.{DOT}])*[{letters}])\.", f"$1{DOT}")
    masked = F.regexp_replace(masked, rf"(?iu)\.(?<=(?:{'|'.join(sorted(profile.abbreviations, key=len, reverse=True))}) ?\.)", DOT)
    marked = F.regexp_replace(masked, rf"(?U)([{END}][{CLOSING}]*+)(?!\s*+[{low}])(?=\s|\z)", f"$1{CUT}")
    marked = F.regexp_replace(marked, rf"(?U)\n(?:(?<=[{END}{DOT}{CLOSING}]\n)|(?=\s*+[{up}]))", f"\n{CUT}")
    return F.transform(F.split(marked, CUT), lambda s: F.translate(s, DOT, "."))


def sentences(text: Column, min_chars: int = 20, max_chars: int = 400, profile: LanguageProfile = TATAR) -> Column:
    """array<struct<sentence,start,end,reason>>: trimmed sentences of a text, offsets in the cleaned text.

    reason is ``accepted``, ``rejected:too_short``, ``rejected:too_long`` or
    ``rejected:non_cyrillic`` (under 60 % of the letters).
    """
    spans = sentence_spans(clean_text(text), profile)

    def placed(s: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<raw:string,at:int>>").alias("out"))
        step = lambda acc, x: F.struct((acc["at"] + F.length(x)).alias("at"), F.concat(acc["out"], F.array(F.struct(x.alias("raw"), acc["at"].alias("at")))).alias("out"))
        return F.aggregate(s, zero, step, lambda acc: acc["out"])

    def judged(x: Column) -> Column:
        counts = lambda body: F.struct(body.alias("body"), F.length(body).alias("n"), F.length(F.regexp_replace(body, r"\P{L}+", "")).alias("letters"), (F.length(body) - F.length(F.regexp_replace(body, profile.word, ""))).alias("own"), (x["at"] + F.length(F.regexp_extract(x["raw"], r"(?U)\A\s*", 0))).alias("start"))

        def reasoned(c: Column) -> Column:
            reason = F.when(c["n"] < min_chars, "rejected:too_short").when(c["n"] > max_chars, "rejected:too_long").when((c["letters"] == 0) | (c["own"] < 0.6 * c["letters"]), "rejected:non_cyrillic").otherwise("accepted")
            return F.struct(c["body"].alias("sentence"), c["start"].alias("start"), (c["start"] + c["n"]).alias("end"), reason.alias("reason"))

        return let(let(strip(x["raw"]), counts), reasoned)

    return F.filter(F.transform(let(spans, placed), judged), lambda x: x["sentence"] != "")


def explode_sentences(docs: DataFrame, text_col: str = "text", min_chars: int = 20, max_chars: int = 400, profile: LanguageProfile = TATAR) -> DataFrame:
    """A row a sentence: the columns of ``docs`` plus position, sentence, start, end, reason."""
    return docs.select("*", F.posexplode(sentences(F.col(text_col), min_chars, max_chars, profile)).alias("position", "s")).select(*docs.columns, "position", "s.*")
