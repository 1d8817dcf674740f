"""Measures, artifact reasons and penalty of a sentence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .profile import TATAR, LanguageProfile
from .text import count_letters, count_specific, let


def _count(text: Column, sign: str) -> Column:
    """How often the sign stands in the text, without overlaps."""
    return F.floor((F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))) / len(sign)).cast("int")


def _beginning(lines: Column, pattern: str) -> Column:
    return F.size(F.filter(lines, lambda x: x.rlike(pattern)))


def measures(text: Column, profile: LanguageProfile = TATAR) -> Column:
    """struct of the counts and ratios that the rules read, unrounded."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"(?U)\S"))
    counted = F.struct(
        F.regexp_count(text, F.lit(profile.word)).alias("words"),
        count_specific(text, profile).alias("specific"),
        F.length(F.regexp_replace(text, r"\P{L}+", "")).alias("letters"),
        F.length(F.regexp_replace(text, r"\P{Lu}+", "")).alias("capitals"),
        lines.alias("lines"),
    )
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)

    def named(c: Column) -> Column:
        markdown = _count(text, "##") + _count(text, "**") + _count(text, "[^") + F.when(text.contains(">"), _beginning(c["lines"], r"(?U)\A\s*>")).otherwise(0)
        return F.struct(
            c["words"].alias("word_count"),
            c["specific"].alias("specific_count"),
            ratio(c["specific"], c["words"]).alias("specific_per_word"),
            count_letters(F.lower(text), profile.foreign).alias("foreign_count"),
            c["letters"].alias("letter_count"),
            ratio(c["capitals"], c["letters"]).alias("uppercase_ratio"),
            F.size(c["lines"]).alias("line_count"),
            markdown.alias("markdown_count"),
            F.when(text.contains("-") | text.contains("—"), _beginning(c["lines"], r"(?U)\A\s*[-—]\s+")).otherwise(0).alias("list_count"),
            _count(text, "—").alias("dash_count"),
            _count(text, ",").alias("comma_count"),
        )

    return let(counted, named)


# fixed values
REASONS = (
    ("markdown", lambda m, p: m["markdown_count"] > 0),
    ("list_block", lambda m, p: (m["line_count"] >= 4) | (m["list_count"] >= 3)),
    ("glossary_block", lambda m, p: m["dash_count"] >= 4),
    ("uppercase_block", lambda m, p: (m["letter_count"] >= 20) & (m["uppercase_ratio"] >= 0.45)),
    ("low_tatar_specific_density", lambda m, p: (m["word_count"] >= 8) & (m["specific_per_word"] < p.min_specific_per_word)),
    ("comma_heavy_list", lambda m, p: (m["comma_count"] >= 12) & (m["specific_per_word"] < 0.50)),
    ("russian_orthography_heavy", lambda m, p: (m["foreign_count"] >= 8) & (m["specific_per_word"] < 0.30)),
)


def penalty(m: Column) -> Column:
    over = lambda value, floor: F.greatest(F.lit(0.0), value - F.lit(float(floor)))
    return (
        F.greatest(F.lit(0.0), (F.lit(0.35) - m["specific_per_word"]) * 120)
        + 6.0 * F.least(m["foreign_count"], F.lit(12))
        + 80.0 * m["markdown_count"]
        + 25.0 * over(m["line_count"], 2)
        + 30.0 * m["list_count"]
        + 15.0 * m["dash_count"]
        + 8.0 * over(m["comma_count"], 8)
        + F.greatest(F.lit(0.0), (m["uppercase_ratio"] - 0.25) * 120)
    )


def sentence_quality(text: Column, profile: LanguageProfile = TATAR) -> Column:
    """struct<measures..., reasons array<string>, penalty double, is_artifact boolean>; ratios and penalty rounded to six places."""

    def judged(m: Column) -> Column:
        reasons = F.filter(F.array(*[F.when(test(m, profile), F.lit(name)) for name, test in REASONS]), lambda x: x.isNotNull())
        names = ("word_count", "specific_count", "foreign_count", "line_count", "markdown_count", "list_count", "dash_count", "comma_count")
        return F.struct(*[m[n].alias(n) for n in names], F.round(m["specific_per_word"], 6).alias("specific_per_word"), F.round(m["uppercase_ratio"], 6).alias("uppercase_ratio"), reasons.alias("reasons"), F.round(penalty(m), 6).alias("penalty"), (F.size(reasons) > 0).alias("is_artifact"))

    return let(measures(text, profile), judged)
