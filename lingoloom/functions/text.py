"""Scalar text functions: columns in, columns out, all built-in expressions."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .profile import LATIN_ALPHABET, TATAR, LanguageProfile

SPACES = r"(?U)\s+"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once a row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _table(values: Mapping[str, str]) -> Column:
    """A constant map, however large, as one literal that the optimizer reads once."""
    return F.from_json(F.lit(json.dumps(values)), "map<string,string>")


def words_in(text: Column, profile: LanguageProfile = TATAR) -> Column:
    """Lower-case words, ё written as е."""
    # The whole text first: no other character becomes one of the letters, and one call a text replaces one a word.
    return F.regexp_extract_all(F.translate(F.lower(text), "ё", "е"), F.lit(profile.word), F.lit(0))


def char_ngrams(word: Column, n: int) -> Column:
    """All runs of n characters; none in a shorter word."""
    return F.when(F.length(word) >= n, F.transform(F.sequence(F.lit(1), F.length(word) - (n - 1)), lambda i: F.substring(word, i, n))).otherwise(F.array().cast("array<string>"))


def harmony_class(word: Column, profile: LanguageProfile = TATAR) -> Column:
    front, back = word.rlike(f"[{profile.front}]"), word.rlike(f"[{profile.back}]")
    return F.when(front & back, "mixed_front_back").when(front, "front_only").when(back, "back_only").otherwise("no_vowels")


def has_conditional(word: Column, profile: LanguageProfile = TATAR) -> Column:
    return word.rlike(f"[{profile.conditional}]")


def count_specific(text: Column, profile: LanguageProfile = TATAR) -> Column:
    """Letters that only this language has, in either case."""
    return count_letters(F.lower(text), profile.specific)


def count_letters(text: Column, letters: str) -> Column:
    """How many characters of the text are among ``letters``, which are few."""

    def less(text: Column) -> Column:
        rest = text
        for letter in letters:
            rest = F.replace(rest, F.lit(letter), F.lit(""))
        return F.length(text) - F.length(rest)

    return let(text, less)


def distinct_letters(text: Column, letters: str) -> Column:
    """Which of ``letters`` the lower-cased text has, in code point order, as one string."""
    return F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(f"[{letters}]"), F.lit(0)))), "")


def sentence_key(text: Column) -> Column:
    """SHA-256 of the text trimmed, in lower case, with single spaces."""
    return F.sha2(F.regexp_replace(F.lower(strip(text)), SPACES, " "), 256)


def stable_sort_key(seed: int, *parts: Column) -> Column:
    """SHA-256 of seed|part|part...; a null part counts as empty."""
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def hash_uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the parts alone."""
    return F.conv(F.substring(stable_sort_key(seed, *parts), 1, 8), 16, 10).cast("double") / float(1 << 32)


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")


def meta_value(text: Column) -> Column:
    return F.regexp_replace(F.lower(strip(text)), SPACES, "_")


def normalize_word(text: Column, profile: LanguageProfile = TATAR) -> Column:
    """From the first to the last letter, in lower case; empty without letters."""
    return F.lower(F.regexp_extract(text, f"(?s){profile.letter}(?:.*{profile.letter})?", 0))


def display_word(surface: Column, normalized: Column) -> Column:
    """The surface form where it is a word in capitals, else the normalised one."""
    trimmed = F.regexp_extract(surface, rf"(?s)[{TATAR.letters}](?:.*[{TATAR.letters}])?", 0)
    return F.when((F.length(trimmed) >= 2) & (F.upper(trimmed) == trimmed) & (F.lower(trimmed) != trimmed), trimmed).otherwise(normalized)


def canonical_apostrophes(text: Column) -> Column:
    return F.translate(text, "'’", "ʼʼ")


def is_clean_latin(text: Column) -> Column:
    """Not empty, and letters of the Latin alphabet only."""
    return text.rlike(r"\A[" + LATIN_ALPHABET.replace("-", r"\-") + r"]+\z")


def latin_upper(text: Column) -> Column:
    return F.upper(F.translate(text, "iı", "İI"))


def restore_case(source: Column, target: Column) -> Column:
    """``target`` with the letter case of ``source``, part by part between hyphens and apostrophes.

    A part in lower case stays as it is, one in capitals becomes capitals, one
    with a capital first gets one, any other stays. If the numbers of parts
    differ the whole word counts as one part.
    """
    cut = r"(?<=[-’'])|(?=[-’'])"

    def one(s: Column, t: Column) -> Column:
        first, rest = F.substring(s, 1, 1), F.expr("''")
        rest = F.regexp_replace(s, r"(?s)\A.", "")
        letters = s.rlike(r"\p{L}")
        return (
            F.when(~letters | (F.lower(s) == s), t)
            .when((F.upper(s) == s) & (F.length(s) > 1), latin_upper(t))
            .when((F.upper(first) == first) & (F.lower(rest) == rest), F.concat(latin_upper(F.substring(t, 1, 1)), F.regexp_replace(t, r"(?s)\A.", "")))
            .otherwise(t)
        )

    parts = F.struct(F.split(source, cut).alias("s"), F.split(F.translate(target, "ʼ", "'"), cut).alias("t"))
    same = let(parts, lambda p: F.when(F.size(p["s"]) == F.size(p["t"]), F.array_join(F.zip_with(p["s"], p["t"], one), "")).otherwise(one(source, target)))
    return F.when(source.rlike(r"[-’']"), F.translate(same, "'", "ʼ")).otherwise(one(source, target))


def url_with_query(base: str, **parameters: Column) -> Column:
    """``base``?name=value&..., values percent-encoded."""
    return F.concat(F.lit(base + "?"), F.concat_ws("&", *[F.concat(F.lit(k + "="), F.url_encode(v.cast("string"))) for k, v in parameters.items()]))


def query_value(url: Column, name: str) -> Column:
    """A parameter of the url's query, before any fragment; null where it is missing."""
    found = F.regexp_extract(F.regexp_replace(url, r"(?s)#.*\z", ""), rf"(?s)[?&]{name}=([^&]*)", 1)
    return F.when(F.regexp_replace(url, r"(?s)#.*\z", "").rlike(rf"[?&]{name}="), found)


# HTML


#: What a character reference may look like: decimal, hexadecimal, or a name of up to 32 characters.
_REFERENCE = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
#: Names that count without a semicolon too, and in front of other letters; the longest first.
_BARE = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))


def _referred(ref: Column) -> Column:
    """What one reference (without its &) stands for: HTML's rules, wrong numbers included."""
    names = _table(html5)
    digits = F.regexp_replace(ref, r"\A#[xX]?0*(?=[0-9a-fA-F])|;", "")
    hexadecimal = ref.rlike(r"\A#[xX]")
    code = F.when(F.length(digits) > 7, 0x110000).otherwise(F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits).cast("int"))
    unit = lambda c: F.decode(F.unhex(F.lpad(F.hex(c), 8, "0")), "UTF-32")
    windows = F.array(*[F.lit(bytes([c]).decode("cp1252", "ignore") or chr(c)) for c in range(0x80, 0xA0)])  # what pages of that code page mean
    control = code.between(0x1, 0x8) | (code == 0xB) | code.between(0xE, 0x1F) | (code == 0x7F) | code.between(0xFDD0, 0xFDEF) | ((code % 0x10000) >= 0xFFFE)
    number = (
        F.when(code.between(0x80, 0x9F), F.get(windows, code - 0x80))
        .when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), "\ufffd")
        .when(control, "")
        .otherwise(unit(code))
    )
    prefix = F.regexp_extract(ref, rf"\A(?:{_BARE})", 0)
    bare = F.concat(F.try_element_at(names, prefix), F.substring(ref, F.length(prefix) + 1, F.length(ref)))
    named = F.coalesce(F.try_element_at(names, ref), F.when(prefix != "", bare), F.concat(F.lit("&"), ref))
    return F.when(ref.isNull(), "").when(ref.startswith("#"), number).otherwise(named)


def unescape(text: Column) -> Column:
    """Character references replaced in one pass, as HTML reads them: all names, with and without semicolons, and numbers."""

    def replaced(text: Column) -> Column:
        pieces = F.struct(F.split(text, _REFERENCE, -1).alias("rest"), F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(1)).alias("refs"))
        joined = let(pieces, lambda p: F.array_join(F.zip_with(p["rest"], p["refs"], lambda a, b: F.concat(a, _referred(b))), ""))
        return F.when(text.contains("&"), joined).otherwise(text)

    return let(text, replaced)  # what made the text runs once


#: References that have to be escaped in HTML, and the no-break space; the ampersand last, so that nothing is read twice. fixed values
BASIC_REFERENCES = (("&nbsp;", "\xa0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def unescape_basic(text: Column) -> Column:
    """``BASIC_REFERENCES`` replaced; all others stay as they are written."""
    for name, char in BASIC_REFERENCES:
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def html_text(html: Column, references: Callable[[Column], Column] = unescape) -> Column:
    """Visible text with single spaces: no scripts, styles or tags. ``references`` says which character references are replaced."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    bare = references(F.regexp_replace(bare, r"(?s)<[^>]+>", " "))
    return strip(F.regexp_replace(F.translate(bare, "﻿", " "), SPACES, " "))


def cell_text(html: Column) -> Column:
    return strip(F.regexp_replace(unescape(F.regexp_replace(html, r"(?s)<[^>]+>", " ")), SPACES, " "))


def paragraph_text(html: Column) -> Column:
    """Bodies of all <p> elements, without scripts, styles, tags, [..] and (..)."""
    body = F.array_join(F.regexp_extract_all(html, F.lit(r"(?is)<p\b[^>]*>(.*?)</p>"), F.lit(1)), " ")
    body = F.regexp_replace(body, r"(?is)<script\b.*?</script>|<style\b.*?</style>", " ")
    body = unescape(F.regexp_replace(body, r"(?s)<[^>]+>", " "))
    body = F.regexp_replace(F.regexp_replace(body, r"\[[^\]]*\]", " "), r"\([^)]*\)", " ")
    return strip(F.regexp_replace(body, SPACES, " "))


def _foldings() -> dict[str, str]:
    """Characters that caseless comparison writes otherwise, from the Unicode tables at hand."""
    return {c: c.casefold() for c in map(chr, (*range(0xD800), *range(0xE000, 0x110000))) if c.casefold() != c}


_FOLDED = _foldings()
_ONE = {c: f for c, f in _FOLDED.items() if len(f) == 1}
_MANY = {c: f for c, f in _FOLDED.items() if len(f) > 1}


def casefold(text: Column) -> Column:
    """Full case folding, one-to-many letters (ß, ﬁ, ŉ) included; sigma has one form."""
    # Lower case first, whose own one-to-many letter (İ) is folded alike; what it leaves goes letter by letter.
    letters = _table(_MANY)
    full = lambda simple: F.array_join(F.transform(F.split(simple, ""), lambda c: F.coalesce(F.try_element_at(letters, c), c)), "")
    simple = lambda low: F.translate(low, "".join(_ONE), "".join(_ONE.values()))
    folded = lambda low: F.when(low.rlike(r"\A\p{ASCII}*+\z"), low).otherwise(let(simple(low), lambda s: F.when(s.rlike("[" + "".join(_MANY) + "]"), full(s)).otherwise(s)))
    return let(F.lower(text), folded)


def normalize_headword(text: Column) -> Column:
    """Single spaces, caseless."""
    return casefold(strip(F.regexp_replace(text, SPACES, " ")))
