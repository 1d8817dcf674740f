"""Document fingerprints by winnowing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .linking import fetch
from .scratch import Scratch

# fixed values: vowel and consonant letters below U+0100, which a regular expression tells apart by one look at a table
VOWELS = "aeiouyAEIOUYàáâãäåæèéêëìíîïòóôõöøùúûüýÿÀÁÂÃÄÅÆÈÉÊËÌÍÎÏÒÓÔÕÖØÙÚÛÜÝ"
CONSONANTS = "bcdfghjklmnpqrstvwxzBCDFGHJKLMNPQRSTVWXZßçñðþÇÑÐÞ"
#: A token is a syllable as a sign can tell it: consonants and the vowels behind them, in a run of characters that aren't
#: white space. Any other sign is a token of its own: digits, punctuation, letters of other scripts. So where tokens begin
#: depends on the characters next to it alone, and one character more changes one token, however long a run is.
TOKEN = rf"[{CONSONANTS}]++[{VOWELS}]*+|[{VOWELS}]++|[^{CONSONANTS}{VOWELS}\x20\x09-\x0D]"
#: Tokens in a gram, grams in a window (powers of two): a run of GRAM + WINDOW - 1 = 11 shared tokens is always noticed.
GRAM, WINDOW = 4, 8
#: Windows of a text that are looked at together; longer texts are read in overlapping segments, so arrays stay small.
SEGMENT = 1 << 14
#: 32 bits of hash above 31 bits that fall as the position rises: the least is the rightmost of equal hashes.
_PLACES = (1 << 31) - 1
#: Modulus (a prime) and base of the rolling hash: values below 2**31, products below 2**62.
_PRIME, _BASE = (1 << 31) - 1, 1_103_515_245
#: Bytes of text in a range of documents, ranges in a task, about.
RANGE_BYTES, TOGETHER = 8 << 20, 4
_LOWEST = -(1 << 63)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _ahead(values: Column, by: int, join: Callable[[Column, Column], Column]) -> Column:
    """``join`` of each value and the one ``by`` places on, as far as there is one."""
    return _let(values, lambda v: F.zip_with(F.slice(v, 1, F.size(v) - by), F.slice(v, 1 + by, F.size(v) - by), join))


def _grams(tokens: Column, offset: Column) -> Column:
    """An entry for every run of GRAM of the tokens' hashes: hash above place.

    The hash is the polynomial of the tokens modulo a prime. That of 2s tokens
    is rolled up from the hashes of s tokens.
    """
    value, size = tokens, 1
    while size < GRAM:
        value = _ahead(value, size, _rolled(pow(_BASE, size, _PRIME)))
        size *= 2
    return F.transform(value, lambda h, i: _entry(h, i + offset))


def _rolled(power: int) -> Callable[[Column, Column], Column]:
    return lambda a, b: (a * F.lit(power).cast("long") + b) % F.lit(_PRIME)


def _entry(value: Column, place: Column) -> Column:
    return F.shiftleft(F.shiftrightunsigned(F.xxhash64(value), 33), 31) + (F.lit(_PLACES - 1).cast("long") - place)


def _changes(minima: Column) -> Column:
    """A minimum that neighbouring windows share counts once; no later window returns to it."""
    return _let(minima, lambda m: F.filter(m, lambda x, i: (i == 0) | (x != F.get(m, i - 1))))


def _least(grams: Column) -> Column:
    """The least entry of every window of WINDOW grams, of all grams if they are fewer."""
    least, size = grams, 1
    while size < WINDOW:
        least = _ahead(least, size, lambda a, b: F.least(a, b))
        size *= 2
    return F.when(F.size(grams) <= WINDOW, F.array(F.array_min(grams))).otherwise(_changes(least))


def winnow(text: Column) -> Column:
    """array<bigint>: of every window of grams the one with the least hash, the rightmost among equals, each once, by position.

    Each entry holds the hash above the position (``hash_of``, ``position_of``).
    A text with fewer tokens than a gram has one gram, one with fewer grams
    than a window has one window, and one without tokens has no entry.
    """
    tokens = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0)), lambda t: F.shiftrightunsigned(F.xxhash64(t), 33))

    def segment(h: Column, j: Column) -> Column:
        return _let(_grams(F.slice(h, j * SEGMENT + 1, F.lit(SEGMENT + GRAM + WINDOW - 2)), j * SEGMENT), _least)

    def whole(h: Column) -> Column:
        n = F.size(h)
        windows = F.greatest(n - (GRAM + WINDOW - 2), F.lit(1))
        parts = F.transform(F.sequence(F.lit(0), F.floor((windows - 1) / SEGMENT).cast("int")), lambda j: segment(h, j))
        short = F.aggregate(h, F.lit(0).cast("long"), _rolled(_BASE))
        return F.when(n == 0, F.array().cast("array<bigint>")).when(n < GRAM, F.array(_entry(short, F.lit(0)))).otherwise(_changes(F.flatten(parts)))

    return _let(tokens, whole)


def hash_of(entry: Column) -> Column:
    return F.shiftright(entry, 31)


def position_of(entry: Column) -> Column:
    """The gram's first token, from 0."""
    return F.lit(_PLACES - 1) - entry.bitwiseAND(_PLACES)


def written(fingerprint: Column) -> Column:
    """hash:position of each entry, comma-joined."""
    return F.array_join(F.transform(fingerprint, lambda e: F.concat_ws(":", hash_of(e), position_of(e))), ",")


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes over all hashes (Jaccard) of two fingerprints; 1 for two empty ones."""
    hashes = lambda x: F.array_distinct(F.transform(x, hash_of))
    return _let(F.struct(hashes(a).alias("a"), hashes(b).alias("b")), lambda s: _let(F.size(F.array_intersect(s["a"], s["b"])), lambda n: F.when(F.size(s["a"]) + F.size(s["b"]) == 0, 1.0).otherwise(n / (F.size(s["a"]) + F.size(s["b"]) - n))))


def with_next(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``docs`` (doc_id, text) plus next_text, that of the next row by (doc_id, hash of text, text) (of the last row the first's), and the fingerprints of both: own, following.

    Rows are dealt into ranges of about ``range_bytes`` of text, between up to
    1024 quantiles of the id and evenly between those; an id that takes several
    quantiles is dealt by its texts' hashes. The first row of each range is
    also handed to the range before it, so text moves once and no range waits
    for another. Ranges are put in order by their first keys alone.
    """
    docs = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(_LOWEST)).alias("key"), F.xxhash64("text").alias("hash"))
    counted = docs.agg(F.sum(F.octet_length("text").cast("long")).alias("bytes"), F.min("key").alias("low"), F.max("key").alias("high")).first()
    parts = 1 + (counted["bytes"] or 0) // range_bytes
    knots = min(1024, parts)
    part = F.lit(0).cast("long")
    if parts > 1:
        found = docs.agg(F.percentile_approx("key", [k / knots for k in range(1, knots)], 20 * knots).alias("c")).first()["c"] if knots > 1 else []
        found = [counted["low"], *found, counted["high"]]
        frequent = {a for a, b in zip(found[:-1], found[1:], strict=True) if a == b}
        cuts = sorted({*found, *(a + 1 for a in frequent if a < (1 << 63) - 1)})
        if len(cuts) > 1:
            part = _part(F.col("key"), F.col("hash"), cuts, -(-parts // knots))
    docs = docs.withColumn("part", part)
    scratch = Scratch(docs.sparkSession)
    # a range's first key is handed to the range before it: within a thousand ranges, then between the thousands
    firsts = scratch.save(docs.groupBy("part").agg(F.min(F.struct("key", "hash")).alias("f")).select("part", "f.key", "f.hash", F.floor(F.col("part") / 1000).alias("thousand")))
    within = Window.partitionBy("thousand").orderBy(F.desc("part"))
    between = Window.orderBy(F.desc("thousand"))
    ends = firsts.groupBy("thousand").agg(F.max("part").alias("end")).select("thousand", F.coalesce(F.lead("end").over(between), F.first("end").over(Window.orderBy(F.desc("thousand")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("end"))
    before = scratch.save(firsts.withColumn("before", F.lead("part").over(within)).join(ends, "thousand").select("part", "key", "hash", F.coalesce("before", "end").alias("before")))
    tail = fetch(docs.select("text", "part", "key", "hash"), before, ["part", "key", "hash"], 32).groupBy("before").agg(F.min("text").alias("text"))
    tail = tail.select(F.lit(None).cast("long").alias("doc_id"), "text", F.lit(None).cast("long").alias("key"), F.lit(None).cast("long").alias("hash"), F.col("before").alias("part"), F.lit(True).alias("border"))
    both = docs.withColumn("border", F.lit(False)).unionByName(tail).repartition(1 + parts // TOGETHER, "part").withColumn("own", winnow(F.col("text")))
    in_range = Window.partitionBy("part").orderBy("border", "key", "hash", "text")
    return both.withColumns({"next_text": F.lead("text").over(in_range), "following": F.lead("own").over(in_range)}).where("not border").select("doc_id", "text", "own", "next_text", "following")


def _part(key: Column, by: Column, cuts: list[int], each: int) -> Column:
    """The range of a key: its interval between the sorted cuts, found by bisection, and its share of that interval (the share of ``by`` where the interval holds one key) in ``each`` steps."""
    at = F.array(*[F.lit(c).cast("long") for c in cuts])
    steps = [1 << k for k in reversed(range(len(cuts).bit_length()))]
    down = lambda i, s: F.when((i + s < len(cuts)) & (F.get(at, i + s) <= key), i + s).otherwise(i)
    interval = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), down)

    def inside(i: Column) -> Column:
        low, high = F.get(at, i).cast("double"), F.get(at, i + 1).cast("double")
        single = F.get(at, i) + 1 >= F.coalesce(F.get(at, i + 1), F.get(at, i))
        share = F.when(single, by.cast("double") / float(1 << 64) + 0.5).when(high > low, (key.cast("double") - low) / (high - low)).otherwise(0.0)
        return i.cast("long") * each + F.greatest(F.lit(0).cast("long"), F.least(F.floor(share * each), F.lit(each - 1).cast("long")))

    return _let(interval, inside)


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, text, next_text, edited, own, other, following.

    ``edited`` is the text with its last floor(n/2) characters replaced by the
    first as many (or all) of the next document's; ``own``, ``other`` and
    ``following`` are the fingerprints of the text, of the edited text and of
    the next text. Null texts count as empty. Null ids come first; rows that
    repeat an id are ordered by their texts' xxhash64, then by text. Other
    columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    both = with_next(docs)
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 2) as int))"), F.substring(F.col("next_text"), F.lit(1), half))
    return both.withColumn("edited", edited).select("*", winnow(F.col("edited")).alias("other"))


def fingerprint_report(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        written(F.col("own")).alias("fingerprint"),
        written(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
    )
