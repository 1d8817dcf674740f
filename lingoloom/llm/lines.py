"""Fuzzy line deduplication: MinHash bands over character shingles, exact verification, one line kept per component."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingoloom.functions.text import let
from lingoloom.operators.ranges import join_split

from .hashing import LineSignatures, blocks, char_shingles, mix
from .linking import BANDS as INDEX
from .linking import fetch, index_rows, linked, regions
from .scratch import Scratch

#: Bands of three 32-bit minima: recall 0.9984 at a similarity of 0.8, 0.99999 at 0.9.
BANDS, ROWS = 9, 3
#: What Python's str.split() takes for white space, as a regular expression of its complement.
VISIBLE = "[^\\t-\\r\\x1c-\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
HOME = "unnumbered boolean, doc long, hash long"


def normalised(line: str) -> str:
    """Lower case, each run of white space one space, none at the ends; empty for a blank line."""
    low = line.lower()
    if "  " not in low and low.isprintable() and low[:1] != " " and low[-1:] != " ":  # no white space but single spaces
        return low
    return " ".join(low.split())


def _name(line: str) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(line.encode("utf-8", "surrogatepass"))


def _buckets(minima: np.ndarray) -> np.ndarray:
    """(lines, BANDS) 64-bit names of the buckets."""
    out = np.tile(np.arange(BANDS, dtype=np.uint64), (len(minima), 1))
    for k in range(ROWS):
        out = mix(out * np.uint64(31) + minima.reshape(-1, BANDS, ROWS)[:, :, k].astype(np.uint64))
    return out


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(home, line_no, name, signature) of every line that isn't blank; the signature, its buckets, is given once a block."""
    minima = LineSignatures(BANDS * ROWS, seed=4)
    for batch in batches:
        homes = [batch.column(c) for c in ("unnumbered", "doc", "hash")]
        for first, some in blocks(batch.column("text").to_pylist()):
            rows = [(first + i, k, n) for i, t in enumerate(some) for k, line in enumerate(t.split("\n")) if (n := normalised(line))]
            own = {n: i for i, n in enumerate(dict.fromkeys(r[2] for r in rows))}
            if not own:
                continue
            names, signs = [_name(n) for n in own], [v.tobytes() for v in _buckets(minima(list(own)))]
            at = [own[r[2]] for r in rows]
            fresh = [signs[a] if a == seen else None for a, seen in zip(at, _firsts(at), strict=True)]
            take = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([*(h.take(take) for h in homes), pa.array([r[1] for r in rows], pa.int32()), pa.array([names[a] for a in at], pa.binary()), pa.array(fresh, pa.binary())], names=["unnumbered", "doc", "hash", "line_no", "name", "signature"])


def _firsts(at: list[int]) -> Iterator[int]:
    """Each number where it first occurs, -1 elsewhere; new numbers come in order."""
    top = -1
    for a in at:
        yield a if a > top else -1
        top = max(top, a)


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, body) of the wanted lines of each fetched text."""
    for batch in batches:
        ids, bodies = [], []
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
            lines = text.split("\n")
            for w in wanted:
                if w["line_no"] < len(lines) and _name(n := normalised(lines[w["line_no"]])) == w["name"]:
                    ids.append(w["id"])
                    bodies.append(n)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(bodies, pa.string())], names=["id", "body"])


def _without(text: Column, drop: Column) -> Column:
    """``text`` less the lines whose numbers are in ``drop``."""
    lines = F.split(text, "\n", -1)
    return let(lines, lambda all_lines: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), drop), lambda i: F.get(all_lines, i)), "\n"))


def dedup_lines(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", counts: tuple[str, str] = ("n_lines", "n_dropped")) -> DataFrame:
    """``docs`` with near-duplicate lines removed, plus n_lines and n_dropped (long), or other names for the ``counts``.

    Lines are compared normalised (lower case, single spaces) by their sets of
    8-character shingles; a shorter line is one shingle. Lines with 100 *
    |A & B| >= percent * |A | B| are linked, and of each component the first
    occurrence stays: that with the smallest (document id, line number), an
    unnumbered document last. Blank lines (nothing but white space, as Python's
    str.split() sees it) always stay and don't count.

    Candidates are lines that share a band of their MinHash signatures
    (``linking.regions`` and ``linking.linked``); each link is confirmed on full
    sets. Lines that occur once and have no link need no join; names that make
    a thousandth of all lines, at most a thousand, are joined by a broadcast.

    Every row stays, with its other columns as they are; a text may become
    empty, null stays null. Rows that share id and text are one document and
    keep the same lines; rows that share an id only are told apart by text.
    A column of ``docs`` named as one of the counts is replaced.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    key, text = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")
    home = [key.isNull().alias("unnumbered"), F.coalesce(key, F.lit(0)).alias("doc"), F.coalesce(F.xxhash64(text), F.lit(0)).alias("hash")]
    of = ["unnumbered", "doc", "hash"]
    texts = docs.select(*home, text.alias("text"))
    lines = scratch.save(texts.mapInArrow(_signed, f"{HOME}, line_no int, name binary, signature binary"))
    distinct = lines.groupBy("name").agg(F.min(F.struct(*of, "line_no")).alias("first"), F.first("signature", ignorenulls=True).alias("signature"), F.count("*").alias("n"))
    distinct = scratch.save(distinct.withColumn("id", F.monotonically_increasing_id()))
    groups, crowded = regions(distinct.select("id", "signature").mapInArrow(index_rows(lambda buckets: (buckets,), np.uint64), INDEX), scratch)
    needed = groups.select("id").unionByName(crowded.select("id")).distinct()
    wanted = distinct.join(needed, "id").groupBy(F.xxhash64(*[f"first.{c}" for c in of]).alias("key")).agg(F.collect_list(F.struct("id", "name", F.col("first.line_no").alias("line_no"))).alias("wanted"))
    wanted = scratch.save(wanted)
    found = fetch(texts.select(F.xxhash64(*of).alias("key"), "text"), wanted, "key", F.size("wanted") * 48 + 40).select("text", "wanted")
    bodies = scratch.save(found.mapInArrow(_bodies, "id long, body string").dropDuplicates(["id"]))
    roots = linked(groups, crowded, bodies, percent, scratch, char_shingles)
    scratch.drop(wanted, bodies)
    # the first occurrence of each component; a line without a link is its own
    members = distinct.select("id", "name", "first").join(roots, "id")
    linked_lines = roots.count()
    best = members.groupBy("root").agg(F.min("first").alias("best"), (F.count("*") * 1000 > linked_lines).alias("frequent"))
    best = join_split(members, best, "root").select("name", F.col("best").alias("kept_at"))
    total = lines.count()
    firsts = distinct.select("name", "first", "n").join(best, "name", "left").where("n > 1 or kept_at <> first")
    firsts = scratch.save(firsts.select("name", F.coalesce("kept_at", "first").alias("kept_at"), (F.col("n") * 1000 > total).alias("frequent")))
    judged = join_split(lines.select(*of, "line_no", "name"), firsts, "name").where(F.struct(*of, "line_no") != F.col("kept_at"))
    drops = judged.groupBy(*of).agg(F.array_distinct(F.collect_list("line_no")).alias("drop"))
    kept = [c for c in docs.columns if c != text_col and c not in counts]
    joined = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept], F.lit(0)).alias("row"), text.alias("text"), *home).join(drops, of, "left")
    n_lines = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(VISIBLE + "[^\\n]*")).cast("long")  # a visible character and the rest of its line
    n_dropped = F.coalesce(F.size("drop"), F.lit(0)).cast("long")
    new = F.when(F.col("drop").isNotNull(), _without(F.col("text"), F.col("drop"))).otherwise(F.col("text"))
    columns = [new.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns if c == text_col or c in kept]
    return joined.select(*columns, n_lines.alias(counts[0]), n_dropped.alias(counts[1]))
