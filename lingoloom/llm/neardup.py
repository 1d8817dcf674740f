"""Near-duplicate documents by a MinHash LSH forest over word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lingoloom.operators.ranges import join_split

from .hashing import MinHash, blocks, digest, word_shingles
from .linking import BROADCAST_BYTES, FOREST, fetch, index_rows, linked, regions
from .scratch import Scratch

#: Sorted orders (eight at most) of four signature values each. A region shares the first two: recall 0.9997 at a similarity of 0.8, 0.99996 at 0.85.
TREES, STEP = 8, 4


def _signatures(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minima = MinHash(TREES * STEP)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for first, some in blocks(texts):
                sets = word_shingles(some, width)
                full = [s for s in sets if len(s)]
                rows = iter(minima(np.concatenate(full), np.concatenate(([0], np.cumsum([len(s) for s in full])))) if full else ())
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(first, len(some)) for c in ("doc_id", "home")), pa.array([len(s) for s in sets], pa.int64()), pa.array([digest(s) if len(s) else None for s in sets], pa.binary()), pa.array([next(rows).tobytes() if len(s) else None for s in sets], pa.binary())],
                    names=["doc_id", "home", "n_shingles", "name", "signature"],
                )

    return run


def _forest(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each signature once a tree: the tree and the first 30 bits of its first two values, then the first bits of the next two."""
    v = values.reshape(len(values), TREES, STEP).astype(np.uint64)
    begin = (np.arange(TREES, dtype=np.uint64) << np.uint64(60)) | (v[:, :, 0] >> np.uint64(2) << np.uint64(30)) | (v[:, :, 1] >> np.uint64(2))
    return begin, (v[:, :, 2] << np.uint64(31)) | (v[:, :, 3] >> np.uint64(1))


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, some in blocks(batch.column("text").to_pylist()):
                part = batch.slice(first, len(some))
                found = word_shingles(some, width)
                rows = [(i, s.tobytes()) for i, name, s in zip(part.column("id").to_pylist(), part.column("name").to_pylist(), found, strict=True) if digest(s) == name]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["id", "body"])

    return run


def unpacked(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(bodies), dtype=np.uint64), np.concatenate(([0], np.cumsum([len(b) // 8 for b in bodies])))


def _judged(docs: DataFrame, percent: int, width: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, home, n_shingles, component_id, kept) of each row."""
    scratch = Scratch(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    docs = docs.withColumn("home", F.coalesce("doc_id", F.xxhash64("text")))  # where a set's text can be fetched again
    named = scratch.save(docs.mapInArrow(_signatures(width), "doc_id long, home long, n_shingles long, name binary, signature binary"))
    distinct = named.where("name is not null").groupBy("name").agg(F.min("doc_id").alias("doc_id"), F.min("home").alias("home"), F.first("signature").alias("signature"), F.count("*").alias("n"))
    distinct = scratch.save(distinct.withColumn("id", F.monotonically_increasing_id()))
    groups, crowded = regions(distinct.select("id", "signature").mapInArrow(index_rows(_forest, np.uint32), FOREST), scratch)
    needed = groups.select("id").unionByName(crowded.select("id")).distinct()
    wanted = scratch.save(distinct.select("id", "name", "home").join(needed, "id"))
    texts = fetch(docs.select("home", "text"), wanted, "home", 48)
    sets = scratch.save(texts.select("id", "name", "text").mapInArrow(_sets(width), "id long, body binary").dropDuplicates(["id"]))
    roots = linked(groups, crowded, sets, percent, scratch, unpacked)
    scratch.drop(wanted, sets)
    members = distinct.select("id", "name", "doc_id", "n").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    total, n_rows = distinct.count(), named.count()
    smallest = members.groupBy("root").agg(F.min("doc_id").alias("component_id"), (F.count("*") * 1000 > total).alias("frequent"))
    judged = scratch.save(join_split(members, smallest, "root").select("name", "component_id", (F.col("n") * 1000 > n_rows).alias("frequent")))
    # rows without words have no name and meet nobody; names of many exact copies are joined by a broadcast
    out = join_split(named.where("name is not null").drop("signature"), judged, "name")
    out = out.unionByName(named.where("name is null").drop("signature").withColumn("component_id", F.lit(None).cast("long")))
    component = F.when(F.col("name").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "home", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))


def near_duplicates(docs: DataFrame, percent: int = 85, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * |A & B| >= percent * |A | B| over their
    sets of ``width``-word shingles. Documents with equal sets share one
    entry. Eight sorted orders of the signatures give candidates: documents that
    share the first two values of an order are compared on full sets with all
    others of that region, where it is crowded with those that share the
    longest prefixes, and then by more and longer orders until regions are
    small (``linking.regions`` and ``linking.linked``).

    Null and empty texts and those without words have an empty set, stay alone
    and are kept. Rows that share an id are one document. A null id is never
    the smallest of a component unless all are null; such rows are kept only
    then. Other columns are ignored, whatever their names.
    """
    return _judged(docs, percent, width, id_col, text_col).drop("home")


def without_near_duplicates(docs: DataFrame, percent: int = 85, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` less the rows that ``near_duplicates`` doesn't keep, with all their columns."""
    gone = Scratch(docs.sparkSession).save(_judged(docs, percent, width, id_col, text_col).where("not kept").select("home").distinct())
    if gone.count() * 16 <= BROADCAST_BYTES:
        gone = F.broadcast(gone)
    home = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.xxhash64(f"`{text_col}`"))
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), home.alias("home")).join(gone, "home", "left_anti").select("row.*")
