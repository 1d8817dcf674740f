"""Hard negatives by product quantisation with stored residual norms.

Each vector keeps a code of one byte for every two dimensions and the norm of
what the code leaves over. Against an anchor, the sum of its table entries
under a code is the score of the coded vector, and by Cauchy-Schwarz the true
score lies within (anchor norm * residual norm) of it. So a pair whose
interval misses a window can't be in it; all others are scored exactly, in
integers. The filter loses nothing, whatever the codebooks are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch
from .vectors import packed, sound_vectors, unpacked

#: Components become floor(256 * x); beyond +-EDGE they are that edge, so scores of up to 2,048 dimensions fit 64 bits.
SCALE, EDGE = 256, 1 << 26
#: Dimensions of a code byte; rows that the codebooks are fitted on at most; rounds of k-means.
STEP, FITTED, ROUNDS = 2, 4096, 6
#: Anchors of a pass over the rows at most, and of one block of scores.
WAVE, BLOCK = 1 << 16, 256
#: Rounding of float32 sums as a share of the norms' product.
SLACK = 2.0**-17


class Quantiser:
    """Codebooks for each run of STEP dimensions, by k-means on a bounded sample."""

    def __init__(self, sample: np.ndarray, width: int):
        self.width, self.parts = width, -(-width // STEP)
        rng = np.random.default_rng(1)
        sample = sample.astype(np.float64) if len(sample) else np.zeros((1, width))
        self.books = []
        for part in self.split(sample):
            distinct = np.unique(part, axis=0)
            centres = distinct if len(distinct) <= 256 else distinct[rng.choice(len(distinct), 256, replace=False)]
            for _ in range(ROUNDS if len(distinct) > 256 else 0):
                near = self.nearest(part, centres)
                size = np.bincount(near, minlength=len(centres))
                sums = np.stack([np.bincount(near, part[:, k], len(centres)) for k in range(STEP)], axis=1)
                centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
            self.books.append(centres)

    def split(self, rows: np.ndarray) -> list[np.ndarray]:
        filled = np.zeros((len(rows), self.parts * STEP), dtype=rows.dtype)
        filled[:, : self.width] = rows
        return [filled[:, k * STEP : (k + 1) * STEP] for k in range(self.parts)]

    @staticmethod
    def nearest(part: np.ndarray, centres: np.ndarray) -> np.ndarray:
        return np.argmin((centres**2).sum(axis=1) - 2 * (part @ centres.T), axis=1)

    def codes(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code bytes (rows, parts), and each row's bound: its residual's norm and room for rounding, rounded up."""
        rows = rows.astype(np.float64)
        codes = np.empty((len(rows), self.parts), dtype=np.uint8)
        left = np.zeros(len(rows))
        for k, (part, centres) in enumerate(zip(self.split(rows), self.books, strict=True)):
            codes[:, k] = near = self.nearest(part, centres)
            left += ((part - centres[near]) ** 2).sum(axis=1)
        left = np.sqrt(left)
        return codes, np.nextafter((left + SLACK * (np.sqrt((rows**2).sum(axis=1)) + left)).astype(np.float32), np.float32(np.inf))

    def tables(self, anchors: np.ndarray) -> list[np.ndarray]:
        """For each code byte a table (256, anchors) of what it adds to the scores."""
        out = []
        for part, centres in zip(self.split(anchors.astype(np.float64)), self.books, strict=True):
            out.append((centres @ part.T).astype(np.float32))
        return out


def looked_up(tables: list[np.ndarray], codes: np.ndarray) -> np.ndarray:
    """(rows, anchors): the sums of table entries under each row's code."""
    total = tables[0][codes[:, 0]]
    for k in range(1, len(tables)):
        total += tables[k][codes[:, k]]
    return total


def exact_scores(rows: np.ndarray, anchors: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Integer inner products of rows[i] and anchors[j]."""
    most = float(np.abs(rows).max(initial=0)) * float(np.abs(anchors).max(initial=0)) * max(1, rows.shape[1])
    if len(i) * 20 > len(rows) * len(anchors) and most < 2**52:  # many of all pairs: one product, exact in doubles
        return (rows.astype(np.float64) @ anchors.astype(np.float64).T)[i, j].astype(np.int64)
    out = np.empty(len(i), dtype=np.int64)
    for first in range(0, len(i), 1 << 15):
        s = slice(first, first + (1 << 15))
        out[s] = np.einsum("ij,ij->i", rows[i[s]].astype(np.int64), anchors[j[s]].astype(np.int64))
    return out


class Best:
    """The first ``keep`` (greatest score, then least id) of each of ``n`` lists, fed bit by bit."""

    def __init__(self, n: int, keep: int):
        self.n, self.keep = n, keep
        self.place, self.score, self.id = (np.zeros(0, dtype=np.int64) for _ in range(3))
        #: Score of each list's last entry; the least integer while it isn't full.
        self.last = np.full(n, np.iinfo(np.int64).min)

    def add(self, place: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(place):
            return
        place, score, ids = np.concatenate((self.place, place)), np.concatenate((self.score, score)), np.concatenate((self.id, ids))
        order = np.lexsort((ids, -score, place))
        place, score, ids = place[order], score[order], ids[order]
        new = np.ones(len(place), dtype=bool)  # an id counts once
        new[1:] = (place[1:] != place[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])
        place, score, ids = place[new], score[new], ids[new]
        at = np.arange(len(place)) - np.searchsorted(place, place)
        kept = at < self.keep
        self.place, self.score, self.id = place[kept], score[kept], ids[kept]
        full = at == self.keep - 1
        self.last[place[full]] = score[full]


class Scan:
    """One task's search: rows come in batches, each anchor's lists grow."""

    def __init__(self, quantiser: Quantiser, anchors: dict[str, np.ndarray], keep: int, per_cent: tuple[int, int]):
        self.q, self.a, self.keep, self.per_cent = quantiser, anchors, keep, per_cent
        self.norm = np.nextafter(np.sqrt((anchors["y"].astype(np.float64) ** 2).sum(axis=1)).astype(np.float32), np.float32(np.inf))
        if "tops" in anchors:  # scores of the positives, a list an anchor and positive
            self.tops = anchors["tops"]
            low, whole = per_cent
            self.floors = -((-low * self.tops) // whole)
        self.best = Best(len(anchors["y"]) * (self.tops.shape[1] if "tops" in anchors else 1), keep)

    def positives(self, rows: dict[str, np.ndarray]) -> None:
        """Rows of each label against the anchors of that label."""
        for label in np.unique(rows["label"]):
            mine = np.flatnonzero(rows["label"] == label)
            theirs = np.flatnonzero(self.a["label"] == label)
            for first in range(0, len(theirs), BLOCK):
                at = theirs[first : first + BLOCK]
                score = looked_up(self.q.tables(self.a["y"][at]), rows["codes"][mine])
                bound = rows["bound"][mine][:, None] * self.norm[at]
                least = self.best.last[at].astype(np.float64)
                if len(mine) > self.keep + 1:  # the exact scores of the likeliest rows bound the list from below; one of them may be the anchor
                    top = np.argpartition(-score, self.keep, axis=0)[: self.keep + 1]
                    j = np.tile(np.arange(len(at)), self.keep + 1)
                    sure = exact_scores(rows["y"][mine], self.a["y"][at], top.ravel(), j).reshape(top.shape).min(axis=0)
                    least = np.maximum(least, sure)
                i, j = np.nonzero(score.astype(np.float64) + bound >= least)
                self._add(rows, mine[i], at[j], at[j])

    def _add(self, rows: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray, place: np.ndarray) -> None:
        score = exact_scores(rows["y"], self.a["y"], i, j)
        ids, there = rows["ids"][i], rows["ids_there"][i] & (rows["ids"][i] != self.a["id"][j][:, None])
        k = there.sum(axis=1)
        self.best.add(np.repeat(place, k), np.repeat(score, k), ids[there])

    def negatives(self, rows: dict[str, np.ndarray]) -> None:
        """Rows of other labels, for each positive those whose score lies in its window."""
        windows = self.tops.shape[1]
        for first in range(0, len(self.a["y"]), BLOCK):
            at = np.arange(first, min(first + BLOCK, len(self.a["y"])))
            score = looked_up(self.q.tables(self.a["y"][at]), rows["codes"]).astype(np.float64)
            bound = rows["bound"][:, None] * self.norm[at].astype(np.float64)
            lists = at[:, None] * windows + np.arange(windows)
            least = np.maximum(self.floors[at], self.best.last[lists])
            least[self.a["missing"][at]] = np.iinfo(np.int64).max
            i, j = np.nonzero((score + bound >= least.min(axis=1)) & (score - bound <= self.tops[at].max(axis=1, where=~self.a["missing"][at], initial=-(1 << 62))) & (rows["label"][:, None] != self.a["label"][at]))
            exact = exact_scores(rows["y"], self.a["y"][at], i, j)
            for w in range(windows):
                ok = (exact >= least[j, w]) & (exact <= self.tops[at][j, w])
                ids, there = rows["ids"][i[ok]], rows["ids_there"][i[ok]].copy()
                there[:, self.keep :] = False
                k = there.sum(axis=1)
                self.best.add(np.repeat(lists[j[ok], w], k), np.repeat(exact[ok], k), ids[there])


def _rows_of(batch: pa.RecordBatch, width: int, parts: int, most: int) -> dict[str, np.ndarray]:
    sizes = batch.column("ids").value_lengths().to_numpy(zero_copy_only=False)
    there = np.arange(most) < sizes[:, None]
    ids = np.zeros(there.shape, dtype=np.int64)
    ids[there] = batch.column("ids").flatten().to_numpy()
    return {
        "label": batch.column("label").to_numpy(),
        "codes": unpacked(batch.column("codes"), np.uint8, parts),
        "bound": batch.column("bound").to_numpy(),
        "y": unpacked(batch.column("y"), np.int32, width),
        "ids": ids,
        "ids_there": there,
    }


def hard_negatives(embeddings: DataFrame, keep: int = 5, per_cent: tuple[int, int] = (80, 100), anchors_every: int = 100, relabelled_every: int = 7, labels: int = 10, wave: int = WAVE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Scores are integer inner products of floor(256 * x). Anchors are the rows
    whose id ``anchors_every`` divides; the positives of one are its first
    ``keep`` other rows of its label, by falling score and rising id. For each
    positive score p the first ``keep`` rows of other labels with
    80 * p <= 100 * score <= 100 * p (``per_cent``) are returned, ranked from 1;
    a positive without any gives no row.

    Rows with a null id, label or vector, or with a null or non-finite
    component, take no part. Shorter vectors are filled up with zeros. Where
    ``relabelled_every`` divides the id, the label becomes (label + 1) %
    ``labels`` first. Equal rows are one; an anchor's "other" rows have other
    ids; rows of one id with several vectors or labels are all kept, each an
    anchor of its own. An empty table gives no rows.

    Equal vectors of one label are one row with their ``keep`` + 1 least ids,
    which loses nothing: no list can hold more of them. Every ``wave`` anchors
    (16 MB at 64 dimensions) the coded rows are scanned once, where they lie:
    tasks hand on ``keep`` rows of a list at most. That's the work of a query
    set of a fixed share of all rows against all rows, in blocks.
    """
    spark = embeddings.sparkSession
    scratch = Scratch(spark)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    known = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").alias("vector")).where("vec_id is not null and label is not null")
    label = F.when(F.col("vec_id") % relabelled_every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    known = known.withColumn("label", label)
    width = known.agg(F.max(F.size("vector"))).first()[0]
    if width is None or width < 0:
        return spark.createDataFrame([], schema)
    width = max(1, width)
    most = keep + 1

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, values = sound_vectors(batch.column("vector"), width)
            y = np.clip(np.floor(values * SCALE), -EDGE, EDGE).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(rows)) for c in ("vec_id", "label")] + [packed(y)], names=["vec_id", "label", "y"])

    sound = known.mapInArrow(whole, "vec_id long, label long, y binary")
    # The least ids of each vector: a partial limit runs before the shuffle, so one common vector stays small.
    least = sound.withColumn("at", F.dense_rank().over(Window.partitionBy("label", "y").orderBy("vec_id"))).where(F.col("at") <= most)
    distinct = least.groupBy("label", "y").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    sample = distinct.select("y").orderBy(F.xxhash64("y"), "y").limit(FITTED).collect()
    quantiser = Quantiser(np.frombuffer(b"".join(r.y for r in sample), dtype=np.int32).reshape(len(sample), width), width)
    shared = spark.sparkContext.broadcast(quantiser)  # 256 entries for every two dimensions

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, bound = shared.value.codes(unpacked(batch.column("y"), np.int32, width))
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("y"), batch.column("ids"), packed(codes), pa.array(bound)], names=["label", "y", "ids", "codes", "bound"])

    rows = scratch.save(distinct.mapInArrow(coded, "label long, y binary, ids array<long>, codes binary, bound float"))
    asked = sound.where(F.col("vec_id") % anchors_every == 0).dropDuplicates()
    asked = scratch.save(asked.withColumn("key", F.monotonically_increasing_id()))
    waves = max(1, -(-asked.count() // wave))
    asked = asked.withColumn("wave", F.pmod(F.xxhash64("key"), F.lit(waves)))

    def searched(anchors: DataFrame, windows: int) -> DataFrame:
        """(key, list, score, id): each task's candidates, wave by wave."""
        found = []
        for w in range(waves):
            some = anchors.where(F.col("wave") == w).select("key", "vec_id", "label", "y", *(["tops"] if windows else [])).collect()  # bounded by ``wave``
            if not some:
                continue
            held = {"key": np.array([r.key for r in some]), "id": np.array([r.vec_id for r in some]), "label": np.array([r.label for r in some]), "y": np.frombuffer(b"".join(r.y for r in some), dtype=np.int32).reshape(len(some), width)}
            if windows:
                held["missing"] = np.array([[k >= len(r.tops) for k in range(windows)] for r in some])
                held["tops"] = np.array([[*r.tops, *[0] * (windows - len(r.tops))] for r in some], dtype=np.int64)
            given = spark.sparkContext.broadcast(held)

            def run(batches: Iterator[pa.RecordBatch], given=given) -> Iterator[pa.RecordBatch]:
                scan = Scan(shared.value, given.value, keep, per_cent)
                for batch in batches:
                    if len(batch):
                        (scan.negatives if windows else scan.positives)(_rows_of(batch, width, shared.value.parts, most))
                key, at = np.divmod(scan.best.place, max(1, windows))
                yield pa.RecordBatch.from_arrays([pa.array(given.value["key"][key]), pa.array(at.astype(np.int32)), pa.array(scan.best.score), pa.array(scan.best.id)], names=["key", "list", "score", "id"])

            found.append(scratch.save(rows.mapInArrow(run, "key long, list int, score long, id long")))
            given.destroy()
        found = reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], "key long, list int, score long, id long")
        place = F.row_number().over(Window.partitionBy("key", "list").orderBy(F.desc("score"), "id"))
        return found.dropDuplicates().withColumn("rank", place).where(F.col("rank") <= keep)

    positives = scratch.save(searched(asked, 0))
    tops = positives.groupBy("key").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "score"))), lambda p: p["score"]).alias("tops"))
    negatives = searched(asked.join(tops, "key"), keep)
    pairs = positives.select("key", (F.col("rank") - 1).alias("list"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = negatives.join(pairs, ["key", "list"]).join(asked.select("key", F.col("vec_id").alias("anchor_id")), "key")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
