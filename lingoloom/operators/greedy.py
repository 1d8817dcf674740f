"""Greedy choice with diminishing returns over a distributed table, block by block.

Gains only shrink while sentences are chosen, so a gain computed earlier is an
upper bound of the present one. Each round the tasks compute all gains against
what has been chosen; the best rows, a bounded block, are fetched and chosen
from, lazily and exactly, as long as the best of them stays above every bound
outside the block. Then the next round begins. The choice is that of a plain
greedy loop over all rows, whatever the block's size: every gain is summed up
in one order, and ties fall to the least sort key.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .kept import Kept

#: Rows of a block, classes of gains within a factor of e, the class of rows without gain.
BLOCK, CLASSES = 8192, 512
#: Rows that are handed to Python at once: a row of a long sentence has tens of kilobytes; with 10,000 rows the JVM crashed at sf0.1 (why was not found out).
BATCH = 500
_NOTHING = -(1 << 30)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(ids, coefs, counts) arrays as bytes, which go to and fro as they are."""
    for batch in batches:
        columns = {c: batch.column(c) for c in batch.schema.names}
        for name, kind in (("ids", "<i8"), ("coefs", "<f8"), ("counts", "<i8")):
            column = columns[name]
            ends = np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)) * 8
            raw = column.flatten().to_numpy(zero_copy_only=False).astype(kind).tobytes()
            columns[name] = pa.array([raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if len(ends) else [], pa.binary())
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _sums(terms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sum of each run of terms, always added up in the same order."""
    out = np.zeros(len(sizes))
    some = sizes > 0
    if some.any():
        out[some] = np.add.reduceat(terms, (np.cumsum(sizes) - sizes)[some])
    return out


class Chosen:
    """What the choice so far has worn: features with their counts, sources, texts. As large as what is chosen."""

    def __init__(self, penalty: float):
        self.penalty = penalty
        self.names, self.used = np.zeros(0, dtype=np.int64), np.zeros(0)
        self.sources: dict[str | None, int] = {}
        self.texts: set[str | None] = set()
        self.rows: set[int] = set()

    def times(self, ids: np.ndarray) -> np.ndarray:
        """How often each feature has been chosen."""
        if not len(self.names):
            return np.zeros(len(ids))
        at = np.minimum(np.searchsorted(self.names, ids), len(self.names) - 1)
        return np.where(self.names[at] == ids, self.used[at], 0.0)

    def wear(self, names: np.ndarray, used: np.ndarray) -> None:
        """Sets the counts of features, which are sorted and distinct."""
        rest = ~np.isin(self.names, names)
        names, used = np.concatenate((self.names[rest], names)), np.concatenate((self.used[rest], used))
        order = np.argsort(names)
        self.names, self.used = names[order], used[order]

    def share(self, source: str | None) -> float:
        return 1 + self.penalty * self.sources.get(source, 0)

    def gains(self, ids: np.ndarray, coefs: np.ndarray, sizes: np.ndarray, sources: list[str | None]) -> np.ndarray:
        return _sums(coefs / np.sqrt(1 + self.times(ids)), sizes) / np.array([self.share(s) for s in sources])


def _choose(block: list, limit: tuple[float, str] | None, room: int, state: Chosen) -> list[tuple[str, float]]:
    """(key, gain) of up to ``room`` rows of a block, best first, as long as no row outside it can be better.

    ``limit`` is (gain, sort key) of the best row outside, None without one.
    """
    rows = [(np.frombuffer(r.ids, "<i8"), np.frombuffer(r.coefs, "<f8"), np.frombuffer(r.counts, "<i8")) for r in block]
    names, flat = np.unique(np.concatenate([ids for ids, _, _ in rows]), return_inverse=True)
    at = np.concatenate(([0], np.cumsum([len(ids) for ids, _, _ in rows])))
    used = state.times(names)
    worn = np.sqrt(1 + used)
    heap = [(-r.gain, r.sort_key, i) for i, r in enumerate(block)]
    heapq.heapify(heap)
    out: list[tuple[str, float]] = []
    while heap and len(out) < room:
        bound, key, i = heapq.heappop(heap)
        if limit and (bound, key) > (-limit[0], limit[1]):
            break
        row, mine = block[i], flat[at[i] : at[i + 1]]
        if row.text_key in state.texts:
            continue
        now = float(_sums(rows[i][1] / worn[mine], np.array([len(mine)]))[0] / state.share(row.source))
        if -now > bound:  # less than the bound: back in line
            heapq.heappush(heap, (-now, key, i))
            continue
        out.append((row.key, now))
        state.rows.add(row.nth)
        state.texts.add(row.text_key)
        state.sources[row.source] = state.sources.get(row.source, 0) + 1
        used[mine] += rows[i][2]
        worn[mine] = np.sqrt(1 + used[mine])
    state.wear(names, used)
    return out


@contextmanager
def _batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most so many rows, until the end of the block."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def greedy_choice(items: DataFrame, quotas: list[tuple[int, int]], source_penalty: float, block: int = BLOCK) -> list[tuple[str, int, float]]:
    """(key, rank, gain) chosen from items (key, source, text_key, sort_key, letters, ids, coefs, counts).

    ``ids``, ``coefs`` and ``counts`` are arrays of one length, ids distinct;
    a row's gain is the sum of coef / sqrt(1 + times the id was chosen),
    divided by 1 + source_penalty * rows chosen of its source. For each (least
    letters, quota) rows with that many letters are chosen until ``quota`` are
    in all. A text is chosen once. Rows without ids have no gain and come
    last. Sort keys must be distinct and not null.

    The items are written once; a round reads them once and hands on one
    narrow row each, of which tasks keep counts by class. The driver holds a
    block and what has been chosen.
    """
    state, out = Chosen(source_penalty), []
    with _batches(items.sparkSession, BATCH), Kept() as kept:
        schema = "key string, source string, text_key string, sort_key string, letters long, ids binary, coefs binary, counts binary"
        typed = items.select(*[F.col(c).cast("string").alias(c) for c in ("key", "source", "text_key", "sort_key")], F.coalesce(F.col("letters"), F.lit(0)).cast("long").alias("letters"), *[F.coalesce(F.col(c), F.array()).cast(f"array<{kind}>").alias(c) for c, kind in (("ids", "long"), ("coefs", "double"), ("counts", "long"))])
        packed = kept(typed.mapInArrow(_packed, schema).withColumn("nth", F.monotonically_increasing_id()))
        for least, quota in quotas:
            eligible = packed.where(F.col("letters") >= least)
            while len(out) < quota:
                taken = _round(eligible, state, quota - len(out), block)
                if taken is None:
                    break
                out += taken
    return [(key, rank, gain) for rank, (key, gain) in enumerate(out, 1)]


def _round(eligible: DataFrame, state: Chosen, room: int, block: int) -> list[tuple[str, float]] | None:
    """The rows that one block yields; None where nothing is left."""
    spark = eligible.sparkSession
    given = spark.sparkContext.broadcast(vars(state))  # as large as what is chosen; a plain dict needs no module where it is read

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Chosen(0)
        vars(state).update(given.value)
        for batch in batches:
            texts, nth = batch.column("text_key").to_pylist(), batch.column("nth").to_pylist()
            free = [i for i, (t, k) in enumerate(zip(texts, nth, strict=True)) if t not in state.texts and k not in state.rows]
            batch = batch.take(pa.array(free, pa.int64()))
            ids, coefs = batch.column("ids").to_pylist(), b"".join(batch.column("coefs").to_pylist())
            sizes = np.array([len(x) // 8 for x in ids], dtype=np.int64)
            gain = state.gains(np.frombuffer(b"".join(ids), "<i8"), np.frombuffer(coefs, "<f8"), sizes, batch.column("source").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("nth"), batch.column("sort_key"), pa.array(gain)], names=["nth", "sort_key", "gain"])

    with Kept() as kept:
        gains = kept(eligible.select("nth", "sort_key", "text_key", "source", "ids", "coefs").mapInArrow(run, "nth long, sort_key string, gain double"))
        # classes of about equal gains, best first; rows that are worth nothing are one class
        cls = F.when(F.col("gain") > 0, F.floor(F.log("gain") * CLASSES).cast("int")).otherwise(_NOTHING)
        classes = sorted(((r.cls, r.n, r.most) for r in gains.groupBy(cls.alias("cls")).agg(F.count("*").alias("n"), F.max("gain").alias("most")).collect()), reverse=True)
        if not classes:
            return None
        wanted, held = 1, classes[0][1]
        while wanted < len(classes) and held + classes[wanted][1] <= block:
            held += classes[wanted][1]
            wanted += 1
        best = gains.where(cls >= classes[wanted - 1][0])
        limit = (classes[wanted][2], "") if wanted < len(classes) else None
        if held > block:  # one class alone is larger: its first rows
            *first, other = best.orderBy(F.desc("gain"), "sort_key").limit(block + 1).collect()
            best = spark.createDataFrame([(r.nth, r.gain) for r in first], "nth long, gain double")
            limit = (other.gain, other.sort_key)
        rows = eligible.join(F.broadcast(best.select("nth", "gain")), "nth").collect()  # ``block`` rows at most
    given.destroy()
    return _choose(rows, limit, room, state)
