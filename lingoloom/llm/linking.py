"""Candidates from MinHash buckets and sorted orders, exact verification and connected components.

All three work on tables of numeric ids. No step collects a bucket, a group of
copies or a component in one task: signatures are dealt by range, crowded
regions are indexed again at a greater depth, what stays crowded is compared in
blocks, and components are found by joins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingoloom.operators.ranges import join_split

from .hashing import MinHash, mix
from .scratch import Scratch

#: Members of a region that are all compared with each other; a region with more is crowded.
SMALL = 32
#: Edges that may meet in one task, edges that a task writes.
HUBS, EDGES = 1_000_000, 50_000
#: Pairs that a crowded region may take to be compared in full; one that takes more is indexed deeper.
FULL = 1 << 20
#: Trees and values a tree for what is crowded, level by level: recall 0.9999 and 0.9998 at a similarity of 0.8.
DEEPER = ((24, 5), (64, 9))
#: Tables up to this many bytes are broadcast to filter a table where it lies; larger ones are joined by a shuffle.
BROADCAST_BYTES = 32 << 20
#: Rows and length of bodies of one side of a block in which a crowded region is compared, about.
CHUNK, CHUNK_LENGTH = 1024, 1 << 23
#: Occurrences of shared members that a block looks at in one go.
POSTINGS = 1 << 21

#: Length of the bodies of small blocks that are compared together, about.
TOGETHER = 1 << 20
#: Rows from which a small block is compared as a matrix; members in a part of it.
DENSE, INCIDENCE = 6, 1 << 16

#: Hashes of the members of all bodies, a body's own one after another, and where each body's begin; a member may repeat.
Unpack = Callable[[list], tuple[np.ndarray, np.ndarray]]


def fetch(table: DataFrame, needed: DataFrame, on: str, width: Column | int) -> DataFrame:
    """Rows of ``table`` whose ``on`` occurs in ``needed`` (distinct, a saved table), with the columns of both; ``width`` is the size of a row of ``needed`` in bytes."""
    size = needed.agg(F.sum(width if isinstance(width, Column) else F.lit(width))).first()[0] or 0
    return table.join(F.broadcast(needed) if size <= BROADCAST_BYTES else needed, on)


def to_rows(column: pa.Array, dtype: type) -> np.ndarray:
    """(n, k) numbers of a binary column whose values all have one length."""
    _, offsets, data = column.buffers()
    first, second = np.frombuffer(offsets, dtype=np.int32)[column.offset : column.offset + 2]
    width = second - first
    return np.frombuffer(data, dtype=np.uint8)[first : first + width * len(column)].view(dtype).reshape(len(column), -1)


#: Schemas of index rows: the region (tree and first values of a signature), where wanted the values that follow as order in it, the id.
BANDS, FOREST = "region long, id long", "region long, deep long, id long"


def index_rows(place: Callable[[np.ndarray], tuple[np.ndarray, ...]], dtype: type) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From (id, signature): one index row for each column that ``place`` makes of the signatures' numbers, (n, trees) regions and, for a forest, orders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _index_batch(batch.column("id"), *place(to_rows(batch.column("signature"), dtype)))

    return run


def _index_batch(ids: pa.Array, *numbers: np.ndarray) -> pa.RecordBatch:
    own = np.repeat(ids.to_numpy(zero_copy_only=False), numbers[0].shape[1])
    return pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(x).view(np.int64).ravel()) for x in numbers), pa.array(own)], names=["region", "deep", "id"] if len(numbers) == 2 else ["region", "id"])


def _deeper_rows(trees: int, depth: int, seed: int, unpack: Unpack) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From (id, body): an index row for each of ``trees`` trees, whose region is 64 bits of ``depth`` new minima, ordered by two more."""
    minima = MinHash(trees * depth, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                values = minima(*unpack(part.column("body").to_pylist())).reshape(part.num_rows, trees, depth).astype(np.uint64)
                region = np.tile(np.arange(trees, dtype=np.uint64), (part.num_rows, 1))
                for k in range(depth):
                    region = mix(region * np.uint64(31) + values[:, :, k])
                further = np.roll(values, -1, axis=1)
                yield _index_batch(part.column("id"), region, (further[:, :, 0] << np.uint64(31)) | (further[:, :, 1] >> np.uint64(1)))

    return run


GROUP, CROWDED, BORDER = 0, 1, 2


def _regions(cut: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From sorted (region, deep, id): groups of rows to compare, the rows of crowded regions, and, where a partition may ``cut`` a region, the rows of its first and last one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, ids, first = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), cut
        for batch in chain(batches, [None]):
            if batch is not None and batch.num_rows:
                path = np.concatenate([path, batch.column("region").to_numpy(zero_copy_only=False)])
                ids = np.concatenate([ids, batch.column("id").to_numpy(zero_copy_only=False)])
            if not len(ids):
                continue
            last = batch is None
            starts = np.concatenate(([0], np.flatnonzero(path[1:] != path[:-1]) + 1))
            sizes = np.diff(np.append(starts, len(ids)))
            closed, crowded, edge = np.ones(len(starts), dtype=bool), sizes > SMALL, np.zeros(len(starts), dtype=bool)
            closed[-1], edge[0], edge[-1] = last, first, cut and last or first and len(starts) == 1
            named = mix(ids.astype(np.uint64)).astype(np.uint64)
            group, member, marked = [], [], []

            plain = closed & ~crowded & ~edge & (sizes > 1)
            rows = np.repeat(plain, sizes)
            group.append(np.repeat(np.add.reduceat(named, starts)[plain], sizes[plain]))
            member.append(np.flatnonzero(rows))
            for a, b in zip(starts[crowded], (starts + sizes)[crowded], strict=True):
                for k in range(a, b - 1, SMALL):  # neighbours in the sorted order share the longest prefixes
                    some = np.arange(k, min(k + SMALL + 1, b))
                    group.append(np.full(len(some), named[some].sum(dtype=np.uint64)))
                    member.append(some)
            member = np.concatenate(member)
            marked.append((GROUP, None, np.concatenate(group), member))
            marked.append((CROWDED, np.flatnonzero(np.repeat(crowded, sizes)), None, None))
            ends = np.flatnonzero(edge & (closed | crowded))
            marked.append((BORDER, np.concatenate([np.arange(starts[k], starts[k] + min(sizes[k], SMALL + 1)) for k in ends] or [np.zeros(0, dtype=np.int64)]), None, None))
            for kind, at, key, some in marked:
                n = len(some if at is None else at)
                if n:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, kind, dtype=np.int32)), pa.nulls(n, pa.int64()) if at is None else pa.array(path[at]), pa.nulls(n, pa.int64()) if key is None else pa.array(key.view(np.int64)), pa.array(ids[some if at is None else at])],
                        names=["kind", "region", "group", "id"],
                    )
            first &= len(starts) == 1
            keep = len(ids) if last else max(starts[-1], len(ids) - SMALL - 1)
            path, ids = path[keep:], ids[keep:]

    return run


def regions(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Groups (group, id) and crowded rows (region, id) of the index ``rows`` (BANDS or FOREST).

    Rows are dealt by range over all their columns, so a crowded region is cut instead
    of landing in one task. A region of up to SMALL members is a group; in a
    larger one, which is crowded, every SMALL neighbours in the sorted order
    are. A region that a partition's border cuts is put together in a second
    pass, from SMALL + 1 rows a side. Groups with the same members are one.
    """
    order, schema = rows.columns, "kind int, region long, group long, id long"
    found = scratch.save(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_regions(True), schema))
    borders = found.where(f"kind = {BORDER}").select("region", "id").distinct()
    across = scratch.save(borders.repartition("region").sortWithinPartitions("region", "id").mapInArrow(_regions(False), schema))
    rows = found.unionByName(across).where(f"kind <> {BORDER}")
    once = scratch.save(rows.select("kind", F.coalesce("group", "region").alias("key"), "id").distinct())
    scratch.drop(found, across)
    return once.where(f"kind = {GROUP}").select(F.col("key").alias("group"), "id"), once.where(f"kind = {CROWDED}").select(F.col("key").alias("region"), "id")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, root) for every id in ``edges`` (a, b): root is the smallest id of its connected component.

    Alternates large-star and small-star steps until all edges point from an id
    to its root: about log(n) rounds whatever the shape of the graph, each a
    few joins. Of more than HUBS edges, ids with a thousandth of all are joined
    by a broadcast, not in one task.
    """
    now = scratch.save(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").coalesce(1 + edges.count() // EDGES))
    while True:
        ends = now.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(now.select(F.col("v").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        if ends.groupBy("u").agg(F.sum("up").alias("up"), F.sum("down").alias("down")).where("up > 1 or (up > 0 and down > 0)").isEmpty():
            return now.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
        n = now.count()
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), (F.count("*") * 1000 > n).alias("frequent"))
        wider = both.where("v > u")
        met = join_split(wider, least, "u") if n > HUBS else wider.join(least, "u")
        large = met.select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        after = scratch.save(small.coalesce(1 + n // EDGES))  # what the last exchange dealt out, of about EDGES edges a task
        scratch.drop(now)
        now = after


class _Forest:
    """Components of the links that one task finds, so that it hands on one edge for each merger."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = parent[x]
        return x

    def link(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)

    def edges(self) -> pa.RecordBatch:
        found = [(self.find(x), x) for x in list(self.parent)]
        found = [e for e in found if e[0] != e[1]]
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"])


def _flat_links(roots: np.ndarray, groups: np.ndarray, hashes: np.ndarray, at: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Roots (x, y) that links inside many small groups join, one link for each merger.

    Rows come group by group (``groups`` counts from 0), ``hashes[at[i]:at[i + 1]]``
    are row i's members. All sets are sorted together as numbers of (group,
    member, row), so equal members of a group stand side by side; a member is
    the hash's lowest 64 - 6 - bits(groups) bits.
    """
    n = len(roots)
    first = np.concatenate(([0], np.flatnonzero(np.diff(groups)) + 1))
    many = np.diff(np.append(first, n))
    row = np.arange(n) - np.repeat(first, many)
    bits = np.uint64(int(groups[-1]).bit_length())
    owner = (groups.astype(np.uint64) << (np.uint64(64) - bits)) if bits else np.zeros(n, dtype=np.uint64)
    keys = np.sort(np.repeat(owner | row.astype(np.uint64), np.diff(at)) | (hashes << (np.uint64(6) + bits) >> bits))
    keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))]
    group = (keys >> (np.uint64(64) - bits)).astype(np.int64) if bits else np.zeros(len(keys), dtype=np.int64)
    own = (keys & np.uint64(63)).astype(np.int64)
    sizes = np.bincount(first[group] + own, minlength=n)
    members = keys >> np.uint64(6)
    # a cell for each pair of rows of a group
    cells = np.concatenate(([0], np.cumsum(many * many)))
    cell = cells[group] + own * many[group]
    common = np.zeros(cells[-1], dtype=np.int64)
    some = np.flatnonzero(many[group] < DENSE)  # rows of small groups, pair by pair
    lone, mine, places = members[some], own[some], cell[some]
    same, step = np.flatnonzero(lone[1:] == lone[:-1]), 1
    while len(same):
        common += np.bincount(places[same] + mine[same + step], minlength=len(common))
        step += 1
        same = same[same + step < len(lone)]
        same = same[lone[same + step] == lone[same]]
    for g in np.flatnonzero(many >= DENSE):  # larger ones as products of their members' incidence
        a, b = np.searchsorted(group, [g, g + 1])
        line = np.concatenate(([0], np.cumsum(members[a + 1 : b] != members[a : b - 1])))
        shared = np.zeros((many[g], many[g]), dtype=np.int64)
        for low in range(0, line[-1] + 1, INCIDENCE):
            c, d = a + np.searchsorted(line, [low, low + INCIDENCE])
            x = np.zeros((line[d - 1 - a] + 1 - low, many[g]), dtype=np.float32)
            x[line[c - a : d - a] - low, own[c:d]] = 1
            shared += (x.T @ x).astype(np.int64)
        common[cells[g] : cells[g + 1]] = np.triu(shared, 1).ravel()
    hit = np.flatnonzero(common)
    of = np.searchsorted(cells, hit, side="right") - 1
    x, y = first[of] + (hit - cells[of]) // many[of], first[of] + (hit - cells[of]) % many[of]
    linked = 100 * common[hit] >= percent * (sizes[x] + sizes[y] - common[hit])
    x, y = x[linked], y[linked]
    label = np.arange(n)
    while True:  # a group's components are found in a few rounds
        low = np.minimum(label[x], label[y])
        after = label.copy()
        np.minimum.at(after, x, low)
        np.minimum.at(after, y, low)
        after = after[after]
        if (after == label).all():
            break
        label = after
    p, q = roots, roots[label]
    crossing = p != q
    return np.minimum(p, q)[crossing], np.maximum(p, q)[crossing]


def _block_links(roots: np.ndarray, left: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Roots (x, y) that links between rows on the left and any others join, one link for each merger."""
    sizes = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
    at = np.concatenate(([0], np.cumsum(sizes)))
    _, member, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    starts = np.cumsum(counts) - counts
    rows = np.repeat(np.arange(len(sets)), sizes)[np.argsort(member, kind="stable")]
    own = np.unique(roots, return_inverse=True)[1]
    out = []
    for i in np.flatnonzero(left):
        mine = member[at[i] : at[i + 1]]
        mine = mine[counts[mine] > 1]
        if not len(mine) or (own == own[i]).all():
            continue
        ends = np.cumsum(counts[mine])
        common = np.zeros(len(sets), dtype=np.int64)
        cuts = np.unique(np.concatenate((np.searchsorted(ends, np.arange(POSTINGS, ends[-1], POSTINGS)), [len(mine)])))
        for a, b in zip(np.concatenate(([0], cuts[:-1])), cuts, strict=True):
            n = counts[mine[a:b]]
            places = np.repeat(starts[mine[a:b]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            common += np.bincount(rows[places], minlength=len(sets))
        hits = np.flatnonzero((100 * common >= percent * (sizes[i] + sizes - common)) & (own != own[i]))
        while len(hits):
            out.append((min(roots[i], roots[hits[0]]), max(roots[i], roots[hits[0]])))
            own[own == own[hits[0]]] = own[i]
            hits = hits[own[hits] != own[i]]
    return out


def _blocks(percent: int, unpack: Unpack) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From rows (block, root, left, body) sorted by block: the links of all blocks. Small blocks of left rows only are compared many at a time."""

    def large(rows: list[tuple]) -> list[tuple[int, int]]:
        hashes, at = unpack([r[3] for r in rows])
        sets = [np.unique(hashes[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
        return _block_links(np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), sets, percent)

    def small(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        hashes, at = unpack([r[3] for r in rows])
        block = np.array([r[0] for r in rows])
        groups = np.concatenate(([0], np.cumsum(block[1:] != block[:-1])))
        return zip(*(x.tolist() for x in _flat_links(np.array([r[1] for r in rows]), groups, hashes, at, percent)), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((r["block"], r["root"], r["left"], r["body"]) for batch in batches for r in batch.to_pylist())
        forest, held, length = _Forest(), [], 0
        for _, block in groupby(rows, itemgetter(0)):
            block = list(block)
            if len(block) > SMALL + 1 or not all(r[2] for r in block):
                for a, b in large(block):
                    forest.link(int(a), int(b))
                continue
            if len({r[1] for r in block}) < 2:
                continue
            held += block
            length += sum(len(r[3]) for r in block)
            if length >= TOGETHER:
                for a, b in small(held):
                    forest.link(a, b)
                held, length = [], 0
        if held:
            for a, b in small(held):
                forest.link(a, b)
        yield forest.edges()

    return run


def _compared(blocks: DataFrame, sets: DataFrame, percent: int, scratch: Scratch, unpack: Unpack) -> DataFrame:
    """Pairs (a, b) of roots that links inside ``blocks`` (block, id, root, left) join."""
    full = blocks.join(sets, "id").select("block", "root", "left", "body").repartition("block").sortWithinPartitions("block")
    return scratch.save(full.mapInArrow(_blocks(percent, unpack), "a long, b long"))


def _group_links(groups: DataFrame, roots: DataFrame | None, sets: DataFrame, percent: int, scratch: Scratch, unpack: Unpack) -> DataFrame:
    """Pairs (a, b) of roots that links inside ``groups`` (group, id) join; groups of one root have none."""
    rows = groups.withColumn("root", F.col("id"))
    if roots is not None:
        rows = scratch.save(groups.join(roots, "id", "left").select("group", "id", F.coalesce("root", "id").alias("root")))
        several = rows.groupBy("group").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("group")
        rows = rows.join(several, "group")
    return _compared(rows.select(F.col("group").alias("block"), "id", "root", F.lit(True).alias("left")), sets, percent, scratch, unpack)


def _live(crowded: DataFrame, roots: DataFrame, scratch: Scratch) -> DataFrame:
    """(region, cost, id, root) of the crowded regions that hold several roots; of regions with the same members one.

    cost is how many pairs a comparison of all that its most frequent root
    doesn't join already takes. The members of the greatest component are left
    out of all regions that hold nobody else, before any other is looked at.
    """
    sizes = roots.groupBy("root").agg(F.count("*").alias("n"))
    giant = roots.join(F.broadcast(sizes.orderBy(F.desc("n"), "root").limit(1).select("root")), "root", "left_semi").select("id")
    others = crowded.join(giant, "id", "left_anti").select("region").distinct()
    rows = scratch.save(crowded.join(others, "region").join(roots, "id", "left").select("region", "id", F.coalesce("root", "id").alias("root")))
    per = rows.groupBy("region", "root").agg(F.count("*").alias("n"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("members"))
    per = per.groupBy("region").agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.sum("members").alias("members")).where("n > most")
    per = per.groupBy("n", "most", "members").agg(F.min("region").alias("region")).select("region", ((F.col("n") - F.col("most")) * F.col("n")).alias("cost"))
    out = scratch.save(rows.join(per, "region").select("region", "cost", "id", "root"))
    scratch.drop(rows)
    return out


def _full_links(live: DataFrame, sets: DataFrame, percent: int, scratch: Scratch, unpack: Unpack) -> DataFrame:
    """Pairs (a, b) of roots that links inside the regions of ``live`` (region, cost, id, root) join.

    A region is compared in full, on full sets, but for what its most frequent
    root already joins: its other rows among themselves and with that root's,
    in blocks of about two CHUNKs. A link found makes one component of two, so
    a block gives fewer links than it has rows.
    """
    rows = scratch.save(live.drop("cost").join(sets.select("id", F.length("body").alias("length")), "id"))
    per = rows.groupBy("region", "root").agg(F.count("*").alias("n"), F.sum("length").alias("length"))
    per = per.groupBy("region").agg(F.max(F.struct("n", "root", "length")).alias("major"), F.sum("n").alias("n"), F.sum("length").alias("length"))
    chunks = lambda n, length: F.ceil(F.greatest(n / CHUNK, length / CHUNK_LENGTH, F.lit(1))).cast("int")
    per = per.select("region", F.col("major.root").alias("major"), chunks(F.col("n") - F.col("major.n"), F.col("length") - F.col("major.length")).alias("minors"), chunks(F.col("major.n"), F.col("major.length")).alias("majors"))
    dealt = rows.join(per, "region").withColumn("left", F.col("root") != F.col("major"))
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("id"), F.when(F.col("left"), F.col("minors")).otherwise(F.col("majors"))).cast("int"))
    block = lambda p, q, kind: F.xxhash64("region", p, q, F.lit(kind))
    among = F.transform(F.sequence(F.lit(0), F.col("minors") - 1), lambda j: block(F.least("chunk", j), F.greatest("chunk", j), 0))
    beyond = F.transform(F.sequence(F.lit(0), F.col("majors") - 1), lambda j: block(F.col("chunk"), j, 1))
    onto = F.transform(F.sequence(F.lit(0), F.col("minors") - 1), lambda j: block(j, F.col("chunk"), 1))
    dealt = dealt.select("id", "root", "left", F.explode(F.when(F.col("left"), F.concat(among, beyond)).otherwise(onto)).alias("block"))
    out = _compared(dealt, sets, percent, scratch, unpack)
    scratch.drop(rows)
    return out


def _joined(ids: DataFrame | None, links: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, root) after ``links`` (a, b) between roots of ``ids`` (id, root), or ids that aren't in it, are added."""
    more = scratch.save(components(links, scratch))
    if ids is None:
        return more
    ids = ids.unionByName(more.select("id", F.col("id").alias("root"))).groupBy("id").agg(F.min("root").alias("root"))
    onward = more.select(F.col("id").alias("root"), F.col("root").alias("last"))
    out = scratch.save(ids.join(onward, "root", "left").select("id", F.coalesce("last", "root").alias("root")))
    scratch.drop(more)
    return out


def linked(groups: DataFrame, crowded: DataFrame, sets: DataFrame, percent: int, scratch: Scratch, unpack: Unpack) -> DataFrame:
    """(id, root) of the components that links within ``groups`` (group, id) and within the regions of ``crowded`` (region, id) form; ids without a link are left out.

    ``sets`` has (id, body) of all their ids; ``unpack`` makes
    hashes of bodies. Two rows are linked when 100 * |A & B| >= percent * |A | B|.

    Groups are compared in full, and so are crowded regions that hold several
    components afterwards, where that takes up to FULL pairs: every pair that
    one component holds already needs no comparison. The rows of others are
    indexed again by more and longer prefixes of new minima, level by level.
    What is crowded on the last level is compared in full, in blocks.
    """
    roots = _joined(None, _group_links(groups, None, sets, percent, scratch, unpack), scratch)
    for level, (trees, depth) in enumerate((*DEEPER, (0, 0))):
        live = _live(crowded, roots, scratch)
        few = live.where(F.col("cost") <= FULL) if trees else live
        if not few.isEmpty():
            roots = _joined(roots, _full_links(few, sets, percent, scratch, unpack), scratch)
        many = live.where(F.col("cost") > FULL).select("region", "id")
        if not trees or many.isEmpty():
            return roots
        rows = sets.join(_live(many, roots, scratch).select("id").distinct(), "id").mapInArrow(_deeper_rows(trees, depth, 100 + level, unpack), FOREST)
        groups, crowded = regions(rows, scratch)
        roots = _joined(roots, _group_links(groups, roots, sets, percent, scratch, unpack), scratch)
    return roots
