"""Comparing groups and cutting regions, against plain enumeration."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
from test_dedup import _components

from lingoloom.llm.linking import BORDER, CROWDED, GROUP, SMALL, _flat_links, _regions


def test_flat_links_match_enumeration():
    draw = random.Random(7)
    for percent in (50, 80):
        sets, groups, roots = [], [], []
        for g in range(40):
            base = [draw.getrandbits(64) for _ in range(draw.randint(1, 40))]
            for _ in range(draw.randint(2, SMALL + 1)):
                own = [x if draw.random() > draw.choice([0.02, 0.2]) else draw.getrandbits(64) for x in base]
                sets.append(own + draw.choices(own, k=3))  # members may repeat
                groups.append(g)
                roots.append(1000 * g + draw.randrange(30))
        at = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
        x, y = _flat_links(np.array(roots), np.array(groups), np.array([h for s in sets for h in s], dtype=np.uint64), at, percent)
        whole = [set(s) for s in sets]
        links = [(roots[i], roots[j]) for i, j in combinations(range(len(sets)), 2) if groups[i] == groups[j] and 100 * len(whole[i] & whole[j]) >= percent * len(whole[i] | whole[j])]
        assert _components(set(roots), zip(x.tolist(), y.tolist(), strict=True)) == _components(set(roots), links)
        assert len(x) < len(roots)


def _cut(rows, cuts, size):
    """Rows (region, id) dealt into partitions at ``cuts``, read in batches of ``size``."""
    out = []
    for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True):
        part = rows[a:b]
        batches = [pa.RecordBatch.from_arrays([pa.array([r for r, _ in part[k : k + size]], pa.int64()), pa.array([i for _, i in part[k : k + size]], pa.int64())], names=["region", "id"]) for k in range(0, len(part), size)]
        for batch in _regions(True)(iter(batches)):
            out += zip(*(c.to_pylist() for c in batch.columns), strict=True)
    return out


def test_regions_are_whole_however_partitions_and_batches_cut_them():
    draw = random.Random(5)
    for _ in range(60):
        sizes = [draw.choice([1, 1, 2, 3, SMALL, SMALL + 1, 100]) for _ in range(12)]
        rows = [(g, 1000 * g + k) for g, n in enumerate(sizes) for k in range(n)]
        cuts = sorted(draw.sample(range(1, len(rows)), 3))
        found = _cut(rows, cuts, draw.choice([1, 7, 50, 1000]))
        borders = sorted({(r, i) for kind, r, _, i in found if kind == BORDER})
        (second,) = [list(_regions(False)(iter([pa.RecordBatch.from_arrays([pa.array([r for r, _ in borders], pa.int64()), pa.array([i for _, i in borders], pa.int64())], names=["region", "id"])])))]
        for batch in second:
            found += zip(*(c.to_pylist() for c in batch.columns), strict=True)
        groups = {}
        for kind, _, g, i in found:
            if kind == GROUP:
                groups.setdefault(g, set()).add(i)
        crowded = {(r, i) for kind, r, _, i in found if kind == CROWDED}
        for g, n in enumerate(sizes):
            ids = {1000 * g + k for k in range(n)}
            if 1 < n <= SMALL:
                assert ids in groups.values()
            if n > SMALL:
                assert all((g, i) in crowded for i in ids)
            if n <= SMALL:
                assert not any(r == g for r, _ in crowded)
        assert all(len(s) <= SMALL + 1 for s in groups.values())
