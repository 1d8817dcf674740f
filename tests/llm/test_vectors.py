"""Whitening and hard negatives against plain exact recomputation."""

import random
from fractions import Fraction
from math import floor, isfinite, sqrt

import numpy as np
import pytest

from lingoloom.llm.negatives import Quantiser, exact_scores, hard_negatives, looked_up
from lingoloom.llm.whitening import eigen, exact_gram, exact_sums, whitened_embeddings

SCHEMA = "vec_id long, embedding array<float>, label int, component string, rank int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA)


def drawn(n, d, seed=1, scale=1.0):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, d)) * scale).astype(np.float32)


def test_limb_products_are_exact():
    rng = random.Random(3)
    for bits in (3, 17, 18, 19, 40, 61):
        rows = [[rng.randrange(-(1 << bits), 1 << bits) for _ in range(3)] for _ in range(50)]
        z = np.array(rows, dtype=np.int64)
        assert exact_gram(z).tolist() == [[sum(r[i] * r[j] for r in rows) for j in range(3)] for i in range(3)]
        assert exact_sums(z).tolist() == [sum(r[i] for r in rows) for i in range(3)]
    assert exact_gram(np.zeros((0, 2), dtype=np.int64)).tolist() == [[0, 0], [0, 0]]


def test_eigenvectors_of_graded_matrices():
    rng = np.random.default_rng(5)
    scales = 10 ** np.linspace(0, 7, 12)
    z = np.rint(rng.normal(size=(400, 12)) * scales * 8).astype(np.int64)
    n, gram, sums = len(z), exact_gram(z), exact_sums(z)
    matrix = [[n * int(gram[i, j]) - int(sums[i]) * int(sums[j]) for j in range(12)] for i in range(12)]
    values, axes = eigen(matrix, n * n)
    assert (np.diff(values) <= 0).all()
    for k in range(12):  # the exact variance along each axis is its eigenvalue
        exact = sum(Fraction(float(axes[i, k])) * matrix[i][j] * Fraction(float(axes[j, k])) for i in range(12) for j in range(12)) / (n * n)
        assert abs(float(exact) / values[k] - 1) < 1e-4 or values[k] < 1e-14 * values[0]
    assert np.abs(axes.T @ axes - np.eye(12)).max() < 1e-14


@pytest.mark.parametrize(("n", "d", "scale"), [(60, 5, 0.1), (40, 40, 3.0), (3, 6, 1.0)])
def test_whitening_equals_plain_recomputation(spark, n, d, scale):
    vectors = drawn(n, d, seed=n, scale=scale)
    vectors[:, 0] += 500  # far from the origin
    rows = [(i, [float(v) for v in x], 1) for i, x in enumerate(vectors)]
    odd = [(900, None, 1), (901, [1.0, None] + [0.0] * (d - 2), 1), (902, [float("nan")] * d, 1), (903, [float("inf")] * d, None)]
    got = whitened_embeddings(table(spark, rows + odd)).collect()
    x = [[floor(64 * Fraction(float(c))) + 1_000_000 for c in v] for v in vectors]
    s = [sum(r[i] for r in x) for i in range(d)]
    centred = [[n * r[i] - s[i] for i in range(d)] for r in x]
    cov = np.array([[float(Fraction(sum(r[i] * r[j] for r in centred), n**3)) for j in range(d)] for i in range(d)])
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    rank = min(32, d, n - 1)
    assert len(got) == n * rank and {r.vec_id for r in got} == set(range(n))
    for r in got:
        k = r.component - 1
        assert r.n == n and r.deviation == sum(v * v for v in centred[r.vec_id])
        plain = float(np.dot(np.array(centred[r.vec_id], dtype=float) / n, axes[:, k])) / sqrt(values[k])
        assert abs(abs(r.whitened) - abs(plain)) < 1e-6
        assert abs(r.explained - values[k] / np.trace(cov)) <= 1e-9 and r.identity_error < 1e-9
    for k in range(1, rank + 1):  # one sign for all rows
        signs = {np.sign(r.whitened * np.dot(np.array(centred[r.vec_id], dtype=float), axes[:, k - 1])) for r in got if r.component == k and abs(r.whitened) > 1e-6}
        assert len(signs) == 1


def test_whitening_of_odd_tables(spark):
    assert whitened_embeddings(table(spark, [])).collect() == []
    assert whitened_embeddings(table(spark, [(1, None, 1), (2, [], 1)])).collect() == []
    assert whitened_embeddings(table(spark, [(1, [1.0, 2.0], 1)] * 3)).collect() == []  # no variance
    rows = [(1, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (None, [3.0], 1), (4, [], None)]  # short ones are filled up
    got = whitened_embeddings(table(spark, rows)).collect()
    assert len(got) == 8 and {r.n for r in got} == {4} and sum(r.vec_id is None for r in got) == 2
    huge = whitened_embeddings(table(spark, [(1, [3e38, 1.0], 1), (2, [-3e38, 2.0], 1), (3, [0.0, 5.0], 1)])).collect()
    assert all(isfinite(r.whitened) for r in huge) and None in {r.deviation for r in huge}


def mined(rows, keep=5):
    """Hard negatives by plain loops over all rows."""
    clean = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(c is None or not isfinite(c) for c in v):
            continue
        clean[(i, (label + 1) % 10 if i % 7 == 0 else label, tuple(floor(256 * float(np.float32(c))) for c in v))] = None
    out = []
    for a, label, v in clean:
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), i, lab) for i, lab, w in clean if i != a)
        same = list(dict.fromkeys((s, i) for s, i, lab in scored if lab == label))[:keep]
        for s, p in same:
            fits = list(dict.fromkeys((t, i) for t, i, lab in scored if lab != label and 80 * -s <= 100 * -t <= 100 * -s))[:keep]
            out += [(a, p, k + 1, i, -s, -t) for k, (t, i) in enumerate(fits)]
    return sorted(out)


def clustered(n, d, seed):
    """Families of near vectors, many equal ones, ids in no order, one vector in a third of the rows."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d))
    rows = []
    for i in rng.permutation(n):
        v = centres[0] if i % 3 == 0 else centres[rng.integers(6)] + rng.normal(size=d) * rng.choice([0, 0.02, 0.5])
        rows.append((int(i), [float(c) for c in (v / np.linalg.norm(v)).astype(np.float32)], int(rng.integers(10))))
    return rows


@pytest.mark.parametrize(("n", "d", "seed"), [(900, 8, 1), (700, 33, 2), (900, 2, 3), (350, 1, 4)])
def test_negatives_equal_plain_loops(spark, n, d, seed):
    rows = clustered(n, d, seed)
    got = hard_negatives(table(spark, rows).repartition(5), wave=3 if seed == 2 else 100).collect()
    assert sorted(map(tuple, got)) == mined(rows) and (got or d == 1)


def test_negatives_of_odd_tables(spark):
    assert hard_negatives(table(spark, [])).collect() == []
    assert hard_negatives(table(spark, [(100, None, 1), (200, [], 1)])).collect() == []
    rows = clustered(300, 4, 9)
    odd = [(None, [1.0] * 4, 1), (1, [1.0] * 4, None), (400, [float("inf")] * 4, 1), (500, [1.0, None, 0.0, 0.0], 1), (600, [1.0], 2), (700, [], 2), (200, [3e38, -3e38, 1.0, 1.0], 3), *rows[:20], rows[0], (rows[0][0], [0.5] * 4, 1), (-100, [0.5] * 4, 1)]
    plain = [(i, v if v is None else [min(max(c, -(2.0**18)), 2.0**18) if c is not None and isfinite(c) else c for c in v] + [0.0] * (4 - len(v)), label) for i, v, label in rows + odd]
    assert sorted(map(tuple, hard_negatives(table(spark, rows + odd).repartition(3)).collect())) == mined(plain)


def test_code_bounds_hold():
    rng = np.random.default_rng(6)
    for scale in (1, 200, 1 << 25):
        rows = np.rint(rng.normal(size=(400, 7)) * scale).clip(-(1 << 26), 1 << 26).astype(np.int32)
        q = Quantiser(rows[:40], 7)
        codes, bound = q.codes(rows)
        score = looked_up(q.tables(rows), codes).astype(np.float64)
        exact = rows.astype(object) @ rows.T.astype(object)
        room = bound[:, None].astype(np.float64) * np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1))
        assert (np.abs(score - exact.astype(np.float64)) <= room * (1 + 1e-6)).all()
        i, j = map(np.ravel, np.indices((400, 400)))
        assert (exact_scores(rows, rows, i, j) == exact[i, j]).all() and (exact_scores(rows, rows, i[:9], j[:9]) == exact[i[:9], j[:9]]).all()
