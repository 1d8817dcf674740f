"""The block-wise greedy choice against a plain loop over all rows."""

import random

import pytest

from lingoloom.operators.greedy import greedy_choice

SCHEMA = "key string, source string, text_key string, sort_key string, letters int, ids array<long>, coefs array<double>, counts array<long>, nth string"


def plain(rows, quotas, penalty):
    used, sources, texts, out = {}, {}, set(), []
    left = {r[0]: r for r in rows}
    for least, quota in quotas:
        while len(out) < quota:
            best = None
            for key, source, text, order, letters, ids, coefs, _, _ in left.values():
                if (letters or 0) < least or text in texts:
                    continue
                gain = sum(c / (1 + used.get(i, 0)) ** 0.5 for i, c in zip(ids or [], coefs or [], strict=True)) / (1 + penalty * sources.get(source, 0))
                if best is None or (-round(gain, 9), order) < best[:2]:
                    best = (-round(gain, 9), order, key)
            if best is None:
                break
            _, source, text, _, _, ids, _, counts, _ = left.pop(best[2])
            texts.add(text)
            sources[source] = sources.get(source, 0) + 1
            for i, n in zip(ids or [], counts or [], strict=True):
                used[i] = used.get(i, 0) + n
            out.append((best[2], -best[0]))
    return out


def drawn(n, seed):
    """Rows whose gains differ, some with no features, null sources and texts, and families of equal texts."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        ids = rng.sample(range(-20, 20), rng.randrange(8)) if rng.random() < 0.9 else None
        coefs = None if ids is None else [rng.randrange(1, 10_000) / 997 for _ in ids]
        rows.append((f"k{i}", rng.choice(["a", "b", None]), rng.choice([None, *(f"t{j}" for j in range(n // 2))]), f"{rng.random():.12f}", rng.choice([0, 1, 2, 3, None]), ids, coefs, None if ids is None else [rng.randrange(1, 4) for _ in ids], "x"))
    return rows


@pytest.mark.parametrize(("n", "seed", "block"), [(60, 1, 1), (60, 2, 7), (150, 3, 20), (150, 4, 4096)])
def test_equals_a_plain_loop(spark, n, seed, block):
    rows = drawn(n, seed)
    quotas = [(2, 10), (1, 15), (0, 28)]
    got = greedy_choice(spark.createDataFrame(rows, SCHEMA).repartition(3), quotas, 0.15, block)
    want = plain(rows, quotas, 0.15)
    assert [k for k, _, _ in got] == [k for k, _ in want] and [r for _, r, _ in got] == list(range(1, len(want) + 1))
    assert all(abs(g - w) < 1e-8 for (_, _, g), (_, w) in zip(got, want, strict=True))


def test_equal_rows_by_sort_key(spark):
    """A class of ties larger than the block is taken by its sort keys, over all rounds."""
    rows = [(f"k{i}", f"s{i}", f"t{i}", f"{i * 37 % 100:03}", 0, [i], [2.0], [1], "x") for i in range(100)]
    got = greedy_choice(spark.createDataFrame(rows, SCHEMA).repartition(4), [(0, 90)], 0.15, block=8)
    assert [k for k, _, _ in got] == [r[0] for r in sorted(rows, key=lambda r: r[3])][:90]


def test_odd_tables(spark):
    assert greedy_choice(spark.createDataFrame([], SCHEMA), [(2, 5), (0, 9)], 0.15) == []
    rows = [("a", None, "t", "1", 0, [], [], [], "x"), ("b", None, "t", "2", 0, None, None, None, "x"), ("c", "s", None, "3", None, None, None, None, "x")]
    assert greedy_choice(spark.createDataFrame(rows, SCHEMA), [(1, 5), (0, 9)], 0.15) == [("a", 1, 0.0), ("c", 2, 0.0)]
