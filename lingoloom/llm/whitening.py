"""Embedding whitening from exact integer covariances.

Vectors become integers; their products are summed by digit-slice GEMM: each
integer is cut into limbs so small that a float64 BLAS product of two limb
matrices is exact, the products are recombined as big integers, and the sums
of all tasks are merged by Spark as base 2**32 digits. Only the eigenvectors
are floating-point.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import sound_vectors

#: Bits of a limb, and rows of a product: 2 * LIMB + log2(SLAB) stays below the 53 bits of a double.
LIMB, SLAB = 18, 1 << 14
#: Bits of the digits in which tasks hand on big integers.
DIGIT = 32
#: x = floor(SCALE * c) + OFFSET; floors beyond +-EDGE are that edge.
SCALE, OFFSET, EDGE = 64, 1_000_000, 1 << 61


def integers(values: np.ndarray) -> np.ndarray:
    """x of each entry, as int64."""
    return np.clip(np.floor(values * SCALE), -EDGE, EDGE).astype(np.int64) + OFFSET


def exact_gram(z: np.ndarray) -> np.ndarray:
    """z^T z of an int64 matrix as Python integers, by float64 products of limbs."""
    d = z.shape[1]
    total = np.zeros((d, d), dtype=object)
    for first in range(0, len(z), SLAB):
        part = z[first : first + SLAB]
        sign, rest = np.sign(part), np.abs(part)
        limbs = []
        while rest.any():
            limbs.append((sign * (rest & ((1 << LIMB) - 1))).astype(np.float64))
            rest = rest >> LIMB
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs[: i + 1]):
                product = (a.T @ b).astype(np.int64).astype(object)  # exact: below 2**53
                total += (product if i == j else product + product.T) << LIMB * (i + j)
    return total


def exact_sums(z: np.ndarray) -> np.ndarray:
    """Column sums of an int64 matrix as Python integers."""
    low, high = z & 0xFFFFFFFF, z >> 32
    return low.sum(axis=0).astype(object) + (high.sum(axis=0).astype(object) << 32)


def _digits(values: list[int]) -> pa.RecordBatch:
    """(place, digit, value): each integer in base 2**DIGIT, its sign in the last digit; zeros left out."""
    place, digit, value = [], [], []
    for p, v in enumerate(values):
        v, k = int(v), 0
        while v:
            low = v if -(1 << DIGIT) < v < 1 << DIGIT else v & ((1 << DIGIT) - 1)
            place.append(p), digit.append(k), value.append(low)
            v, k = (v - low) >> DIGIT, k + 1
    return pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(digit, pa.int32()), pa.array(value, pa.int64())], names=["place", "digit", "value"])


def _merged(vectors: DataFrame, size: int, own: Callable[[np.ndarray], np.ndarray], width: int) -> list[int]:
    """``size`` integers: the sums over all tasks of ``own(x)`` of their integer vectors, merged digit by digit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=object)
        for batch in batches:
            total += own(integers(sound_vectors(batch.column("vector"), width)[1]))
        yield _digits(total.tolist())

    sums = vectors.select("vector").mapInArrow(run, "place int, digit int, value long").groupBy("place", "digit").agg(F.sum("value").alias("value"))
    out = [0] * size
    for r in sums.collect():  # a few digits for each pair of dimensions
        out[r.place] += r.value << DIGIT * r.digit
    return out


def eigen(matrix: list[list[int]], divisor: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of ``matrix / divisor`` by falling size, and unit eigenvectors as columns.

    A float64 decomposition of the correctly rounded quotients is the start;
    Jacobi rotations in extended precision then clear what it leaves off the
    diagonal, so small eigenvalues beside large ones are right as well.
    """
    d = len(matrix)
    whole = np.array([[np.longdouble(v // divisor) + np.longdouble(v % divisor / divisor) for v in row] for row in matrix], dtype=np.longdouble).reshape(d, d)
    q = np.linalg.eigh(whole.astype(np.float64))[1].astype(np.longdouble)
    for _ in range(3):  # columns orthogonal to extended precision
        q = q @ (1.5 * np.eye(d, dtype=np.longdouble) - 0.5 * (q.T @ q))
    b = q.T @ whole @ q
    tiny = np.finfo(np.longdouble).eps
    for _ in range(30):
        moved = False
        for i in range(d):
            for j in range(i + 1, d):
                if abs(b[i, j]) <= tiny * np.sqrt(abs(b[i, i] * b[j, j])) or b[i, j] == 0:
                    continue
                moved = True
                turn = (b[j, j] - b[i, i]) / (2 * b[i, j])
                t = (1 if turn >= 0 else -1) / (abs(turn) + np.sqrt(turn * turn + 1))
                c = 1 / np.sqrt(t * t + 1)
                s = t * c
                for m in (b, q):
                    m[:, i], m[:, j] = c * m[:, i] - s * m[:, j], s * m[:, i] + c * m[:, j]
                b[i], b[j] = c * b[i] - s * b[j], s * b[i] + c * b[j]
        if not moved:
            break
    values = np.diag(b)
    order = np.argsort(-values, kind="stable")
    return values[order].astype(np.float64), q[:, order].astype(np.float64)


class Whitening:
    """n, per-dimension sums, eigenvalues and eigenvectors of integer vectors; ``fit`` reads them in two passes."""

    def __init__(self, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray, trace: float):
        self.n, self.sums, self.values, self.vectors, self.trace = n, sums, values, vectors, trace
        self.pivot = np.array([s // n for s in sums], dtype=np.int64)
        #: What the pivot leaves of the mean, in [0, 1).
        self.rest = np.array([s % n / n for s in sums])

    @classmethod
    def fit(cls, vectors: DataFrame, width: int, components: int) -> Whitening | None:
        """None without vectors. Components whose variance is zero, or below 1e-15 of all, are left out."""
        n, *sums = _merged(vectors, width + 1, lambda x: np.concatenate(([len(x)], exact_sums(x))), width)
        if not n:
            return None
        pivot = np.array([s // n for s in sums], dtype=np.int64)
        upper = np.triu_indices(width)

        def products(x: np.ndarray) -> np.ndarray:
            z = x - pivot
            return exact_gram(z)[upper]

        gram = np.zeros((width, width), dtype=object)
        gram[upper] = _merged(vectors, len(upper[0]), products, width)
        rest = [s % n for s in sums]  # sums of z = x - pivot
        matrix = [[n * int(gram[min(i, j), max(i, j)]) - rest[i] * rest[j] for j in range(width)] for i in range(width)]
        values, axes = eigen(matrix, n * n)
        total = sum(matrix[i][i] for i in range(width))
        trace = total / (n * n)
        count = min(components, int((values > 1e-15 * trace).sum()))
        return cls(n, sums, values[:count], axes[:, :count], trace)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """(rows, components)."""
        return ((x - self.pivot) - self.rest) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum over dimensions of (n * x - S)**2 of each row, exact; None beyond 64 bits."""
        z = x - self.pivot
        rest = np.array([s % self.n for s in self.sums], dtype=object)
        most = self.n * (int(np.abs(z).max(initial=0)) + 1)
        if most * most * max(1, z.shape[1]) < 1 << 63:
            return ((self.n * z - rest.astype(np.int64)) ** 2).sum(axis=1).tolist()
        exact = ((self.n * z.astype(object) - rest) ** 2).sum(axis=1).tolist()
        return [v if v < 1 << 63 else None for v in exact]


def whitened_embeddings(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32) -> DataFrame:
    """One row a sound row and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    A row whose vector is null or holds a null or non-finite entry takes no
    part; all others are the list the transform is fitted on. Entry c becomes
    floor(64 * c) + 1000000. Shorter vectors are filled up with c = 0 to the
    longest one's width. Null ids and repeated rows count as rows of their
    own. Components are eigenvectors of the covariance about the mean, by
    falling eigenvalue; those without variance are left out, so equal
    vectors, like an empty table, give no rows. ``deviation`` is null where
    it needs over 64 bits. ``identity_error`` is measured: the covariance of
    all whitened rows is summed up in a pass of its own.

    Five passes over the vectors, no shuffle of rows. The driver holds square
    matrices of the vectors' width, nothing that grows with the rows.
    """
    vectors = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    width = vectors.agg(F.max(F.size("vector"))).first()[0]
    model = Whitening.fit(vectors, width, components) if width and width > 0 else None
    if model is None or not len(model.values):
        return embeddings.sparkSession.createDataFrame([], schema)
    count = len(model.values)

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums = np.zeros((count, count)), np.zeros(count)
        for batch in batches:
            w = model.whiten(integers(sound_vectors(batch.column("vector"), width)[1]))
            total, sums = total + w.T @ w, sums + w.sum(axis=0)
        flat = np.concatenate((total.ravel(), sums))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], names=["place", "value"])

    found = np.zeros(count * count + count)
    for r in vectors.select("vector").mapInArrow(squares, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).collect():
        found[r.place] = r.value
    mean = found[count * count :] / model.n
    error = float(np.abs(found[: count * count].reshape(count, count) / model.n - np.outer(mean, mean) - np.eye(count)).max())
    explained = model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, values = sound_vectors(batch.column("vector"), width)
            for first in range(0, len(rows), 1024):
                x = integers(values[first : first + 1024])
                k = len(x)
                ids = batch.column("vec_id").take(pa.array(np.repeat(rows[first : first + k], count)))
                deviation = pa.array(model.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(k), count)))
                columns = [ids, np.tile(np.arange(1, count + 1, dtype=np.int32), k), np.full(k * count, model.n), deviation, model.whiten(x).ravel(), np.tile(explained, k), np.full(k * count, error)]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(run, schema)
