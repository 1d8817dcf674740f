"""Document quality by attention-based multiple-instance learning over passages."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import _SPACE, blocks, mix, word_hashes
from .sampling import fold_of, labelled_sample
from .scratch import Scratch

#: Words in a passage; the last one of a document may have fewer.
PASSAGE = 64
#: Byte classes that a passage's bytes are counted by.
CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&<>=~^_+@\\", b"|", b"!?", b".,;:'\"()-", bytes(range(0x80, 0x100)))
N_FORM = 8 + len(CLASSES)
#: Buckets that the words of a passage are hashed into, half of their hashes counting negatively.
BUCKETS = 256
N_FEATURES = N_FORM + BUCKETS
HIDDEN, ATTENTION = 12, 8
#: Least scale of a bucket, so that words that training hardly saw don't count for much.
WORD_SCALE = 0.5
#: Passages that the model is fitted on, at most: sampled documents are taken in the order of their hashes as long as they fit.
FITTED_PASSAGES = 40_000


def encode_passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(passages, N_FEATURES) of all texts, and where each text's passages begin: N_FORM numbers of form, then the words."""
    joined = np.frombuffer(b" ".join(t.encode("utf-8", "surrogatepass") for t in texts) + b" ", dtype=np.uint8)
    space = _SPACE[joined]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    hashes, at = word_hashes(texts)
    counts = np.diff(at)
    passages = -(-counts // PASSAGE)
    begin = np.concatenate(([0], np.cumsum(passages)))
    if not begin[-1]:
        return np.zeros((0, N_FEATURES)), begin
    within = np.arange(begin[-1]) - np.repeat(begin[:-1], passages)
    first = np.repeat(at[:-1], passages) + within * PASSAGE
    owner = np.repeat(np.arange(begin[-1]), np.diff(np.append(first, len(starts))))
    size = np.bincount(owner, minlength=begin[-1]).astype(float)
    per = lambda v: np.add.reduceat(v.astype(float), first)
    sizes = ends - starts
    chars = np.maximum(1.0, per(sizes))
    columns = [np.log1p(size), chars / size, np.sqrt(np.maximum(0, per(sizes.astype(float) ** 2) / size - (chars / size) ** 2))]
    for c in CLASSES:
        table = np.zeros(256, dtype=np.int64)
        table[list(c)] = 1
        sums = np.concatenate(([0], np.cumsum(table[joined])))
        columns.append(per(sums[ends] - sums[starts]) / chars)
    again = np.zeros(len(hashes), dtype=bool)
    again[1:] = hashes[1:] == hashes[:-1]
    again[first] = False
    columns.append(per(again) / size)
    order = np.lexsort((hashes, owner))
    fresh = np.ones(len(hashes), dtype=bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    columns.append(np.bincount(owner[order][fresh], minlength=begin[-1]) / size)
    columns.append(per(sizes == 1) / size)
    columns.append(per(sizes >= 16) / size)
    # words of a passage that an earlier passage of the text has, by hashes of word pairs
    pairs = mix(hashes[:-1] * np.uint64(3) + hashes[1:]) if len(hashes) > 1 else np.zeros(0, dtype=np.uint64)
    text_of = np.repeat(np.arange(len(texts)), counts)
    order = np.lexsort((np.arange(len(pairs)), pairs, text_of[: len(pairs)]))
    seen = np.zeros(len(hashes), dtype=bool)
    if len(pairs) > 1:
        same = (pairs[order][1:] == pairs[order][:-1]) & (text_of[order][1:] == text_of[order][:-1])
        seen[order[1:][same]] = True
    columns.append(per(seen) / size)
    # which words: signed counts by hashed bucket, over the root of the passage's words
    signs = np.where((hashes >> np.uint64(63)).astype(bool), -1.0, 1.0)
    place = owner * BUCKETS + ((hashes >> np.uint64(40)) % np.uint64(BUCKETS)).astype(np.int64)
    words = np.bincount(place, signs, minlength=begin[-1] * BUCKETS).reshape(-1, BUCKETS) / np.sqrt(size)[:, None]
    return np.concatenate([np.stack(columns, axis=1), words], axis=1), begin


class AttentionModel:
    """Passage encoder, gated attention and a logistic layer over the weighted passage representation."""

    SHAPES = (("w", (N_FEATURES, HIDDEN)), ("b", (HIDDEN,)), ("v", (HIDDEN, ATTENTION)), ("u", (HIDDEN, ATTENTION)), ("a", (ATTENTION,)), ("c", (HIDDEN,)), ("d", (1,)))

    def __init__(self, seed: int = 9):
        draw = np.random.default_rng(seed)
        self.p = {k: draw.normal(0, 0.3, s) for k, s in self.SHAPES}
        self.mean, self.scale = np.zeros(N_FEATURES), np.ones(N_FEATURES)

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean.astype(x.dtype)) / self.scale.astype(x.dtype), -8, 8)

    def forward(self, x: np.ndarray, begin: np.ndarray) -> dict[str, np.ndarray]:
        """Activations of scaled passages; every document must have one."""
        p = self.p
        h = np.tanh(x @ p["w"] + p["b"])
        t, g = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        e = (t * g) @ p["a"]
        of = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
        e = np.exp(e - np.maximum.reduceat(e, begin[:-1])[of])
        weight = e / np.add.reduceat(e, begin[:-1])[of]
        z = np.add.reduceat(weight[:, None] * h, begin[:-1])
        return {"x": x, "h": h, "t": t, "g": g, "of": of, "weight": weight, "z": z, "y": 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))}

    def gradient(self, f: dict[str, np.ndarray], wrong: np.ndarray, begin: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss; ``wrong`` is (prediction - label) by document, weighted."""
        p = self.p
        dz = wrong[:, None] * p["c"]
        at = dz[f["of"]]
        dot = (at * f["h"]).sum(1)
        de = f["weight"] * (dot - np.add.reduceat(f["weight"] * dot, begin[:-1])[f["of"]])
        dg = de[:, None] * p["a"]
        dt, du = dg * f["g"] * (1 - f["t"] ** 2), dg * f["t"] * f["g"] * (1 - f["g"])
        dh = (at * f["weight"][:, None] + dt @ p["v"].T + du @ p["u"].T) * (1 - f["h"] ** 2)
        return {"w": f["x"].T @ dh, "b": dh.sum(0), "v": f["h"].T @ dt, "u": f["h"].T @ du, "a": (f["t"] * f["g"]).T @ de, "c": f["z"].T @ wrong, "d": np.array([wrong.sum()])}

    def fit(self, x: np.ndarray, begin: np.ndarray, y: np.ndarray, rounds: int = 300, rate: float = 0.03, decay: float = 1e-4) -> AttentionModel:
        """Full-batch Adam on the class-balanced log loss."""
        self.mean, self.scale = x.mean(0, dtype=float), x.std(0, dtype=float) + 1e-6
        self.scale[N_FORM:] = np.maximum(self.scale[N_FORM:], WORD_SCALE)
        x = self.scaled(x)
        share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
        m = {k: np.zeros(s) for k, s in self.SHAPES}
        v = {k: np.zeros(s) for k, s in self.SHAPES}
        for step in range(1, rounds + 1):
            f = self.forward(x, begin)
            for k, g in self.gradient(f, (f["y"] - y) * share, begin).items():
                g = g + decay * self.p[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def score(self, x: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Of each document; 0 for one without a passage."""
        out = np.zeros(len(begin) - 1)
        full = np.diff(begin) > 0
        if full.any():
            out[full] = self.forward(self.scaled(x), np.append(begin[:-1][full], begin[-1]))["y"]
        return out


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, texts in blocks(batch.column("text").to_pylist()):
            x, begin = encode_passages(texts)
            part = batch.slice(first, len(texts))
            rows = [x[a:b].astype(np.float32).tobytes() for a, b in zip(begin[:-1], begin[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), pa.array(np.diff(begin)), pa.array(rows, pa.binary())], names=["doc_id", "label", "n", "passages"])


def fit_quality(docs: DataFrame, labels: DataFrame, per_class: int = 1500, folds: int = 3, held_fold: int = 1) -> AttentionModel:
    """The model fitted on up to ``per_class`` labelled documents of either class outside the held-out fold.

    Whole documents are taken in the order of their hashes while their passages
    fit into FITTED_PASSAGES, about 45 MB, which the driver holds; a document
    that doesn't fit is passed over.
    """
    scratch = Scratch(docs.sparkSession)
    sample = labelled_sample(docs, labels, "quality", fold_of(F.col("doc_id"), folds) != held_fold, per_class, seed=9).repartition(12, "doc_id")
    encoded = scratch.save(sample.mapInArrow(_encoded, "doc_id long, label int, n long, passages binary"))
    room, fits = FITTED_PASSAGES, []
    for r in sorted(encoded.where("n > 0").select("doc_id", "n", F.xxhash64("doc_id").alias("h")).collect(), key=lambda r: (r["h"], r["doc_id"])):
        if r["n"] <= room:
            fits.append(r["doc_id"])
            room -= r["n"]
    rows = encoded.where(F.col("doc_id").isin(fits)).orderBy("doc_id").collect() if fits else []
    rows = [(r["label"], np.frombuffer(r["passages"], dtype=np.float32).reshape(-1, N_FEATURES)) for r in rows]
    model = AttentionModel()
    y = np.array([float(r[0]) for r in rows])
    if len(set(y)) == 2:
        model.fit(np.concatenate([r[1] for r in rows]), np.concatenate(([0], np.cumsum([len(r[1]) for r in rows]))), y)
    else:  # nothing to learn: every document with words gets the one label there is
        model.p["c"] *= 0
        model.p["d"][:] = 3.0 if not len(y) or y[0] == 1 else -3.0
    return model


def with_quality(docs: DataFrame, model: AttentionModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the model's score as ``score_col`` (replaced if there)."""
    columns = [c for c in docs.columns if c != score_col]

    @F.pandas_udf("double")
    def score(text):  # noqa: ANN001, ANN202
        import pandas as pd

        out = [model.score(*encode_passages(some)) for _, some in blocks(text.tolist())]
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    return docs.select(*[F.col(f"`{c}`") for c in columns], score(F.col(f"`{text_col}`")).alias(score_col))


def accepted(docs: DataFrame, model: AttentionModel, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the model scores ``least`` or more, with all their columns; those without words go."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    scored = with_quality(docs.select(row, F.col(f"`{text_col}`").alias("text")), model)
    return scored.where(F.col("score") >= least).select("row.*")


def score_quality(docs: DataFrame, labels: DataFrame, per_class: int = 1500, folds: int = 3, held_fold: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted.

    A document is a bag of passages of 64 words, all of them. Each is encoded
    by its character classes, word lengths and repetition and by its words,
    hashed into BUCKETS signed counts; gated attention,
    learned from document labels only, weighs the passages; a logistic layer
    scores the weighted sum.

    Null, empty and wordless texts have no passage and score 0. A null id is
    not held out. Repeated rows are scored one by one. Without labels of both
    classes all texts with words get the one label there is (1 if none). Other
    columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    model = fit_quality(docs, labels, per_class, folds, held_fold)
    held = F.coalesce(fold_of(F.col("doc_id"), folds) == held_fold, F.lit(False))
    return with_quality(docs, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
