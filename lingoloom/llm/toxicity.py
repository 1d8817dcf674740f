"""Toxicity by a weighted finite-state grammar over clauses."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import mix, word_shingles
from .sampling import fold_of, labelled_sample
from .scratch import Scratch

#: Closed classes of words: the classes are given, what each word weighs is learned from labels.
THREATS = "kill hurt destroy burn shoot stab punch beat smash crush töten umbringen schlagen matar golpear tuer frapper".split()
SECOND = "you your yours yourself du dich dir ihr euch tu te ti usted ustedes toi vous".split()
THIRD = "he she they him her them his their er sie ihn él ella ellos il elle ils elles".split()
NEGATIONS = "not no never neither nor without isn't aren't wasn't don't doesn't nicht kein keine nie niemals sin nunca jamás pas jamais sans".split()
REPORTS = "said says say wrote writes called calls quoted quotes claimed reported according sagte schrieb nannte dijo escribió llamó dit écrit appelé".split()
#: Tokens over which a negation holds; what is left of a negated hit; what is left of reported speech before labels say more.
REACH, NEGATED, REPORTED = 3, 0.5, 0.7
THREAT_WEIGHT = 3.0
#: Families of labelled texts that a cue's weight before learning counts for.
PRIOR = 20.0
QUOTES = '"«„“'
CLAUSE_END = re.compile(r"[.!?;:\n]")
_EDGES = ".,;:!?\"'()[]{}<>«»„“”‘’…*#$%&|-—"
#: Logarithm of how many stems may be tried: what chance gives once in e**14 stems is no evidence.
TRIED = 14.0
#: Prefix lengths of the insult transducer; a whole word ends in $.
PREFIXES = range(3, 9)


def stems(word: str) -> Iterator[str]:
    for n in PREFIXES:
        if len(word) < n:
            break
        yield word[:n]
    yield word + "$"


def _tokens(low: str) -> set[str]:
    """The words that the clauses of a text have."""
    return set(CLAUSE_END.sub(" ", low).split())


#: What the lexicon makes of a token, and what the negation transducer makes of that.
SYMBOLS = ("other", "quote", "negation", "report", "target", "threat", "insult")
MARKED = (*SYMBOLS, "threat-", "insult-")


@dataclass(frozen=True)
class Transducer:
    """States, arcs and weights: ``arcs[state, symbol]`` lists (output, next state, weight, takes).

    An arc's weight is multiplied by the token's own weight if it ``takes`` it.
    A clause weighs the sum, over all paths from a start to a final state, of
    the products of their arcs' weights and the final weight.
    """

    starts: tuple
    finals: dict
    arcs: dict

    def weigh(self, tape: list[tuple[str, float]]) -> float:
        now = dict.fromkeys(self.starts, 1.0)
        for symbol, own in tape:
            then: dict = {}
            for state, mass in now.items():
                for _, target, weight, takes in self.arcs.get((state, symbol), ()):
                    then[target] = then.get(target, 0.0) + mass * weight * (own if takes else 1.0)
            now = then
        return sum(mass * self.finals.get(state, 0.0) for state, mass in now.items())


def compose(a: Transducer, b: Transducer) -> Transducer:
    """What ``b`` makes of what ``a`` writes; only pairs of states that can be reached."""
    reads: dict = {}
    for (state, symbol), some in a.arcs.items():
        reads.setdefault(state, []).append((symbol, some))
    starts = tuple((p, q) for p in a.starts for q in b.starts)
    arcs, todo, seen = {}, list(starts), set(starts)
    while todo:
        p, q = todo.pop()
        for symbol, some in reads.get(p, ()):
            out = [(z, (p2, q2), v * w, m or n) for y, p2, v, m in some for z, q2, w, n in b.arcs.get((q, y), ())]
            arcs[(p, q), symbol] = out
            fresh = {s for _, s, _, _ in out} - seen
            seen |= fresh
            todo += fresh
    return Transducer(starts, {(p, q): a.finals[p] * b.finals[q] for p, q in seen if p in a.finals and q in b.finals}, arcs)


def union(a: Transducer, b: Transducer) -> Transducer:
    """Either: the paths of both."""
    tag = lambda t, n: Transducer(tuple((n, s) for s in t.starts), {(n, s): w for s, w in t.finals.items()}, {((n, s), x): [(y, (n, s2), w, m) for y, s2, w, m in some] for (s, x), some in t.arcs.items()})
    a, b = tag(a, 0), tag(b, 1)
    return Transducer(a.starts + b.starts, a.finals | b.finals, a.arcs | b.arcs)


def negation() -> Transducer:
    """Marks hits within REACH tokens of a negation."""
    arcs = {}
    for k in range(REACH + 1):
        for x in SYMBOLS:
            if x == "negation":
                arcs[k, x] = [(x, REACH, 1.0, False)]
            elif x == "quote":
                arcs[k, x] = [(x, k, 1.0, False)]
            else:
                arcs[k, x] = [(x + "-" if k and x in ("threat", "insult") else x, max(0, k - 1), 1.0, False)]
    return Transducer((0,), dict.fromkeys(range(REACH + 1), 1.0), arcs)


def _watch(start: str, end: str, moves: dict[str, tuple[float, bool]], skips: bool) -> Transducer:
    """Two states; the symbols of ``moves`` lead from the first to the second with (weight, takes), and may be skipped where ``skips``."""
    arcs = {(s, x): [(x, s, 1.0, False)] for s in (start, end) for x in MARKED}
    for x, (weight, takes) in moves.items():
        arcs[start, x] = [*(arcs[start, x] if skips else ()), (x, end, weight, takes)]
    return Transducer((start,), {start: 1.0, end: 1.0}, arcs)


def insult() -> Transducer:
    """A path for each insult of a clause."""
    t = _watch("seek", "insulted", {"insult": (1.0, True), "insult-": (NEGATED, True)}, True)
    return Transducer(t.starts, {"insulted": 1.0}, t.arcs)


def threat() -> Transducer:
    """A path for each threat that isn't negated, final only where the clause names a target."""
    t = compose(_watch("seek", "threatened", {"threat": (1.0, True)}, True), _watch("nobody", "somebody", {"target": (1.0, False)}, False))
    return Transducer(t.starts, {("threatened", "somebody"): 1.0}, t.arcs)


def target() -> Transducer:
    """Weighs a clause by the first target that it names."""
    return _watch("nobody", "somebody", {"target": (1.0, True)}, False)


def reported() -> Transducer:
    """Weighs a clause by its first reporting verb or quotation mark."""
    return _watch("plain", "said", {"report": (1.0, True), "quote": (1.0, True)}, False)


def hits() -> Transducer:
    """Insults and threats after negation, before targets and reported speech weigh them."""
    return compose(negation(), union(insult(), threat()))


def given_cues() -> dict[str, tuple[str, float]]:
    """Symbol and weight of the closed classes' words before labels are seen."""
    out = {w: ("target", 1.2) for w in THIRD} | {w: ("target", 1.5) for w in SECOND}
    return out | {w: ("report", REPORTED) for w in REPORTS} | {w: ("negation", 1.0) for w in NEGATIONS} | {w: ("threat", THREAT_WEIGHT) for w in THREATS}


class Grammar:
    """The lexicon (insult stems and cues with weights) and the machine composed of all transducers.

    Each token is one symbol; a token that opens with a quotation mark is that
    symbol first. A token takes its weight on the one arc of a path that reads
    it as a hit, a target or a report.
    """

    def __init__(self, insults: dict[str, float], cues: dict[str, tuple[str, float]] | None = None):
        self.insults, self.cues = insults, given_cues() if cues is None else cues
        self.machine = compose(compose(hits(), target()), reported())
        self.known: dict[str, tuple] = {}

    def symbols(self, token: str) -> tuple[tuple[str, float], ...]:
        found = self.known.get(token)
        if found is None:
            if len(self.known) > 400_000:
                self.known.clear()
            word = token.strip(_EDGES)
            weight = max((self.insults.get(s, 0.0) for s in stems(word)), default=0.0) if word else 0.0
            found = (("insult", weight),) if weight > 0 else (self.cues.get(word, ("other", 1.0)),)
            if token[:1] in QUOTES:
                found = (("quote", REPORTED), *found)
            self.known[token] = found
        return found

    def is_hit(self, token: str) -> bool:
        return self.symbols(token)[-1][0] in ("insult", "threat")

    def clause(self, tokens: list[str]) -> float:
        return self.machine.weigh([s for t in tokens for s in self.symbols(t)])

    def hit_clauses(self, text: str) -> Iterator[list[str]]:
        """Tokens of the clauses that hold an insult or a threat; the others weigh nothing."""
        low = text.lower()
        if any(map(self.is_hit, _tokens(low))):
            for part in CLAUSE_END.split(low):
                tokens = part.split()
                if any(map(self.is_hit, tokens)):
                    yield tokens

    def read(self, text: str) -> tuple[float, float, int]:
        """Sum and maximum of the clause weights, and the number of clauses that matched."""
        found = [w for c in self.hit_clauses(text) if (w := self.clause(c)) > 0]
        return math.fsum(found), max(found, default=0.0), len(found)


def _stem_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either class with each stem, per batch."""
    for batch in batches:
        counts = (Counter(), Counter())
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            words = {w.strip(_EDGES) for w in _tokens((text or "").lower())}
            counts[label].update({s for w in words if w for s in stems(w)})
        names = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([c[n] for n in names], pa.int64()) for c in counts)], names=["stem", "clean", "toxic"])


def _family(text: str) -> int:
    """The least hash of a document's three-word windows, which near copies share as often as they share windows."""
    windows = word_shingles([text], 3)[0]
    return int(mix(windows).min() >> np.uint64(1)) if len(windows) else -1


def _families(found: Callable[[str], set[str]]):
    """(name, family, label) of everything that ``found`` names in a document; the empty name is every document's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = set()
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                family = _family(text or "")
                rows.update((s, family, label) for s in found(text or "") | {""})
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int32())], names=["name", "family", "label"])

    return run


def _by_family(sample: DataFrame, found: Callable[[str], set[str]]) -> dict[str, tuple[int, int]]:
    """Toxic families and all families with each name."""
    rows = sample.mapInArrow(_families(found), "name string, family long, label int").distinct()
    return {r["name"]: (r["toxic"], r["n"]) for r in rows.groupBy("name").agg(F.sum("label").alias("toxic"), F.count("*").alias("n")).collect()}


def learn_insults(sample: DataFrame, least: int = 3) -> dict[str, float]:
    """Stems that mark toxic documents, with log-odds weights. The sample bounds how many there can be.

    Stems are first counted by documents. Those that look toxic are then counted
    by families of near copies, so that a text that was copied a thousand times
    counts about once. A stem is an insult if 99 of 100 families with it are
    toxic, more than chance would give to any of all the stems tried.
    """
    totals = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return {}
    counts = sample.mapInArrow(_stem_counts, "stem string, clean long, toxic long").groupBy("stem").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = (F.col("toxic") + 0.5) / (totals[1] + 1) / ((F.col("clean") + 0.5) / (totals[0] + 1))
    rows = counts.where((F.col("toxic") >= least) & (odds >= 8) & (F.col("toxic") >= 4 * F.col("clean"))).select("stem").collect()
    wanted = frozenset(r["stem"] for r in rows)
    by_family = _by_family(sample, lambda text: {s for t in _tokens(text.lower()) if (w := t.strip(_EDGES)) for s in stems(w)} & wanted)
    all_toxic, all_n = by_family.pop("")
    share = min(max(all_toxic / all_n, 1e-6), 1 - 1e-6)
    out = {}
    for stem, (toxic, n) in by_family.items():
        clean = n - toxic
        if toxic >= least and toxic >= 99 * clean and toxic * math.log(1 / share) - clean * math.log(n + 1) >= TRIED:
            out[stem] = math.log((toxic + 0.5) / (clean + 0.5)) + math.log((1 - share) / share)
    return out


def learn_cues(sample: DataFrame, insults: dict[str, float]) -> dict[str, tuple[str, float]]:
    """The closed classes' words with weights that labels have moved.

    A word's weight is multiplied by how much oftener than other hit clauses'
    the families of its clauses are toxic; PRIOR families at the common share
    are added, so a rare word keeps about the weight it was given.
    """
    grammar = Grammar(insults)
    in_clauses = lambda text: {"hit", *(w for c in grammar.hit_clauses(text) for t in c if (w := t.strip(_EDGES)) in grammar.cues)}
    counts = _by_family(sample, lambda text: in_clauses(text) if next(grammar.hit_clauses(text), None) else set())
    toxic, n = counts.get("hit", (0, 0))
    share = (toxic + 0.5) / (n + 1)
    moved = {w: (counts[w][0] + PRIOR * share) / (counts[w][1] + PRIOR) / share for w in grammar.cues if w in counts}
    return {w: (symbol, weight * moved.get(w, 1.0)) for w, (symbol, weight) in grammar.cues.items()}


def _features(values: tuple[float, float, int]) -> list[float]:
    total, most, clauses = values
    return [1.0, math.log1p(total), math.log1p(most), math.log1p(clauses)]


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps; the intercept isn't penalised."""
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (p - y) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _read(insults: dict[str, float], cues: dict[str, tuple[str, float]], weights: list[float] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(insults, cues)
        for batch in batches:
            found = [grammar.read(t or "") for t in batch.column("text").to_pylist()]
            x = np.array([_features(f) for f in found]).reshape(len(found), 4)
            score = 1 / (1 + np.exp(-np.clip(x @ np.array(weights), -30, 30))) if weights is not None else np.zeros(len(found))
            keys = [batch.column(c) for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(score, pa.float64()), *(pa.array([f[k] for f in found], kind) for k, kind in ((0, pa.float64()), (1, pa.float64()), (2, pa.int64())))], names=[*(c for c in batch.schema.names if c != "text"), "score", "total", "most", "n_clauses"])

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = 4000, folds: int = 5, held_fold: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted, n_clauses.

    Insult stems, the weights of cues and the four numbers that turn clause weights into a
    probability are learned from up to ``per_class`` labelled documents of
    either class outside the held-out fold; nothing but the text is an input of
    a score.

    Null and empty texts match no clause and get the score of any text without
    one. A null id is not held out. Rows that repeat are scored one by one.
    Without labels of both classes every score is the sum of clause weights
    squeezed into 0 to 1. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sample = scratch.save(labelled_sample(docs, labels, "toxic", fold_of(F.col("doc_id"), folds) != held_fold, per_class, seed=6).repartition(24, "doc_id"))
    insults = learn_insults(sample)
    cues = learn_cues(sample, insults)
    weights = [-4.0, 2.0, 0.0, 0.0]
    fitted = sample.select("text", "label").mapInArrow(_read(insults, cues, None), "label int, score double, total double, most double, n_clauses long").collect()  # 2 * per_class rows at most
    y = np.array([float(r["label"]) for r in fitted])
    if len(set(y)) == 2:
        weights = _fit(np.array([_features((r["total"], r["most"], r["n_clauses"])) for r in fitted]), y).tolist()
    scored = docs.mapInArrow(_read(insults, cues, weights), "doc_id long, score double, total double, most double, n_clauses long")
    held = F.coalesce(fold_of(F.col("doc_id"), folds) == held_fold, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_clauses")
