"""The classifiers: grammar, gradient, held-out accuracy and odd rows."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lingoloom.llm.passages import N_FEATURES, PASSAGE, AttentionModel, encode_passages, score_quality
from lingoloom.llm.sampling import labelled_sample
from lingoloom.llm.toxicity import NEGATED, REACH, Grammar, compose, given_cues, hits, negation, reported, score_toxicity, target


def test_clauses_weigh_negation_reports_targets_and_threats():
    g = Grammar({"idio": 4.0, "scum$": 3.0})
    plain = g.clause("what an idiot".split())
    assert plain == 4.0 and g.clause("idiocy everywhere".split()) == 4.0 and g.clause(["scummy"]) == 0
    assert g.clause("not an idiot".split()) == 2.0 and g.clause("not in the least bit an idiot".split()) == 4.0
    assert g.clause("she said an idiot".split()) < g.clause("she met an idiot".split())
    assert g.clause("you idiot".split()) == 6.0
    assert g.clause("i will kill you".split()) == 4.5 and g.clause("kill time".split()) == 0
    assert g.read("Fine. You IDIOT! scum, really")[2] == 2 and g.read("") == (0.0, 0.0, 0)


def _by_hand(symbols):
    """Each hit of a clause by itself, as the docstrings say."""
    first = lambda kinds: next((w for s, w in symbols if s in kinds), 1.0)
    total, told = 0.0, [s for s, _ in symbols]
    for i, (symbol, weight) in enumerate(symbols):
        before = [s for s in told[:i] if s != "quote"][-REACH:]
        negated = "negation" in before
        if symbol == "insult":
            total += weight * (NEGATED if negated else 1.0)
        if symbol == "threat" and not negated and "target" in told:
            total += weight
    return total * first(("target",)) * first(("report", "quote"))


def test_the_composed_machine_matches_enumeration():
    machine = Grammar({}).machine
    draw = random.Random(6)
    own = {"other": 1.0, "quote": 0.7, "negation": 1.0, "report": 0.6, "target": 1.5, "threat": 3.0, "insult": 4.0}
    for n in range(5):
        for clause in itertools.product(own, repeat=n):
            symbols = [(s, own[s]) for s in clause]
            assert machine.weigh(symbols) == pytest.approx(_by_hand(symbols))
    for _ in range(2000):
        symbols = [(s, own[s] * draw.uniform(0.5, 2)) for s in draw.choices(list(own), k=draw.randint(5, 12))]
        assert machine.weigh(symbols) == pytest.approx(_by_hand(symbols))


def test_composition_multiplies_and_feeds():
    both = compose(compose(hits(), target()), reported())
    assert len(both.finals) > len(hits().finals) and all(s in {state for state, _ in both.arcs} or s in both.finals for some in both.arcs.values() for _, s, _, _ in some)
    assert negation().arcs[2, "insult"] == [("insult-", 1, 1.0, False)] and negation().arcs[0, "insult"] == [("insult", 0, 1.0, False)]


def test_cues_learn_from_labels(spark):
    """A reporting verb that stands in clean texts only weighs less than it did, one in toxic texts no less."""
    from lingoloom.llm.toxicity import learn_cues

    draw = random.Random(3)
    word = lambda: "".join(draw.choices("aeioulnrst", k=5))
    rows = [(f"{word()} {word()} {'said' if i % 2 else 'wrote'} {word()} gobshite {word()} {word()}", 1 - i % 2) for i in range(120)]
    cues = learn_cues(spark.createDataFrame(rows, "text string, label int"), {"gobshite$": 5.0})
    given = given_cues()
    assert cues["said"][1] < 0.5 * given["said"][1] and cues["wrote"][1] > given["wrote"][1] and cues["kill"] == given["kill"]


@pytest.fixture(scope="module")
def toxic(spark):
    draw = random.Random(4)
    word = lambda: "".join(draw.choices("aeioulnrst", k=draw.randint(2, 7)))
    docs, labels = [], []
    for i in range(1500):
        words = [word() for _ in range(draw.randint(5, 60))]
        bad = i % 4 == 0
        if bad:
            for _ in range(draw.randint(1, 3)):
                words[draw.randrange(len(words))] = draw.choice(["wretch", "gobshite" + word(), "gobshite"])
        docs.append((i, " ".join(words)))
        labels.append((i, int(not bad), int(bad)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_held_out(toxic):
    docs, labels = toxic
    got = score_toxicity(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(1500) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r.predicted == r.toxic for r in held]) > 0.97 and all(r.predicted == (r.score >= 0.5) for r in got)


def test_toxicity_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (5, 1, 0), (None, 0, 1), (9, None, None)], "doc_id long, quality int, toxic int")
    assert score_toxicity(odd, labels).count() == odd.count()
    assert all(0 <= r.score <= 1 for r in score_toxicity(odd, labels.limit(0)).collect())
    assert score_toxicity(nothing, labels).count() == 0


def test_passages_cover_whole_texts():
    x, begin = encode_passages(["w " * (PASSAGE * 3 + 1), "", "one", "é | 😀 !! 12"])
    assert begin.tolist() == [0, 4, 4, 5, 6] and x.shape == (6, N_FEATURES) and np.isfinite(x).all()
    alone, _ = encode_passages(["é | 😀 !! 12"])
    assert np.allclose(alone, x[5:])


def test_gradient_matches_differences():
    draw = np.random.default_rng(0)
    x, begin, y = draw.normal(size=(12, N_FEATURES)), np.array([0, 3, 4, 9, 12]), np.array([1.0, 0, 1, 0])
    model = AttentionModel()
    f = model.forward(x, begin)
    found = model.gradient(f, (f["y"] - y) / 4, begin)
    loss = lambda: -np.mean(y * np.log(model.forward(x, begin)["y"]) + (1 - y) * np.log(1 - model.forward(x, begin)["y"]))
    for name, grad in found.items():
        at = tuple(draw.integers(0, n) for n in grad.shape)
        old = model.p[name][at]
        model.p[name][at] = old + 1e-5
        up = loss()
        model.p[name][at] = old - 1e-5
        down = loss()
        model.p[name][at] = old
        assert grad[at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-7)


def test_quality_held_out(spark):
    draw = random.Random(6)
    word = lambda: "".join(draw.choices("aeioulnrst", k=draw.randint(2, 7)))
    docs, labels = [], []
    for i in range(800):
        words = [word() for _ in range(draw.randint(80, 400))]
        good = i % 3 > 0
        if not good:  # one bad stretch in an otherwise good text
            at = draw.randrange(len(words) - 60)
            words[at : at + 60] = [w + "$$$" for w in words[at : at + 60]] if i % 2 else [words[at]] * 60
        docs.append((i, " ".join(words)))
        labels.append((i, int(good), 0))
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = score_quality(spark.createDataFrame(docs, "doc_id long, text string"), labels).join(labels, "doc_id").where("held_out").collect()
    assert {r.doc_id for r in got} == {i for i in range(800) if zlib.crc32(str(i).encode()) % 3 == 1}
    assert np.mean([r.predicted == r.quality for r in got]) > 0.95


def test_quality_reads_words(spark):
    """Texts of equal form that differ in their words only."""
    draw = random.Random(16)
    word = lambda: "".join(draw.sample("aeioulnrst", k=5))
    vocabularies = [[word() for _ in range(60)] for _ in range(2)]
    docs = [(i, " ".join(draw.choices(vocabularies[i % 2], k=150))) for i in range(600)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(600)], "doc_id long, quality int, toxic int")
    got = score_quality(spark.createDataFrame(docs, "doc_id long, text string"), labels).where("held_out").collect()
    assert np.mean([r.predicted == r.doc_id % 2 for r in got]) > 0.95


def test_an_id_is_sampled_once(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(2, "b"), (3, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    rows = labelled_sample(docs, labels, "quality", F.lit(True), 10, 9).collect()
    assert sorted((r.doc_id, r.text, r.label) for r in rows) == [(1, "text 0", 1), (2, "b", 0), (3, "c", 1)]


def test_quality_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (2, 0, 1), (None, 0, 1), (9, None, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.score for r in score_quality(odd, labels).collect()}
    assert got[2] == got[3] == got[4] == 0.0
    assert score_quality(odd, labels.limit(0)).where("predicted = 1").count() == 6
    assert score_quality(nothing, labels).count() == 0


def test_words_glued_by_punctuation_count_alone():
    g = Grammar({"idio": 4.0})
    assert g.read("stop!idiot") == (4.0, 4.0, 1) and g.read("ok:kill you")[2] == 1 and g.read("all.fine") == (0.0, 0.0, 0)
