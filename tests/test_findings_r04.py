"""What the review of round 4 found too slow or too large on large tables, each case small."""

import random

import pytest
from pyspark.sql import functions as F

from lingoloom.operators import features as feats
from lingoloom.operators import harvest


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("top", [7, 200_000])
def test_sentences_are_counted_and_weighed_where_they_are(spark, monkeypatch, top):
    """no row a sentence and word is made of words that the tasks know; the outcome is the feature table's, whatever they know."""
    monkeypatch.setattr(feats, "TOP", top)
    draw = random.Random(4)
    words = ["".join(draw.choice("аәбвгеёикуүцюяъьтлнң") for _ in range(draw.randint(1, 30 if i % 9 == 0 else 7))) for i in range(70)]
    texts = [" ".join(draw.choices([*words, "KГЕЯ", "Ёл"], k=draw.randint(0, 25))) + draw.choice(["", ", 1", " «٣»", "İ", "ab𝟙cГӘ"]) for _ in range(150)]
    rows = spark.createDataFrame([(f"s{i}", t) for i, t in enumerate([*texts, "", None])], "key string, sentence string").repartition(3).persist()
    for low, high in ((2, 10_000), (3, 9)):
        table = feats.feature_table(rows, "key", low, high).persist()
        counts = feats.corpus_counts(rows)
        got = feats.corpus_document_frequencies(rows, low, high, counts=counts, key="key")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, feats.document_frequencies(table).collect()))
        assert feats.counted_sentences(counts) == 151
        scores = feats.corpus_scores(rows, "key", 151, low, high, counts=counts)
        expected = {r.key: r for r in feats.scored(table, "key", 151).collect()}
        for r in scores.collect():
            e = expected.pop(r.key)
            assert (r.base_score, r.diversity_score, r.conditional_letter_count) == (pytest.approx(e.base_score), pytest.approx(e.diversity_score), e.conditional_letter_count)
        assert not expected
        for df in (got, scores):
            assert "explode(regexp_extract_all" not in optimized(df)
    spark.catalog.clearCache()


def _judged(spark):
    draw = random.Random(9)
    rows = [(d, 0, 0, i, f"s {draw.randrange(40)}", i, "accepted", draw.choice(["conditional", "mixed_harmony"]), f"k{draw.randrange(40)}", draw.choice(["candidate"] * 4 + ["skipped_quality"])) for d in range(30) for i in range(draw.randrange(9))]
    return spark.createDataFrame(rows, "id long, window int, window_start int, position int, sentence string, start int, reason string, keep_reason string, key string, disposition string").repartition(3)


@pytest.mark.parametrize("owners_keep", [True, False])
def test_fates_need_no_texts(spark, owners_keep):
    """Duplicates and caps are found without the sentences; F6: where they are wanted, they meet their fates once."""
    config = harvest.HarvestConfig(max_candidates_per_doc=2, owners_keep=owners_keep)
    rows = _judged(spark)
    fates = [{(r.id, r.position): (r.disposition, r.rank) for r in harvest.dedup_and_cap(t, config).collect()} for t in (rows, harvest.narrow(rows))]
    assert fates[0] == fates[1] and len(fates[0]) == rows.count()
    assert {"kept", "doc_cap", "doc_duplicate", "global_duplicate", "skipped_quality"} == {d for d, _ in fates[0].values()}
    moved = [x for x in optimized(harvest.dedup_and_cap(rows, config)).splitlines() if "Window [" in x or "RepartitionByExpression" in x]
    assert moved and not any("sentence" in x for x in moved)
    spark.catalog.clearCache()
