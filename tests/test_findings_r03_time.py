"""What the review of round 3 found too slow or too large, each case small."""

from pyspark.sql import functions as F

from lingoloom.operators import dictionary, harvest, lexicon
from lingoloom.operators.harvest import HarvestConfig, dedup_and_cap
from lingoloom.plans.queries import QUERIES
from lingoloom.streaming import annotation


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_tokens_of_pages_are_read_once(spark):
    """tokens are read below the joins; no filter or condition repeats the patterns."""
    alignment = spark.createDataFrame([(1, "H", "l1", "r1", "aligned"), (2, "H", "l2", "r2", "aligned"), (3, "-H", "l1", "r1", "aligned"), (4, "H", "l1", "r1", "missing_side")], "align_id long, headword string, left_entry_id string, right_entry_id string, status string")
    page = lambda rows: spark.createDataFrame(rows, "entry_id string, html string")
    pairs = lexicon.word_pairs(alignment, page([("l1", "<p>H n Вакыт-лар кала</p>"), ("l2", "<p>H n кала</p>")]), page([("r1", "<p>H n STRAÑE &amp; NO</p>"), ("r2", "<p>H n a b</p>")]))
    assert [tuple(r)[:5] for r in pairs.orderBy("position").collect()] == [(1, "H", 0, "вакыт-лар", "strañe"), (1, "H", 1, "кала", "no")]
    heads = [line for line in optimized(pairs).splitlines() if "Join " in line or "Filter " in line]
    assert heads and not any("regexp" in line for line in heads)


def _sentences(spark, docs):
    schema = "id long, window int, window_start int, position int, sentence string, start int, reason string, keep_reason string, key string, disposition string"
    return spark.createDataFrame([(d, 0, 0, i, k, i, "accepted", "conditional", k, "candidate") for d, keys in enumerate(docs) for i, k in enumerate(keys)], schema)


def test_sentences_are_judged_once(spark):
    """owners and both sides of the split join read what was judged, as segmenting is dear."""
    read = spark.sparkContext.accumulator(0)

    def counted(frames):
        for f in frames:
            read.add(len(f))
            yield f

    rows = _sentences(spark, [["a", "b"], ["b", "c"], ["c", "c"]])
    fates = dedup_and_cap(rows.mapInPandas(counted, rows.schema), HarvestConfig(exhaustive=True))
    assert [r.disposition for r in fates.orderBy("id", "position").collect()] == ["kept", "kept", "global_duplicate", "kept", "global_duplicate", "global_duplicate"]
    assert read.value == 6
    spark.catalog.clearCache()


def test_a_long_chain_takes_few_rounds(spark):
    """blocks of documents are scanned in turn, so rounds are no more than blocks, whatever chains run through them."""
    rows = _sentences(spark, [[f"k{d:03}", f"k{d + 1:03}"] for d in range(60)]).select("id", "key", F.struct("start", "sentence").alias("place"))
    for blocks in (1, 4):
        rounds = []
        count = harvest.join_split
        harvest.join_split = lambda left, right, on, how="inner": (rounds.append("first" in right.columns), count(left, right, on, how))[1]
        try:
            owners = {r.key: r.owner for r in harvest._keepers(rows, 1, blocks).collect()}
        finally:
            harvest.join_split = count
        assert owners == {f"k{d:03}": d for d in range(1, 60)} and sum(rounds) <= blocks + 1
    spark.catalog.clearCache()


SMALL = "/root/testdata/sf0.001"


def test_distributions_in_one_pass(spark):
    """both distributions come from one reading of the texts."""
    assert optimized(QUERIES["selection_distributions"](spark, SMALL)).count("Relation [") == 1


def test_samples_are_numbered_by_counts(spark):
    """numbering deals out a row a document; the ranges hold no text."""
    plan = optimized(QUERIES["selected_samples"](spark, SMALL))
    assert "k0#" not in plan and "struct(id" not in plan
    spark.catalog.clearCache()


def test_reviews_are_judged_once(spark):
    """no filter repeats the reading of annotations."""
    tasks = spark.createDataFrame([(0, '{"data":{"cyrl_word":"кала"},"annotations":[]}'), (1, '{"data":5}')], "nth int, j string").select("nth", F.parse_json("j").alias("task"))
    out = dictionary.completed_reviews(tasks)
    assert [(r.nth, r.error) for r in out.collect()] == [(1, "data must be an object")]
    plan = out._jdf.queryExecution().logical().toString() + optimized(out)
    assert not any("Filter" in line and "annotations" in line for line in plan.splitlines())
    spark.catalog.clearCache()


def test_responses_are_parsed_twice_at_most(spark):
    """once for what is broken, once for the items; duplicates are found among these."""
    rows = spark.createDataFrame([("b", '[{"id":"a","tatar":true,"tokens":[]},{"id":"a"}]')], "line string, body string")
    out = annotation.validated(rows, spark.createDataFrame([("b", "a", "x")], "line string, id string, text string"), "line")
    assert sorted(e for r in out.collect() for e in r.errors) == ["duplicate id: a"]
    assert optimized(out).count("LogicalRDD") + optimized(out).count("LocalRelation") == 3
