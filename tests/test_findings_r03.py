"""What the review of round 3 found, each case small."""

import os

from pyspark.sql import functions as F

from lingoloom.functions import text as T
from lingoloom.functions.profile import TATAR
from lingoloom.operators import dictionary, features, lexicon, report
from lingoloom.operators.harvest import HarvestConfig, dedup_and_cap


def test_owners_that_keep_and_owners_that_have(spark):
    """b is over the cap of the first document: whether the second may keep it is the configuration's choice."""
    schema = "id long, window int, window_start int, position int, sentence string, start int, reason string, keep_reason string, key string, disposition string"
    rows = [(d, 0, 0, i, k, i, "accepted", "conditional", k, "candidate") for d, keys in ((1, "ab"), (2, "bb")) for i, k in enumerate(keys)]
    fates = lambda config: [r.disposition for r in dedup_and_cap(spark.createDataFrame(rows, schema), config).orderBy("id", "position").collect()]
    assert fates(HarvestConfig(max_candidates_per_doc=1)) == ["kept", "doc_cap", "kept", "doc_duplicate"]
    assert fates(HarvestConfig(max_candidates_per_doc=1, owners_keep=False)) == ["kept", "doc_cap", "global_duplicate", "doc_duplicate"]


def test_references_of_plain_texts(spark):
    """All of HTML's references, or the basic ones alone, none of them read twice."""
    html = F.lit("<p>&copy; a&nbsp;b &lt;i&gt; &quot;&#39;&amp;lt;</p><script>x</script>")
    r = spark.range(1).select(T.html_text(html).alias("all"), T.html_text(html, T.unescape_basic).alias("basic")).first()
    assert r["all"] == "© a b <i> \"'&lt;" and r["basic"] == "&copy; a b <i> \"'&lt;"


def test_labels_by_given_letters(spark):
    words = spark.createDataFrame([("вәра",), ("роль",), ("сыәр",)], "w string")
    got = words.select(lexicon.antat_label(F.col("w")).alias("a"), lexicon.antat_label(F.col("w"), TATAR.review).alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [("RL", "N"), ("RL", "RL"), ("RL", "RL")]


def test_words_held_back_without_conversions(spark):
    tokens = spark.createDataFrame([("s", i, w, "N", False) for i, w in enumerate(["вакыт", "вәра", "кала", "кала", "сыр"])], "sample_id string, position int, text string, label string, homonym boolean")
    one = lambda w: spark.createDataFrame([(w,)], "normalized_word string")
    got = dictionary.held_back(dictionary.word_stats(tokens), one("кала"), one("сыр"))
    assert {r.word: r.disposition for r in got.collect()} == {"вакыт": None, "вәра": "mixed_harmony", "кала": "reviewed", "сыр": "already_exported"}
    assert "native_dsl" not in got.columns


def test_review_tasks_read_their_words_once(spark):
    """Numbering looks at its rows several times; what made them runs once."""
    read = spark.sparkContext.accumulator(0)

    def counted(frames):
        for f in frames:
            read.add(len(f))
            yield f

    schema = "word string, display string, label string, frequency long, state string, native_dsl string, loanword_dsl string, disposition string"
    rows = spark.createDataFrame([(f"w{i}", f"w{i}", "N", i, "origin_dependent", "a", "b", "keep") for i in range(20)], schema)
    tasks = dictionary.review_tasks(rows.mapInPandas(counted, schema))
    assert [r.number for r in tasks.orderBy("number").collect()] == list(range(1, 21)) and read.value == 20
    spark.catalog.clearCache()


def test_coverage_shuffles_no_row_a_sentence_and_word(spark):
    """Keys that several rows share count once; sentences and words aren't dealt together."""
    rows = spark.createDataFrame([(1, "вә ра вәра"), (1, "ук, ЁК"), (2, "ке ке"), (None, "ра"), (3, "!")], "key int, sentence string")
    got = report.harmony_coverage(rows, "key")
    assert {tuple(r) for r in got.collect()} == {("front_only", 2, 4, 3), ("back_only", 1, 3, 2), ("mixed_front_back", 1, 1, 1), ("no_vowels", 0, 0, 0)}
    letters = {tuple(r) for r in report.letter_coverage(rows, "key").where("sentence_count > 0").collect()}
    assert letters == {("в", 1, 2, 2), ("е", 2, 3, 2), ("к", 2, 4, 3), ("у", 1, 1, 1)}
    grouped = [line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate [" in line]
    assert not any("key#" in line and "word#" in line for line in grouped)


def test_headline_by_words(spark):
    rows = spark.createDataFrame([(1, "вә ра", 1), (1, "вәра ке", 2), (2, "мәра", 0), (3, "", None)], "id int, sentence string, conditional_letter_count int")
    assert tuple(report.headline(rows).first()) == (4, 3, 2, 1, 0, 2, 1)


def test_letters_of_other_cases(spark):
    r = spark.createDataFrame([("Ә әҢ xЩщь Ёё К\u212a",)], "s string").select(T.count_specific(F.col("s")).alias("n"), T.count_letters(F.lower("s"), TATAR.foreign).alias("f"), T.words_in(F.col("s")).alias("w")).first()
    assert (r.n, r.f, list(r.w)) == (3, 5, ["ә", "әң", "щщь", "ее", "к"])


def test_document_frequencies_of_rows_in_any_order(spark):
    """Shuffled rows arrive in another order each time they are read: frequent and rare words of a sentence still meet."""
    rows = [(f"k{i}", "вакыт" if i % 2 else " ".join(f"вак{chr(0x430 + i % 32)}{chr(0x430 + i // 32)}{b}" for b in "бдзлмнпрст")) for i in range(300)]

    def moved(frames):
        for f in frames:
            yield f.sample(frac=1, random_state=int.from_bytes(os.urandom(4)))

    sentences = spark.createDataFrame(rows, "key string, sentence string")
    want = {r.feature: r.df for r in features.document_frequencies(features.feature_table(sentences, "key")).collect()}
    restless = sentences.coalesce(1).mapInPandas(moved, "key string, sentence string")
    for key in ("key", None):
        got = features.corpus_document_frequencies(restless, key=key)
        assert {r.feature: r.df for r in got.collect()} == want
    spark.catalog.clearCache()
