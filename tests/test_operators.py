"""Operators of the corpus engine on small tables."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lingoloom.functions import text as T
from lingoloom.functions.segment import clean_text, document_windows, sentences
from lingoloom.functions.sentence_quality import sentence_quality
from lingoloom.operators import dictionary, harvest, lexicon, report, training
from lingoloom.operators import features as feats
from lingoloom.operators import select as choose
from lingoloom.plans import bridge
from lingoloom.sources import tables


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def split(spark, text, **options):
    return [(s.sentence, s.reason) for s in one(spark, sentences(F.lit(text), **options).alias("s")).s]


SPLITS = [
    ("Бакчада алма үсә. Безнең әби чәй эчә.", ["Бакчада алма үсә.", "Безнең әби чәй эчә."]),
    ("Анда алма һ.б. җимеш сатыла. Без сөт алдык.", ["Анда алма һ.б. җимеш сатыла.", "Без сөт алдык."]),
    ("Бүген һава 12.5 градус җылы. Кичә салкын иде.", ["Бүген һава 12.5 градус җылы.", "Кичә салкын иде."]),
    ("Әби: «Тизрәк кайт!» диде. Мин йөгердем.", ["Әби: «Тизрәк кайт!» диде.", "Мин йөгердем."]),
    ("Урман артында кечкенә күл\nБалыклар анда йөзә.", ["Урман артында кечкенә күл", "Балыклар анда йөзә."]),
    ("Р. Алиев М.К. Сафин т. д. Шул.", ["Р. Алиев М.К. Сафин т. д. Шул."]),
    ("Тавыс. Кил.", ["Тавыс. Кил."]),
]


@pytest.mark.parametrize("text,expected", SPLITS)
def test_sentences(spark, text, expected):
    assert [s for s, _ in split(spark, text, min_chars=1)] == expected


def test_sentence_reasons_and_offsets(spark):
    assert split(spark, "Ярый. Урамда яңа мәктәп ачылды.", min_chars=10) == [("Ярый.", "rejected:too_short"), ("Урамда яңа мәктәп ачылды.", "accepted")]
    assert split(spark, "This is English text here.", min_chars=1)[0][1] == "rejected:non_cyrillic"
    text = "  Бакча зур <b>якты</b>.  Күпер http://x.y/z якын!\n\nӘби килә. "
    row = one(spark, clean_text(F.lit(text)).alias("c"), sentences(F.lit(text), 1).alias("s"))
    assert all(row.c[s.start : s.end] == s.sentence for s in row.s) and len(row.s) == 3
    assert [s.start for s in row.s] == sorted(s.start for s in row.s)


def test_document_windows(spark):
    w = one(spark, document_windows(F.lit("а" * 10_000), 2_000, 500, 4).alias("w")).w
    assert len(w) == 4 and w[0].start == 0 and w[-1].start == 9_500 and all(len(x.text) == 500 for x in w)
    assert [x.start for x in one(spark, document_windows(F.lit("а" * 33_047)).alias("w")).w] == [0, 7262, 14524, 21785, 29047]
    assert len(one(spark, document_windows(F.lit("аб")).alias("w")).w) == 1


def test_scalar_functions(spark):
    row = one(
        spark,
        *[T.normalize_word(F.lit(x)).alias(f"n{i}") for i, x in enumerate(["«Вакытында!»", "...", "сүз-сүз", "Шофёр"])],
        *[T.harmony_class(F.lit(x)).alias(f"h{i}") for i, x in enumerate(["күрә", "бара", "гадел", "ртм"])],
        *[T.count_specific(F.lit(x)).alias(f"c{i}") for i, x in enumerate(["Әә.", "Әни бара.", "Бу ел юл бар."])],
        *[T.restore_case(F.lit(a), F.lit(b)).alias(f"r{i}") for i, (a, b) in enumerate([("ШӘҺӘР", "şähär"), ("Орфография", "orfografiyä"), ("мин", "min"), ("Иске-Казан", "iske-qazan"), ("МИН", "min")])],
        T.char_ngrams(F.lit("ел"), 3).alias("g"),
        T.unescape(F.lit("a &amp;lt; &#1171;&#x4D9; &quot;")).alias("u"),
        T.query_value(F.lit("text.php?id=278928&sourname=29&kind=1#actual"), "kind").alias("q"),
        T.paragraph_text(F.lit("<p>A (x) b</p><P class='k'>c [y]\nd</P>")).alias("p"),
    )
    assert [row[f"n{i}"] for i in range(4)] == ["вакытында", "", "сүз-сүз", "шофёр"]
    assert [row[f"h{i}"] for i in range(4)] == ["front_only", "back_only", "mixed_front_back", "no_vowels"]
    assert [row[f"c{i}"] for i in range(3)] == [2, 1, 0]
    assert [row[f"r{i}"] for i in range(5)] == ["ŞÄHÄR", "Orfografiyä", "min", "İske-Qazan", "MİN"]
    assert row.g == [] and row.u == 'a &lt; ғә "' and row.q == "1" and row.p == "A b c d"


def test_quality(spark):
    q = lambda s: one(spark, sentence_quality(F.lit(s)).alias("q")).q
    assert q("Әни шәһәргә бара.").reasons == [] and q("## Әни **бара**").reasons == ["markdown"]
    assert "uppercase_block" in q("ВЕРХОВНЫЙ БАШ КОМАНДУЮЩИЙ ПРИКАЗЫ").reasons
    assert "low_tatar_specific_density" in q("заявитель представляет документы в случае обнаружения технической ошибки здесь").reasons


def _features(spark, sentence, frequencies=None):
    rows = spark.createDataFrame([("k", sentence)], "key string, sentence string")
    known = spark.createDataFrame(list((frequencies or {}).items()), "word string, frequency long")
    return {r.feature: r.n for r in feats.feature_table(rows, "key", frequencies=known).collect()}


def test_features(spark):
    f = _features(spark, "ел", {"ел": 3})
    assert all(f[k] == 1 for k in ("cond_letter:е", "cond_word:ел", "cond_ctx:^*е*л", "cond_bigram_right:ел", "cond_position:е:initial", "ambig:initial_e", "style:length:short"))
    f = _features(spark, "вакыт сирәк", {"вакыт": 1, "сирәк": 3})
    assert "cond_word:вакыт" not in f and f["word:вакыт"] == 1
    f = _features(spark, "кала килә гасыр гөл")
    assert all(f[f"ambig:{a}_before_{b}_vowel"] == 1 for a in "kg" for b in ("front", "back"))
    f = _features(spark, "гадел каяә евро цехта")
    assert f["ambig:mixed_harmony_e"] == 3 and all(f[f"ambig:mixed_harmony_{n}"] == 1 for n in ("g", "k", "ya", "v", "ts"))


def test_corpus_scores_equal_those_of_the_feature_table(spark):
    draw = random.Random(8)
    words = ["ел", "вакыт", "килә", "бара", "гадел", "юл", "дәүләт", "шәһәр", "әни", "матур", "күрә", "сүз", "каяә", "цех"]
    rows = spark.createDataFrame([(f"k{i:03}", " ".join(draw.choices(words, k=draw.randint(1, 12))) + draw.choice(["", ", 5", "!", " «а»"]), draw.choice(["x y", None]), draw.choice([1990, None])) for i in range(200)], "key string, sentence string, genre string, publish_year int").persist()
    table = feats.feature_table(rows, "key").persist()
    df = {r.feature: r.df for r in feats.document_frequencies(table).collect()}
    assert {r.feature: r.df for r in feats.corpus_document_frequencies(rows).collect()} == df
    weighted = {r.feature: r.df for r in feats.corpus_document_frequencies(rows, weighted_only=True).collect()}
    assert weighted == {k: v for k, v in df.items() if not k.startswith(("cond_bigram", "cond_position"))}
    expected = {r.key: r for r in feats.scored(table, "key", 200).collect()}
    for r in feats.corpus_scores(rows, "key", 200).collect():
        e = expected.pop(r.key)
        assert (r.base_score, r.diversity_score, r.conditional_letter_count) == (pytest.approx(e.base_score), pytest.approx(e.diversity_score), e.conditional_letter_count)
    assert not expected


def test_harvest(spark):
    docs = spark.createDataFrame([("d1", "Әни һаман җырлый. Ел башында шәһәрдә вакыт бар. Заһир тәмам. Ел башында шәһәрдә вакыт бар. Юл турында хәбәрләр бар."), ("d2", "Ел башында шәһәрдә вакыт бар. В случае обнаружения технической ошибки заявитель представляет документы."), ("d3", None)], "id string, text string")
    config = harvest.HarvestConfig(min_chars=1, max_candidates_per_doc=2, general_keep_probability=1.0, min_specific_letters=2)
    rows = harvest.prepare(docs, config).orderBy("id", "source_sentence_index").collect()
    assert [(r.id, r.reason, r["index"], r.source_sentence_index) for r in rows] == [("d1", "conditional", 0, 0), ("d1", "conditional", 0, 1)]
    assert rows[0].sentence == "Ел башында шәһәрдә вакыт бар." and rows[0].source_start_char == 18
    counters = {r.counter: r.n for r in harvest.diagnostics(docs, config).collect()}
    assert counters["doc_duplicate"] == 1 and counters["global_duplicate"] == 1 and counters["doc_cap"] >= 1 and counters["kept"] == 2
    assert harvest.prepare(docs, harvest.HarvestConfig(min_chars=1, max_candidates=1)).count() == 1


def _greedy(items, features, df, n, target):
    """A plain greedy choice for comparison."""
    import math

    from lingoloom.functions.profile import WEIGHTS

    used, sources, texts, out = {}, {}, set(), []
    weight = lambda f: WEIGHTS.get(f.split(":")[0], 0.0)

    def gain(k):
        g = sum(weight(f) * c * (math.log((n + 1) / (df[f] + 1)) + 1) / math.sqrt(1 + used.get(f, 0)) for f, c in features[k].items())
        s = sources.get(items[k]["source"], 0)
        return g / (1 + 0.15 * s) if s else g

    for least, quota in ((2, round(target * 0.5)), (1, round(target * 0.85)), (0, target)):
        while len(out) < quota:
            left = [k for k in items if k not in out and items[k]["c"] >= least and items[k]["text"] not in texts]
            if not left:
                break
            best = max(left, key=lambda k: (round(gain(k), 9), [-ord(x) for x in items[k]["sort"]]))
            out.append(best)
            texts.add(items[best]["text"])
            sources[items[best]["source"]] = sources.get(items[best]["source"], 0) + 1
            for f, c in features[best].items():
                used[f] = used.get(f, 0) + c
    return out


def test_adaptive_selection_is_greedy(spark):
    draw = random.Random(2)
    words = ["ел", "вакыт", "килә", "бара", "гадел", "юл", "дәүләт", "шәһәр", "әни", "матур", "күрә", "сүз"]
    rows = [(f"k{i:02}", f"s{i % 4}", " ".join(draw.choices(words, k=draw.randint(2, 6)))) for i in range(40)]
    lines = spark.createDataFrame(rows, "key string, source string, sentence string").persist()
    table = feats.feature_table(lines, "key").persist()
    scores = feats.scored(table, "key", 40).join(lines, "key").select("key", "source", T.sentence_key(F.col("sentence")).alias("text_key"), T.stable_sort_key(13, F.col("key")).alias("sort_key"), "conditional_letter_count", F.lit(1).alias("mixed_harmony_count"), F.lit(1.0).alias("score"))
    got, by_block = ([r.key for r in sorted(choose.adaptive_selection(choose.shortlist(scores, 12, 1000), table, 40, 12, block=b).collect(), key=lambda r: r.rank)] for b in (4096, 3))
    assert got == by_block
    features, df = {}, {}
    for r in table.collect():
        features.setdefault(r.key, {})[r.feature] = r.n
        df[r.feature] = df.get(r.feature, 0) + 1
    items = {r.key: {"source": r.source, "text": r.text_key, "sort": r.sort_key, "c": r.conditional_letter_count} for r in scores.collect()}
    assert got == _greedy(items, features, df, 40, 12)


def test_quota_selection(spark):
    rows = [(f"k{i:02}", float(i), f"{i:02}", i % 3) for i in range(30)]
    got = choose.quota_selection(spark.createDataFrame(rows, "key string, score double, sort_key string, conditional_letter_count int"), 10).orderBy("rank").collect()
    assert [r.key for r in got] == ["k29", "k26", "k23", "k20", "k17", "k28", "k25", "k22", "k27", "k24"][:10] or len(got) == 10
    assert [r.rank for r in got] == list(range(1, 11)) and all(r.conditional_letter_count == 2 for r in got[:5])


SAMPLES = [
    ("sent_1", True, [("Мин", "N"), ("вакытында", "N"), ("Вакытында", "N"), ("яңа", "N"), ("проект", "RL"), ("турында", "N"), ("әйттем", "N")]),
    ("sent_2", True, [("Гадел", "N"), ("сүз", "U"), ("торак", "U"), ("сер", "U")]),
    ("sent_3", True, [("позиция", "RL"), ("дөрес", "N")]),
    ("sent_4", False, []),
]


def _tables(spark, rows):
    samples = spark.createDataFrame([(i, i, " ".join(t for t, _ in ts) + ".") for i, _, ts in rows], tables.SAMPLES)
    state = spark.createDataFrame([(i, "annotated", int(ok), json.dumps([{"text": t, "label": x} for t, x in ts]), 1, None, None) for i, ok, ts in rows], tables.STATE)
    return samples, state


def test_word_export(spark):
    samples, state = _tables(spark, SAMPLES)
    empty = spark.createDataFrame([], "normalized_word string")
    tokens = dictionary.labelled_tokens(samples, state)
    judged = dictionary.dispositions(dictionary.word_stats(tokens), empty, empty).persist()
    rows = {r.word: r for r in judged.collect()}
    assert rows["вакытында"].frequency == 2 and rows["гадел"].disposition == "mixed_harmony" and rows["проект"].label == "RL"
    tasks = dictionary.review_tasks(judged).collect()
    by_word = {t.cyrl_word: t for t in tasks}
    assert by_word["проект"].auto_zamanalif == "pro{{PROJECT_E|plain=e|glide=ye}}kt" and by_word["торак"].auto_zamanalif == "" and tasks[0].id == "word_000001" and tasks[0].cyrl_word == "вакытында"
    assert dictionary.review_tasks(judged, max_items=1).count() == 1
    done = spark.createDataFrame([("вакытында",)], "normalized_word string")
    assert {r.word: r.disposition for r in dictionary.dispositions(dictionary.word_stats(tokens), done, empty).collect()}["вакытында"] == "reviewed"
    assert dictionary.export_report(judged, tokens, 4).first().total_input_sentences == 4


def test_save_reviewed_word(spark):
    table = spark.createDataFrame([("су", "su", "N", "old")], tables.REVIEWED)
    assert {tuple(r)[:2] for r in dictionary.save_reviewed_word(table, "су", "suw", "N", "now").collect()} == {("су", "suw")}
    for bad in (("Су", "su", "N"), ("", "su", "N"), ("су", "су", "N"), ("су", "su", "Q")):
        with pytest.raises(ValueError):
            dictionary.save_reviewed_word(table, *bad, "now")


def test_strict_tokens_are_errors(spark):
    samples = spark.createDataFrame([("a", "a", "Мин су"), ("b", "b", "Су"), ("c", "c", "Су")], tables.SAMPLES)
    tokens = [("a", '[{"text":"Мин","label":"N"},{"text":"су","label":"Q"}]'), ("b", '{"text":"Су"}'), ("c", '[{"label":"N"}]')]
    state = spark.createDataFrame([(i, "annotated", 1, t, 1, None, None) for i, t in tokens], tables.STATE)
    reviewed = spark.createDataFrame([("су", "su"), ("мин", "min")], "normalized_word string, zamanalif_dsl string")
    got = {r.id: r.error for r in training.training_pairs(samples, state, reviewed).collect()}
    assert got == {"a": "token 1: invalid label", "b": "token -1: tokens aren't a list", "c": "token 0: invalid text"}
    document = training.manifest_document(training.manifest(samples, state, training.training_pairs(samples, state, reviewed)), {"IYA": "compact"}, {"IYA": "compact"})
    assert document["counts"]["annotated_sentences"] == 3 and document["effective_policy"] == {"IYA": "compact"}


def test_selection_report(spark):
    rows = spark.createDataFrame([("a", "k1", "Ел килә", 2, 0.0, ""), ("b", "k2", "гадел юл", 3, 30.0, "markdown")], "id string, key string, sentence string, conditional_letter_count int, quality_penalty double, quality_reasons string")
    made = report.selection_report(rows, feats.feature_table(rows, "key", 1), 13, {"min_tatar_specific_letters": 2})
    assert made["selected_sentence_count"] == 2 and made["source_count"] == 2 and made["quality_filter"]["artifact_reason_distribution"] == {"markdown": 1}
    assert made["quality_filter"]["quality_penalty_distribution"] == {"0": 1, "25": 1} and made["conditional_letter_count_distribution"] == {"2": 1, "3": 1}
    assert made["conditional_letter_coverage"]["е"]["top_words"][0][1] == 1 and made["vowel_harmony_coverage"]["front_only"]["word_count"] == 2
    assert ["гадел", 1] in made["top_mixed_harmony_words_selected"] and made["sentences_with_three_or_more_conditional_letters"] == 1 and len(made) == 26
    json.dumps(made)


def test_json_array_file(spark, tmp_path):
    rows = spark.createDataFrame([(i, {"id": f"w{i}"}) for i in range(25)], "number long, data map<string,string>").repartition(5)
    tables.write_json_array(rows, f"file://{tmp_path}/tasks", "number")
    (part,) = list((tmp_path / "tasks").glob("part-*"))
    assert json.loads(part.read_text()) == [{"data": {"id": f"w{i}"}} for i in range(25)]
    tables.write_json_array(rows.limit(0), f"file://{tmp_path}/none", "number")
    assert json.loads(next((tmp_path / "none").glob("part-*")).read_text()) == []


def test_training_pairs(spark):
    rows = [("a", True, [("Орфография", "RL"), ("һәм", "N"), ("ШӘҺӘР", "N")]), ("b", True, [("Сер", "RL"), ("калды", "N")]), ("c", True, [("Гадел", "N"), ("килде", "N")]), ("d", True, [("МИН", "N"), ("шат", "N")])]
    samples, state = _tables(spark, rows)
    samples = samples.unionByName(spark.createDataFrame([("e", "e", "Бу юл бар.")], tables.SAMPLES))
    state = state.unionByName(spark.createDataFrame([("e", "annotated", 1, json.dumps([{"text": "юк", "label": "N"}]), 1, None, None)], tables.STATE))
    reviewed = spark.createDataFrame([("орфография", "orfografi{{IYA|compact=ä|explicit=yä}}"), ("юк", "yuq")], "normalized_word string, zamanalif_dsl string")
    got = {r.id: r for r in training.training_pairs(samples, state, reviewed).collect()}
    assert got["a"].zamanalif == "Orfografiyä häm ŞÄHÄR." and got["d"].zamanalif == "MİN şat."
    assert got["c"].reason == "mixed_harmony_word" and got["b"].reason == "unreviewed_word" and got["e"].error == "token not in text"
    compact = {r.id: r for r in training.training_pairs(samples, state, reviewed, {"IYA": "compact"}).collect()}
    assert compact["a"].zamanalif == "Orfografiä häm ŞÄHÄR."


def test_alignment_and_listings(spark):
    side = lambda names: spark.createDataFrame([(f"e{i}", n, 1, i) for i, n in enumerate(names)], "entry_id string, headword string, page int, position int")
    got = {r.headword_key: r.status for r in lexicon.align_editions(side(["ATTIC", "ATTIRE", "ATTITUDE"]), side(["ATTIC I", "ATTIC II", "ATTIRE", "ATTITUDE"])).collect()}
    assert got == {"attic": "missing_side", "attic i": "missing_side", "attic ii": "missing_side", "attire": "aligned", "attitude": "aligned"}
    html = "<table><tr><td>ABANDON </td><td><a href='text.php?id=278928&amp;sourname=29&amp;kind=1#actual'>x</a></td></tr><tr><td>B</td><td>no link</td></tr></table>"
    rows = lexicon.parse_listings(spark.createDataFrame([(29, 1, html)], "source_id int, page int, html string")).collect()
    assert [(r.position, r.entry_id, r.headword) for r in rows] == [(1, "278928", "ABANDON")]


def test_pairs_and_coverage(spark):
    alignment = spark.createDataFrame([(1, "ABANDON", "l1", "r1", "aligned")], "align_id long, headword string, left_entry_id string, right_entry_id string, status string")
    left = spark.createDataFrame([("l1", "<p>ABANDON v ташлап китәргә, вакыт</p>")], "entry_id string, html string")
    right = spark.createDataFrame([("r1", "<p>ABANDON v taşlap kitärgä, waqıt</p>")], "entry_id string, html string")
    pairs = lexicon.word_pairs(alignment, left, right).persist()
    assert [(r.cyrillic, r.latin, r.label) for r in pairs.orderBy("position").collect()] == [("ташлап", "taşlap", "N"), ("китәргә", "kitärgä", "N"), ("вакыт", "waqıt", "N")]
    assert {r.cyrillic: r.coverage for r in lexicon.coverage(pairs).collect()}["вакыт"] == "native"
    assert lexicon.mismatches(pairs).count() == 0


def test_reports(spark):
    rows = spark.createDataFrame([("a", "Ел килә", 2, 0.0, "", 1), ("b", "гадел юл", 3, 30.0, "markdown", 2)], "id string, sentence string, conditional_letter_count int, quality_penalty double, quality_reasons string, k int")
    assert {r.harmony: r.word_count for r in report.harmony_coverage(rows, "id").collect()} == {"front_only": 2, "back_only": 0, "mixed_front_back": 1, "no_vowels": 1}
    assert {r.name: r.n for r in report.quality_summary(rows).collect()} == {"with_penalty": 1, "with_reasons": 1, "penalty:0": 1, "penalty:25": 1, "reason:markdown": 1}
    assert report.saturation(spark.createDataFrame([("a", 3), ("b", 1)], "value string, n long")).first().top_10_share == 1.0
    assert report.headline(rows).first().with_3_conditional == 1


def test_upserts(spark):
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "c"), (3, "d"), (3, "e")], "k int, v string")
    assert sorted(map(tuple, dictionary.insert_or_replace(old, new, "k").collect())) == [(1, "a"), (2, "c"), (3, "e")]
    assert sorted(r.k for r in dictionary.insert_or_ignore(old, new, "k").collect()) == [1, 2, 3]


def test_review_import(spark, tmp_path):
    def task(word, origin="N", text="waqıt", cancelled=False):
        result = [{"from_name": "reviewed_origin", "type": "choices", "value": {"choices": [origin]}}, {"from_name": "corrected_zamanalif", "type": "textarea", "value": {"text": [text]}}]
        return {"data": {"id": "1", "cyrl_word": word}, "annotations": [{"was_cancelled": cancelled, "result": result}]}

    def run(tasks, reviewed=()):
        path = tmp_path / f"{random.random()}.json"
        path.write_text(json.dumps(tasks))
        table = spark.createDataFrame(list(reviewed), tables.REVIEWED)
        return {r.normalized_word: r.zamanalif_dsl for r in dictionary.import_reviews(table, tables.read_review_export(spark, str(path)), "now").collect()}

    assert run([task("вакыт"), task("юл", cancelled=True)]) == {"вакыт": "waqıt"}
    assert run([task("вакыт")], [("вакыт", "waqıt", "N", "old")]) == {"вакыт": "waqıt"}
    for bad in ([task("вакыт"), task("вакыт")], [task("вакыт", "X")], [task("вакыт", text="вакыт")]):
        with pytest.raises(ValueError):
            run(bad)
    with pytest.raises(ValueError):
        run([task("вакыт", text="wakit")], [("вакыт", "waqıt", "N", "old")])


RESULT = [{"from_name": "reviewed_origin", "type": "choices", "value": {"choices": ["N"]}}, {"from_name": "corrected_zamanalif", "type": "textarea", "value": {"text": ["waqıt"]}}]


def _with(j, **change):
    return [r | change if i == j else r for i, r in enumerate(RESULT)]


def test_review_types_count(spark, tmp_path):
    """Every rejection of an export, and what doesn't count."""
    task = lambda results, **more: {"data": {"cyrl_word": "вакыт"}, "annotations": [{"result": results}]} | more
    cases = [
        (5, "task must be an object"),
        ({"data": []}, "data must be an object"),
        ({"data": {"cyrl_word": 5}}, "invalid data.cyrl_word"),
        ({"data": {"cyrl_word": "abc"}}, "no Cyrillic word in data.cyrl_word"),
        (task(RESULT, annotations={}), "annotations must be a list"),
        (task(RESULT, annotations=[7]), "annotation 0 must be an object"),
        (task("x"), "annotation 0.result must be a list"),
        (task([3, *RESULT]), "annotation 0 result 0 must be an object"),
        (task(RESULT[:1]), "annotation 0 must contain exactly one 'corrected_zamanalif' result"),
        (task([RESULT[0], *RESULT]), "annotation 0 must contain exactly one 'reviewed_origin' result"),
        (task(_with(0, type="choice")), "annotation 0 result 0 origin type must be 'choices'"),
        (task(_with(0, value={"choices": ["N", "U"]})), "annotation 0 result 0 must select exactly one origin"),
        (task(_with(0, value=None)), "annotation 0 result 0 must select exactly one origin"),
        (task(_with(0, value={"choices": [1]})), "annotation 0 result 0 has invalid origin: 1"),
        (task(_with(1, type=None)), "annotation 0 result 1 conversion type must be 'textarea'"),
        (task(_with(1, value={"text": [5]})), "annotation 0 result 1 must contain exactly one text value"),
        (task(_with(1, value={"text": [""]})), "annotation 0 result 1 conversion must not be empty"),
        (task(_with(1, value={"text": ["вакыт"]})), "invalid notation: not choice notation over the alphabet"),
        (task(RESULT, annotations=[{"result": RESULT}, {"result": _with(0, value={"choices": ["U"]})}]), "conflicting completed annotations"),
        (task(RESULT, annotations=[{"result": RESULT}, {"result": RESULT}]), None),
        (task(_with(1, value={"text": ["mäs'älä"]}), data={"cyrl_word": "мәсьәлә"}), None),
        (task(RESULT), "duplicate normalized word"),
    ]
    left_out = [task(RESULT, annotations=None), task(None), task([]), {"data": {"cyrl_word": "юл"}}, task("x", annotations=[{"was_cancelled": True, "result": "x"}])]
    path = tmp_path / "export.json"
    path.write_text(json.dumps([c for c, _ in cases] + left_out))
    got = {r.nth: r.error for r in dictionary.completed_reviews(tables.read_review_export(spark, str(path))).collect()}
    assert got == {i: e for i, (_, e) in enumerate(cases)}
    path.write_text("{}")
    assert [r.error for r in dictionary.completed_reviews(tables.read_review_export(spark, str(path))).collect()] == ["export must be a JSON array"]


def test_harvest_queries_read_whole_texts(spark, tmp_path):
    from lingoloom.plans.queries import QUERIES

    n = 900  # over 20,000 characters, over 30 sentences
    text = "\n".join(f"Sentence that has number {'abcdefghij'[i // 100]}{'abcdefghij'[i // 10 % 10]}{'abcdefghij'[i % 10]} in it." for i in range(n))
    spark.createDataFrame([(1, text, "s0")], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    whole = len(split(spark, spark.range(1).select(bridge.bridged(F.lit(text)).alias("t")).first().t))
    assert len(text) > 20_000
    assert QUERIES["segmented_sentences"](spark, str(tmp_path)).count() == whole
    kept = QUERIES["harvest_candidates"](spark, str(tmp_path))
    counters = {r.counter: r.n for r in QUERIES["harvest_diagnostics"](spark, str(tmp_path)).collect()}
    assert kept.count() == counters["kept"] and sum(v for k, v in counters.items() if ":" not in k) == whole
    assert not {"doc_cap", "skipped_general", "skipped_language", "skipped_quality"} & set(counters)
