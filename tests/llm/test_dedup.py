"""Near-duplicate documents and lines against brute force."""

import random
import re
from itertools import combinations

from lingoloom.llm.lines import dedup_lines, normalised
from lingoloom.llm.linking import components
from lingoloom.llm.neardup import near_duplicates, without_near_duplicates
from lingoloom.llm.scratch import Scratch


def _components(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def _shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _corpus(seed=3):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdefghij", k=draw.randint(2, 6)))
    texts = []
    for _ in range(60):
        base = [word() for _ in range(draw.randint(3, 300))]
        texts.append(" ".join(base))
        for _ in range(draw.choice([0, 0, 1, 3, 8])):  # copies with up to a few edits
            copy = list(base)
            for _ in range(draw.randint(0, 6)):
                copy[draw.randrange(len(copy))] = word()
            texts.append("  ".join(copy).upper() if draw.random() < 0.2 else " ".join(copy))
    draw.shuffle(texts)
    return texts


def test_components_of_chains_and_stars(spark):
    draw = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(draw.randrange(200, 260), draw.randrange(200, 260)) for _ in range(50)]
    edges = [(a, b) for a, b in edges if a != b]
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark)).collect()}
    assert got == _components({x for e in edges for x in e}, edges)


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark)).count() == 0


def test_near_duplicates_match_brute_force(spark):
    texts = _corpus()
    sets = {i: _shingles(t) for i, t in enumerate(texts)}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    assert len(links) > 50
    expected = _components(sets, links)
    got = near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (len(sets[i]), expected[i], expected[i] == i) for i in sets}


def test_a_large_group_of_copies_is_one_component(spark):
    draw = random.Random(8)
    base = [f"w{draw.randrange(10**6)}" for _ in range(200)]
    rows = []
    for i in range(400):
        copy = list(base)
        copy[draw.randrange(200)] = f"e{i}"
        rows.append((i, " ".join(copy)))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {0}


def test_pairs_inside_a_large_family_are_found(spark):
    """Texts of one template, similar but unlinked, with real pairs far apart among them."""
    draw = random.Random(21)
    words = lambda n: [f"w{draw.randrange(10**7)}" for _ in range(n)]
    template = words(176)
    texts = [template + words(24) for _ in range(1500)]  # 172 shingles of 220 shared: 0.78
    pairs = [(k, 1500 + k) for k in range(60)]
    for k, _ in pairs:
        texts.append(texts[k][:-14] + words(14))  # 182 of 210: 0.87
    got = near_duplicates(spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i - 1500 if i >= 1500 else i for i in range(1560)}


def test_line_pairs_inside_a_large_family_are_found(spark):
    draw = random.Random(22)
    text = lambda n: "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    template = text(150)
    lines = [template + text(30) for _ in range(1200)]  # 143 shingles of 203 shared: 0.70
    lines += [lines[k][:-16] + text(16) for k in range(60)]  # 157 of 189: 0.83
    got = dedup_lines(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id for r in got if r.n_dropped} == set(range(1200, 1260))


def test_lines_of_unicode_white_space_are_blank(spark):
    got = dedup_lines(spark.createDataFrame([(1, "one line\n\u00a0\u2003\n\u00a0"), (2, "\u00a0\nother line")], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_lines, r.n_dropped) for r in got) == [(1, 1, 0), (2, 1, 0)]


def test_a_very_common_line_and_a_text_of_many_lines(spark):
    rows = [(i, f"common notice of all\nown line number {i} {i * 7919}") for i in range(1500)] + [(9999, "\n".join(f"{k} {k * k} unlike" for k in range(20_000)))]
    got = {r.doc_id: r for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).select("doc_id", "text", "n_lines").collect()}
    assert "common notice" in got[0].text and not any("common notice" in got[i].text for i in range(1, 1500))
    assert got[9999].n_lines == 20_000


def test_clashing_names_come_back(spark):
    odd_names = "doc_id long, text string, doc string, hash string, unnumbered string, `drop` string, `row` string, home string, `a.b` string"
    docs = spark.createDataFrame([(1, "some line of text", *"abcdefg"), (2, "some line of text", *"hijklmn")], odd_names)
    for out in (dedup_lines(docs).drop("n_lines", "n_dropped"), without_near_duplicates(docs)):
        assert out.columns == docs.columns and tuple(out.where("doc_id = 1").first()) == (1, "some line of text", *"abcdefg")


def test_near_duplicates_of_odd_rows(spark, odd, nothing):
    got = near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by_id = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got}
    assert by_id[1] == (4, 1, True) and by_id[None] == (4, 1, False)
    assert by_id[2] == (0, 2, True) and by_id[4] == (0, 4, True) and by_id[5] == (1, 5, True) and by_id[7] == (1, 7, True)
    assert near_duplicates(nothing).count() == 0
    left = without_near_duplicates(odd)
    assert left.columns == odd.columns and left.where("doc_id is null").count() == 0 and left.count() == odd.count() - 1


def _line_sets(line):
    return {line[i : i + 8] for i in range(max(1, len(line) - 7))}


def test_lines_match_brute_force(spark):
    draw = random.Random(5)
    pool = ["".join(draw.choices("abcdefghijkl ", k=draw.randint(1, 200))) for _ in range(60)]
    docs = []
    for i in range(40):
        lines = []
        for _ in range(draw.randint(0, 8)):
            line = list(draw.choice(pool))
            if draw.random() < 0.4 and line:
                line[draw.randrange(len(line))] = "z"
            lines.append("".join(line))
        docs.append((i, "\n".join(lines)))
    places = [(i, k, normalised(x)) for i, t in docs for k, x in enumerate(t.split("\n")) if normalised(x)]
    sets = [_line_sets(x) for *_, x in places]
    links = [(a, b) for a, b in combinations(range(len(places)), 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = _components(range(len(places)), links)
    keep = {places[r][:2] for k, r in root.items() if k == r}
    expected = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if not normalised(x) or (i, k) in keep) for i, t in docs}
    got = dedup_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: r.text for r in got} == expected
    assert sum(r.n_dropped for r in got) == len(places) - len(keep) > 20


def test_lines_of_odd_rows(odd, nothing):
    out = dedup_lines(odd.withColumnRenamed("kept", "n_dropped"))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_lines", "n_dropped"]
    rows = out.collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].text is None and by_id[3].text == "" and by_id[4].text == " \t\n "
    assert [r.text for r in rows if r.doc_id == 1] == ["alpha beta gamma delta epsilon zeta eta theta"] * 2
    assert by_id[None].text == "" and by_id[None].n_dropped == 1  # repeats the line of document 1
    assert by_id[6].text == "Ünïcödé 😀 one\ntwo\n\ntwo three four" and by_id[6].n_lines == 3
    assert dedup_lines(nothing).count() == 0
