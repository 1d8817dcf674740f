"""The pipeline stage by stage against brute force on a small fixture."""

import hashlib
import math
import random
from itertools import combinations

import public_tokenizers
import pytest
import tiktoken
from test_dedup import _components, _line_sets, _shingles

import corpus_pipeline
from lingoloom.llm.bpe import read_ranks
from lingoloom.llm.lines import normalised


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    draw = random.Random(12)
    word = lambda: "".join(draw.choices("aeioulnrst", k=draw.randint(2, 7)))
    docs, labels = [], []
    notice = " ".join(word() for _ in range(12))
    for i in range(90):
        lines = [" ".join(word() for _ in range(draw.randint(20, 60))) for _ in range(3)]
        bad = i % 5 == 0
        text = "\n".join(" ".join(w + "$$$" for w in x.split()) if bad else x for x in lines)
        if not bad and i % 4 == 0:
            text += "\n" + notice
        docs.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, int(not bad), 0))
    for i, of in ((90, 1), (91, 2), (92, 7)):  # copies with other line breaks, so that lines differ but words don't
        text = docs[of][1].replace("\n", " ")
        docs.append((i, text, "en", "s0", len(text)))
    root = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return f"file://{root}"


def _lines(docs):
    places = [(i, k, normalised(x)) for i, t in sorted(docs.items()) for k, x in enumerate(t.split("\n")) if normalised(x)]
    sets = [_line_sets(x) for *_, x in places]
    links = [(a, b) for a, b in combinations(range(len(places)), 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    keep = {places[k][:2] for k, r in _components(range(len(places)), links).items() if k == r}
    return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if not normalised(x) or (i, k) in keep) for i, t in docs.items()}


def _near(docs):
    sets = {i: _shingles(t) for i, t in docs.items()}
    links = [(a, b) for a, b in combinations(sorted(sets), 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    root = _components(sets, links)
    return {i: t for i, t in docs.items() if root[i] == i}


def _mixed(docs, source):
    chars = {}
    for i, t in docs.items():
        chars[source[i]] = chars.get(source[i], 0) + len(t)
    total = sum(math.sqrt(c) for c in chars.values())
    out = []
    for i, t in docs.items():
        c = chars[source[i]]
        rate = math.sqrt(c) / total * sum(chars.values()) / c
        u = int(hashlib.sha256(f"17|{i}|1".encode()).hexdigest()[:13], 16) / (1 << 52)
        k, p = 0, math.exp(-rate)
        cdf = p
        while cdf <= u:
            k += 1
            p *= rate / k
            cdf += p
        out += [i] * k
    return sorted(out)


def test_stages_match_brute_force(spark, folder):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "mixing", "tokens"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, source = docs.columns, {r.doc_id: r.source for r in docs.collect()}
    stage = {n: (lambda d, f=f: f(spark, d, folder)) for n, f in corpus_pipeline.STAGES}
    texts = lambda d: {r.doc_id: r.text for r in d.collect()}

    good = stage["quality"](docs).persist()
    kept = texts(good)
    assert good.columns == columns and set(kept) == {i for i in range(93) if i >= 90 or i % 5}
    lines = stage["line_dedup"](good).persist()
    expected = _lines(kept)
    assert lines.columns == columns and texts(lines) == expected and sum(t.count("\n") for t in kept.values()) > sum(t.count("\n") for t in expected.values())
    assert all(r.n_chars == len(r.text) for r in lines.collect())
    near = stage["near_dedup"](lines).persist()
    expected = _near(expected)
    assert near.columns == columns and texts(near) == expected and not {90, 91, 92} & set(expected)
    mixed = stage["mixing"](near).persist()
    assert mixed.columns == columns and sorted(r.doc_id for r in mixed.collect()) == _mixed(expected, source)
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={p: i for i, p in enumerate(read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))}, special_tokens={})
    rows = stage["tokens"](mixed).collect()
    assert len(rows) == mixed.count() and all(r.ids == known.encode_ordinary(expected[r.doc_id]) and r.decoded_sha256 == hashlib.sha256(expected[r.doc_id].encode()).hexdigest() for r in rows)
    assert sorted((r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, folder).collect()) == sorted((r.doc_id, r.ids_sha256) for r in rows)


def test_exact_copies_leave_no_empty_documents(spark, folder):
    docs = spark.createDataFrame([(i, "one line of the text\nand another line of it", "en", "s0", 1) for i in range(20)] + [(20, "", "en", "s0", 0), (21, "its own line", "en", "s0", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in corpus_pipeline.line_dedup(spark, docs, folder).collect()) == [0, 20, 21]


def test_near_dedup_links_from_four_fifths(spark, folder):
    words = [f"w{i}" for i in range(104)]
    other = [*words[:-10], *(f"x{i}" for i in range(10))]  # 90 of 110 shingles: 0.82
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(other))], "doc_id long, text string")
    assert [r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, folder).collect()] == [1]
