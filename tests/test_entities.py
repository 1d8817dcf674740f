"""Character references and case folding against Python's own tables; words of dictionary entries."""

import html
import re
import unicodedata

from pyspark.sql import functions as F

from lingoloom.functions import text as T
from lingoloom.operators import lexicon


def test_references_equal_the_library(spark):
    names = [f"x&{n}y &{n}" for n in html.entities.html5]
    numbers = [f"&#{i};&#x{i:X};" for i in (*range(0x180), 0xD7FF, 0xD800, 0xDFFF, 0xFDD0, 0xFFFD, 0xFFFE, 0xFFFF, 0x10000, 0x1FFFE, 0x10FFFD, 0x10FFFF, 0x110000, 10**9, 10**30)]
    others = ["", "&", "&&amp;;", "&amp;lt;", "&notit;", "&notin;", "&ampamp", "&no;", "&#;", "&#x;", "&#00065;&#x0041", "&#65 &#x41g", "&unknown; &lt &LT&gt;", "a & b &c", "&" + "q" * 40 + ";", "&#0;&#00;", "&AMP;&Amp;", "ünï &nbsp;·"]
    texts = names + numbers + others
    got = [r.t for r in spark.createDataFrame(list(enumerate(texts)), "i int, s string").select("i", T.unescape(F.col("s")).alias("t")).orderBy("i").collect()]
    assert [(t, g) for t, g in zip(texts, got, strict=True) if html.unescape(t) != g] == []


def test_folding_equals_the_library(spark):
    letters = [c for c in map(chr, (*range(1, 0xD800), *range(0xE000, 0x110000))) if unicodedata.category(c) != "Cn"]  # the JVM may know newer ones
    texts = ["".join(letters[i : i + 64]) for i in range(0, len(letters), 64)] + ["ΣΑΣ ΟΔΟΣ", "Straße", "İIıi", "ŉ ﬁ ẞ", ""]
    got = [r.t for r in spark.createDataFrame(list(enumerate(texts)), "i int, s string").select("i", T.casefold(F.col("s")).alias("t")).orderBy("i").collect()]
    assert [(a, b) for a, b in zip(map(str.casefold, texts), got, strict=True) if a != b] == []


ENTRY = "<html><body><p><b>sample</b> [x] <i>{}</i>\n{}</p></body></html>"


def _found(spark, pages):
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string").select("i", lexicon.cyrillic_tokens(F.col("html")).alias("c"), lexicon.latin_tokens(F.col("html")).alias("l")).orderBy("i").collect()
    return [(list(r.c), list(r.l)) for r in rows]


def test_tokens_of_entries(spark):
    pages = [
        ENTRY.format("v", "1) ташлап китәргә, ташларга; 2) баш тартырга"),
        ENTRY.format("V.", "1) taşlap kitärğä, taşlarğa; 2) baş tartırğa"),
        ENTRY.format("n", "тәү-тә, мәс’әлә Ёлка а"),
        ENTRY.format("n", "waqıt-ara mäs’älä PL reflex Adj İnt ƏLİF x"),
        "<p>Latin words, and İ ə front's сүз - юл-</p>",
        "<p>" + "ю " * 60 + "n кала</p>",
        "<p>a <script>n чит()</script><style>сыр</style> n өй</p>outside<p>n (җәя) [җәя] ике</p>",
        "",
    ]
    got = _found(spark, pages)
    assert got[0][0] == ["ташлап", "китәргә", "ташларга", "баш", "тартырга"] and got[1][1] == ["taşlap", "kitärğä", "taşlarğa", "baş", "tartırğa"]
    assert got[2][0] == ["тәү-тә", "мәс’әлә", "ёлка"]
    assert got[3][1] == ["waqıt-ara", "mäs’älä", "adj", "əli̇f"]
    assert got[4][0] == ["сүз", "юл"] and got[5][0] == ["кала"]
    assert got[6][0] == ["өй", "ике"] and got[7] == ([], [])


def test_labels_of_entries(spark):
    words = {"роль": "RL", "шофёр": "RL", "вакыт": "N", "вәра": "RL", "нәра": "N", "кәнишә": "N"}
    got = spark.createDataFrame([(w,) for w in words], "w string").select("w", lexicon.antat_label(F.col("w")).alias("l")).collect()
    assert {r.w: r.l for r in got} == words


def test_gaps_and_mismatches(spark):
    pairs = spark.createDataFrame([(1, "H", 0, "вакыт", "waqıt", "N"), (1, "H", 1, "проект", "proyekt", "RL"), (2, "K", 0, "вакыт", "zzz", "N")], "align_id long, headword string, position int, cyrillic string, latin string, label string")
    covered = lexicon.coverage(pairs)
    assert {(r.latin, r.coverage) for r in covered.collect()} == {("waqıt", "native"), ("proyekt", "loanword"), ("zzz", "gap")}
    (line,) = [r.line for r in lexicon.gap_lines(covered).collect()]
    assert re.match(r"вакыт -> expected zzz, N got .+, RL got .+, letters=вкы, headword=K, align_id=2$", line)
    lines = [r.line for r in lexicon.mismatch_lines(pairs.unionByName(pairs.where("align_id = 2")), limit=1).collect()]
    assert lines == ["вакыт -> expected zzz, got waqıt, label=N, headword=K, align_id=2", "... 1 more"]
