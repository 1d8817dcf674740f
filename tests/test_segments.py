"""Sentences of random texts against a plain scan, one character at a time."""

import random
import re

from pyspark.sql import functions as F

from lingoloom.functions.profile import TATAR
from lingoloom.functions.segment import clean_text, sentences

END, CLOSING = ".!?…", "\"'»”’)]}"
UPPER, LOWER = re.compile(f"[{TATAR.upper}]"), re.compile(f"[{TATAR.lower}]")


def _next(text, at):
    while at < len(text) and text[at].isspace():
        at += 1
    return at


def test_boundaries_match_a_plain_scan(spark):
    draw = random.Random(11)
    pieces = ["алма", "Бакча", "күл", "Әби", "3.5", "12", "«Кил", "кил»", "һава.", "Су!", "Ник?", "йөри…", "!»", ".)", "\n", "\n\n", "тау", "Урман", "зур,", "(бар)", "яр;"]
    texts = [" ".join(draw.choices(pieces, k=draw.randint(1, 25))) for _ in range(400)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", clean_text(F.col("t")).alias("clean"), sentences(F.col("t"), 1, 10_000).alias("s")).collect()
    for r in rows:
        found = [(s.start, s.end) for s in r.s]
        assert all(r.clean[a:b] == s.sentence for (a, b), s in zip(found, r.s, strict=True))
        # spans keep every visible character, in order, once
        assert "".join("".join(s.sentence.split()) for s in r.s) == "".join(r.clean.split())
        for (_, b), (a, _) in zip(found, found[1:], strict=False):
            gap = r.clean[b:a]
            before = r.clean[b - 1]
            if "\n" in gap:
                assert before in END + CLOSING or UPPER.match(r.clean[a])
            else:
                stem = r.clean[:b].rstrip(CLOSING)
                assert stem[-1] in END and gap.isspace() and not LOWER.match(r.clean[a])
        # and nothing inside a span is a boundary by itself
        for a, b in found:
            for k in range(a, b - 1):
                if r.clean[k] in "!?…":
                    after = k + 1
                    while after < b and r.clean[after] in END + CLOSING:
                        after += 1
                    if after < b and r.clean[after].isspace():
                        assert LOWER.match(r.clean[_next(r.clean, after)]) or r.clean[k + 1] in END
