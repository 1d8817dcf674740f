"""Token files: Elias-Fano sequences, shards and the whole round trip against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from lingoloom.llm.token_files import EliasFano, Shard, WordEncoder, read_token_files, write_shard, write_token_files

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("values", [[], [0], [5], [0, 0, 0], [7] * 1000, list(range(2000)), [0, 2**63, 2**64 - 1], [*range(5000), 2**40], [1, 1, 2, 900_000, 900_000], sorted(random.Random(1).randrange(10**9) for _ in range(3000))])
def test_selected_values(values):
    universe = values[-1] if values else 0
    coded = EliasFano.of(np.array(values, dtype=np.uint64), universe)
    again, end = EliasFano.read(memoryview(b"xx" + coded.to_bytes() + b"yy"), 2)
    assert end == 2 + len(coded.to_bytes())
    assert again[np.arange(len(values))].tolist() == values
    order = random.Random(2).sample(range(len(values)), min(50, len(values)))
    assert [again[i] for i in order] == [values[i] for i in order] and (not values or again[-1] == values[-1])
    with pytest.raises(IndexError):
        again[len(values)]


def test_space_is_near_minimal():
    rng = np.random.default_rng(3)
    for n, universe in ((10_000, 10**6), (50_000, 60_000), (4000, 10**9)):
        values = np.sort(rng.integers(0, universe + 1, n))
        assert EliasFano.of(values, universe).bits() <= n * (2 + max(1, np.ceil(np.log2(universe / n)))) * 1.02 + n * 32 / 256 + 256


def test_shards():
    bodies = [[5, 6, 2], [2], [], [1] * 700, [9, 2]]
    raw = write_shard([None, None, -(2**63), 4, 2**63 - 1], np.array(list(map(len, bodies))), np.array(sum(bodies, []), dtype="<u4").tobytes(), 4)
    shard = Shard(raw)
    assert shard.doc_ids() == [None, None, -(2**63), 4, 2**63 - 1] and [shard.ids(i).tolist() for i in range(5)] == bodies
    empty = Shard(write_shard([], np.zeros(0, dtype=np.int64), b"", 2))
    assert empty.n == 0 and empty.doc_ids() == []
    with pytest.raises(ValueError, match="not a token file"):
        Shard(b"x" * 200)


def plain(rows, end=2):
    """(doc_id, start, n_tokens, crc) of rows in the files' order, by the library alone."""
    from tokenizers import Tokenizer

    whole, out, start = Tokenizer.from_file(PATH), [], 0
    for doc_id, text in rows:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, end]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_words_equal_the_library():
    from tokenizers import Tokenizer

    whole, words = Tokenizer.from_file(PATH), WordEncoder(PATH, 2)
    rng = random.Random(4)
    signs = "abcXYZ éÉß.,;:!?&'\"-_()<|>*  \t\n\r0179ΣσςİIıﬁ̸́ͅ日本😀‍  \x0b\x1c=ÀçÅ"
    texts = ["".join(rng.choices(signs, k=rng.randrange(60))) for _ in range(1500)]
    texts += ["it's we'll I'D THEY'VE", "<|endoftext|>x <|startoftext|>", "a.̸b ≠ Å Å.", "straße STRASSE ŒUVRE", "x" * 5000, "word " * 3000]
    for text, got in zip(texts, words.encode(texts), strict=True):
        assert np.frombuffer(got, dtype="<u2").tolist() == [*whole.encode(text, add_special_tokens=False).ids, 2], text


@pytest.mark.parametrize(("shard_ids", "range_bytes"), [(1 << 25, 32 << 20), (40, 2000), (1, 300)])
def test_files_equal_the_library(spark, tmp_path, shard_ids, range_bytes):
    rng = random.Random(5)
    rows = [(i, " ".join("".join(rng.choices("aeiounstr", k=rng.randrange(1, 9))) for _ in range(rng.randrange(40)))) for i in range(-20, 120)]
    rows[7], rows[9] = (rows[7][0], None), (rows[9][0], "")
    shuffled = rng.sample(rows, len(rows))
    docs = spark.createDataFrame([(t, i, 0, "f") for i, t in shuffled], "text string, doc_id long, part int, file string").repartition(6)
    manifest = write_token_files(docs, PATH, str(tmp_path / "out"), 2, shard_ids=shard_ids, range_bytes=range_bytes)
    assert manifest.agg({"n_docs": "sum"}).first()[0] == len(rows) and (shard_ids > 40 or manifest.count() > 30)
    got = read_token_files(spark, str(tmp_path / "out")).orderBy("doc_id").collect()
    assert [tuple(r)[:4] for r in got] == plain(rows)
    assert all(r.ids[-1] == 2 and len(r.ids) == r.n_tokens and zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32 for r in got)


def test_odd_and_empty_tables(spark, tmp_path, odd, nothing):
    write_token_files(odd, PATH, str(tmp_path / "odd"), 2)
    got = [tuple(r) for r in read_token_files(spark, str(tmp_path / "odd"), with_ids=False).orderBy("start").collect()]
    rows = sorted(((r.doc_id, r.text) for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert got == plain(rows)
    write_token_files(nothing, PATH, str(tmp_path / "no"), 2)
    assert read_token_files(spark, str(tmp_path / "no")).collect() == []
