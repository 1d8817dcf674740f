"""Token ids in binary files: one array of ids, Elias-Fano encoded document boundaries.

A shard holds the ids of consecutive documents in ascending id order: a header,
the documents' ids and ends as Elias-Fano sequences, then all token ids as
unsigned 16- or 32-bit integers. Where a document begins is a ``select`` over
a bit vector; no table of 64-bit offsets exists, on disk or in memory.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .hashing import blocks
from .scratch import shared_folder

MAGIC, VERSION = b"LOOMTOK\n", 1
#: Ones between two sampled positions of a bit vector, low bits of a value at most.
SAMPLE, LOW = 256, 56
#: Bytes of text about that a range of documents holds, ranges at most, keys looked at for each cut, token ids of a shard about.
RANGE_BYTES, RANGES, LOOKED_AT, SHARD_IDS = 32 << 20, 20_000, 20, 1 << 25
#: Words that a task remembers before it starts anew.
REMEMBERED = 700_000

_HEADER = "<8sIIQQQqQQ"
_SEQUENCE = "<QQIIQ"


class EliasFano:
    """A non-decreasing sequence of n unsigned integers up to ``universe`` in about n * (2 + log2(universe / n)) bits.

    The low bits of all values lie packed one after another; the high parts
    are a bit vector in unary, with the position of each SAMPLE-th one stored
    in 32 bits. ``self[i]`` and ``self[array]`` select in it.
    """

    def __init__(self, n: int, universe: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.universe, self.low_bits = n, universe, low_bits
        self.low = np.frombuffer(low + bytes(8), dtype=np.uint8)
        self.words = np.frombuffer(high + bytes(-len(high) % 8 + 8), dtype="<u8")
        self.samples = np.frombuffer(samples, dtype="<u4")
        self.raw = (low, high, samples)

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        low_bits = min(LOW, max(0, ((universe + 1) // max(1, n)).bit_length() - 1))
        shift = np.uint64(low_bits)
        bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
        places = (values >> shift).astype(np.int64) + np.arange(n)
        if n and places[-1] >= 1 << 32:
            raise ValueError("too many values for 32-bit positions; write smaller shards")
        vector = np.zeros((universe >> low_bits) + n + 1 if n else 0, dtype=np.uint8)
        vector[places] = 1
        return cls(n, universe, low_bits, low, np.packbits(vector, bitorder="little").tobytes(), places[::SAMPLE].astype("<u4").tobytes())

    def to_bytes(self) -> bytes:
        low, high, samples = self.raw
        return struct.pack(_SEQUENCE, self.n, self.universe, self.low_bits, len(samples), len(high)) + low + high + samples

    @classmethod
    def read(cls, data: memoryview, at: int) -> tuple[EliasFano, int]:
        """The sequence that begins at a byte, and the byte behind it."""
        n, universe, low_bits, n_samples, n_high = struct.unpack_from(_SEQUENCE, data, at)
        at += struct.calcsize(_SEQUENCE)
        ends = np.cumsum([at, (n * low_bits + 7) // 8, n_high, n_samples]).tolist()
        return cls(n, universe, low_bits, *(bytes(data[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True))), ends[-1]

    def select(self, i: np.ndarray) -> np.ndarray:
        """Positions of the i-th ones (from 0)."""
        at = self.samples[i // SAMPLE].astype(np.int64)
        left = i % SAMPLE
        word = at >> 6
        bits = self.words[word] & (~np.uint64(0) << (at & 63).astype(np.uint64))
        count = np.bitwise_count(bits).astype(np.int64)
        behind = np.flatnonzero(left >= count)
        while len(behind):  # on to the word that holds the one sought
            left[behind] -= count[behind]
            word[behind] += 1
            bits[behind] = self.words[word[behind]]
            count[behind] = np.bitwise_count(bits[behind])
            behind = behind[left[behind] >= count[behind]]
        place = word << 6
        for half in (32, 16, 8, 4, 2, 1):
            below = bits & np.uint64((1 << half) - 1)
            count = np.bitwise_count(below).astype(np.int64)
            go = left >= count
            bits = np.where(go, bits >> np.uint64(half), below)
            left, place = left - go * count, place + go * half
        return place

    def __getitem__(self, i: int | np.ndarray) -> int | np.ndarray:
        """The i-th values, as an integer or an unsigned 64-bit array."""
        if not isinstance(i, np.ndarray):
            return int(self[np.array([range(self.n)[i]], dtype=np.int64)][0])
        high = (self.select(i) - i).astype(np.uint64) << np.uint64(self.low_bits)
        first = i * self.low_bits
        window = np.zeros(len(i), dtype=np.uint64)
        for k in range(8):
            window |= self.low[(first >> 3) + k].astype(np.uint64) << np.uint64(8 * k)
        low = (window >> (first & 7).astype(np.uint64)) & np.uint64((1 << self.low_bits) - 1)
        return high | low

    def bits(self) -> int:
        return 8 * sum(map(len, self.raw))


def write_shard(doc_ids: list[int | None], sizes: np.ndarray, ids: bytes, width: int) -> bytes:
    """The bytes of a shard: documents in ascending order, null ids first; ``ids`` is their token ids of ``width`` bytes each."""
    nulls = sum(d is None for d in doc_ids)
    known = np.array(doc_ids[nulls:], dtype=np.int64)
    first = int(known[0]) if len(known) else 0
    apart = known.view(np.uint64) - np.uint64(first % (1 << 64))
    names = EliasFano.of(apart, int(apart[-1]) if len(apart) else 0).to_bytes()
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    bounds = EliasFano.of(ends, total).to_bytes()
    begin = struct.calcsize(_HEADER) + len(names) + len(bounds)
    pad = -begin % 4
    return struct.pack(_HEADER, MAGIC, VERSION, width, len(doc_ids), nulls, total, first, struct.calcsize(_HEADER) + len(names), begin + pad) + names + bounds + bytes(pad) + ids


class Shard:
    """A shard's documents by number: ``doc_ids()``, ``spans(i)``, ``ids(i)``; reads nothing but what it is asked for."""

    def __init__(self, data: bytes):
        data = memoryview(data)
        magic, version, self.width, self.n, self.nulls, self.total, self.first, at_bounds, self.at_ids = struct.unpack_from(_HEADER, data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token file of this version")
        self.names, _ = EliasFano.read(data, struct.calcsize(_HEADER))
        self.bounds, _ = EliasFano.read(data, at_bounds)
        self.tokens = np.frombuffer(data, dtype=f"<u{self.width}", offset=self.at_ids, count=self.total)

    def doc_ids(self) -> list[int | None]:
        apart = self.names[np.arange(self.names.n)] + np.uint64(self.first % (1 << 64))
        return [None] * self.nulls + apart.view(np.int64).tolist()

    def spans(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the i-th documents' ids begin and end in the shard's array."""
        ends = self.bounds[i].astype(np.int64)
        starts = np.zeros(len(i), dtype=np.int64)
        starts[i > 0] = self.bounds[i[i > 0] - 1].astype(np.int64)
        return starts, ends

    def ids(self, i: int) -> np.ndarray:
        (start,), (end,) = self.spans(np.array([range(self.n)[i]]))
        return self.tokens[start:end]


class WordEncoder(dict):
    """Token bytes of words, made when first met, by a tokenizer that splits at white space.

    Texts are cut at white space, where this family of tokenizers (white space
    dropped, pre-tokens of letters, digits or other signs) always ends a
    pre-token. A new word of Latin-1 letters and closing signs is lowered and
    handed to the library's BPE model, its signs apart; any other new word
    takes the library's whole way. Tokenizers with other rules are not for
    this class: ``check`` refuses them.
    """

    PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?&%$#*]*)")
    #: Signs that ``str.split`` takes for white space and the tokenizer doesn't.
    OTHER = "\x1c\x1d\x1e\x1f"
    CUT = re.compile(r"[^ \t\n\r]+")

    def __init__(self, path: str, end: int):
        from tokenizers import Tokenizer

        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        most = max(self.whole.get_vocab(with_added_tokens=True).values(), default=0)
        self.width, self.kind = (2, "H") if max(most, end) < 1 << 16 else (4, "I")
        self.end = array(self.kind, [end]).tobytes()
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = iter(range(0x100, 0x200))
        self.shown = {b: chr(b if b in shown else next(rest)) for b in range(256)}
        self.check()

    def check(self) -> None:
        """Raises where the ways of encoding differ on a sentence of all kinds of words."""
        text = "Änd thé quick-brown  fox's\tÉTÉ... 42nd ÇA,va?! x&&& ﬁn naïvé 日本 ß İ.\nΣΑΣ <|endoftext|> don't ªµº.\x1cu\x85v\xa0w\u3000"
        if self.encode([text, ""]) != [array(self.kind, self.whole.encode(text, add_special_tokens=False).ids).tobytes() + self.end, self.end]:
            raise ValueError("this tokenizer doesn't split texts into white-space words")

    def _piece(self, text: str) -> bytes:
        """The token bytes of one pre-token."""
        if (found := self.get(text)) is None:
            shown = text if text.isascii() else text.encode().decode("latin-1").translate(self.shown)
            found = self[text] = array(self.kind, [t.id for t in self.model.tokenize(shown)]).tobytes()
        return found

    def __missing__(self, word: str) -> bytes:
        if m := self.PLAIN.fullmatch(word):
            core, signs = m.groups()
            found = self._piece(core.lower()) + self._piece(signs) if signs else self._piece(core.lower())
        else:
            found = array(self.kind, self.whole.encode(word, add_special_tokens=False).ids).tobytes()
        self[word] = found
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids and the end id."""
        out = []
        for text in texts:
            words = self.CUT.findall(text) if any(c in text for c in self.OTHER) else text.split()
            out.append(b"".join(map(self.__getitem__, words)) + self.end)
        if len(self) > REMEMBERED:
            self.clear()
        return out


def _store(folder: str):
    """The file system of a qualified folder, and the folder's path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def _qualified(spark: SparkSession, folder: str) -> str:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    full = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub(r"^file:/(?!/)", "file:///", full)


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", shard_ids: int = SHARD_IDS, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Encodes every whole text, appends ``end_id`` and writes shards below ``folder``; returns the manifest (part, shard, file, n_docs, n_ids).

    Documents are encoded where they lie; their token ids, which take less
    room than the texts, are dealt by ranges of the documents' ids into parts
    and sorted there, so parts, and shards within a part, are in ascending
    order. Null ids come first; rows of one id follow the hash of their
    texts, and equal rows may be dealt to several parts. A null text is
    empty: its end id alone. A task holds one shard at a time (a document
    that is longer makes it longer). Files have names of their own for every
    attempt of a task; the manifest, which Spark commits, names those that
    count, so lost executors and repeated tasks leave nothing but unread
    files. ``folder`` must not have a manifest yet. Other columns are ignored.
    """
    spark = docs.sparkSession
    folder = _qualified(spark, folder)
    with open(tokenizer, "rb") as file:
        given = spark.sparkContext.broadcast(file.read())  # a vocabulary, doesn't grow with the data
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    docs = docs.withColumn("hash", F.xxhash64("text"))
    n, size = docs.agg(F.count("*"), F.sum(F.octet_length("text") + 64)).first()
    parts = max(1, min(RANGES, -(-(size or 0) // range_bytes)))
    cuts: list[tuple] = []
    if parts > 1:  # LOOKED_AT keys a part
        some = docs.select("doc_id", "hash").sample(min(1.0, 1.2 * LOOKED_AT * parts / n), seed=1).limit(2 * LOOKED_AT * parts).collect()
        some = sorted((r.doc_id is not None, r.doc_id or 0, r.hash) for r in some)
        cuts = [some[len(some) * k // parts] for k in range(1, parts)] if some else []

    def encoder() -> WordEncoder:
        import tempfile

        with tempfile.NamedTemporaryFile(suffix=".json") as own:  # the library reads files; a task's own copy, gone at once
            own.write(given.value)
            own.flush()
            return WordEncoder(own.name, end_id)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, nth = encoder(), 0
        for batch in batches:
            hashes = batch.column("hash").to_pylist()
            ids = batch.column("doc_id").to_pylist()
            for first, texts in blocks(batch.column("text").to_pylist()):
                last = first + len(texts)
                part = []
                for key in zip((i is not None for i in ids[first:last]), (i or 0 for i in ids[first:last]), hashes[first:last], strict=True):
                    low, high = bisect_left(cuts, key), bisect_right(cuts, key)
                    part.append(low + nth % (high - low + 1))  # over several parts where a key fills them
                    nth += 1
                columns = [batch.column("doc_id").slice(first, len(texts)), batch.column("hash").slice(first, len(texts)), pa.array(part, pa.int32()), pa.array(words.encode(texts), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "hash", "part", "ids"])

    rows = docs.mapInArrow(encoded, "doc_id long, hash long, part int, ids binary").repartitionById(parts, "part")
    rows = rows.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "hash").select("doc_id", "part", "ids")
    width = encoder().width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        store.create_dir(f"{root}/shards", recursive=True)
        attempt, shard = uuid.uuid4().hex, 0
        names: list[int | None] = []
        bodies: list[bytes] = []
        held, part = 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal shard, names, bodies, held
            file = f"part-{part:05d}-{shard:05d}-{attempt}.tok"
            sizes = np.array([len(b) // width for b in bodies], dtype=np.int64)
            with store.open_output_stream(f"{root}/shards/{file}") as out:
                out.write(write_shard(names, sizes, b"".join(bodies), width))
            row = pa.RecordBatch.from_pylist([{"part": part, "shard": shard, "file": file, "n_docs": len(names), "n_ids": int(sizes.sum())}], schema=pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))
            names, bodies, held, shard = [], [], 0, shard + 1
            return row

        for batch in batches:
            for name, part, body in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "part", "ids")), strict=True):
                names.append(name)
                bodies.append(body)
                held += len(body) // width
                if held >= shard_ids:
                    yield flush()
        if names:
            yield flush()

    manifest = rows.mapInArrow(run, "part int, shard int, file string, n_docs long, n_ids long")
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """One row a document of the files below ``folder``: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and ids array<int> unless ``with_ids`` is false.

    Offsets come from each shard's select structure, counted on from the ids
    of the shards before it, of which the manifest has a row each. ids_crc32
    is of the document's ids as little-endian unsigned 32-bit integers.
    """
    folder = _qualified(spark, folder)
    manifest = spark.read.parquet(f"{folder}/manifest")
    before = F.sum("n_ids").over(Window.orderBy("part", "shard")) - F.col("n_ids")  # a row a shard
    shards = manifest.select("part", "shard", "file", before.alias("base"))
    n = max(1, min(RANGES, shards.count()))
    shards = shards.repartition(n, "part", "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        for batch in batches:
            for file, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist(), strict=True):
                with store.open_input_file(f"{root}/shards/{file}") as source:
                    shard = Shard(source.read())
                names = pa.array(shard.doc_ids(), pa.int64())
                for first in range(0, shard.n, 256):
                    i = np.arange(first, min(first + 256, shard.n))
                    starts, ends = shard.spans(i)
                    tokens = [shard.tokens[a:b].astype("<u4") for a, b in zip(starts, ends, strict=True)]
                    columns = [names.slice(first, len(i)), pa.array(starts + base), pa.array(ends - starts), pa.array([zlib.crc32(t.tobytes()) for t in tokens], pa.int64())]
                    if with_ids:
                        columns.append(pa.array([t.astype(np.int32) for t in tokens], pa.list_(pa.int32())))
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    return shards.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)


def token_file_report(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Writes ``docs`` into files of the shared folder and reads them back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    write_token_files(docs, tokenizer, folder, end_id)
    return read_token_files(spark, folder, with_ids=False)
