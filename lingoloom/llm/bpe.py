"""Byte-level BPE by a sentencepiece model that is written directly from the vocabulary."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import blocks

#: Distinct pre-tokens that a task remembers before it starts anew.
REMEMBERED = 300_000


def read_ranks(path: str) -> list[bytes]:
    """The byte strings of a .tiktoken file by rank; ranks must run from 0 without a gap."""
    with open(path, "rb") as file:
        pairs = sorted((int(rank), base64.b64decode(piece)) for piece, rank in map(bytes.split, file))
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks have gaps")
    return [p for _, p in pairs]


def byte_map() -> list[str]:
    """A visible character for each byte: itself where printable Latin-1, else one from U+0100 on in byte order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int | float) -> bytes:
    """One field of a protocol buffer message: bytes, a varint or a 32-bit float."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def serialised_model(ranks: list[bytes]) -> bytes:
    """A sentencepiece BPE model: byte-mapped pieces scored by negative rank, then <unk>; nothing is normalised.

    Piece ids are ranks. Scores are 32-bit floats, exact below 2**24 ranks.
    """
    shown = byte_map()
    pieces = [_field(1, _field(1, "".join(shown[b] for b in p).encode()) + _field(2, -float(rank))) for rank, p in enumerate(ranks)]
    unknown = _field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))
    trainer = _field(3, 2) + _field(4, len(ranks) + 1) + _field(40, len(ranks)) + _field(41, (1 << 64) - 1) + _field(42, (1 << 64) - 1) + _field(43, (1 << 64) - 1)
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + unknown + _field(2, trainer) + _field(3, normaliser)


class Codec:
    """Encodes each match of ``pattern`` separately; decodes by the inverse of the byte mapping."""

    def __init__(self, ranks: list[bytes], pattern: str):
        import regex
        import sentencepiece

        self.pattern = regex.compile(pattern)
        self.whole = {p: i for i, p in enumerate(ranks)}
        self.shown = dict(enumerate(byte_map()))
        self.model = sentencepiece.SentencePieceProcessor()
        self.model.LoadFromSerializedProto(serialised_model(ranks))
        byte_of = {c: b for b, c in self.shown.items()}
        #: Bytes of each id: the model's piece, its characters mapped back.
        self.spelt = [bytes(map(byte_of.__getitem__, piece)) for piece in self.model.IdToPiece(list(range(len(ranks))))]
        self.known: dict[str, list[int]] = {}

    def learn(self, pieces: set[str]) -> None:
        """Encodes pre-tokens not met before; one that is a vocabulary entry as a whole is that entry."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        rest = []
        for p in pieces:
            if p in self.known:
                continue
            raw = p.encode("utf-8", "replace")
            if (one := self.whole.get(raw)) is not None:
                self.known[p] = [one]
            else:
                rest.append((p, raw.decode("latin-1").translate(self.shown)))
        if rest:
            for (p, _), ids in zip(rest, self.model.encode([m for _, m in rest], num_threads=1), strict=True):
                self.known[p] = ids

    def encode(self, texts: list[str]) -> list[list[int]]:
        pieces = list(map(self.pattern.findall, texts))
        self.learn(set(chain.from_iterable(pieces)))
        return [list(chain.from_iterable(map(self.known.__getitem__, p))) for p in pieces]

    def decode(self, ids: list[int]) -> bytes:
        """The model's pieces, each character mapped back to its byte."""
        return b"".join(map(self.spelt.__getitem__, ids))


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row a document: doc_id, n_tokens, ids_sha256, decoded_sha256, and ids array<int> unless ``with_ids`` is false.

    Every match of ``pattern`` in the whole text is encoded by itself, by the
    ranks of the .tiktoken file at ``path``, which the driver reads and hands
    to the tasks (it doesn't grow with the data). The ids are decoded again;
    digests are of the decimal ids joined by commas and of the decoded bytes.

    Null and empty texts have no ids. Repeated rows and null ids are encoded
    row by row. Other columns are ignored.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(ranks.value, pattern)
        decimal = list(map(str, range(len(ranks.value))))
        for batch in batches:
            for first, texts in blocks(batch.column("text").to_pylist()):
                part = batch.slice(first, len(texts))
                found = codec.encode(texts)
                columns = [part.column("doc_id"), pa.array([len(x) for x in found], pa.int64())]
                columns.append(pa.array([hashlib.sha256(",".join(map(decimal.__getitem__, x)).encode()).hexdigest() for x in found]))
                columns.append(pa.array([hashlib.sha256(codec.decode(x)).hexdigest() for x in found]))
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns.append(pa.array(found, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return docs.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
