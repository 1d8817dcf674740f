"""Vectorised hashing of words and characters, shared by the MinHash operators.

Everything works on one Arrow batch at a time, in blocks of about 250,000
characters, so memory does not depend on how many documents a task reads.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

BLOCK = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[65:91] += np.uint64(32)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_tables: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to n."""
    if not _tables or len(_tables["up"]) <= n:
        size = max(n + 1, BLOCK + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            row = np.full(size, base, dtype=np.uint64)
            row[0] = 1
            _tables[name] = np.multiply.accumulate(row)
    return _tables["up"], _tables["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: each input bit reaches each output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _prefix_sums(values: np.ndarray) -> np.ndarray:
    up, _ = _powers(len(values))
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=out[1:])
    return out


def blocks(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """(index of the first, texts) with about BLOCK characters each, one text at least."""
    first, size, got = 0, 0, []
    for i, t in enumerate(texts):
        t = t or ""
        if got and size + len(t) > BLOCK:
            yield first, got
            first, size, got = i, 0, []
        got.append(t)
        size += len(t)
    if got:
        yield first, got


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (A-Z lowered, cut at 0x20 and 0x09-0x0D), and where each text's begin."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    joined = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
    space = _SPACE[joined]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    sums = _prefix_sums(_LOWER[joined])
    _, down = _powers(len(joined))
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    text_ends = np.cumsum([len(r) + 1 for r in raw])
    return hashes, np.concatenate(([0], np.searchsorted(starts, text_ends)))


_PLACES = [np.uint64(pow(0xD6E8FEB86659FD93, j + 1, 1 << 64)) for j in range(64)]


def word_shingles(texts: list[str], width: int = 5) -> list[np.ndarray]:
    """Each text's sorted distinct shingles of ``width`` words; with fewer words the whole sequence is one."""
    words, at = word_hashes(texts)
    rolled = np.zeros(max(0, len(words) - width + 1), dtype=np.uint64)
    for j in range(width):
        rolled += words[j : j + len(rolled)] * _PLACES[j]
    rolled = mix(rolled)
    out = []
    for a, b in zip(at[:-1], at[1:], strict=True):
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            own = words[a:b]
            out.append(mix(np.array([sum(int(x) * int(p) for x, p in zip(own, _PLACES, strict=False)) + int(b - a) & (1 << 64) - 1], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def rolled(lines: list[str], width: int, dtype: type) -> tuple[np.ndarray, np.ndarray]:
    """Polynomial hashes (unmixed) of all runs of ``width`` characters of each line, and where each line's begin; ``width`` is a power of two.

    No line may be empty; one shorter than ``width`` is a single run, told
    apart by its length.
    """
    sizes = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
    short = sizes < width
    if short.any():
        lines = [x if len(x) >= width else x.ljust(width, "\0") for x in lines]
    value = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(dtype, copy=False)
    padded = np.maximum(sizes, width)
    power, size, whole = 0x9E3779B97F4A7C15, 1, (1 << 8 * np.dtype(dtype).itemsize) - 1
    while size < width:  # the polynomial of 2s characters from those of s characters
        value = value[:-size] * dtype(power & whole) + value[size:]
        power, size = power * power & whole, 2 * size
    inside = np.ones(len(value) + width - 1, dtype=bool)
    inside[(np.cumsum(padded)[:, None] - np.arange(1, width)).ravel()] = False
    value = value[inside[: len(value)]]
    at = np.concatenate(([0], np.cumsum(padded - width + 1)))
    value[at[:-1][short]] ^= sizes[short].astype(dtype)
    return value, at


def char_shingles(lines: list[str], width: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all character shingles of all lines (none empty), and where each line's begin; a shorter line is one shingle."""
    value, at = rolled(lines, width, np.uint64)
    return mix(value), at


def digest(values: np.ndarray) -> bytes:
    """128 bits that name a sorted set of hashes."""
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


class MinHash:
    """``n`` independent 32-bit minima of each set's hashes."""

    def __init__(self, n: int, seed: int = 1):
        draw = np.random.default_rng(seed).integers(0, 1 << 63, size=(n, 2), dtype=np.uint64)
        self.odd, self.add = draw[:, 0] * np.uint64(2) + np.uint64(1), draw[:, 1]

    def __call__(self, hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """(sets, n) from the concatenated hashes and where each set begins; no set may be empty."""
        out = np.empty((len(at) - 1, len(self.odd)), dtype=np.uint32)
        for k, (a, b) in enumerate(zip(self.odd, self.add, strict=True)):
            out[:, k] = np.minimum.reduceat(((hashes * a + b) >> np.uint64(32)).astype(np.uint32), at[:-1])
        return out


class LineSignatures:
    """``n`` 32-bit minima of each line's character shingles: faster than MinHash over char_shingles, for candidates only."""

    def __init__(self, n: int, seed: int, width: int = 8):
        self.odd, self.width = np.random.default_rng(seed).integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32) | np.uint32(1), width

    def __call__(self, lines: list[str]) -> np.ndarray:
        """(lines, n) of lines that aren't empty; a line shorter than a shingle is one."""
        value, at = rolled(lines, self.width, np.uint32)
        value = (value ^ (value >> np.uint32(16))) * np.uint32(0x7FEB352D)
        value = (value ^ (value >> np.uint32(15))) * np.uint32(0x846CA68B)
        value ^= value >> np.uint32(16)
        return np.stack([np.minimum.reduceat(value * a, at[:-1]) for a in self.odd], axis=1)
