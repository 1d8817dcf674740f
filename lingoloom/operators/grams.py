"""Features of sentences as numbers: read off a batch of sentences by arrays, then counted or weighed.

The features of letters (runs of two to four, letters between their neighbours,
and so on) are as many as the alphabet has such runs, however large a corpus
is, so each has a fixed number. Words are as many as there are; they stay texts
and are counted by a dictionary of the batch. Nothing here knows of Spark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

from lingoloom.functions.profile import LanguageProfile

# fixed values: names of letters in the features about ambiguous spellings
LETTER_NAMES = {"к": "k", "г": "g", "в": "v", "у": "u", "ү": "ü", "е": "e", "я": "ya", "ю": "yu", "ц": "ts"}
GLIDING = ("е", "я", "ю")
HARMONIES = ("no_vowels", "front_only", "back_only", "mixed_front_back")
STYLES = ("style:length:short", "style:length:medium", "style:length:long", "style:has_digit", "style:has_quote", "style:has_inner_punct")
#: Signs of the last three style features: decimal digits, quotes, signs within a sentence.
SIGNS = (r"\d", "[\"'«»“”„]", "[,;:()]")
MIXED = ("ambig:mixed_harmony_conditional_word", *(f"ambig:mixed_harmony_{n}" for n in LETTER_NAMES.values()))
#: Bytes of text that are looked at together; marks of letters.
PART = 1 << 21
FRONT, BACK, CONDITIONAL, NAMED = 1, 2, 4, 3


@dataclass
class Read:
    """The letters of some sentences, one array after another: ``ids`` of letters, ``begin`` of words, ``sentence`` of each."""

    n: int
    ids: np.ndarray
    begin: np.ndarray
    sentence: np.ndarray
    #: of words: places of their first letters, their sentences, marks of all their letters
    at: np.ndarray
    of: np.ndarray
    marks: np.ndarray
    #: of words: numbers in ``texts``
    word: np.ndarray
    texts: pa.StringArray
    #: of sentences: words, bits of their signs
    words: np.ndarray
    signs: np.ndarray


@dataclass
class Coder:
    """Numbers of all features but those that name words or are about metadata."""

    profile: LanguageProfile
    small: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        p = self.profile
        every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x20000))))  # no letter or digit above has another case
        letters = sorted({c for c in re.findall(f"[{p.letters}]", every) if c.lower() == c and c != "ё"})
        self.letters, self.base = letters, len(letters) + 1
        at = {c: i for i, c in enumerate(letters, 1)}
        #: the letter of each character, in either case, ё written as е
        self.table = np.zeros(0x110000, np.uint8 if self.base < 256 else np.int32)
        for c in every:
            if (low := c.lower().replace("ё", "е")) in at:
                self.table[ord(c)] = at[low]
        #: bits of the signs that style features are about
        self.signs = np.zeros(0x110000, np.uint8)
        for k, sign in enumerate(SIGNS):
            self.signs[[*map(ord, re.findall(sign, every))]] |= 1 << k
        self.points = np.array([0, *map(ord, letters)], "<u4")
        self.bytes = np.array([0, *(len(c.encode()) for c in letters)], np.int32)
        self.letter_marks = np.zeros(self.base, np.int32)
        for c, i in at.items():
            self.letter_marks[i] = FRONT * (c in p.front) | BACK * (c in p.back) | CONDITIONAL * (c in p.conditional)
        for k, c in enumerate(LETTER_NAMES):
            if c in at:
                self.letter_marks[at[c]] |= 1 << (NAMED + k)
        self.conditional = [c for c in letters if c in p.conditional]
        self.velar = [c for c in "кг" if c in self.conditional]
        self.nth = np.full(self.base, -1, np.int64)
        self.nth[[at[c] for c in self.conditional]] = range(len(self.conditional))
        b = self.base
        #: where the runs of 2, 3, 4 letters and the contexts begin, and the end of all these
        self.starts = np.cumsum([0, b**2, b**3, b**4, len(self.conditional) * b * b])
        self._tables()

    def _number(self, feature: str) -> int:
        """The number of a feature among the small ones."""
        return self.small.setdefault(feature, len(self.small))

    def _tables(self) -> None:
        p, b, place = self.profile, self.base, lambda before, after: "initial" if not before else "final" if not after else "middle"
        self.harmonies = np.array([self._number(f"vowel_harmony:{h}") for h in HARMONIES])
        self.styles = np.array([self._number(s) for s in STYLES])
        self.deterministic = np.array([-1, *(self._number(f"deterministic_letter:{c}") if c in p.deterministic else -1 for c in self.letters)])
        sign = ["", *self.letters]
        rows = []
        for c in self.conditional:
            for x in range(b):
                for y in range(b):
                    own = [f"cond_letter:{c}", f"cond_bigram_left:{sign[x] or '^'}{c}", f"cond_bigram_right:{c}{sign[y] or '$'}", f"cond_position:{c}:{place(x, y)}"]
                    name = LETTER_NAMES.get(c)
                    if c in GLIDING:
                        own.append(f"ambig:{'internal_' if x else 'initial_'}{name}")
                    elif name and c not in "кг":
                        own.append(f"ambig:{name}_letter")
                    rows.append([self._number(f) for f in own] + [-1] * (5 - len(own)))
        #: numbers of the small features of each context
        self.of_context = np.array(rows, np.int64).reshape(-1, 5)
        self.velars = np.full((b, 2), -1, np.int64)
        for c in self.velar:
            self.velars[self.letters.index(c) + 1] = [self._number(f"ambig:{LETTER_NAMES[c]}_before_{v}_vowel") for v in ("back", "front")]

    @property
    def large(self) -> int:
        return int(self.starts[-1])

    @property
    def size(self) -> int:
        """All numbers are below this one."""
        return self.large + len(self.small)

    def names(self, codes: np.ndarray) -> list[str]:
        """The features of some numbers."""
        small, b, sign, out = list(self.small), self.base, ["", *self.letters], []
        for code in codes.tolist():
            if code >= self.large:
                out.append(small[code - self.large])
                continue
            kind = int(np.searchsorted(self.starts, code, "right")) - 1
            rest = code - int(self.starts[kind])
            if kind == 3:
                c, x, y = rest // (b * b), rest // b % b, rest % b
                out.append(f"cond_ctx:{sign[x] or '^'}*{self.conditional[c]}*{sign[y] or '$'}")
            else:
                out.append(f"char{kind + 2}:" + "".join(sign[rest // b**k % b] for k in reversed(range(kind + 2))))
        return out

    def read(self, texts: pa.Array) -> Read:
        """``texts``: sentences, at least one."""
        ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        signs = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
        firsts = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[ends - ends[0]]
        found = self.table[signs]
        marked = np.flatnonzero(other := self.signs[signs])
        bits, of = np.zeros(len(texts), np.uint8), np.searchsorted(firsts, marked, "right") - 1
        for k in range(len(SIGNS)):
            bits[of[other[marked] >> k & 1 == 1]] |= 1 << k
        at = np.flatnonzero(found)
        ids = found[at]
        begin = np.ones(len(at), bool)
        begin[1:] = np.diff(at) > 1
        before = np.searchsorted(at, firsts)  # letters before each sentence
        begin[before[before < len(at)]] = True
        sentence = np.repeat(np.arange(len(texts)), np.diff(before))
        words = np.flatnonzero(begin)
        of = sentence[words]
        marks = np.bitwise_or.reduceat(self.letter_marks[ids], words) if len(words) else np.zeros(0, np.int32)
        sizes = np.concatenate(([0], np.cumsum(self.bytes[ids])))
        offsets = np.append(sizes[words], sizes[-1]).astype(np.int32)
        text = self.points[ids].tobytes().decode("utf-32-le").encode()
        coded = pa.StringArray.from_buffers(len(words), pa.py_buffer(offsets), pa.py_buffer(text)).dictionary_encode()
        word = coded.indices.to_numpy(zero_copy_only=False)
        return Read(len(texts), ids.astype(np.int64), begin, sentence, words, of, marks, word, coded.dictionary, np.bincount(of, minlength=len(texts)), bits)

    def runs(self, r: Read) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, sentences, numbers) of all runs of 2, 3 and 4 letters of a word."""
        code, fits = r.ids, np.ones(len(r.ids), bool)
        for n in (2, 3, 4):
            if len(code) < 2:
                return
            code = code[:-1] * self.base + r.ids[n - 1 :]
            fits = fits[:-1] & ~r.begin[n - 1 :]
            yield n, r.sentence[: len(code)][fits], code[fits] + int(self.starts[n - 2])

    def contexts(self, r: Read) -> tuple[np.ndarray, np.ndarray]:
        """(sentences, numbers from 0) of the conditional letters between their neighbours."""
        at = np.flatnonzero(self.nth[r.ids] >= 0)
        last = np.append(r.begin[1:], True)
        before = np.where(r.begin[at], 0, r.ids[at - 1])
        after = np.where(last[at], 0, r.ids[np.minimum(at + 1, len(r.ids) - 1)])
        return r.sentence[at], (self.nth[r.ids[at]] * self.base + before) * self.base + after

    def rest(self, r: Read) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(sentences, small numbers) of all other features."""
        vowel = np.flatnonzero(self.letter_marks[r.ids] & (FRONT | BACK))
        at = np.flatnonzero(self.velars[r.ids, 0] >= 0)
        nth = np.searchsorted(vowel, at, "right")
        at, nth = at[nth < len(vowel)], nth[nth < len(vowel)]
        number = np.cumsum(r.begin)
        same = number[vowel[nth]] == number[at]
        at, to = at[same], vowel[nth[same]]
        yield r.sentence[at], self.velars[r.ids[at], self.letter_marks[r.ids[to]] & FRONT]
        at = np.flatnonzero(self.deterministic[r.ids] >= 0)
        yield r.sentence[at], self.deterministic[r.ids[at]]
        yield r.of, self.harmonies[r.marks & (FRONT | BACK)]
        length = np.where(r.words <= 8, 0, np.where(r.words <= 20, 1, 2))
        yield np.arange(r.n), self.styles[length]
        for k in range(3):
            yield (at := np.flatnonzero(r.signs >> k & 1)), np.full(len(at), self.styles[3 + k])


def parts(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in parts of about ``PART`` bytes of text, a row at least."""
    batch = batch.set_column(batch.schema.get_field_index(text), text, batch.column(text).cast(pa.string()))
    column = batch.column(text)
    if not len(column):
        return
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    start = 0
    while start < len(column):
        end = max(start + 1, int(np.searchsorted(ends, ends[start] + PART, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def mixed_bits(marks: np.ndarray) -> np.ndarray:
    """Bits of ``MIXED`` of each word: those it has where its frequency is in the band, 0 for words that aren't conditional and of mixed harmony."""
    want = FRONT | BACK | CONDITIONAL
    return np.where((marks & want) == want, 1 | (marks >> NAMED << 1), 0)


def first_marks(r: Read) -> np.ndarray:
    """The marks of each text of ``r.texts``."""
    out = np.zeros(len(r.texts), np.int32)
    out[r.word] = r.marks
    return out


def pairs(a: np.ndarray, b: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of two arrays with their counts; ``b`` is below ``size``."""
    bits = max(1, int(size).bit_length())
    both = np.sort(a.astype(np.int64) << bits | b)
    first = np.ones(len(both), bool)
    first[1:] = both[1:] != both[:-1]
    at = np.flatnonzero(first)
    return both[at] >> bits, both[at] & ((1 << bits) - 1), np.diff(np.append(at, len(both)))


def counted(profile: LanguageProfile):  # noqa: ANN201
    """A function over batches (sentence): (word, code, frequency, df) of words, and at the end of the features of letters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(profile)
        df = np.zeros(coder.size, np.int64)
        for part in (p for b in batches for p in parts(b, "sentence")):
            r = coder.read(part.column("sentence"))
            runs = [(s, c) for _, s, c in coder.runs(r)]
            s, c = coder.contexts(r)
            runs.append((s, c + coder.starts[3]))
            _, code, _ = pairs(np.concatenate([s for s, _ in runs]), np.concatenate([c for _, c in runs]), coder.large)
            df[: coder.large] += np.bincount(code, minlength=coder.large)
            has = np.zeros((r.n, len(coder.small) + 1), bool)  # the last column is for -1
            for k in range(coder.of_context.shape[1]):
                has[s, coder.of_context[c, k]] = True
            for s, small in coder.rest(r):
                has[s, small] = True
            df[coder.large :] += has[:, :-1].sum(axis=0)
            _, word, _ = pairs(r.of, r.word, len(r.texts))
            n = len(r.texts)
            yield pa.RecordBatch.from_arrays([r.texts, pa.array(np.full(n, -1)), pa.array(np.bincount(r.word, minlength=n)), pa.array(np.bincount(word, minlength=n))], names=["word", "code", "frequency", "df"])
        code = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(code), pa.string()), pa.array(code), pa.array(np.zeros(len(code), np.int64)), pa.array(df[code])], names=["word", "code", "frequency", "df"])

    return run


def named(profile: LanguageProfile):  # noqa: ANN201
    """A function over batches (code, df): (feature, df)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(profile)
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(coder.names(b.column("code").to_numpy()), pa.string()), b.column("df")], names=["feature", "df"])

    return run


def mixed(profile: LanguageProfile, top: dict, min_frequency: int):  # noqa: ANN201
    """A function over batches (nth, sentence): (nth, word, bits, n) of what words of mixed harmony share.

    ``top`` (a broadcast) has frequent words and whether they are in the band;
    a word that isn't there is below the band's end, so it is in the band if a
    part alone has it often enough. At the end there is a row of each bit, with
    an empty word: the sentences that have it from such words. Words that stay
    open have a row each time they could add bits to their sentences.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        coder, (known, allowed, every) = Coder(profile), (top.value[k] for k in ("word", "allowed", "every"))
        total = np.zeros(len(MIXED), np.int64)
        for part in (p for b in batches for p in parts(b, "sentence")):
            r = coder.read(part.column("sentence"))
            bits = mixed_bits(first_marks(r))
            at = np.flatnonzero(bits)
            found = pc.index_in(r.texts.take(pa.array(at)), value_set=known).fill_null(-1).to_numpy(zero_copy_only=False)
            often = np.bincount(r.word, minlength=len(r.texts))[at] >= min_frequency
            sure, left = np.zeros(len(bits), bool), np.zeros(len(bits), bool)
            sure[at] = np.where(found >= 0, allowed[found] if len(allowed) else False, often & (not every))
            left[at] = (found < 0) & ~often & (not every)
            has, mine = np.zeros((r.n, len(MIXED)), bool), sure[r.word]
            s, b = r.of[mine], bits[r.word[mine]]
            for k in range(len(MIXED)):
                has[s[b >> k & 1 == 1], k] = True
            total += has.sum(axis=0)
            certain, mine = has @ (1 << np.arange(len(MIXED))), left[r.word]
            s, w, _ = pairs(r.of[mine], r.word[mine], len(r.texts))
            new = bits[w] & ~certain[s]
            s, w, new = s[new != 0], w[new != 0], new[new != 0]
            yield pa.RecordBatch.from_arrays([part.column("nth").take(pa.array(s)), r.texts.take(pa.array(w)), pa.array(new.astype(np.int64)), pa.array(np.ones(len(s), np.int64))], names=["nth", "word", "bits", "n"])
        n = len(MIXED)
        yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.array([""] * n), pa.array(1 << np.arange(n)), pa.array(total)], names=["nth", "word", "bits", "n"])

    return run


#: Keys of the rows of sentences among those of words: so many, that no task gets them all; no word has this sign.
SALTS = 4096
SALT = "\0"


def weighed(profile: LanguageProfile, given: dict):  # noqa: ANN201
    """A function over batches (key, sentence): (key, word, times, base, rare, letters, mixed), a row a sentence, and one for each of its words that ``given`` lacks.

    ``given`` (a broadcast) has the numbers of features with their rarity, and
    the sums of words with what their names weigh.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        coder, got = Coder(profile), given.value
        weights = lambda f: profile.weights.get(f.split(":")[0], 0.0)
        weight = np.zeros(coder.size + 1)  # the last is for -1
        for n in (2, 3, 4):
            weight[coder.starts[n - 2] : coder.starts[n - 1]] = weights(f"char{n}")
        weight[coder.starts[3] : coder.large] = weights("cond_ctx")
        weight[coder.large : -1] = [weights(f) for f in coder.small]
        rare = np.zeros(coder.size + 1)
        rare[got["code"]] = got["rarity"]
        rare *= weight
        context, small = np.arange(coder.starts[3], coder.large), np.where(coder.of_context < 0, coder.size, coder.of_context + coder.large)
        of_context = [x[context] + x[small].sum(axis=1) for x in (weight, rare)]
        salts = pa.array([f"{SALT}{i}" for i in range(SALTS)])
        for part in (p for b in batches for p in parts(b, "sentence")):
            r = coder.read(part.column("sentence"))
            summed = lambda s, x=None: np.bincount(s, weights=x, minlength=r.n)  # noqa: B023, E731
            sums = [np.zeros(r.n), np.zeros(r.n)]
            s, c = coder.contexts(r)
            letters = summed(s)
            for total, x in zip(sums, of_context, strict=True):
                total += summed(s, x[c])
            for n, s, c in coder.runs(r):
                sums[0] += weights(f"char{n}") * summed(s)
                sums[1] += summed(s, rare[c])
            for s, c in coder.rest(r):
                for total, x in zip(sums, (weight, rare), strict=True):
                    total += summed(s, x[c + coder.large])
            found = pc.index_in(r.texts, value_set=got["word"]).fill_null(-1).to_numpy(zero_copy_only=False)
            for total, name in zip(sums, ("base", "rare"), strict=True):
                total += summed(r.of, np.append(got[name], 0.0)[found][r.word])
            both = summed(r.of[(r.marks & (FRONT | BACK)) == FRONT | BACK])
            yield pa.RecordBatch.from_arrays([part.column("key"), salts.take(pa.array(np.arange(r.n) % SALTS)), pa.array(np.zeros(r.n, np.int64)), *map(pa.array, (*sums, letters, both))], names=["key", "word", "times", "base", "rare", "letters", "mixed"])
            mine = (found < 0)[r.word]
            if not got["every"] and mine.any():
                s, w, times = pairs(r.of[mine], r.word[mine], len(r.texts))
                none = np.zeros(len(s))
                yield pa.RecordBatch.from_arrays([part.column("key").take(pa.array(s)), r.texts.take(pa.array(w)), *map(pa.array, (times, none, none, none.astype(np.int64), none.astype(np.int64)))], names=["key", "word", "times", "base", "rare", "letters", "mixed"])

    return run
