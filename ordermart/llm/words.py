"""Words and word shingles of many texts at once, as 64-bit hashes in numpy.

A word is a maximal run of letters and digits, in lower case; everything
else separates.  Each code point has a random 64-bit value; a word's hash
is the polynomial of its values, taken from prefix sums, so that a chunk
of texts costs a fixed number of array passes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_U = np.uint64
_BASE, _GAMMA = _U(0x9E3779B97F4A7C15), _U(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection that spreads every bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Tables:
    """Per worker process: lower case and the random value of each code point."""

    lower: np.ndarray | None = None
    value: np.ndarray | None = None
    powers = np.ones(1, dtype=_U)
    inverse = np.ones(1, dtype=_U)

    @classmethod
    def load(cls) -> None:
        if cls.value is None:
            n = 0x110000
            low = np.arange(n, dtype=np.uint32)
            alnum = np.fromiter((chr(i).isalnum() for i in range(n)), bool, n)
            for i in np.flatnonzero(alnum):
                c = chr(i).lower()
                if len(c) == 1:
                    low[i] = ord(c)
            cls.lower = low
            cls.value = np.where(alnum, mix64(low.astype(_U) + _GAMMA), _U(0))

    @classmethod
    def upto(cls, n: int) -> None:
        if len(cls.powers) < n:
            size = 1 << (n - 1).bit_length()
            inv = pow(int(_BASE), -1, 1 << 64)
            cls.powers = np.cumprod(np.concatenate([[_U(1)], np.full(size - 1, _BASE)]), dtype=_U)
            cls.inverse = np.cumprod(np.concatenate([[_U(1)], np.full(size - 1, _U(inv))]), dtype=_U)


def codes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each followed by a line feed, and where each begins (one more at the end)."""
    joined = "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    begin = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)), out=begin[1:])
    return codes, begin


def lowered(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points, and whether each is a letter or digit."""
    _Tables.load()
    return _Tables.lower[codes], _Tables.value[codes] != 0


@dataclass
class Words:
    """Words of a chunk in text order: hash, character span, and each text's first word."""

    hashes: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray       # of each text, one more at the end
    begin: np.ndarray       # first character of each text
    codes: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def span_hashes(value: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the values in each span [start, end), wherever the span lies; ``value`` is overwritten."""
    _Tables.upto(len(value))
    value *= _Tables.powers[:len(value)]
    total = np.cumsum(value, dtype=_U)
    before = np.where(start > 0, total[start - 1], _U(0))
    return mix64((total[end - 1] - before) * _Tables.inverse[start])


def words_of(texts: list[str]) -> Words:
    codes, begin = codes_of(texts)
    _Tables.load()
    value = _Tables.value[codes]
    inside = value != 0
    edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0))
    start, end = edge[0::2], edge[1::2]     # the closing line feed ends the last word
    hashes = span_hashes(value, start, end)
    return Words(hashes, start, end, np.searchsorted(start, begin), begin, codes)


def shingles_of(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every ``k`` consecutive words of a text, and the count a text.

    A text with fewer than ``k`` words but one at least has one shingle,
    of all its words; a text without words has none.
    """
    n = w.counts()
    per = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    owner = np.repeat(np.arange(len(n)), per)
    offset = np.zeros(len(n) + 1, dtype=np.int64)
    np.cumsum(per, out=offset[1:])
    at = w.first[:-1][owner] + np.arange(len(owner)) - offset[:-1][owner]
    out = np.zeros(len(at), dtype=_U)
    last = w.first[1:][owner]
    padded = np.append(w.hashes, np.zeros(k, dtype=_U))
    for j in range(k):
        part = np.where(at + j < last, padded[at + j], _U(j + 1))
        out = mix64(out + part + _U(j))
    return out, per


def shingle_letters(w: Words, k: int) -> np.ndarray:
    """Letters and digits in each of the shingles that ``shingles_of(w, k)`` returns."""
    n = w.counts()
    per = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    owner = np.repeat(np.arange(len(n)), per)
    at = w.first[:-1][owner] + np.arange(len(owner)) - (np.cumsum(per) - per)[owner]
    total = np.concatenate([[0], np.cumsum(w.end - w.start)])
    return total[np.minimum(at + k, w.first[1:][owner])] - total[at]


def sequence_digest(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each text's word sequence (0, 0 for none)."""
    out = []
    for salt in (_U(0x1F83D9ABFB41BD6B), _U(0x5BE0CD19137E2179)):
        n = w.counts()
        place = np.arange(len(w.hashes), dtype=np.int64) - np.repeat(w.first[:-1], n)
        term = mix64((w.hashes ^ salt) + place.astype(_U) * _GAMMA)
        total = np.concatenate([[_U(0)], np.cumsum(term, dtype=_U)])
        out.append(np.where(n > 0, mix64(total[w.first[1:]] - total[w.first[:-1]] + n.astype(_U)), _U(0)))
    return out[0], out[1]
