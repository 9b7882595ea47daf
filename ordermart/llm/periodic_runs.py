"""Operator 13: all periodic runs of words, by internal pattern matching.

A run is a stretch of words with smallest period q (words q apart are the
same) that is at least twice q and LEAST words long, and that no word
beside it extends.

Method.  The words that begin at each place are ranked by blocks of 1, 2,
4, ... words, each size from the one before, until no block of a text
occurs in it twice; the last ranks are the suffix array, and the blocks
equal to one lie in one range of it.  A wavelet matrix over the suffix
array answers range successor: the next occurrence, from a given place, of
a block.  A run of period q holds, before its last q words, a dyadic block
(one of 2^k words that begins at a multiple of 2^k) that occurs again q
words on; k is chosen so that q is one of 2^(k+1) - 1 ... 2^(k+2) - 2, or
7 words or more are left for smaller q.  So the occurrences of every
dyadic block in the window of these distances give candidate periods.
Occurrences closer than a block form an arithmetic progression, found by
one extension instead of one query each; of the progression that begins at
the block itself only its difference can be a smallest period.  Each
candidate is extended both ways by comparing blocks of falling size, and
of equal stretches the least period stays.

Scale.  Texts do not meet: each is worked on by itself, and a chunk of
them in common numpy passes, without any shuffle.  Memory of a task is
4 bytes a word and block size, sizes going up to the longest repeat, for a
chunk of about a million characters or one longer text.  A text of n
words takes O(n log^2 n) steps, also if it repeats one word.

Results on edge cases.  Null, empty and white texts have no words and no
runs.  Words are compared byte by byte; repeated rows give equal results
each.  An empty table gives no row.  Other columns take no part, whatever
their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Fewest words of a run.
LEAST = 12
#: Candidates extended at once; they bound the work arrays.
SLICE = 1 << 20


class Blocks:
    """Ranks of the blocks of 2^k words of several texts; blocks of different texts, or beyond a text, differ."""

    def __init__(self, words: np.ndarray, first: np.ndarray):
        """``words``: a number for each word; ``first``: where each text begins, one more at the end."""
        n = len(words)
        sizes = np.diff(first)
        end = np.repeat(first[1:], sizes)
        text = np.repeat(np.arange(len(sizes)), sizes)
        key = text * (int(words.max(initial=0)) + 1) + words
        _, index, counts = np.unique(key, return_inverse=True, return_counts=True)
        self.n = n
        self.ranks = [self._padded((np.cumsum(counts) - counts)[index])]
        self.again = [counts[index] > 1]        # whether a place's block occurs twice
        active = np.flatnonzero(self.again[0])
        step = 1
        while len(active):
            last = self.ranks[-1]
            after = active + step
            key = last[active].astype(np.int64) * (n + 2) + np.where(after < end[active], last[np.minimum(after, n)] + 1, 0)
            order = np.argsort(key, kind="stable")
            key, place = key[order], active[order]
            head = np.flatnonzero(np.diff(key, prepend=-1))
            size = np.diff(np.append(head, len(key)))
            old = last[place]
            old_head = np.flatnonzero(np.diff(old, prepend=-1))
            start = np.repeat(old_head, np.diff(np.append(old_head, len(key))))
            ranks = last.copy()
            ranks[place] = old + np.repeat(head, size) - start
            self.ranks.append(ranks)
            active = np.sort(place[np.repeat(size > 1, size)])
            again = np.zeros(n, dtype=bool)
            again[active] = True
            self.again.append(again)
            step *= 2

    @staticmethod
    def _padded(ranks: np.ndarray) -> np.ndarray:
        return np.append(ranks, -1).astype(np.int32)

    def same_after(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i on equal those from j on (i < j)."""
        i, j = i.copy(), j.copy()
        start = i.copy()
        for k in range(len(self.ranks) - 1, -1, -1):
            same = self.ranks[k][i] == self.ranks[k][j]
            i += same * (1 << k)
            j += same * (1 << k)
        return i - start

    def same_before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before i equal those before j (i < j)."""
        i, j = i.copy(), j.copy()
        start = i.copy()
        for k in range(len(self.ranks) - 1, -1, -1):
            a, b = i - (1 << k), j - (1 << k)
            same = (a >= 0) & (self.ranks[k][np.maximum(a, 0)] == self.ranks[k][np.maximum(b, 0)])
            i -= same * (1 << k)
            j -= same * (1 << k)
        return start - i


class WaveletMatrix:
    """Range successor over an array of numbers: one bit of all numbers a level, zeros moved before ones."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.zeros, self.split = [], []
        for b in range(self.bits - 1, -1, -1):
            one = (values >> b) & 1
            before = np.zeros(len(values) + 1, dtype=np.int32)
            np.cumsum(1 - one, out=before[1:])
            self.zeros.append(before)
            self.split.append(int(before[-1]))
            values = np.concatenate([values[one == 0], values[one == 1]])

    def _less(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many numbers in [lo, hi) are less than x (x below 2^bits)."""
        count = np.zeros(len(lo), dtype=np.int64)
        for level in range(self.bits):
            one = ((x >> (self.bits - 1 - level)) & 1).astype(bool)
            a, b = self.zeros[level][lo], self.zeros[level][hi]
            count += one * (b - a)
            lo = np.where(one, self.split[level] + lo - a, a)
            hi = np.where(one, self.split[level] + hi - b, b)
        return count

    def _nth(self, lo: np.ndarray, hi: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The number in [lo, hi) that has ``nth`` lesser ones before it in order."""
        value = np.zeros(len(lo), dtype=np.int64)
        for level in range(self.bits):
            a, b = self.zeros[level][lo], self.zeros[level][hi]
            one = nth >= b - a
            value = 2 * value + one
            nth = nth - one * (b - a)
            lo = np.where(one, self.split[level] + lo - a, a)
            hi = np.where(one, self.split[level] + hi - b, b)
        return value

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray, none: int) -> np.ndarray:
        """The least number of each range [lo, hi) that is x or more; ``none`` where there is none."""
        out = np.full(len(lo), none, dtype=np.int64)
        able = np.flatnonzero(x < 1 << self.bits)
        lo, hi, x = lo[able], hi[able], x[able]
        before = self._less(lo, hi, x)
        some = np.flatnonzero(before < hi - lo)
        out[able[some]] = self._nth(lo[some], hi[some], before[some])
        return out


def _window(k: int) -> tuple[int, int]:
    """Distances at which blocks of 2^k words look for occurrences."""
    if k < 3:
        return (6, 6) if k == 1 else (1, 14)
    return (1 << k + 1) - 1, (1 << k + 2) - 2


def _candidates(blocks: Blocks):
    """(place, distance) pairs: a block at the place occurs again at the distance."""
    if len(blocks.ranks) < 2:
        return
    n = blocks.n
    suffixes = np.empty(n, dtype=np.int64)
    suffixes[blocks.ranks[-1][:-1]] = np.arange(n)
    twice = blocks.again[1][suffixes]           # only blocks that occur twice are asked for
    kept = np.concatenate([[0], np.cumsum(twice)])
    tree = WaveletMatrix(suffixes[twice])
    for k in range(1, len(blocks.ranks) - 1):
        size, (near, far) = 1 << k, _window(k)
        i = np.arange(0, n, size)
        i = i[blocks.again[k][i]]
        if not len(i):
            continue
        rank = blocks.ranks[k]
        count = np.bincount(rank[:-1][blocks.again[k]], minlength=n)
        lo, hi = kept[rank[i]], kept[rank[i] + count[rank[i]]]
        limit = i + far
        # the progression that begins at the block: only its difference can be a smallest period
        second = tree.successor(lo, hi, i + 1, n + far)
        step = second - i
        run = np.flatnonzero((step <= size) & (second <= limit))
        ask = i + near
        at, d = i[run], step[run]
        ask[run] = np.maximum(ask[run], at + (d + blocks.same_after(at, at + d) - size) // d * d + 1)
        yield at[d >= near], d[d >= near]
        while len(i):
            found = tree.successor(lo, hi, ask, n + far)
            live = found <= limit
            i, lo, hi, limit, found = (x[live] for x in (i, lo, hi, limit, found))
            if not len(i):
                break
            yield i, found - i
            second = tree.successor(lo, hi, found + 1, n + far)
            step = second - found
            run = np.flatnonzero((step <= size) & (second <= limit))
            ask = second.copy()
            at, d = found[run], step[run]
            times = (d + blocks.same_after(at, at + d) - size) // d
            ask[run] = at + times * d + 1
            times = np.minimum(times, (limit[run] - at) // d)
            for a in range(0, len(run), 1 << 12):
                part = slice(a, a + (1 << 12))
                t = times[part]
                j = np.arange(int(t.sum())) - np.repeat(np.cumsum(t) - t, t) + 1
                yield np.repeat(i[run][part], t), np.repeat((found - i)[run][part], t) + j * np.repeat(d[part], t)


def runs_of(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) of all runs of the texts, sorted by start, end.

    ``words`` numbers the words of all texts in order, ``first`` says where
    each text begins (and the last one ends).
    """
    blocks = Blocks(words, first)
    out = [np.zeros((0, 3), dtype=np.int64)]
    for places, distances in _candidates(blocks):
        for a in range(0, len(places), SLICE):
            i, d = places[a:a + SLICE], distances[a:a + SLICE]
            start = i - blocks.same_before(i, i + d)
            end = i + d + blocks.same_after(i, i + d)
            good = end - start >= np.maximum(LEAST, 2 * d)
            out.append(np.unique(np.stack([start[good], end[good], d[good]], axis=1), axis=0))
    found = np.unique(np.concatenate(out), axis=0)
    same = np.append(False, (found[1:, :2] == found[:-1, :2]).all(axis=1)) if len(found) else np.zeros(0, bool)
    return found[~same]


def periodic_runs(docs: DataFrame, rewrite: Callable[[list[bytes], int | None], list[bytes]] | None = None) -> DataFrame:
    """(doc_id, runs, collapsed) of every row of ``docs`` (doc_id, text).

    ``runs`` are structs (start, length, period) in words, by start and
    period; ``collapsed`` is the text's words, joined by single spaces,
    without those that a run has after its first period.  ``rewrite``
    turns a text's words and doc_id into the words to search.
    """
    def fn(texts, rows):
        ids = rows.column(0).to_pylist()
        docs_words = [t.encode("utf-8", "surrogatepass").split() for t in texts]
        if rewrite is not None:
            docs_words = [rewrite(w, i) for w, i in zip(docs_words, ids)]
        first = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum([len(w) for w in docs_words], out=first[1:])
        number: dict[bytes, int] = {}
        words = np.fromiter((number.setdefault(w, len(number)) for ws in docs_words for w in ws), np.int64, int(first[-1]))
        found = runs_of(words, first)
        owner = np.searchsorted(first, found[:, 0], "right") - 1
        found = found[np.lexsort((found[:, 2], found[:, 0], owner))]
        change = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(change, found[:, 0] + found[:, 2], 1)
        np.add.at(change, found[:, 1], -1)
        drop = np.cumsum(change[:-1]) > 0
        counts = np.bincount(owner, minlength=len(texts))
        collapsed = []
        for i, ws in enumerate(docs_words):
            if counts[i]:
                ws = [w for w, gone in zip(ws, drop[first[i]:first[i + 1]].tolist()) if not gone]
            collapsed.append(b" ".join(ws).decode("utf-8", "surrogatepass"))
        offsets = np.zeros(len(texts) + 1, dtype=np.int32)
        np.cumsum(counts, out=offsets[1:])
        spans = pa.StructArray.from_arrays(
            [pa.array(found[:, 0] - first[np.sort(owner)], pa.int64()), pa.array(found[:, 1] - found[:, 0], pa.int64()),
             pa.array(found[:, 2], pa.int64())], names=["start", "length", "period"])
        return {"doc_id": rows.column(0), "runs": pa.ListArray.from_arrays(pa.array(offsets), spans), "collapsed": collapsed}

    return common.map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "text", fn,
                            "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string",
                            ["doc_id"])


def looped(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The contract's words: one document in ten, by its id, goes on in a loop from some word on."""
    if doc_id is None or not words or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return words
    n, g = len(words), h // 10
    at = g % n
    period = 1 + (n - at) // (3 + g % 8)
    part = words[at:at + period]
    return words[:at] + (part * (-(-(n - at) // period)))[:n - at]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document: doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256."""
    found = periodic_runs(common.table(spark, sf_dir, "documents"), looped)
    # the greatest length; of several the smallest start, then period
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"),
                                                              (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return (found.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
                    F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
                    F.floor(1000 * F.col("best.length") / -F.col("best.period")).cast("long").alias("exponent_milli"),
                    F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))
