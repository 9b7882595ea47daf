"""Operator 4: packing documents into sequences by best-two-fit.

Method.  A document is its token ids and the end id; only documents longer
than a sequence are cut, into full pieces and a rest.  A sequence is filled
greedily: the longest piece left, then again and again the longest piece
that fits the gap.  Then its smallest piece is taken out, if two unpacked
pieces fit the gap so expanded more tightly, and put back for later; this
repeats as long as the gap shrinks.

Scale.  Which of several pieces of one length goes where does not matter,
so the plan is made over the histogram of lengths: 4096 numbers at most,
whatever the corpus holds.  A filling found once is repeated as often as
the counts allow; each filling uses a length up, so the plan has a few
thousand fillings at most.  The pieces are numbered within their length by
a distributed count (length and bucket, pre-aggregated), and a task finds a
piece's sequence from its number.  Nothing of the corpus but the histogram
reaches the driver.  Tokens are made once, with a bounded cache of words
in each Python worker, since the tokenizer treats words on their own.

Results on edge cases.  Null and empty texts are one piece of the end id.
Strings of special tokens in a text give their ids, as the tokenizer does.
Null doc_ids and repeated rows are packed like others, each row by itself.
An empty table gives no row.  Other columns take no part.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from . import common
from .words import codes_of, mix64, span_hashes

SEQUENCE = 4096
END_ID = 1
VOCABULARY = "word_bpe_49k.json"
#: Words that a worker's cache of plain words holds before it starts anew (about 30 bytes each).
CACHE_CHUNKS = 1_000_000
#: Bytes that its cache of other chunks holds before it starts anew, about; CHUNK_BYTES for an entry besides its text.
CACHE_BYTES, CHUNK_BYTES = 64 << 20, 200
#: Pieces of one length that are numbered together in one task, about.
BUCKET_PIECES = 50_000

#: White space and controls that str.split() cuts at but the tokenizer may not.
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_SPACE = re.compile("[ \t\n\r\x0b\x0c]+")
#: Fixed: Latin letters and common signs.  In texts of these and ASCII alone, but for the
#: apostrophe, the vocabulary's words are runs of letters, single digits and runs of signs.
_LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿßœš"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞŒŠ"
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~¡¿«»“”‘’–—…€§°·©®"
_BLANK, _LETTER, _DIGIT, _SIGN = range(4)
_PLAIN = re.compile("[" + re.escape(" \t\n\r0123456789" + _LETTERS + _CAPITALS + _SIGNS) + "]*")


class ChunkTokenizer:
    """Token ids of texts as little-endian 32-bit bytes, one per worker process and vocabulary."""

    _held: dict[str, "ChunkTokenizer"] = {}

    def __init__(self, vocabulary: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Tokenizer, pre_tokenizers

        path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
        self.tokenizer = Tokenizer.from_file(path)
        # strings of the vocabulary's own tokens, which the tokenizer takes out of a text first
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.chunks: dict[str, bytes] = {}
        self.chunk_bytes = 0
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.as_bytes = {ord(c): level.pre_tokenize_str(c)[0][0] for c in _LETTERS + _SIGNS + "0123456789"}
        table = np.zeros((2, 0x2100), dtype=np.uint32)      # class and lower case of the plain characters
        for kind, chars in ((_LETTER, _LETTERS + _CAPITALS), (_DIGIT, "0123456789"), (_SIGN, _SIGNS)):
            for c in chars:
                table[:, ord(c)] = kind, ord(c.lower())
        self.table = table
        self.value = np.where(table[0] > 0, mix64(table[1].astype(np.uint64) + np.uint64(77)), np.uint64(0))
        self._empty()

    def _empty(self) -> None:
        """A new word cache: sorted hashes, and the place of each word's ids in the pool and their number."""
        self.known, self.at, self.size = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)
        self.pool, self.used = np.zeros(1 << 18, dtype="<u4"), 0

    @classmethod
    def get(cls, vocabulary: str) -> "ChunkTokenizer":
        if vocabulary not in cls._held:
            cls._held[vocabulary] = cls(vocabulary)
        return cls._held[vocabulary]

    def ids(self, texts: list[str]) -> list[bytes]:
        plain = [i for i, t in enumerate(texts) if _PLAIN.fullmatch(t) and not any(m in t for m in self.marks)]
        out: list = [None] * len(texts)
        for i, b in zip(plain, self._plain_ids([texts[i] for i in plain])):
            out[i] = b
        rest = [i for i, b in enumerate(out) if b is None]
        split = [_SPACE.split(texts[i]) if _ODD_SPACE.search(texts[i]) else texts[i].split() for i in rest]
        if self.chunk_bytes > CACHE_BYTES:
            self.chunks.clear()
            self.chunk_bytes = 0
        new = list({c for chunks in split for c in chunks}.difference(self.chunks))
        for chunk, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)):
            self.chunks[chunk] = ids = np.array(e.ids, dtype="<u4").tobytes()
            self.chunk_bytes += CHUNK_BYTES + 4 * len(chunk) + len(ids)
        for i, chunks in zip(rest, split):
            out[i] = b"".join(map(self.chunks.__getitem__, chunks))
        return out

    def _learn(self, words: list[str], hashes: np.ndarray) -> None:
        """Ids of new ``words``, whose ``hashes`` ascend, into the cache."""
        tokenize = self.tokenizer.model.tokenize
        ids = [[t.id for t in tokenize(w if w.isascii() else w.translate(self.as_bytes))] for w in words]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((x for i in ids for x in i), np.uint32, int(sizes.sum()))
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        spot = np.searchsorted(self.known, hashes)
        self.at = np.insert(self.at, spot, self.used + np.cumsum(sizes) - sizes)
        self.size = np.insert(self.size, spot, sizes)
        self.known = np.insert(self.known, spot, hashes)
        self.pool[self.used:self.used + len(flat)] = flat
        self.used += len(flat)

    def _plain_ids(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        if len(self.known) > CACHE_CHUNKS:
            self._empty()
        codes, begin = codes_of(texts)
        kind = self.table[0][codes]
        edge = np.flatnonzero((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)) + 1
        edge = np.concatenate([[0], edge, [len(codes)]])
        start, end = edge[:-1], edge[1:]
        keep = kind[start] != _BLANK
        start, end = start[keep], end[keep]
        if not len(start):
            return [b""] * len(texts)
        hashes = span_hashes(self.value[codes], start, end)
        distinct, where, index = np.unique(hashes, return_index=True, return_inverse=True)
        new = np.flatnonzero(np.searchsorted(self.known, distinct) == np.searchsorted(self.known, distinct, "right"))
        if len(new):
            lower = self.table[1][codes].astype("<u4").tobytes().decode("utf-32-le")
            a, b = start[where[new]].tolist(), end[where[new]].tolist()
            self._learn([lower[x:y] for x, y in zip(a, b)], distinct[new])
        row = np.searchsorted(self.known, distinct)[index]
        first, size = self.at[row], self.size[row].astype(np.int64)
        total = np.concatenate([[0], np.cumsum(size)])
        ids = self.pool[np.repeat(first - total[:-1], size) + np.arange(total[-1])]
        cut = total[np.searchsorted(start, begin)].tolist()
        return [ids[x:y].tobytes() for x, y in zip(cut[:-1], cut[1:])]


def pieces_of(docs: DataFrame, vocabulary: str = VOCABULARY, sequence: int = SEQUENCE, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document."""
    step, end = 4 * sequence, np.array([END_ID], dtype="<u4").tobytes()

    def fn(texts, rows):
        owner, piece, length, crc, ids = [], [], [], [], []
        for i, b in enumerate(ChunkTokenizer.get(vocabulary).ids(texts)):
            b += end
            for k, at in enumerate(range(0, len(b), step)):
                part = b[at:at + step]
                owner.append(i)
                piece.append(k)
                length.append(len(part) >> 2)
                crc.append(zlib.crc32(part))
                if keep_ids:
                    ids.append(part)
        out = {"doc_id": rows.column(0).take(pa.array(owner, pa.int64())), "piece": piece,
               "start": np.array(piece, dtype=np.int64) * sequence, "length": length, "ids_crc32": crc}
        if keep_ids:
            out["ids"] = common.flat_lists(np.frombuffer(b"".join(ids), "<u4").astype(np.int32), length, pa.int32())
        return out

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return common.map_texts(docs.select(F.col("doc_id").cast("long"), "text"), "text", fn, schema, ["doc_id"])


def plan(histogram: dict[int, int], sequence: int = SEQUENCE) -> tuple[np.ndarray, int]:
    """Fillings for so many pieces of each length.

    Returns rows (length, first, shift, offset), sorted by length and first,
    and the number of sequences: the pieces of a length numbered from
    ``first`` (to the next row's) go to sequence number + shift at offset.
    """
    left = np.zeros(sequence + 1, dtype=np.int64)
    for n, c in histogram.items():
        left[n] = c
    lengths = np.arange(sequence + 1)
    taken = np.zeros(sequence + 1, dtype=np.int64)
    rows, sequences = [], 0
    while left.any():
        free = left.copy()
        fill, gap = [], sequence
        while gap:      # greedy: the longest that fits
            fits = np.flatnonzero(free[:gap + 1])
            if not len(fits):
                break
            fill.append(int(fits[-1]))
            free[fill[-1]] -= 1
            gap -= fill[-1]
        while gap:      # two for the smallest, if they fit more tightly
            small = fill[-1]
            room = gap + small
            low = np.maximum.accumulate(np.where(free > 0, lengths, 0))
            first = np.flatnonzero(free[:room + 1])
            second = low[np.minimum(first, room - first)]
            alone = (second == first) & (free[first] < 2)
            second = np.where(alone, low[np.maximum(first - 1, 0)], second)
            total = np.where(second > 0, first + second, 0)
            if not len(total) or total.max() <= small:
                break
            best = int(np.argmax(total))
            free[small] += 1
            a, b = int(first[best]), int(second[best])
            fill = sorted([*fill[:-1], a, b], reverse=True)
            free[a] -= 1
            free[b] -= 1
            gap = room - a - b
        used = np.bincount(fill, minlength=sequence + 1)
        need = np.flatnonzero(used)
        times = int((left[need] // used[need]).min())
        offset = 0
        for n in fill:
            rows.append((n, taken[n], sequences - taken[n], offset))
            taken[n] += times
            offset += n
        left -= used * times
        sequences += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return table, sequences


def pack(pieces: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """``pieces`` (with ``length``) and their sequence_id and offset."""
    spark = pieces.sparkSession
    common.ship_package(spark)
    uid, bucket, first, at_place, at = (common.free_name(pieces, c) for c in ("__uid", "__bucket", "__before", "__place", "__at"))
    held = common.materialise(pieces.withColumn(uid, F.monotonically_increasing_id()), "pieces")
    counted = held.groupBy("length").agg(F.count("*").alias("n")).collect()     # ``sequence`` rows at most
    histogram = {int(r.length): r.n for r in counted}
    table, _ = plan(histogram, sequence)
    buckets = max(1, -(-max(histogram.values(), default=1) // BUCKET_PIECES))
    held = held.withColumn(bucket, F.pmod(F.xxhash64(uid), F.lit(buckets)))
    before = (held.groupBy("length", bucket).agg(F.count("*").alias("n"))
              .withColumn(first, F.sum("n").over(Window.partitionBy("length").orderBy(bucket)) - F.col("n"))
              .drop("n"))
    number = F.row_number().over(Window.partitionBy("length", bucket).orderBy(uid)) - 1
    numbered = held.withColumn(at_place, number).join(before, ["length", bucket])
    plan_rows = spark.sparkContext.broadcast(table)     # bounded by the sequence length, not by the corpus

    @F.pandas_udf("sequence_id long, offset long")
    def place(length, number):
        import pandas as pd
        t = plan_rows.value
        lo = np.searchsorted(t[:, 0], length.to_numpy(), "left")
        hi = np.searchsorted(t[:, 0], length.to_numpy(), "right")
        at, n = lo.copy(), number.to_numpy()
        while (step := np.flatnonzero(hi - at > 1)).size:   # bisection in each piece's own rows
            mid = (at[step] + hi[step]) // 2
            up = t[mid, 1] <= n[step]
            at[step[up]] = mid[up]
            hi[step[~up]] = mid[~up]
        return pd.DataFrame({"sequence_id": n + t[at, 2], "offset": t[at, 3]})

    out = numbered.withColumn(at, place(F.col("length"), F.col(first) + F.col(at_place)))
    return out.select(*[F.col(f"`{c}`") for c in pieces.columns], F.col(f"{at}.sequence_id").alias("sequence_id"),
                      F.col(f"{at}.offset").alias("offset"))


def op4_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(pieces_of(common.table(spark, sf_dir, "documents")))
