"""Operator 10: quality by a factorisation machine.

Method.  A text's features are hashed words, statistics of its structure
(case, signs, repetition, sentence and line shapes, in bins) and its
length.  A factorisation machine scores them: a bias, a weight for each
feature and, for each pair of features, the inner product of two vectors of
``RANK`` numbers, which the sum-of-squares identity
``sum_{i<j} <v_i, v_j> x_i x_j = (|sum x_i v_i|^2 - sum x_i^2 |v_i|^2) / 2``
gives in time linear in the number of features.

Scale.  Fitting reads a sample of ``SAMPLE_ROWS`` labelled documents at
most (``sampling``); their features, not their texts, go to the driver,
which runs AdaGrad on them.  The model is a fixed number of weights.
Scoring is one narrow pass over all rows, in array code.

Results on edge cases.  Null and empty texts have the features of a text of
length 0 and get that score.  If the labelled rows are of one kind only or
there are none, every score is the share of label 1 (0.0 without rows).
Repeated rows score alike; other columns take no part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .sampling import labelled_sample
from .words import words_of

#: Most labelled documents that the fit reads.
SAMPLE_ROWS = 12_000
WORD_BUCKETS = 1 << 14
RANK = 8
EPOCHS, BATCH, RATE, RIDGE = 12, 128, 0.05, 1e-4
GOOD_SCORE = 0.7

#: Upper ends of the bins of shares and of sizes.
_SHARES = np.array([0, .005, .01, .02, .04, .07, .1, .15, .2, .25, .3, .35, .4, .5, .6, .7, .8, .9, .95, .99])
_SIZES = np.concatenate([[0], 1.5 ** np.arange(31)])
_BINS = 34
STATISTICS = ("upper", "digit", "sign", "bar", "distinct", "again", "top", "same_line", "no_end",
              "word_length", "sentence", "words_a_line", "lines", "words")
_SHARE_COUNT = 9
FEATURES = WORD_BUCKETS + _BINS * len(STATISTICS)


def _per(flags: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sum of the flags between neighbouring places of ``begin``."""
    total = np.concatenate([[0], np.cumsum(flags)])
    return (total[begin[1:]] - total[begin[:-1]]).astype(np.float64)


class _Kinds:
    """Per worker process: what each code point is."""

    table: np.ndarray | None = None

    @classmethod
    def load(cls) -> np.ndarray:
        if cls.table is None:
            cls.table = np.fromiter((c.isupper() + 2 * c.isdigit() + 4 * (not c.isalnum() and not c.isspace())
                                     for c in map(chr, range(0x110000))), np.uint8, 0x110000)
        return cls.table


def statistics(texts: list[str], w) -> np.ndarray:
    """STATISTICS of each text, by name's order: shares from 0 to 1, then sizes."""
    kinds = _Kinds.load()[w.codes]
    begin, first = w.begin, w.first
    chars = np.maximum(1.0, np.diff(begin) - 1.0)
    words = w.counts().astype(np.float64)
    some = np.maximum(1.0, words)
    c = w.codes
    inner_feed = c == 10
    inner_feed[begin[1:] - 1] = False
    lines = _per(inner_feed, begin) + 1
    stops = (c == 46) | (c == 33) | (c == 63)
    sentences = _per(stops, begin)
    same = np.zeros(len(w.hashes))
    owner = w.owner()
    if len(w.hashes):
        same[1:] = (w.hashes[1:] == w.hashes[:-1]) & (owner[1:] == owner[:-1])
    distinct, top = np.zeros(len(texts)), np.zeros(len(texts))
    if len(w.hashes):
        order = np.lexsort((w.hashes, owner))
        h, o = w.hashes[order], owner[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
        at = np.flatnonzero(new)
        distinct = np.bincount(o[at], minlength=len(texts)).astype(np.float64)
        np.maximum.at(top, o[at], np.diff(np.append(at, len(h))).astype(np.float64))
    repeated = np.zeros(len(texts))
    for i in np.flatnonzero(lines > 1).tolist():
        rows = [x for x in texts[i].split("\n") if x]
        repeated[i] = 1 - len(set(rows)) / max(1, len(rows))
    ended = _per(stops & np.append(c[1:] == 10, True), begin)
    return np.stack([
        _per(kinds & 1, begin) / chars, _per((kinds & 2) > 0, begin) / chars, _per((kinds & 4) > 0, begin) / chars,
        _per(c == 124, begin) / some, distinct / some, _per(same, first) / some, top / some, repeated,
        1 - np.minimum(1.0, ended / lines), _per(w.end - w.start, first) / some, words / np.maximum(1.0, sentences),
        words / lines, lines, words], axis=1)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers and values of all texts one after the other, and how many each text has."""
    w = words_of(texts)
    stats = statistics(texts, w)
    bins = np.empty(stats.shape, dtype=np.int64)
    bins[:, :_SHARE_COUNT] = np.searchsorted(_SHARES, stats[:, :_SHARE_COUNT] - 1e-12)
    bins[:, _SHARE_COUNT:] = np.searchsorted(_SIZES, stats[:, _SHARE_COUNT:] - 1e-12)
    bins = np.minimum(bins, _BINS - 1) + WORD_BUCKETS + _BINS * np.arange(len(STATISTICS))
    key = np.unique(w.owner() * WORD_BUCKETS + (w.hashes % np.uint64(WORD_BUCKETS)).astype(np.int64))
    owner, bucket = key // WORD_BUCKETS, key % WORD_BUCKETS
    distinct = np.bincount(owner, minlength=len(texts))
    all_owner = np.concatenate([owner, np.repeat(np.arange(len(texts)), len(STATISTICS))])
    number = np.concatenate([bucket, bins.ravel()])
    # hashed words share one unit of length; each statistic has half of one
    value = np.concatenate([1 / np.sqrt(np.maximum(1, distinct))[owner], np.full(bins.size, 0.5)])
    order = np.argsort(all_owner, kind="stable")
    return number[order], value[order], distinct + len(STATISTICS)


@dataclass
class Machine:
    bias: float
    weight: np.ndarray
    vector: np.ndarray
    constant: float | None = None

    def logits(self, number: np.ndarray, value: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        if not len(sizes):
            return np.zeros(0)
        at = np.cumsum(sizes) - sizes       # every text has its statistics, so no part is empty
        xv = value[:, None] * self.vector[number]
        total, square = np.add.reduceat(xv, at, axis=0), np.add.reduceat(xv * xv, at, axis=0)
        return self.bias + np.add.reduceat(value * self.weight[number], at) + 0.5 * (total ** 2 - square).sum(axis=1)

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(*features(texts)), -30, 30)))


def train(number: np.ndarray, value: np.ndarray, sizes: np.ndarray, y: np.ndarray, seed: int = 7) -> Machine:
    """AdaGrad on the logistic loss, in the order of a fixed random generator."""
    rng = np.random.default_rng(seed)
    m = Machine(float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))), np.zeros(FEATURES),
                rng.normal(0, 0.05, (FEATURES, RANK)))
    past_w, past_v, past_b = np.full(FEATURES, 1e-6), np.full((FEATURES, RANK), 1e-6), 1e-6
    first = np.cumsum(sizes) - sizes
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for a in range(0, len(order), BATCH):
            rows = order[a:a + BATCH]
            n = sizes[rows]
            at = np.repeat(first[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            j, x, begin = number[at], value[at], np.cumsum(n) - n
            xv = x[:, None] * m.vector[j]
            total = np.add.reduceat(xv, begin, axis=0)
            z = m.bias + np.add.reduceat(x * m.weight[j], begin) + 0.5 * (
                total ** 2 - np.add.reduceat(xv * xv, begin, axis=0)).sum(axis=1)
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) / len(rows)
            e = np.repeat(error, n)
            # the gradient of each distinct feature of the batch
            used, back = np.unique(j, return_inverse=True)
            grad_w = np.bincount(back, e * x, len(used)) + RIDGE * m.weight[used]
            part = (e * x)[:, None] * (np.repeat(total, n, axis=0) - xv)
            grad_v = np.stack([np.bincount(back, part[:, f], len(used)) for f in range(RANK)], axis=1) + RIDGE * m.vector[used]
            past_w[used] += grad_w ** 2
            past_v[used] += grad_v ** 2
            past_b += error.sum() ** 2
            m.weight[used] -= RATE * grad_w / np.sqrt(past_w[used])
            m.vector[used] -= RATE * grad_v / np.sqrt(past_v[used])
            m.bias -= RATE * error.sum() / np.sqrt(past_b)
    return m


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Machine:
    """A machine from labelled documents that are not held out (crc32(doc_id) mod 4 is not 2)."""
    sample = labelled_sample(docs, labels, "quality", common.held_out_mod4(F.col("doc_id")), rows)

    def fn(texts, batch):
        number, value, sizes = features(texts)
        import pyarrow as pa
        return {"label": batch.column(0), "number": common.flat_lists(number.astype(np.int32), sizes, pa.int32()),
                "value": common.flat_lists(value.astype(np.float32), sizes, pa.float32())}

    seen = common.map_texts(sample, "text", fn, "label int, number array<int>, value array<float>", ["label"]).toArrow()
    empty = np.zeros(0)
    if not seen.num_rows:
        return Machine(0.0, empty, empty, 0.0)
    y = (seen["label"].to_numpy() == 1).astype(np.float64)
    if y.min() == y.max():
        return Machine(0.0, empty, empty, float(y.mean()))
    number, value = (seen[c].combine_chunks() for c in ("number", "value"))
    sizes = np.diff(number.offsets.to_numpy()).astype(np.int64)
    flat, x = number.flatten().to_numpy().astype(np.int64), value.flatten().to_numpy().astype(np.float64)
    # rows arrive in any order: sort them by content, so that the fit is the same each time
    first = np.cumsum(sizes) - sizes
    print_ = np.add.reduceat(flat * 2654435761 % 1000003, first) * 2 + y.astype(np.int64)
    order = np.lexsort((sizes, print_))
    n = sizes[order]
    at = np.repeat(first[order] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return train(flat[at], x[at], n, y[order])


def score_column(text: Column, machine: Machine, spark: SparkSession) -> Column:
    """Score from 0 to 1 of a text column."""
    common.ship_package(spark)
    held = spark.sparkContext.broadcast(machine)    # FEATURES x (RANK + 1) numbers

    @F.pandas_udf("double")
    def score(text):
        import pandas as pd
        texts = [t if t is not None else "" for t in text]
        return pd.Series(np.concatenate([held.value.scores(texts[a:b]) for a, b in common.in_chunks(texts)]
                                        or [np.zeros(0)]))

    return score(text)


def op10_factorisation_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document: doc_id, held_out, score, predicted."""
    docs = common.table(spark, sf_dir, "documents")
    machine = fit(docs, common.table(spark, sf_dir, "labels"))
    return (docs.select("doc_id", common.held_out_mod4(F.col("doc_id")).alias("held_out"),
                        score_column(F.col("text"), machine, spark).alias("score"))
            .withColumn("predicted", (F.col("score") >= GOOD_SCORE).cast("int")))
