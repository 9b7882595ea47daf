"""Operator 1: language identification with hyperdimensional profiles.

Method.  Each letter has a random vector of ``DIMENSIONS`` signs.  An
n-gram's vector binds its letters: the product of the letters' vectors,
each rotated (permuted) by its place from the end.  A text is the bundle
(sum) of the vectors of its n-grams, a language the bundle of all its
training texts.  A text gets the language whose prototype has the largest
cosine with it.  Words are lower-cased runs of letters; each is framed by
blanks, which have a vector of their own, so beginnings and ends count.

Scale.  Training is one pass over all training rows: each task adds up one
integer vector per language, and a group-by adds these; the model is a few
languages times ``DIMENSIONS`` numbers.  Prediction is one narrow pass.
Inside a task n-grams are counted in arrays and multiplied with their
vectors as matrices, block by block.  Sums are integers, so the result does
not depend on order or partitioning.

Results on edge cases.  Null and empty texts and texts without a letter get
``und`` and score 0.0, and so does every text if nothing was learned.  Rows
with a null lang are not learned from but are predicted.  Equal cosines go
to the first language by name.  Repeated rows are learned as often as they
occur.  Other columns take no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .words import codes_of, mix64

DIMENSIONS = 1024
NGRAM = 3
UNDETERMINED = "und"
#: n-grams whose vectors are made at once: bounds the work arrays to a few MB.
_BLOCK = 4096

_BLANK = 32


class _Letters:
    """Per worker process: lower-case letter of each code point (blank for all others)."""

    table: np.ndarray | None = None

    @classmethod
    def load(cls) -> np.ndarray:
        if cls.table is None:
            out = np.full(0x110000, _BLANK, dtype=np.uint32)
            for i in range(0x110000):
                c = chr(i)
                if c.isalpha():
                    low = c.lower()
                    out[i] = ord(low) if len(low) == 1 else i
            cls.table = out
        return cls.table


def letter_vectors(codes: np.ndarray) -> np.ndarray:
    """Random signs of each code point, the same in every process."""
    words = np.arange(DIMENSIONS // 64, dtype=np.uint64)
    bits = mix64(codes.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + mix64(words + np.uint64(1))[None, :])
    return (np.unpackbits(bits.view(np.uint8), axis=1).astype(np.int8) * 2 - 1)


def ngram_vectors(grams: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Bound vectors of n-grams given as rows of letter indexes."""
    out = np.ones((len(grams), DIMENSIONS), dtype=np.float32)
    for place in range(NGRAM):
        out *= np.roll(vectors, NGRAM - 1 - place, axis=1)[grams[:, place]]
    return out


def _grams(texts: list[str]):
    """Distinct letters, distinct n-grams (rows of letter indexes), and the n-gram and text of every occurrence."""
    codes, begin = codes_of(texts)
    low = _Letters.load()[codes]
    # runs of other characters count as one blank
    keep = np.ones(len(low), dtype=bool)
    keep[1:] = (low[1:] != _BLANK) | (low[:-1] != _BLANK)
    keep[begin[:-1]] = True
    text = np.repeat(np.arange(len(texts)), np.diff(begin))[keep]
    low = low[keep]
    # a blank before each text
    first = np.flatnonzero(np.diff(text, prepend=-1))
    low, text = np.insert(low, first, _BLANK), np.insert(text, first, np.arange(len(texts)))
    letters, index = np.unique(low, return_inverse=True)
    base = np.int64(len(letters))
    n = max(0, len(index) - NGRAM + 1)
    key = np.zeros(n, dtype=np.int64)
    for place in range(NGRAM):
        key = key * base + index[place:place + n]
    whole = (text[:n] == text[NGRAM - 1:]) & (low[1:n + 1] != _BLANK)   # the middle letter is a letter
    key, text = key[whole], text[:n][whole]
    if base ** NGRAM <= 1 << 22:
        flag = np.zeros(int(base) ** NGRAM, dtype=bool)
        flag[key] = True
        distinct = np.flatnonzero(flag)
        rank = np.zeros(len(flag), dtype=np.int32)
        rank[distinct] = np.arange(len(distinct))
        gram = rank[key]
    else:
        distinct, gram = np.unique(key, return_inverse=True)
    parts = np.stack([(distinct // base ** (NGRAM - 1 - p)) % base for p in range(NGRAM)], axis=1)
    return letters, parts, gram, text


def bundles(texts: list[str], group: np.ndarray, groups: int) -> np.ndarray:
    """Sum of the n-gram vectors of the texts of each group (group[i] is the group of text i)."""
    out = np.zeros((groups, DIMENSIONS), dtype=np.float64)
    letters, parts, gram, text = _grams(texts)
    vectors = letter_vectors(letters)
    of = group[text]
    order = np.argsort(gram, kind="stable") if len(parts) > _BLOCK else np.arange(len(gram))
    gram, of = gram[order], of[order]
    for a in range(0, len(parts), _BLOCK):
        b = min(a + _BLOCK, len(parts))
        lo, hi = (np.searchsorted(gram, [a, b]) if len(parts) > _BLOCK else (0, len(gram)))
        counts = np.bincount(of[lo:hi].astype(np.int64) * (b - a) + gram[lo:hi] - a, minlength=groups * (b - a))
        # counts and sums stay below 2^24, where single precision is exact
        out += counts.reshape(groups, b - a).astype(np.float32) @ ngram_vectors(parts[a:b], vectors)
    return out


def prototypes(docs: DataFrame, held_out: Column) -> dict[str, np.ndarray]:
    """Bundle of each language over all rows with a lang that are not held out."""

    def fn(texts, rows):
        langs, group = np.unique(np.array(rows.column(0).to_pylist(), dtype=object), return_inverse=True)
        sums = np.rint(bundles(texts, group, len(langs))).astype(np.int64)
        place = np.tile(np.arange(DIMENSIONS, dtype=np.int32), len(langs))
        return {"lang": pa.array(np.repeat(langs, DIMENSIONS), pa.string()), "place": place, "total": sums.ravel()}

    train = docs.filter(F.col("lang").isNotNull() & ~held_out & F.col("text").isNotNull()).select("lang", "text")
    rows = (common.map_texts(train, "text", fn, "lang string, place int, total long", ["lang"])
            .groupBy("lang", "place").agg(F.sum("total").alias("total"))
            .groupBy("lang").agg(F.expr("transform(array_sort(collect_list(struct(place, total))), x -> x.total)").alias("v")))
    found = {r.lang: np.array(r.v, dtype=np.float64) for r in rows.collect()}
    return {k: v for k, v in sorted(found.items()) if v.any()}


def predict(texts: list[str], names: list[str], unit: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language and cosine (at least 0) of each text; ``unit`` has the prototypes as unit rows."""
    own = bundles(texts, np.arange(len(texts)), len(texts))
    norm = np.linalg.norm(own, axis=1)
    if not len(names):
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    cosine = own @ unit.T / np.maximum(norm, 1e-12)[:, None]
    best = cosine.argmax(axis=1)
    score = np.clip(cosine[np.arange(len(texts)), best], 0.0, 1.0)
    return [names[b] if n else UNDETERMINED for b, n in zip(best.tolist(), norm.tolist())], np.where(norm > 0, score, 0.0)


def language_column(text: Column, learned: dict[str, np.ndarray], spark: SparkSession) -> Column:
    """struct<lang_pred, score> of a text column."""
    common.ship_package(spark)
    names = list(learned)
    unit = np.stack([v / np.linalg.norm(v) for v in learned.values()]) if names else np.zeros((0, DIMENSIONS))
    held = spark.sparkContext.broadcast((names, unit))      # languages x DIMENSIONS numbers

    @F.pandas_udf("lang_pred string, score double")
    def tell(text):
        import pandas as pd
        names, unit = held.value
        texts = [t if t is not None else "" for t in text]
        langs, scores = [], np.zeros(len(texts))
        for a, b in common.in_chunks(texts):
            part, scores[a:b] = predict(texts[a:b], names, unit)
            langs += part
        return pd.DataFrame({"lang_pred": langs, "score": scores})

    return tell(text)


def op1_hyperdimensional_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document: doc_id, held_out, lang_pred, score."""
    docs = common.table(spark, sf_dir, "documents")
    held_out = common.held_out_mod4(F.col("doc_id"))
    learned = prototypes(docs, held_out)
    return (docs.select("doc_id", held_out.alias("held_out"), language_column(F.col("text"), learned, spark).alias("p"))
            .select("doc_id", "held_out", "p.lang_pred", "p.score"))
