"""Operator 9: exact repeated passages by hashing the units of lines.

Method.  A text is cut into lines and a line into sentences (a unit ends
after ``.``, ``!`` or ``?`` before white space, or at a line feed).  Inside a
sentence of any length, the least hash of two neighbouring words in every
window of ``WINDOW`` such pairs ends a unit too (winnowing), so cuts are at
most ``WINDOW`` words apart and the words of a window alone decide them.  Of
a repeated passage of 50 words or more, wherever it begins and ends, all but
``2 * WINDOW + 1`` words at most are whole units; 25 words stay to be found.
A unit is normalised to its
lower-case words and hashed to 128 bits.  The digests are grouped over all
documents, and the occurrence ranked first (least doc_id, then place in the
text) is the original.  In every other place the unit is a repeat.  Repeats
that follow each other and hold ``MIN_WORDS`` words or more are cut from
the text; shorter runs, such as a licence line, stay.  Units keep their
offsets in the original text, and the removed spans are returned.

Scale.  A repeat inside one document is known without a shuffle.  For the
rest, each document sends one row per distinct digest; a group-by with
partial aggregation finds the least doc_id, and a sort-merge join, which
adaptive execution splits where a line is hot, sends the repeats back to
their documents.  No group is collected except the repeats of one document.

Results on edge cases.  Null text gives null and no spans; empty text stays
empty.  Units without words are never repeats of their own but go with the
run around them.  Null ids rank last.  Rows with the same doc_id rank
equal: a unit first seen in both stays in both.  Other columns pass through
whatever their names are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from . import common
from .words import Words, mix64, words_of

#: Words of a run of repeated units from which it is removed: what a passage of
#: 50 words holds in whole units at least (50 - 2 * WINDOW - 1).
MIN_WORDS = 25

_U = np.uint64
_LAST_ID = (1 << 63) - 1
#: Code points that end a sentence before white space.
_ENDS = [ord(c) for c in ".!?"]
#: Neighbouring word pairs of a sentence among which the least hash ends a unit.
WINDOW = 12


def _least_pairs(w: Words, word: np.ndarray) -> np.ndarray:
    """Second words of the pairs that are the least (leftmost) of a window inside a sentence, but for a sentence's last word."""
    n = len(w.hashes)
    if n <= WINDOW:
        return np.zeros(0, dtype=np.int64)
    size = np.diff(word)
    sentence = np.repeat(np.arange(len(size)), size)
    pair = mix64(w.hashes[:-1] * _U(0x9E3779B97F4A7C15) + w.hashes[1:])   # pair i ends with word i + 1
    windows = n - WINDOW
    least, at = pair[:windows].copy(), np.arange(windows)
    for j in range(1, WINDOW):
        less = pair[j:j + windows] < least
        least[less] = pair[j:j + windows][less]
        at[less] = np.flatnonzero(less) + j
    chosen = np.unique(at[sentence[:windows] == sentence[WINDOW:]]) + 1
    return chosen[sentence[chosen] == sentence[np.minimum(chosen + 1, n - 1)]]


def units_of(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First character of each unit of a chunk (with the chunk's end), first word of each unit, unit of each text's begin."""
    c = w.codes
    cut = np.zeros(len(c) + 1, dtype=bool)
    feed = c == 10
    cut[1:] = feed
    space = (c == 32) | feed | (c == 13) | (c == 9)
    stop = (c[:-1] == _ENDS[0]) | (c[:-1] == _ENDS[1]) | (c[:-1] == _ENDS[2])
    cut[1:-1] |= stop & space[1:]
    cut[w.begin] = True
    cut[w.end[_least_pairs(w, np.searchsorted(w.start, np.flatnonzero(cut)))]] = True
    edge = np.flatnonzero(cut)
    return edge, np.searchsorted(w.start, edge), np.searchsorted(edge, w.begin)


def unit_digests(w: Words, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two digests of each unit's word sequence, and its number of words."""
    n = np.diff(word)
    place = np.arange(len(w.hashes)) - np.repeat(word[:-1], n)
    out = []
    for salt in (_U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9)):
        total = np.concatenate([[_U(0)], np.cumsum(
            mix64((w.hashes ^ salt) + place.astype(_U) * _U(0x9E3779B97F4A7C15)), dtype=_U)])
        out.append(mix64(total[word[1:]] - total[word[:-1]] + n.astype(_U)))
    return out[0], out[1], n


def _digests(docs: DataFrame) -> DataFrame:
    """(id, row_key, hi, lo): the distinct unit digests of each document."""

    def fn(texts, rows):
        w = words_of(texts)
        _, word, first = units_of(w)
        hi, lo, n = unit_digests(w, word)
        owner = np.repeat(np.arange(len(texts)), np.diff(first))
        has = np.flatnonzero(n > 0)
        order = has[np.lexsort((lo[has], hi[has], owner[has]))]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (hi[order][1:] != hi[order][:-1]) | (lo[order][1:] != lo[order][:-1]) | (
            owner[order][1:] != owner[order][:-1])
        at = order[new]
        row = pa.array(owner[at], pa.int64())
        return {"id": rows.column(0).take(row), "row_key": rows.column(1).take(row),
                "hi": hi[at].view(np.int64), "lo": lo[at].view(np.int64)}

    return common.map_texts(docs, "text", fn, "id long, row_key long, hi long, lo long", ["id", "row_key"])


def _cut(texts: list[str], repeated: list[np.ndarray], min_words: int) -> tuple[list[str], list[list]]:
    """Texts without the runs of repeated units, and the removed (start, end) spans."""
    w = words_of(texts)
    edge, word, first = units_of(w)
    hi, _, n = unit_digests(w, word)
    kept, spans = [], []
    for i, text in enumerate(texts):
        a, b = first[i], first[i + 1]
        own, words = hi[a:b], n[a:b]
        again = np.ones(b - a, dtype=bool)
        again[np.unique(own, return_index=True)[1]] = False     # later in the same text
        if len(repeated[i]):
            again |= np.isin(own.view(np.int64), repeated[i])
        again |= words == 0
        out, parts, at = [], [], 0
        if again.any():
            step = np.diff(np.concatenate([[0], again.astype(np.int8), [0]]))
            for s, e in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()):
                if words[s:e].sum() >= min_words:
                    lo = int(edge[a + s] - w.begin[i])
                    hi_ = min(int(edge[a + e] - w.begin[i]), len(text))
                    out.append((lo, hi_))
                    parts.append(text[at:lo])
                    at = hi_
        kept.append("".join(parts) + text[at:])
        spans.append(out)
    return kept, spans


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with ``text`` cut, and a last column ``removed_spans`` array<struct<start, end>> of code points."""
    common.ship_package(docs.sparkSession)
    keyed = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("text")).withColumn(
        "row_key", F.xxhash64("text"))
    last = F.lit(_LAST_ID)
    units = common.materialise(_digests(keyed), "units")
    ranked = units.withColumn("rank", F.coalesce("id", last))
    first = (ranked.groupBy("hi", "lo").agg(F.min("rank").alias("first"), F.max("rank").alias("latest"))
             .filter("first < latest").select("hi", "lo", "first"))
    again = (ranked.join(first, ["hi", "lo"]).filter(F.col("rank") > F.col("first"))
             .groupBy("id", "row_key").agg(F.collect_set("hi").alias("units")))
    again = common.materialise(again, "repeats")
    common.release(units)

    @pandas_udf("text string, spans array<struct<start:int,end:int>>")
    def cut(text, repeated):
        import pandas as pd
        texts = [t if t is not None else "" for t in text]
        marks = [np.asarray(r if r is not None else [], dtype=np.int64) for r in repeated]
        out_t, out_s = [], []
        for a, b in common.in_chunks(texts):
            t, s = _cut(texts[a:b], marks[a:b], min_words)
            out_t += t
            out_s += s
        common.give_back()
        return pd.DataFrame({"text": [None if o is None else t for o, t in zip(text, out_t)],
                             "spans": [[{"start": x, "end": y} for x, y in s] for s in out_s]})

    names, made = docs.columns, common.free_name(docs, "__cut")
    joined = docs.join(again, docs["doc_id"].eqNullSafe(again["id"])
                       & (F.xxhash64(docs["text"]) == again["row_key"]), "left")
    done = joined.select(*[docs[f"`{c}`"] for c in names], cut(docs["text"], again["units"]).alias(made))
    return done.select(*[F.col(f"{made}.text").alias("text") if c == "text" else F.col(f"`{c}`") for c in names],
                       F.col(f"{made}.spans").alias("removed_spans"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its repeated passages removed: doc_id, text, removed_spans, n_removed."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).withColumn("n_removed", F.size("removed_spans"))
