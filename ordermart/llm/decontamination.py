"""Operator 2: benchmark decontamination with the q-gram lemma.

Method.  Texts are reduced to their letters and digits in lower case.  An
item is found where a window of w = min(``WINDOW``, item length) characters
of it occurs in the document with at most k = ``ERROR_RATE`` w edits (6 in
60: a replaced word of six letters), fewer only in items of under 32.
Such a window shares w - q + 1 - k q of its q-grams with the document, all
within k + 1 diagonals.  Shared q-grams are counted per document, item and
diagonal band; bands are 2k wide and overlap by k, so each lies in one.
Every window that meets the bound in a band is verified on the 2k diagonals
of that band.  Windows copied letter by letter are seen by their consecutive
q-grams, and the pair needs no alignment.  So no pair within the budget is
lost, and none beyond it is reported.

Scale.  The index of the benchmark is sent to the tasks in blocks of about
``BLOCK_CHARS`` characters, one after the other if the benchmark is larger:
each block is applied, written and dropped before the next is read.
Documents are read once per block in a narrow pass: no shuffle, no group,
and a passage that a third of all documents hold costs each of them the
same.  Work arrays are cut at ``PAIRS`` shared q-grams.

Results on edge cases.  Null, empty and short texts have no match.  An item
with fewer than ``Q`` letters and digits matches nothing: it is too short
to be evidence.  Items that repeat are all reported.  An empty benchmark
gives no row and drops no document.  Other columns pass through ``remove_contaminated``
whatever their names are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .words import _Tables, codes_of, span_hashes

Q = 8
WINDOW = 60
ERROR_RATE = 0.1
#: Characters of benchmark text in one index; larger benchmarks take several passes.
BLOCK_CHARS = 8_000_000

MATCHES = "array<struct<item_id:long,start:int,end:int,edits:int>>"
_FILTER_BITS = 22
#: From the first to the last shared q-gram of a match: its window and one insertion an edit.
SPREAD = WINDOW + int(ERROR_RATE * WINDOW) - Q
#: Pairs of shared q-grams and windows handled at once inside a task; they bound the work arrays.
PAIRS, ALIGNED = 1 << 21, 1 << 13
#: Cells of the alignment (16 bits): edits times _UNIT and a diagonal below it; _FAR is out of the band.
_UNIT, _FAR = 64, 1 << 14
#: Letters after which alignments over their budget are left out.
_CHECKED = 6


@dataclass
class Index:
    """q-grams of a block of items, sorted by hash, with the bounds of each item."""

    ids: list
    codes: np.ndarray       # letters and digits of all items
    first: np.ndarray       # of each item, one more at the end
    grams: np.ndarray       # sorted hashes
    item: np.ndarray
    place: np.ndarray       # in the item
    window: np.ndarray
    budget: np.ndarray
    bound: np.ndarray
    seen: np.ndarray        # bit per hash prefix: a first, cheap test


def _reduced(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case letters and digits of all texts, the character each comes from, where each text begins, and q-gram hashes.

    Hashes of q-grams that would leave their text are 0.
    """
    codes, begin = codes_of(texts)
    _Tables.load()
    at = np.flatnonzero(_Tables.value[codes])
    first = np.searchsorted(at, begin)
    low = _Tables.lower[codes[at]]
    hashes = np.zeros(len(at), dtype=np.uint64)
    if len(at) >= Q:
        start = np.arange(len(at) - Q + 1)
        hashes[:len(start)] = span_hashes(_Tables.value[low], start, start + Q)
        for cut in first[1:].tolist():      # the last q - 1 of each text
            hashes[max(0, cut - Q + 1):cut] = 0
    return low, at, first, hashes


def build_index(items: list[tuple[int, str]]) -> Index:
    texts = [t or "" for _, t in items]
    low, _, first, hashes = _reduced(texts)
    sizes = np.diff(first)
    item = np.repeat(np.arange(len(items)), sizes)
    place = np.arange(len(low)) - np.repeat(first[:-1], sizes)
    keep = np.flatnonzero(hashes)
    order = keep[np.argsort(hashes[keep], kind="stable")]
    window = np.minimum(WINDOW, sizes)
    # a short item's budget is what leaves at least one shared q-gram
    budget = np.maximum(0, np.minimum((ERROR_RATE * window).astype(np.int64), (window - Q) // Q))
    bound = np.maximum(1, window - Q + 1 - budget * Q)
    seen = np.zeros(1 << _FILTER_BITS, dtype=bool)
    seen[(hashes[keep] >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
    return Index([i for i, _ in items], low, first, hashes[order], item[order], place[order], window, budget, bound, seen)


def _slices(hits: np.ndarray, counts: np.ndarray):
    """(first, end) of runs of hits with about PAIRS pairs, or one hit, in their core.

    ``end`` reaches as far past the core as a match that begins in it.
    """
    part = np.cumsum(counts) // PAIRS
    cuts = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(hits)]])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if b > a:
            yield a, int(np.searchsorted(hits, hits[b - 1] + SPREAD, "right"))


def _shared(index: Index, first: np.ndarray, hashes: np.ndarray):
    """Shared q-grams in slices: (document, item, place in the texts, place in the item) of each."""
    hit = np.flatnonzero(index.seen[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] & (hashes != 0))
    lo = np.searchsorted(index.grams, hashes[hit], "left")
    hi = np.searchsorted(index.grams, hashes[hit], "right")
    hit, lo, n = hit[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
    if not len(hit) or not len(index.bound):
        return
    # a stretch with too few places of shared q-grams, of whatever item, holds no match
    least = int(index.bound.min())
    far = np.zeros(len(hit), dtype=bool)
    if len(hit) >= least:
        near = np.flatnonzero(hit[least - 1:] - hit[:len(hit) - least + 1] <= SPREAD)
        mark = np.zeros(len(hit) + 1, dtype=np.int64)
        np.add.at(mark, near, 1)
        np.add.at(mark, near + least, -1)
        far = np.cumsum(mark[:-1]) > 0
    hit, lo, n = hit[far], lo[far], n[far]
    if not len(hit):
        return
    for a, b in _slices(hit, n):
        m = n[a:b]
        row = np.repeat(lo[a:b] - (np.cumsum(m) - m), m) + np.arange(m.sum())
        where = np.repeat(hit[a:b], m)
        yield np.searchsorted(first, where, "right") - 1, index.item[row], where, index.place[row]


def _verbatim(index: Index, doc, item, where, place):
    """(document, item, place in the texts) of the first whole window of each pair that is copied letter by letter."""
    diagonal = where - place
    order = np.lexsort((where, diagonal, item, doc))
    doc, item, where, diagonal = (x[order] for x in (doc, item, where, diagonal))
    length = index.window[item] - Q
    then = np.arange(len(doc)) + length
    whole = then < len(doc)
    then = np.minimum(then, len(doc) - 1)
    whole &= ((doc[then] == doc) & (item[then] == item) & (diagonal[then] == diagonal) & (where[then] - where == length))
    return doc[whole], item[whole], where[whole]


def _windows(index: Index, first: np.ndarray, doc, item, where, place):
    """(document, item, start in the item, lowest diagonal) of every item window that meets the bound in a band."""
    step = np.maximum(1, index.budget[item])
    band = (where - first[doc] - place) // step
    doc, item, place, step = (np.concatenate([x, x]) for x in (doc, item, place, step))
    band = np.concatenate([band, band - 1])
    order = np.lexsort((place, band, item, doc))
    doc, item, place, band, step = (x[order] for x in (doc, item, place, band, step))
    # a window that begins at s has the q-grams s to s + w - q: the bound-th after a hit must be among them
    bound, reach = index.bound[item], index.window[item] - Q
    then = np.arange(len(doc)) + bound - 1
    good = then < len(doc)
    then = np.minimum(then, len(doc) - 1)
    good &= (doc[then] == doc) & (item[then] == item) & (band[then] == band) & (place[then] - place <= reach)
    at = np.flatnonzero(good)
    size = index.first[item[at] + 1] - index.first[item[at]]
    low = np.maximum(0, place[then[at]] - reach[at])
    high = np.minimum(place[at], size - index.window[item[at]])
    # both ends grow along a band: leave out the starts that the hit before gave
    same = np.zeros(len(at), dtype=bool)
    same[1:] = ((doc[at][1:] == doc[at][:-1]) & (item[at][1:] == item[at][:-1]) & (band[at][1:] == band[at][:-1]))
    low[1:] = np.where(same[1:], np.maximum(low[1:], high[:-1] + 1), low[1:])
    n = np.maximum(0, high - low + 1)
    row = np.repeat(np.arange(len(at)), n)
    start = low[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    at = at[row]
    return doc[at], item[at], start, band[at] * step[at]


def align(patterns: np.ndarray, texts: np.ndarray, budget: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Banded alignment of each pattern (rows; 0 pads the end) with its text on the diagonals 0 to 2 * budget - 1.

    ``texts`` begin at the pattern's place on diagonal 0.  Returns the rows
    that keep within their budget, with the least edits of each and the text
    places where that alignment begins and ends.
    """
    length = (patterns != 0).sum(axis=1)
    rows = np.arange(len(patterns))
    width = 2 * int(budget.max())
    patterns, texts = np.ascontiguousarray(patterns.T), np.ascontiguousarray(texts.T)
    closed = np.arange(width)[:, None] >= 2 * budget
    # a cell holds edits * _UNIT + the diagonal that its path began on
    cells = np.where(closed, _FAR, np.arange(width)[:, None]).astype(np.int16)
    uneven = bool(closed.any())
    for j in range(len(patterns)):
        if j and j % _CHECKED == 0:             # the least of a row never falls: over budget is out
            live = np.flatnonzero(cells.min(axis=0) < (budget + 1) * _UNIT)
            rows, budget, closed = rows[live], budget[live], closed[:, live]
            cells, patterns, texts = cells[:, live], patterns[:, live], texts[:, live]
        step = cells + (texts[j:j + width] != patterns[j]) * np.int16(_UNIT)
        np.minimum(step[:-1], cells[1:] + np.int16(_UNIT), out=step[:-1])
        for c in range(1, width):
            np.minimum(step[c], step[c - 1] + np.int16(_UNIT), out=step[c])
        if uneven:
            step[closed] = _FAR
        ended = patterns[j] == 0
        cells = np.where(ended, cells, step) if ended.any() else step
    end = cells.argmin(axis=0)
    best = cells[end, np.arange(len(rows))].astype(np.int64)
    good = best < (budget + 1) * _UNIT
    rows, best, end = rows[good], best[good], end[good]
    return rows, best // _UNIT, best % _UNIT, end + length[rows]


def matches(texts: list[str], index: Index) -> list[list[tuple]]:
    """(item_id, start, end, edits) of each item found in each text, in character offsets.

    The match has the least edits; of copies letter by letter it is the first.
    """
    out: list[list[tuple]] = [[] for _ in texts]
    low, at, first, hashes = _reduced(texts)
    begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    best: dict[tuple[int, int], tuple] = {}

    def keep(doc, item, edits, a, z):
        a, z = np.maximum(a, first[doc]), np.minimum(z, first[doc + 1])
        for d, i, *hit in zip(doc.tolist(), item.tolist(), edits.tolist(), a.tolist(), z.tolist()):
            if (d, i) not in best or hit < best[d, i]:
                best[d, i] = hit

    for doc, item, where, place in _shared(index, first, hashes):
        d, i, a = _verbatim(index, doc, item, where, place)
        keep(d, i, np.zeros(len(d), dtype=np.int64), a, a + index.window[i])
        items = len(index.ids)
        copied = np.array([d * items + i for (d, i), hit in best.items() if hit[0] == 0], dtype=np.int64)
        rest = ~np.isin(doc * items + item, copied) & (index.budget[item] > 0)
        doc, item, start, diagonal = _windows(index, first, doc[rest], item[rest], where[rest], place[rest])
        for s in range(0, len(doc), ALIGNED):
            d, i, p, g = (x[s:s + ALIGNED] for x in (doc, item, start, diagonal))
            w, k = index.window[i], index.budget[i]
            cols = np.arange(int(w.max()))
            src = (index.first[i] + p)[:, None] + cols
            pattern = np.where(cols < w[:, None], index.codes[np.minimum(src, len(index.codes) - 1)], 0)
            cols = np.arange(int(w.max() + 2 * k.max()))
            origin = first[d] + p + g
            src = origin[:, None] + cols
            inside = (src >= first[d][:, None]) & (src < first[d + 1][:, None])
            text = np.where(inside, low[np.clip(src, 0, len(low) - 1)], 1)
            ok, edits, a, z = align(pattern, text, k)
            keep(d[ok], i[ok], edits, origin[ok] + a, origin[ok] + z)
    for (d, i), (e, a, z) in sorted(best.items()):
        out[d].append((index.ids[i], int(at[a] - begin[d]), int(at[z - 1] - begin[d]) + 1, e))
    return out


def indexes(benchmark: DataFrame) -> Iterator[tuple[Index, bool]]:
    """Indexes over blocks of items (item_id, text) of about BLOCK_CHARS characters at most, or one item; and whether it is the last."""
    items = benchmark.filter("text is not null").select(F.col("item_id").cast("long").alias("id"), "text")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-2 * total // BLOCK_CHARS)
    block = F.pmod(F.xxhash64("id", "text"), F.lit(max(1, blocks)))
    for b in range(blocks):
        rows = sorted(((r.id, r.text) for r in items.filter(block == b).toLocalIterator()), key=lambda x: (x[0] is None, x))
        yield build_index(rows), b == blocks - 1


def match_column(text: Column, index: Index, spark: SparkSession) -> Column:
    """Matches of the index's items in a text column, as MATCHES."""
    common.ship_package(spark)
    held = spark.sparkContext.broadcast(index)

    @F.pandas_udf(MATCHES)
    def find(text):
        import pandas as pd
        texts = [t if t is not None else "" for t in text]
        out = []
        for a, b in common.in_chunks(texts):
            out += [[{"item_id": i, "start": s, "end": e, "edits": n} for i, s, e, n in m]
                    for m in matches(texts[a:b], held.value)]
        del texts
        common.give_back()
        return pd.Series(out)

    return find(text)


def _block_by_block(benchmark: DataFrame, apply) -> list[DataFrame]:
    """``apply(index, before)`` for each block of the benchmark, each result written before the next block is read.

    The last one is not written: a benchmark of one block takes one narrow pass.
    """
    done: list[DataFrame] = []
    for index, last in indexes(benchmark):
        part = apply(index, done[-1] if done else None)
        done.append(part if last else common.materialise(part, "decontaminated"))
    return done


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, end, edits): the best match of each item in each row of ``docs``."""
    spark = docs.sparkSession

    def found(index, _):
        return (docs.select("doc_id", F.explode(match_column(F.col("text"), index, spark)).alias("m"))
                .select("doc_id", "m.item_id", "m.start", "m.end", "m.edits"))

    parts = _block_by_block(benchmark, found)
    if not parts:
        return docs.select("doc_id", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("item_id", "long"), ("start", "int"), ("end", "int"), ("edits", "int"))]).filter("false")
    return reduce(DataFrame.union, parts)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns kept."""
    name = common.free_name(docs, "__matches")

    def kept(index, before):
        rows = docs if before is None else before
        return rows.withColumn(name, match_column(F.col("text"), index, docs.sparkSession)).filter(
            F.size(name) == 0).drop(name)

    parts = _block_by_block(benchmark, kept)
    return parts[-1] if parts else docs


def op2_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in every document: doc_id, item_id, start, end, edits."""
    return contaminated(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
