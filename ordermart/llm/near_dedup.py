"""Operator 3: near-duplicate classes with ProbMinHash.

Method.  A text is the set of its five-word shingles.  ProbMinHash draws,
for each shingle, the arrival times of a Poisson process whose rate is the
shingle's weight; each arrival falls into one of ``M`` registers, a register
keeps its earliest arrival, and a shingle stops as soon as its next arrival
is later than the latest register (early termination).  Two texts agree in a
register with the probability Jaccard similarity of their weighted sets.
A shingle weighs more the more letters it has, from 1 to ``MAX_WEIGHT``
(``shingle_weights``).  The weight depends on the shingle alone, not on how
often it occurs: a line repeated in one copy only does not part it from the
other.  Registers are banded, equal bands make candidates, and candidates are
verified exactly: they are linked if the Jaccard similarity of their shingle
sets is ``THRESHOLD`` or more.  At this bound of the weights the probability
similarity of such a pair is 0.8 / (0.8 + 0.2 * MAX_WEIGHT) = 0.76 at least,
if all its long shingles are among those that differ.

Scale.  Texts with the same word sequence form one exact class by a
pre-aggregated group-by, and only one row of a class goes on.  A bucket
(texts equal in a band) is never expanded into pairs: its members are
compared with its least member, and a group of copies is one component
after that.  What is left are buckets of several components, as those of
texts that share a frequent passage.  Prefix filtering (``_prefix_buckets``)
finds which of their texts can still be linked; these are compared block by
block (``_block_links``), unless they are in one component, so no link
between components is lost and no pair becomes a row.  Joins on a hot pivot
or bucket are sort-merge joins between two shuffles, which adaptive
execution splits.

Results on edge cases.  Null, empty and wordless texts have no shingle:
they are in no group, their class is their own doc_id and they are always
kept.  A text of fewer than five words has one shingle, its word sequence.
Rows that repeat (same doc_id and text) are one document, of which
``keep_one`` keeps one row.  Null ids rank last; a class of null ids only
has the class id null.  Other columns pass through ``keep_one`` whatever
their names are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .components import connected_components
from .words import mix64, sequence_digest, shingle_letters, shingles_of, words_of

SHINGLE_WORDS = 5
THRESHOLD = 0.8
#: Weight of a shingle of LONG letters or more; an empty one would weigh 1.
MAX_WEIGHT, LONG = 1.25, 40
#: 26 bands of 5 registers: a pair shares no band with probability 3e-5 at similarity 0.8, 4e-4 at 0.76.
BANDS, ROWS = 26, 5
M = BANDS * ROWS
#: Shingle sets of a block; two blocks are compared in one task.
BLOCK_NODES = 256

_U = np.uint64
_LAST_ID = (1 << 63) - 1


def shingle_weights(letters: np.ndarray) -> np.ndarray:
    return 1 + (MAX_WEIGHT - 1) * np.minimum(letters, LONG) / LONG


def shingle_sets(shingles: np.ndarray, per: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text, how many a text has, and their weights."""
    at = np.arange(len(shingles))
    owner = np.repeat(np.arange(len(per)), per)
    order = np.lexsort((at, shingles, owner))
    s, o = shingles[order], owner[order]
    new = np.ones(len(s), dtype=bool)
    new[1:] = (s[1:] != s[:-1]) | (o[1:] != o[:-1])
    return s[new], np.bincount(o[new], minlength=len(per)), shingle_weights(letters[order][new])


def prob_minhash(items: np.ndarray, weights: np.ndarray, sizes: np.ndarray, m: int = M) -> np.ndarray:
    """Registers (texts x m) of the winning item's hash; all 0 for a text without items."""
    texts = len(sizes)
    time = np.full(texts * m, np.inf)
    won = np.zeros(texts * m, dtype=_U)
    owner = np.repeat(np.arange(texts), sizes)
    # a small set needs many arrivals an item before its registers fill
    block = np.maximum(1, -(-3 * m // np.maximum(sizes, 1)))[owner]
    item, clock, drawn = np.arange(len(items)), np.zeros(len(items)), np.zeros(len(items), dtype=np.int64)
    while len(item):
        g = block[item]
        rep = np.repeat(np.arange(len(item)), g)
        begin = np.cumsum(g) - g
        nth = np.arange(len(rep)) - begin[rep] + drawn[rep]
        r = mix64(items[item][rep] + (nth.astype(_U) + _U(1)) * _U(0xD1342543DE82EF95))
        step = -np.log(((r >> _U(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / weights[item][rep]
        run = np.cumsum(step)
        when = run - (run[begin] - step[begin])[rep] + clock[rep]
        slot = owner[item][rep] * m + (mix64(r ^ _U(0xA24BAED4963EE407)) % _U(m)).astype(np.int64)
        np.minimum.at(time, slot, when)
        first = np.flatnonzero(time[slot] == when)
        won[slot[first]] = items[item][rep[first]]
        limit = time.reshape(texts, m).max(axis=1)
        clock = when[begin + g - 1]
        go = clock < limit[owner[item]]
        drawn = (drawn + g)[go]
        item, clock = item[go], clock[go]
    return won.reshape(texts, m)


def band_keys(registers: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit bucket key for each band; the band's number is part of it."""
    out = np.tile(np.arange(bands, dtype=_U), (len(registers), 1))
    for j in range(rows):
        out = mix64(out * _U(0x9E3779B97F4A7C15) + registers[:, np.arange(bands) * rows + j])
    return out


def _signatures(docs: DataFrame) -> DataFrame:
    """Row per document: id, row key, node (digest of the word sequence; null without words) and band keys."""

    def fn(texts, rows):
        w = words_of(texts)
        items, sizes, weights = shingle_sets(*shingles_of(w, SHINGLE_WORDS), shingle_letters(w, SHINGLE_WORDS))
        keys = band_keys(prob_minhash(items, weights, sizes))
        node, check = sequence_digest(w)
        none = w.counts() == 0
        counts = np.where(none, 0, keys.shape[1])
        return {"id": rows.column(0), "row_key": rows.column(1),
                "node": pa.array(node.view(np.int64), mask=none), "check": pa.array(check.view(np.int64), mask=none),
                "bands": common.flat_lists(keys[~none].ravel().view(np.int64), counts, pa.int64())}

    return common.map_texts(docs, "text", fn, "id long, row_key long, node long, check long, bands array<long>",
                            ["id", "row_key"])


def _shingle_sets(texts: DataFrame) -> DataFrame:
    def fn(texts, rows):
        w = words_of(texts)
        items, sizes, _ = shingle_sets(*shingles_of(w, SHINGLE_WORDS), shingle_letters(w, SHINGLE_WORDS))
        return {"node": rows.column(0), "items": common.flat_lists(items.view(np.int64), sizes, pa.int64())}

    return common.map_texts(texts, "text", fn, "node long, items array<long>", ["node"])


def _jaccard(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose shingle sets reach the threshold."""
    full = (pairs.join(sets.select(F.col("node").alias("a"), F.col("items").alias("left")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("items").alias("right")), "b"))

    def run(batches):
        for batch in batches:
            la, ra = batch.column(2), batch.column(3)
            lv, lo = la.values.to_numpy(), la.offsets.to_numpy()
            rv, ro = ra.values.to_numpy(), ra.offsets.to_numpy()
            good = []
            for i in range(batch.num_rows):
                x, y = lv[lo[i]:lo[i + 1]], rv[ro[i]:ro[i + 1]]
                if THRESHOLD * max(len(x), len(y)) <= min(len(x), len(y)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    if both >= THRESHOLD * (len(x) + len(y) - both):
                        good.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(good, pa.int64())),
                                              batch.column(1).take(pa.array(good, pa.int64()))], names=["a", "b"])
            batch = la = ra = lv = rv = x = y = None
            common.give_back()

    return full.select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def _representatives(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text): the text of one row of each exact class among ``nodes`` (node, id, row_key)."""
    return (docs.join(nodes, (docs["id"].eqNullSafe(nodes["id"])) & (docs["row_key"] == nodes["row_key"]))
            .select(nodes["node"], docs["text"])
            .groupBy("node").agg(F.first("text").alias("text")))


def _components(classes: DataFrame, docs: DataFrame) -> DataFrame | None:
    """(node, component) of the exact classes that are linked to another one.

    ``classes`` has one row (node, id, row_key, bands) for each exact class.
    """
    buckets = classes.select("node", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("pivot")).filter("n > 1")
    members = common.materialise(buckets.join(shared, "bucket"), "buckets")
    if members.isEmpty():
        common.release(members)
        return None
    wanted = members.select("node").distinct()
    sets = common.materialise(
        _shingle_sets(_representatives(docs, classes.select("node", "id", "row_key").join(wanted, "node"))), "sets")
    pairs = (members.filter("node <> pivot")
             .select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct())
    comps = connected_components(_jaccard(pairs, sets), "a", "b")
    unsettled = common.materialise(_unsettled(members.filter("n > 2"), comps), "open")
    common.release(members)
    if not unsettled.isEmpty():
        prefixes = common.materialise(_prefix_buckets(unsettled.select("node", "comp").distinct(), sets), "prefixes")
        if not prefixes.isEmpty():
            more = _block_links(prefixes, sets)
            comps = connected_components(more.union(
                comps.filter("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b"))), "a", "b")
        common.release(prefixes)
    common.release(unsettled)
    common.release(sets)
    return comps


def _block_links(prefixes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between nodes of different components that prefix buckets connect.

    Nodes that buckets connect are a cluster; a cluster is cut into blocks
    of about BLOCK_NODES sets, and each two blocks meet in one task.
    """
    # buckets and nodes are both 64-bit hashes: a star for each bucket
    clusters = connected_components(prefixes, "bucket", "node").withColumnRenamed("component", "cluster")
    members = prefixes.select("node", "comp").distinct().join(clusters, "node")
    sized = (members.groupBy("cluster").agg(F.count("*").alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
             .filter("lo < hi").select("cluster", F.ceil(F.col("n") / BLOCK_NODES).cast("int").alias("blocks")))
    placed = (members.join(sized, "cluster").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
              .join(sets, "node")
              .select("cluster", "node", "comp", "block", "items", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
              .select("cluster", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
                      "node", "comp", "block", "items"))

    def meet(key, rows):
        import pandas as pd

        sizes = np.fromiter(map(len, rows["items"]), np.int64, len(rows))
        nodes, comps, block = (rows[c].to_numpy() for c in ("node", "comp", "block"))
        _, flat = np.unique(np.concatenate(rows["items"].to_numpy()), return_inverse=True)
        first = np.cumsum(sizes) - sizes
        mark = np.zeros(flat.max(initial=-1) + 1, dtype=np.int64)
        left = np.flatnonzero(block == key[1])
        a, b = [], []
        for i in left.tolist():
            right = np.flatnonzero((block == key[2]) & (comps != comps[i]) & ((key[1] != key[2]) | (nodes > nodes[i]))
                                   & (np.minimum(sizes, sizes[i]) >= THRESHOLD * np.maximum(sizes, sizes[i])))
            if len(right):
                own = flat[first[i]:first[i] + sizes[i]]
                mark[own] = 1
                n = sizes[right]
                begin = np.cumsum(n) - n
                both = np.add.reduceat(mark[flat[np.repeat(first[right] - begin, n) + np.arange(n.sum())]], begin)
                mark[own] = 0
                good = right[both >= THRESHOLD * (n + sizes[i] - both)]
                a += [int(nodes[i])] * len(good)
                b += nodes[good].tolist()
        return pd.DataFrame({"a": np.array(a, dtype=np.int64), "b": np.array(b, dtype=np.int64)})

    return placed.groupBy("cluster", "lo", "hi").applyInPandas(meet, "a long, b long")


def _unsettled(members: DataFrame, comps: DataFrame) -> DataFrame:
    """(bucket, node, n, comp) of the buckets whose members are in different components."""
    labelled = (members.select("bucket", "node", "n").join(comps, "node", "left")
                .select("bucket", "node", "n", F.coalesce("component", "node").alias("comp")))
    split = (labelled.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
             .filter("lo < hi").select("bucket"))
    return labelled.join(split, "bucket")


def _prefix_buckets(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """(bucket, node, n, comp): shingles that two linked nodes of different components must share.

    Sets of Jaccard similarity t or more share one of the first
    n - ceil(t n) + 1 members of each in any common order.  The order here
    puts shingles of one component only first, then the rare ones, so texts
    that only share a frequent passage meet in no bucket.
    """
    items = (sets.join(nodes, "node").select("node", "comp", F.explode("items").alias("bucket")))
    items = common.materialise(items, "items")
    spread = (items.groupBy("bucket").agg(F.count("*").alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
              .filter("lo < hi").select("bucket", "n"))
    ordered = (items.join(spread, "bucket", "left")
               .groupBy("node", "comp").agg(F.array_sort(F.collect_list(
                   F.struct(F.coalesce("n", F.lit(0)).alias("n"), "bucket"))).alias("all")))
    first = F.size("all") - F.ceil(F.size("all") * F.lit(THRESHOLD) - 1e-9) + 1
    return (ordered.select("node", "comp", F.explode(F.slice("all", 1, first.cast("int"))).alias("x"))
            .select("x.bucket", "node", "x.n", "comp").filter("n > 0"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(id, row_key, class_id, kept): one row per row of ``docs`` (doc_id, text, ...).

    ``class_id`` is the least doc_id of the row's near-duplicate class,
    ``row_key`` is xxhash64 of the text (null: empty), and ``kept`` marks
    the one document of the class that stays (on all rows that repeat it).
    """
    last = F.lit(_LAST_ID)
    keyed = docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "row_key", F.xxhash64("text"))
    found = common.materialise(_signatures(keyed), "signatures")
    # an exact class has one word sequence; its first document stands for it
    least = (found.filter("node is not null").groupBy("node", "check")
             .agg(F.min(F.coalesce("id", last)).alias("first_id")))
    classes = common.materialise(
        found.join(least, ["node", "check"]).filter(F.coalesce("id", last) == F.col("first_id"))
        .groupBy("node", "first_id").agg(F.min("row_key").alias("row_key"), F.first("bands").alias("bands"))
        .select("node", "row_key", "bands", F.nullif("first_id", last).alias("id")), "classes")
    comps = _components(classes, keyed)
    placed = classes.select("node", "id", "row_key")
    placed = (placed.withColumn("component", F.col("node")) if comps is None else
              placed.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node")))
    # the least id, and the least node that has it
    heads = placed.groupBy("component").agg(F.min(F.struct(F.coalesce("id", last).alias("id"), "node")).alias("head"))
    heads = heads.select("component", F.col("head.id").alias("head"), F.col("head.node").alias("stay"))
    placed = placed.join(heads, "component").select(
        "node", F.nullif("head", last).alias("class_id"), F.col("id").alias("rep_id"),
        F.col("row_key").alias("rep_key"), (F.col("node") == F.col("stay")).alias("stays"))
    return found.select("id", "row_key", "node").join(placed, "node", "left").select(
        "id", "row_key", F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        (F.col("node").isNull() | (F.col("stays") & F.col("id").eqNullSafe(F.col("rep_id"))
                                   & (F.col("row_key") == F.col("rep_key")))).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without all but one document of each near-duplicate class, all columns kept."""
    kept = common.materialise(near_duplicates(docs).filter("kept").groupBy("id", "row_key")
                              .agg(F.count("*").alias("n"), F.max(F.col("class_id").isNull()).alias("free")), "kept")
    key = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    hit = docs["doc_id"].eqNullSafe(kept["id"]) & (key == kept["row_key"])
    wordless = F.length(F.regexp_replace(F.coalesce(docs["text"], F.lit("")), "[^\\p{L}\\p{N}]", "")) == 0
    if not kept.filter("n > 1").isEmpty():
        # repeated rows of one document: only one of them stays, but for texts without words
        once = docs.join(kept, hit, "left_semi").filter(~wordless).dropDuplicates(["doc_id", "text"])
        return once.union(docs.filter(wordless))
    return docs.join(kept, hit, "left_semi")


def op3_probminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document: doc_id, class_id (its least doc_id), kept."""
    return near_duplicates(common.table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "class_id", "kept")
