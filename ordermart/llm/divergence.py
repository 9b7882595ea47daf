"""Operator 12: how far the sources of a language diverge in their terms, by hash-consed segment trees.

Each (lang, source) group counts the terms that its language keeps: those
in at least LEAST_DOCS of its documents.  With V kept terms and N counted
occurrences a term has weight p = 1 + floor(SCALE * (count + 2) / (N + 2 V)),
and two groups differ at it by floor((p - q)^2 / (p + q)).  A pair of
groups is valued by the sum over all kept terms, a group's single terms by
their difference from the language's own count.

Method.  The counts of a group are a segment tree over term ids: leaves
are counts, an inner node is its two children.  Equal subtrees, of any
group and at any place of one height, are one node: nodes are numbered by
their pair of children (hash-consing), and the empty subtree is one node a
height.  Two trees are walked together from their roots.  At each height
the equal node pairs are joined and only counted, so each is opened once
however often it occurs; at the leaves each pair of counts is priced once
and multiplied.  The language's counts are one more tree; walked with it,
a group's leaf pairs price its terms.

Scale.  Counting is pre-aggregated in the tasks that read the texts, by
term and group, so neither a hot source nor a frequent term is moved row
by row.  Term ids are cut into blocks of about BLOCK_TERMS terms (by hash;
within a block the frequent come first, so rare tails look alike) and
sources into blocks of about BLOCK_SOURCES; one task builds the trees of
one term block for two source blocks, and sums over the term blocks are
the upper ends of the trees.  What a task holds is bounded by the two block
sizes.  All arithmetic is on integers: sums of products stay below 2^63,
and weights are divided as unbounded integers.

Results on edge cases.  Null text, lang or source count as ''.  Each row
is a document, repeated ones too.  A group without terms takes part with
counts of 0; a language without kept terms gives pairs of value 0.  A
language with one source has no pairs.  An empty table gives no row.
Other columns take no part.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

LEAST_DOCS = 10
SCALE = 1_000_000_000
TOP = 10
BLOCK_TERMS = 4_096
BLOCK_SOURCES = 64
#: Terms that a task counts before it sends them on (about 200 bytes each).
HELD_TERMS = 500_000

#: Fixed: a term is a run of ASCII letters and of characters beyond ASCII; only A-Z are lower-cased.
_TERM_BYTES = bytes(i + 32 if 65 <= i <= 90 else i if 97 <= i <= 122 or i > 127 else 32 for i in range(256))
#: A held number is occurrences * 2^40 + documents.
_DOCS = 40


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, d): occurrences and documents of each term; term null: the group occurs."""
    texts = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("text", "lang", "source")])

    def run(batches):
        held: dict[tuple[str, str], dict[bytes | None, int]] = {}
        size = 0

        def flush():
            for (lang, source), terms in held.items():
                names, numbers = list(terms), list(terms.values())
                for a in range(0, len(names), 1 << 16):
                    part = numbers[a:a + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(lang, len(part)), pa.repeat(source, len(part)),
                         pa.array(names[a:a + (1 << 16)], pa.binary()).cast(pa.string()),
                         pa.array([x >> _DOCS for x in part], pa.int64()),
                         pa.array([x & ((1 << _DOCS) - 1) for x in part], pa.int64())],
                        names=["lang", "source", "term", "n", "d"])

        for batch in batches:
            texts_of = batch.column(0).cast(pa.binary()).to_pylist()
            for text, lang, source in zip(texts_of, batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                terms = held.setdefault((lang, source), {None: 0})
                size -= len(terms)
                known = terms.get
                for t, c in Counter(text.translate(_TERM_BYTES).split()).items():
                    terms[t] = known(t, 0) + (c << _DOCS) + 1
                size += len(terms)
                if size > HELD_TERMS:
                    yield from flush()
                    held, size = {}, 0
        yield from flush()

    return (texts.mapInArrow(run, "lang string, source string, term string, n long, d long")
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d")))


class Forest:
    """Segment trees with shared nodes over the same leaves, a power of two of them."""

    def __init__(self, leaves: np.ndarray):
        """``leaves``: a row of counts for each tree."""
        self.children: list[tuple[np.ndarray, np.ndarray]] = []      # by height: both children of each node
        self.counts, nodes = np.unique(leaves, return_inverse=True)
        nodes = nodes.reshape(leaves.shape)
        self.leaves = nodes
        while nodes.shape[1] > 1:
            below = int(nodes.max()) + 1
            pairs, index = np.unique(nodes[:, 0::2] * below + nodes[:, 1::2], return_inverse=True)
            self.children.append((pairs // below, pairs % below))
            nodes = index.reshape(nodes.shape[0], -1)
        self.roots = nodes[:, 0]

    def walk(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Leaf pairs of each pair of trees a[i], b[i]: (pair, leaf of a, leaf of b, how often), each combination once."""
        pair, u, v = np.arange(len(a)), self.roots[a], self.roots[b]
        times = np.ones(len(a), dtype=np.int64)
        for left, right in reversed(self.children):
            pair, times = np.tile(pair, 2), np.tile(times, 2)
            u, v = np.concatenate([left[u], right[u]]), np.concatenate([left[v], right[v]])
            # equal node pairs become one, with the sum of their numbers
            width = int(max(u.max(initial=0), v.max(initial=0))) + 1
            key = (pair * width + u) * width + v
            order = np.argsort(key, kind="stable")
            head = np.flatnonzero(np.diff(key[order], prepend=-1))
            times = np.add.reduceat(times[order], head) if len(head) else times
            pair, u, v = (x[order][head] for x in (pair, u, v))
        return pair, u, v, times


def weights(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)) of each count, in unbounded integers."""
    below = total + 2 * terms
    return np.array([1 + SCALE * (c + 2) // below if c <= total else 0 for c in counts.tolist()], dtype=np.int64)


def difference(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _price_pairs(forest: Forest, a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Sum of differences of each pair of trees; ``weight``: by tree and leaf."""
    total = np.zeros(len(a), dtype=np.int64)
    # so many pairs at once that the open node pairs stay within about a million
    step = max(1, (1 << 20) // max(1, forest.leaves.shape[1]))
    for at in range(0, len(a), step):
        x, y = a[at:at + step], b[at:at + step]
        pair, u, v, times = forest.walk(x, y)
        f = difference(weight[x[pair], u], weight[y[pair], v])
        np.add.at(total, at + pair, f * times)
    return total


def _block_values(key, frame):
    """Values of one term block for the groups of two source blocks (see ``divergence``)."""
    import pandas as pd

    _, _, left, right = key
    terms = int(frame["terms"].iloc[0])         # kept terms of the language
    size = int(frame["size"].iloc[0])           # of this block
    frame = frame.sort_values(["is_lang", "sblock", "source"], kind="stable")
    leaves = np.zeros((len(frame), 1 << max(0, size - 1).bit_length()), dtype=np.int64)
    for i, (places, counts) in enumerate(zip(frame["places"], frame["counts"])):
        if places is not None and len(places):
            leaves[i, np.asarray(places, dtype=np.int64)] = counts
    sources, totals = frame["source"].tolist(), frame["total"].tolist()
    is_lang, of = frame["is_lang"].to_numpy(), frame["sblock"].to_numpy()
    out = {c: [] for c in ("source", "part", "item", "value")}

    def put(source, part, item, value):
        for c, x in zip(out, (source, part, item, value)):
            out[c] += x

    if size == 0:       # no kept terms: only pairs, of value 0
        weight = forest = None
    else:
        forest = Forest(leaves)
        weight = np.stack([weights(forest.counts, int(t), terms) for t in totals])
        padding = leaves.shape[1] - size
        zero = int(np.searchsorted(forest.counts, 0))
    own = np.flatnonzero(~is_lang)
    a, b = np.triu_indices(len(own), 1)
    if left != right:
        across = of[own][a] != of[own][b]
        a, b = a[across], b[across]
    a, b = own[a], own[b]
    value = np.zeros(len(a), dtype=np.int64)
    if forest is not None and len(a):
        value = _price_pairs(forest, a, b, weight)
        if padding:     # leaves beyond the block are no terms
            value -= padding * difference(weight[a, zero], weight[b, zero])
    name = lambda at: [sources[i] for i in at.tolist()]
    put(name(a), ["pair"] * len(a), name(b), value.tolist())
    put(name(b), ["pair"] * len(a), name(a), value.tolist())
    if left == right and forest is not None:
        lang = int(np.flatnonzero(is_lang)[0])
        names = np.array(frame["names"].iloc[lang], dtype=object)
        pair, u, v, _ = forest.walk(own, np.full(len(own), lang))
        p, q = weight[own[pair], u], weight[lang, v]
        f = difference(p, q)
        wanted = (forest.counts[u] > 0) & (p > q)
        for i in range(len(own)):
            at = np.flatnonzero((pair == i) & wanted)
            at = at[np.argsort(-f[at], kind="stable")]
            # the best leaf pairs, as many as hold TOP terms, and all that tie with the last of them
            place_u, place_v = forest.leaves[own[i], :size], forest.leaves[lang, :size]
            best: list[tuple[int, str]] = []
            for k in at.tolist():
                if len(best) >= TOP and -best[-1][0] > f[k]:
                    break
                best += [(-int(f[k]), t) for t in names[(place_u == u[k]) & (place_v == v[k])]]
            best.sort(key=lambda x: (x[0], x[1].encode("utf-8", "surrogatepass")))
            best = best[:TOP]
            put([sources[own[i]]] * len(best), ["term"] * len(best), [t for _, t in best], [-x for x, _ in best])
    out["lang"] = [key[0]] * len(out["source"])
    return pd.DataFrame({c: pd.Series(out[c], dtype="int64" if c == "value" else object)
                         for c in ("lang", "source", "part", "item", "value")})


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, block_terms: int = BLOCK_TERMS,
               block_sources: int = BLOCK_SOURCES) -> DataFrame:
    """(lang, source, part, item, value, rank) of ``docs`` (text, lang, source): pairs of sources and their own terms."""
    common.ship_package(docs.sparkSession)
    counted = common.materialise(term_counts(docs), "terms")
    kept = (counted.filter(F.col("term").isNotNull()).groupBy("lang", "term")
            .agg(F.sum("d").alias("d"), F.sum("n").alias("n")).filter(F.col("d") >= least_docs))
    kept = common.materialise(kept.select("lang", "term", "n"), "kept-terms")
    langs = (counted.groupBy("lang").agg(F.countDistinct("source").alias("sources"))
             .join(kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("total")), "lang", "left")
             .fillna(0, ["terms", "total"])
             .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("terms") / block_terms)).cast("int"))
             .withColumn("sblocks", F.ceil(F.col("sources") / block_sources).cast("int")))
    langs = common.materialise(langs, "langs")
    # term ids: a block, and a place in it
    place = F.row_number().over(Window.partitionBy("lang", "block").orderBy(F.desc("n"), "term")) - 1
    terms = (kept.join(langs.select("lang", "blocks"), "lang")
             .withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")).drop("blocks")
             .withColumn("place", place))
    terms = common.materialise(terms, "term-ids")
    at = counted.select("lang", "source", "term", F.col("n").alias("count")).join(terms.drop("n"), ["lang", "term"])
    packed = (at.groupBy("lang", "source", "block")
              .agg(F.collect_list(F.struct("place", "count")).alias("c"))      # a block's terms at most
              .select("lang", "source", "block", F.col("c.place").alias("places"), F.col("c.count").alias("counts")))
    packed = common.materialise(packed, "group-blocks")
    totals = packed.groupBy("lang", "source").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x)).alias("total"))
    groups = (counted.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").fillna(0, ["total"])
              .join(langs.select("lang", "terms", "blocks", "sblocks"), "lang")
              .withColumn("sblock", F.pmod(F.xxhash64("source"), F.col("sblocks")).cast("int")))
    sizes = terms.groupBy("lang", "block").agg(
        F.count("*").cast("int").alias("size"), F.array_sort(F.collect_list(F.struct("place", "term", "n"))).alias("t"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    # every group has a row in every term block of its language, also without a count there
    of_groups = (groups.select("lang", "source", "total", "terms", "sblocks", "sblock", every)
                 .join(packed, ["lang", "source", "block"], "left")
                 .join(sizes.select("lang", "block", "size"), ["lang", "block"], "left").fillna(0, ["size"])
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sblocks") - 1)))
                 .withColumn("left", F.least("sblock", "other")).withColumn("right", F.greatest("sblock", "other"))
                 .select("lang", "block", "left", "right", "source", "sblock", "total", "terms", "size", "places", "counts",
                         F.lit(False).alias("is_lang"), F.lit(None).cast("array<string>").alias("names")))
    # the language's own tree, for each block of sources
    of_langs = (langs.join(sizes, "lang").withColumn("left", F.explode(F.sequence(F.lit(0), F.col("sblocks") - 1)))
                .select("lang", "block", "left", F.col("left").alias("right"), F.lit("").alias("source"),
                        F.lit(-1).alias("sblock"), "total", "terms", "size", F.col("t.place").alias("places"),
                        F.col("t.n").alias("counts"), F.lit(True).alias("is_lang"), F.col("t.term").alias("names")))
    valued = (of_groups.unionByName(of_langs).groupBy("lang", "block", "left", "right")
              .applyInPandas(_block_values, "lang string, source string, part string, item string, value long"))
    summed = valued.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    best = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return (summed.withColumn("rank", F.row_number().over(best)).filter((F.col("part") == "pair") | (F.col("rank") <= TOP))
            .select("lang", "source", "part", "item", "value", "rank"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of sources and the ten most typical terms of each, by language: lang, source, part, item, value, rank."""
    return divergence(common.table(spark, sf_dir, "documents"))


#: DuckDB twin of op12: every group with every kept term, priced one by one.
OP12_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents),
w AS (
    SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
grp AS (SELECT DISTINCT lang, source FROM d),
cnt AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
    FROM grp g JOIN kept k USING (lang)
    LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL) c USING (lang, source, term)),
gp AS (
    SELECT lang, source, term, n,
           1 + (CAST(1000000000 AS HUGEINT) * (n + 2)) // (sum(n) OVER g + 2 * count(*) OVER g) AS p
    FROM cnt WINDOW g AS (PARTITION BY lang, source)),
lc AS (SELECT lang, term, sum(n) AS n FROM cnt GROUP BY lang, term),
lp AS (
    SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (n + 2)) // (sum(n) OVER l + 2 * count(*) OVER l) AS q
    FROM lc WINDOW l AS (PARTITION BY lang)),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, ((a.p - b.p) * (a.p - b.p)) // (a.p + b.p) AS f
    FROM gp a JOIN gp b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source),
vals AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.f, 0) AS BIGINT) AS value
    FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (SELECT lang, source, item, sum(f) AS f FROM pairs GROUP BY ALL) s
           ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    UNION ALL
    SELECT g.lang, g.source, 'term', g.term, CAST(((g.p - l.q) * (g.p - l.q)) // (g.p + l.q) AS BIGINT)
    FROM gp g JOIN lp l USING (lang, term) WHERE g.n > 0 AND g.p > l.q),
r AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM vals)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 10
"""
