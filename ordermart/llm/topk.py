"""Operator 5: exact top-k search by exhaustive term-at-a-time accumulation.

Method.  A vector is a sparse row of integer weights (zero weights are no
postings).  For a block of candidates, each term (dimension) has a postings
list of (row, weight).  A query goes through its terms and scatters query
weight times posting weights into a dense array of scores, one for each
row of the block.  A partition selection keeps the block's k best, and the
lists of all blocks are merged.

Scale.  Candidates and queries are cut into blocks of a bounded number of
rows by a hash of their id.  Each query block meets each candidate block in
one task, as the exhaustive search demands, and sends k rows a query on.
Shuffles move blocks packed as arrays; the merge keeps k rows at every
step.  No block depends on a value, so equal vectors spread evenly.

Results on edge cases.  Vectors that are null, or hold null or non-finite
components, and rows without an id take no part.  Empty vectors score 0.
Vectors of other lengths are compared on the terms that both have.  Rows
with the query's id are its own and no candidates; other repeated rows
each count.  Fewer candidates than k: all are returned.  Scores that may
pass 64 bits, by the lengths of the two vectors, are summed in unbounded
integers; one that does not fit raises an error only if it is returned.
Other columns take no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

K = 10
SCALE = 1024
QUERY_DIVISOR = 100
#: Products of two lengths below this keep every partial sum within 64 bits.
SAFE = float(1 << 62)
LEAST, MOST = -(1 << 63), (1 << 63) - 1
#: Rows of a block; a candidate block of 64 terms takes about 16 MB while it is searched.
CANDIDATE_BLOCK, QUERY_BLOCK = 16_384, 4_096


def integer_vectors(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component x, of the rows that take part."""
    x = F.col("embedding").cast("array<double>")
    whole = table.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
                         & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))))
    return whole.select(F.col("vec_id").cast("long").alias("vec_id"),
                        F.transform(x, lambda e: F.floor(e * float(scale)).cast("long")).alias("v"))


def _blocked(vectors: DataFrame, rows: int, name: str) -> tuple[DataFrame, int]:
    """Blocks (name, ids, sizes, values) of about ``rows`` vectors, packed in the tasks that hold them."""
    blocks = max(1, -(-vectors.count() // rows))

    def run(batches):
        for batch in batches:
            ids, v = batch.column(0).to_numpy(), batch.column(2)
            of = batch.column(1).to_numpy()
            sizes = np.diff(v.offsets.to_numpy()).astype(np.int64)
            values, first = v.values.to_numpy(), v.offsets.to_numpy()[:-1]
            for b in np.unique(of):
                at = np.flatnonzero(of == b)
                n = sizes[at]
                take = np.repeat(first[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(b)], pa.int32()), common.flat_lists(ids[at], [len(at)], pa.int64()),
                     common.flat_lists(n, [len(at)], pa.int64()), common.flat_lists(values[take], [len(take)], pa.int64())],
                    names=[name, "ids", "sizes", "values"])

    numbered = vectors.select("vec_id", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int").alias("block"), "v")
    return numbered.mapInArrow(run, f"{name} int, ids array<long>, sizes array<long>, values array<long>"), blocks


def _unpack(frame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids in order, and row, term and weight of every component, of the packed parts of a block."""
    cat = lambda c: np.concatenate([np.asarray(x, dtype=np.int64) for x in frame[c]] or [np.zeros(0, np.int64)])
    ids, sizes, values = cat("ids"), cat("sizes"), cat("values")
    order = np.argsort(ids, kind="stable")
    rank = np.empty(len(ids), dtype=np.int64)
    rank[order] = np.arange(len(ids))
    row = np.repeat(rank, sizes)
    term = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    some = values != 0
    return ids[order], row[some], term[some], values[some]


def _lengths(row: np.ndarray, weight: np.ndarray, rows: int) -> np.ndarray:
    """Euclidean length of each row."""
    return np.sqrt(np.bincount(row, weights=weight.astype(np.float64) ** 2, minlength=rows))


def search_block(queries, candidates, k: int) -> tuple[list, list, list, list]:
    """(query_id, vec_id, score, fits) of the k best candidates of a block for each query of a block.

    A score that does not fit into 64 bits stands at their end, with ``fits`` false.
    """
    cid, crow, cterm, cweight = _unpack(candidates)
    qid, qrow, qterm, qweight = _unpack(queries)
    # no sum of products is larger than the product of the lengths
    clength, qlength = _lengths(crow, cweight, len(cid)), _lengths(qrow, qweight, len(qid))
    by_row = [{} for _ in range(len(cid))] if len(cid) and len(qid) and clength.max() * qlength.max() >= SAFE else None
    if by_row is not None:
        for r in np.flatnonzero(clength * qlength.max() >= SAFE).tolist():
            at = np.flatnonzero(crow == r)
            by_row[r] = dict(zip(cterm[at].tolist(), cweight[at].tolist()))
    order = np.argsort(cterm, kind="stable")
    crow, cterm, cweight = crow[order], cterm[order], cweight[order]
    terms = int(max(cterm.max(initial=-1), qterm.max(initial=-1))) + 1
    begin = np.searchsorted(cterm, np.arange(terms + 1))
    order = np.argsort(qrow, kind="stable")
    qterm, qweight = qterm[order], qweight[order]
    first = np.searchsorted(qrow[order], np.arange(len(qid) + 1))
    out_q, out_v, out_s, out_f = [], [], [], []
    for i in range(len(qid)):
        scores = np.zeros(len(cid), dtype=np.int64)
        for t, w in zip(qterm[first[i]:first[i + 1]].tolist(), qweight[first[i]:first[i + 1]].tolist()):
            a, b = begin[t], begin[t + 1]
            if b - a == len(cid):       # every row has the term: its rows are all rows in order
                scores += w * cweight[a:b]
            else:
                scores[crow[a:b]] += w * cweight[a:b]
        wide = np.flatnonzero(clength * qlength[i] >= SAFE)
        fits = np.ones(len(cid), dtype=bool)
        if len(wide):       # these sums may have wrapped: unbounded integers
            query = dict(zip(qterm[first[i]:first[i + 1]].tolist(), qweight[first[i]:first[i + 1]].tolist()))
            for r in wide.tolist():
                exact = sum(w * by_row[r].get(t, 0) for t, w in query.items())
                scores[r] = min(max(exact, LEAST), MOST)
                fits[r] = LEAST <= exact <= MOST
        able = np.flatnonzero(cid != qid[i])
        s = scores[able]
        if len(s) > k:
            least = np.partition(s, len(s) - k)[len(s) - k]
            above = np.flatnonzero(s > least)
            # ids are in order, so the first of the ties are the smallest
            able, s = (x[np.concatenate([above, np.flatnonzero(s == least)[:k - len(above)]])] for x in (able, s))
        out_q += [int(qid[i])] * len(able)
        out_v += cid[able].tolist()
        out_s += s.tolist()
        out_f += fits[able].tolist()
    return out_q, out_v, out_s, out_f


def top_k(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each row of ``vectors`` (vec_id, v) that is a query."""
    import pandas as pd

    spark = vectors.sparkSession
    common.ship_package(spark)
    vectors = common.materialise(vectors, "vectors")
    asked = vectors.filter(is_query)
    candidates, cn = _blocked(vectors, CANDIDATE_BLOCK, "cb")
    queries, qn = _blocked(asked, QUERY_BLOCK, "qb")
    queries = queries.withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(cn - 1))))
    candidates = candidates.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(qn - 1))))

    def meet(left, right):
        q, v, s, f = search_block(left, right, k)
        return pd.DataFrame({"query_id": q, "vec_id": v, "score": s, "fits": f})

    found = (queries.groupBy("qb", "cb").cogroup(candidates.groupBy("qb", "cb"))
             .applyInPandas(meet, "query_id long, vec_id long, score long, fits boolean"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", F.when(F.col("fits"), F.col("score")).otherwise(
                F.raise_error(F.lit("a score does not fit into 64 bits")).cast("long")).alias("score")))


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best vectors of every vector whose vec_id is divisible by 100: query_id, rank, vec_id, score."""
    vectors = integer_vectors(common.table(spark, sf_dir, "embeddings"))
    return top_k(vectors, F.col("vec_id") % QUERY_DIVISOR == 0)


#: DuckDB twin of op5: queries against all rows, ranked by score and id.
OP5_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 100 = 0),
r AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
