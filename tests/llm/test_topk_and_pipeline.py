import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from ordermart.llm import common, topk

from . import edges


def test_top_k_edges(spark):
    r = random.Random(1)
    rows = [(i, [float(r.randint(-3, 3)) / 8 for _ in range(r.choice([3, 6, 6, 6]))]) for i in range(400)]
    rows += [(i, [0.5] * 6) for i in range(400, 700)]       # one frequent vector: ties go to smaller ids
    whole = [*rows]
    rows += [(1000, None), (1100, [0.1, None, 1.0]), (1200, [float("nan")] * 6), (1300, [float("inf")] * 6), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit(1)).withColumn("score", F.lit(1))
    got = {}
    for x in topk.top_k(topk.integer_vectors(df), F.col("vec_id") % 100 == 0).collect():
        got.setdefault(x.query_id, {})[x.rank] = (x.vec_id, x.score)
    ints = [(i, np.floor(1024 * np.array(v)).astype(int)) for i, v in whole]
    assert set(got) == {i for i, _ in whole if i % 100 == 0}
    for qi, qv in ints:
        if qi % 100 == 0:
            scores = sorted((-int(sum(a * b for a, b in zip(qv, v))), i) for i, v in ints if i != qi)[:topk.K]
            assert [got[qi][k + 1] for k in range(topk.K)] == [(i, -s) for s, i in scores]
    few = topk.top_k(topk.integer_vectors(df.filter("vec_id in (100, 101, 102)")), F.col("vec_id") == 100)
    assert few.count() == 2
    assert topk.top_k(topk.integer_vectors(df.filter("false")), F.col("vec_id") == 0).count() == 0


def test_scores_near_the_end_of_64_bits(spark):
    """One large component stops nothing; sums that wrap in between are exact; only returned scores must fit."""
    top = 3e9 / 1024
    rows = [(0, [1.0, 0.5, 0.0]), (100, [top, -1.0, 2.0]), (1, [0.25, 1.0, 1.0]), (2, [top, top, -top]), (3, [0.0, 0.0, 9.0]),
            (200, [top * 900, top * 900, 0.0])]
    ints = {i: [int(np.floor(1024 * x)) for x in v] for i, v in rows}
    got = topk.top_k(topk.integer_vectors(spark.createDataFrame(rows[:5], "vec_id long, embedding array<double>")),
                     F.col("vec_id") % 100 == 0).collect()
    want = set()
    for q in (0, 100):
        scores = sorted((-sum(a * b for a, b in zip(ints[q], ints[v])), v) for v in (0, 100, 1, 2, 3) if v != q)
        want |= {(q, k + 1, v, -s) for k, (s, v) in enumerate(scores)}
    assert {tuple(r) for r in got} == want
    with pytest.raises(Exception, match="does not fit"):
        both = spark.createDataFrame([rows[5], (300, [top * 900, top * 900, 1.0])], "vec_id long, embedding array<double>")
        topk.top_k(topk.integer_vectors(both), F.col("vec_id") % 100 == 0).collect()
    # a sum below the least that fits is no result where others are better
    many = [(i, [float(i % 7), 1.0, 0.0]) for i in range(1, 30)] + [(400, [-top * 900, -top * 900, 0.0]), rows[5]]
    found = topk.top_k(topk.integer_vectors(spark.createDataFrame(many, "vec_id long, embedding array<double>")),
                       F.col("vec_id") == 200).collect()
    assert len(found) == 10 and 400 not in {r.vec_id for r in found}


def test_blocks_give_the_same(spark, monkeypatch):
    v = topk.integer_vectors(spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet"))
    want = sorted(map(tuple, topk.top_k(v, F.col("vec_id") % 100 == 0).collect()))
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 60)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    assert sorted(map(tuple, topk.top_k(v, F.col("vec_id") % 100 == 0).collect())) == want


def test_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_dedup", "substring_dedup", "decontamination", "packing"]
    columns, before = docs.columns, docs.count()
    for name, stage in cp.STAGES:
        docs = common.materialise(stage(spark, docs, sf), name)
        if name != "packing":
            assert docs.columns == columns and docs.count() <= before
            before = docs.count()
    texts = before
    assert docs.select("doc_id").distinct().count() == texts
    assert sorted(map(tuple, cp.run(spark, sf).select("doc_id", "piece", "ids_crc32").collect())) == sorted(
        map(tuple, docs.select("doc_id", "piece", "ids_crc32").collect()))


def test_stages_take_empty_tables(spark):
    docs = edges.empty(spark)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.count() == 0
