import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermart.llm import shuffling

from . import edges


def test_matrix_keeps_all_sums():
    rng = np.random.default_rng(1)
    for sizes, shards in (([5, 0, 1, 9, 30], 8), ([0, 0], 3), ([1000] * 40 + [100_000], 7), ([2], 8)):
        room = shuffling.shard_sizes(sum(sizes), shards)
        assert max(room) - min(room) <= 1 and sum(room) == sum(sizes)
        m = np.array(shuffling.draw_matrix(sizes, room, rng))
        assert m.sum(axis=1).tolist() == sizes and m.sum(axis=0).tolist() == room and m.min() >= 0


def test_draws_follow_the_mass_function(monkeypatch):
    rng = np.random.default_rng(2)
    for own in (False, True):
        monkeypatch.setattr(shuffling, "NUMPY_ITEMS", 0 if own else 1 << 30)
        for good, bad, draws in ((7, 13, 9), (40, 5, 30), (300, 900, 400)):
            got = collections.Counter(shuffling.hypergeometric(rng, good, bad, draws) for _ in range(20_000))
            mass = {k: math.comb(good, k) * math.comb(bad, draws - k) / math.comb(good + bad, draws)
                    for k in range(max(0, draws - bad), min(good, draws) + 1)}
            assert set(got) <= set(mass)
            assert max(abs(got[k] / 20_000 - m) for k, m in mass.items()) < 0.015


def test_draws_from_very_many():
    rng = np.random.default_rng(3)
    good, bad, draws = 40_000_000_000, 10_000_000_000, 700_000_000
    x = np.array([shuffling.hypergeometric(rng, good, bad, draws) for _ in range(3_000)], dtype=float)
    spread = math.sqrt(draws * 0.8 * 0.2 * (1 - draws / (good + bad)))
    assert abs(x.mean() - 0.8 * draws) < 5 * spread / math.sqrt(3_000)
    assert abs(x.std() / spread - 1) < 0.07


def _places(df):
    out = collections.defaultdict(list)
    for r in df.collect():
        out[r.shard].append(r.slot)
    return out


@pytest.mark.parametrize("partitions", [1, 20])
def test_sizes_slots_and_rows(spark, monkeypatch, partitions):
    monkeypatch.setattr(shuffling, "RANGE_ROWS", 50)        # several ranges a shard
    docs = edges.clashing(spark).drop("a.b")
    many = docs.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(97)))).repartition(partitions)
    for name in ("__part", "__place", "__turn", "__range", "__cuts", "__before", "part", "g"):
        many = many.withColumn(name, F.lit(3))
    got = shuffling.shuffle_rows(many)
    assert got.columns == [*many.columns, "shard", "slot"]
    places = _places(got)
    n = many.count()
    assert sorted(map(len, places.values()), reverse=True) == shuffling.shard_sizes(n, 8)
    assert all(sorted(s) == list(range(len(s))) for s in places.values())
    key = lambda df: collections.Counter(map(tuple, df.select("doc_id", "text", "n_chars").collect()))
    assert key(got) == key(many)


def test_brute_force_of_the_exchange(spark, monkeypatch):
    """The same shards as a plain loop that permutes, cuts by the matrix, exchanges and permutes again."""
    monkeypatch.setattr(shuffling, "RANGE_ROWS", 20)
    held = {}
    keep = shuffling.common.materialise

    def spy(df, tag):
        held[tag] = keep(df, tag)
        return held[tag]

    monkeypatch.setattr(shuffling.common, "materialise", spy)
    monkeypatch.setattr(shuffling.common, "release", lambda df: None)
    rows = spark.range(1_000, numPartitions=9)
    got = {r.id: (r.shard, r.slot) for r in shuffling.shuffle_rows(rows).collect()}
    cuts = {r.part: r.cuts for r in held["shuffle-matrix"].collect()}
    parts = collections.defaultdict(list)
    for r in held["shuffle-parts"].collect():
        parts[r["__part"]].append((r["__place"], r["__turn"], r.id))
    shards = collections.defaultdict(list)
    for p, items in parts.items():
        items.sort()
        assert [i[0] for i in items] == list(range(len(items)))
        start = 0
        for j, cut in enumerate(cuts[p]):
            shards[j] += [(t, i) for _, t, i in items[start:cut]]
            start = cut
    want = {i: (j, slot) for j, items in shards.items() for slot, (_, i) in enumerate(sorted(items))}
    assert got == want


def test_places_are_uniform(spark):
    """Rows of every partition spread over shards and slots: chi-square against a uniform order."""
    rows = spark.range(16_000, numPartitions=16)
    got = shuffling.shuffle_rows(rows).collect()
    for cells in (collections.Counter((r.id // 1_000, r.shard) for r in got),
                  collections.Counter((r.id // 1_000, r.slot * 8 // 2_000) for r in got)):
        chi = sum((cells[a, b] - 125) ** 2 / 125 for a in range(16) for b in range(8))
        assert 50 < chi < 180       # 105 degrees of freedom
    again = {r.id: (r.shard, r.slot) for r in shuffling.shuffle_rows(rows).collect()}
    assert again == {r.id: (r.shard, r.slot) for r in got}
    other = {r.id: (r.shard, r.slot) for r in shuffling.shuffle_rows(rows, seed=5).collect()}
    assert sum(other[i] == again[i] for i in other) < 40


def test_query_and_small_tables(spark, tmp_path):
    docs = edges.documents(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = shuffling.op11_hypergeometric_shuffle(spark, str(tmp_path))
    assert got.dtypes == [("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"),
                          ("shard", "int"), ("slot", "bigint"), ("grown_shard", "int")]
    want = collections.Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in edges.rows())
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got.collect()) == want
    assert {r.law for r in got.collect()} == {"rows"} and {r.grown_shard for r in got.collect()} == {None}
    assert shuffling.shuffle_rows(edges.empty(spark)).count() == 0
    assert _places(shuffling.shuffle_rows(spark.range(3))) == {0: [0], 1: [0], 2: [0]}
    with pytest.raises(ValueError):
        shuffling.shuffle_rows(spark.range(3).withColumn("SLOT", F.lit(1)))


def test_write_shards(spark, tmp_path):
    got = shuffling.shuffle_rows(spark.range(500, numPartitions=4))
    shuffling.write_shards(got, f"{tmp_path}/out", file_rows=20)
    back = spark.read.parquet(f"{tmp_path}/out")
    key = lambda df: sorted((r.id, r.shard, r.slot) for r in df.collect())
    assert key(back) == key(got)
    first = spark.read.parquet(f"{tmp_path}/out/shard=3").withColumn("f", F.input_file_name()).collect()
    by_file = collections.defaultdict(list)
    for r in first:
        by_file[r.f].append(r.slot)
    assert all(s == sorted(s) for s in by_file.values())
