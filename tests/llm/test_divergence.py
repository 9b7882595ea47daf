import collections
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermart.llm import divergence as dv

from . import edges


def _expected(rows, least):
    """Every group with every kept term, in plain integers."""
    docs = [(lang or "", source or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")))
            for _, t, lang, source, *_ in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = collections.Counter(t for d in own for t in set(d[2]))
        kept = [t for t in df if df[t] >= least]
        groups = {s: collections.Counter(t for d in own if d[1] == s for t in d[2]) for s in {d[1] for d in own}}
        groups[None] = collections.Counter(t for d in own for t in d[2])
        price = {}
        for s, c in groups.items():
            n = sum(c[t] for t in kept)
            price[s] = {t: 1 + 10 ** 9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}
        f = lambda p, q: (p - q) ** 2 // (p + q)
        for s in groups:
            if s is None:
                continue
            pairs = [(o, sum(f(price[s][t], price[o][t]) for t in kept)) for o in groups if o not in (None, s)]
            terms = [(t, f(price[s][t], price[None][t])) for t in kept if groups[s][t] and price[s][t] > price[None][t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, 10)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(items[:most])]
    return collections.Counter(out)


def _rows():
    r = random.Random(4)
    vocabulary = ["the", "The", "Über", "über", "İx", "ﬁn", "naïve", "é", "数据", "a_b", "x1y", "don't", "\x7fq\x80"] + [
        f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    rows = [*edges.rows(), (None, None, None, None, None), (1, "", "solo", None, 0)]
    for i in range(300):
        source = r.choice(["a", "b", "b", "b", "c", "", "Z", "é", None])
        words = [r.choice(vocabulary[:r.choice([5, 20, 73])]) for _ in range(r.randint(0, 30))]
        rows.append((i, " ".join(words), r.choice(["en", "en", "de", "", None]), source, 1))
    return rows


@pytest.mark.parametrize("terms,sources", [(4096, 64), (8, 2), (3, 1)])
def test_values_equal_plain_integers(spark, terms, sources):
    docs = spark.createDataFrame(_rows(), edges.SCHEMA).repartition(3)
    for c in ("term", "n", "block", "place", "terms", "total", "sblock", "rank", "value"):
        docs = docs.withColumn(c, F.lit(1))
    got = dv.divergence(docs, 4, terms, sources)
    assert collections.Counter(map(tuple, got.collect())) == _expected(_rows(), 4)


def test_query_equals_sql(spark, tmp_path):
    spark.createDataFrame(_rows(), edges.SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = dv.op12_source_divergence(spark, str(tmp_path))
    assert got.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"),
                          ("value", "bigint"), ("rank", "int")]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(con.execute(dv.OP12_SQL).fetchall())
    assert dv.divergence(edges.empty(spark)).count() == 0


def test_equal_subtrees_are_one_node_and_opened_once():
    rng = np.random.default_rng(1)
    leaves = rng.integers(0, 3, (6, 64))
    leaves[1] = leaves[0]
    leaves[2, 8:] = 0
    leaves[3] = np.tile(leaves[3, :8], 8)
    forest = dv.Forest(leaves)
    assert forest.roots[0] == forest.roots[1] and len(set(forest.roots.tolist())) == 5
    for height, (left, right) in enumerate(forest.children):
        assert len(set(zip(left.tolist(), right.tolist()))) == len(left)
    a, b = np.triu_indices(6, 1)
    pair, u, v, times = forest.walk(a, b)
    assert len(set(zip(pair.tolist(), u.tolist(), v.tolist()))) == len(pair)     # each combination once
    got = collections.Counter()
    for k, x, y, t in zip(pair.tolist(), forest.counts[u].tolist(), forest.counts[v].tolist(), times.tolist()):
        got[k, x, y] += t
    want = collections.Counter((k, int(x), int(y)) for k, (i, j) in enumerate(zip(a, b)) for x, y in zip(leaves[i], leaves[j]))
    assert got == want


def test_weights_of_very_large_counts():
    counts = np.array([0, 1, 10 ** 17, 4 * 10 ** 17])
    assert dv.weights(counts, 5 * 10 ** 17, 10 ** 6).tolist() == [
        1 + 10 ** 9 * (c + 2) // (5 * 10 ** 17 + 2 * 10 ** 6) for c in counts.tolist()]
