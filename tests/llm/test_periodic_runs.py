import collections
import hashlib
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from ordermart.llm import periodic_runs as pr

from . import edges


def plain_runs(words):
    """(start, length, period) of all runs, every period tried on its own."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(pr.LEAST, 2 * q):
                found.setdefault((i, j + q), q)     # periods come in order: the smallest stays
            i = j
    return sorted((s, e - s, q) for (s, e), q in found.items())


def _found(texts):
    first = np.cumsum([0, *map(len, texts)])
    flat = np.array([w for t in texts for w in t], dtype=np.int64)
    rows = pr.runs_of(flat, first)
    out = [[] for _ in texts]
    for s, e, q in rows.tolist():
        t = int(np.searchsorted(first, s, "right")) - 1
        out[t].append((s - int(first[t]), e - s, q))
    return [sorted(o) for o in out]


def _texts(r, count, most):
    for _ in range(count):
        n, kind = r.randint(0, most), r.random()
        if kind < 0.3:
            t = [r.randint(0, r.choice([0, 1, 2, 5, 50])) for _ in range(n)]
        elif kind < 0.6:        # loops of loops, with single changes
            t = []
            while len(t) <= n:
                part = [r.randint(0, 3) for _ in range(r.randint(1, 12))] * r.randint(1, 9)
                t += part * r.randint(1, 4)
            for _ in range(r.randint(0, 3)):
                t[r.randrange(len(t))] = 9
        elif kind < 0.8:        # Fibonacci and Thue-Morse words have many runs
            a, b = [0], [0, 1]
            while len(b) < n:
                a, b = b, b + a
            t = b[:n] if r.random() < 0.5 else [bin(i).count("1") & 1 for i in range(n)]
        else:                   # a long loop, cut by few words
            part = [r.randint(0, 40) for _ in range(r.randint(1, 1 + most // 3))]
            t = [r.randint(0, 40) for _ in range(r.randint(0, 20))] + part * r.randint(2, 6)
        yield t


def test_all_runs_of_small_texts():
    r = random.Random(1)
    for _ in range(60):
        texts = list(_texts(r, 20, 90))
        assert _found(texts) == [plain_runs(t) for t in texts]


def test_all_runs_of_longer_texts():
    r = random.Random(2)
    texts = list(_texts(r, 30, 700))
    assert _found(texts) == [plain_runs(t) for t in texts]


def test_every_text_over_two_words():
    """Brute force over all texts of 13 and 14 words of two kinds."""
    for n in (13, 14):
        texts = [[x >> i & 1 for i in range(n)] for x in range(1 << n)]
        assert _found(texts) == [plain_runs(t) for t in texts]


def test_one_word_and_broken_loops_stay_fast():
    import time
    t0 = time.time()
    n = 300_000
    assert _found([[0] * n]) == [[(0, n, 1)]]
    block = [0] * 5_000 + [1]
    found = _found([block * 40])[0]
    assert (0, 5_001 * 40, 5_001) in found and len(found) == 41
    assert time.time() - t0 < 60


def test_successor():
    r = random.Random(3)
    values = np.array([r.randrange(100) for _ in range(200)])
    tree = pr.WaveletMatrix(values)
    lo = np.array([r.randrange(200) for _ in range(500)])
    hi = np.array([r.randint(a, 200) for a in lo])
    x = np.array([r.randrange(140) for _ in lo])
    want = [min((v for v in values[a:b] if v >= y), default=999) for a, b, y in zip(lo, hi, x)]
    assert tree.successor(lo, hi, x, 999).tolist() == want


def _expected(doc_id, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            digest("".join("%d,%d,%d\n" % r for r in runs)), digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


def _rows():
    r = random.Random(5)
    rows = [x for x in edges.rows() if x[0] != 8]       # the long text is too long for the plain search
    for i in range(100, 260):
        words = [r.choice(["ab", "c", "Ä", "\x85", "x y", "d\x1ce", "　"]) for _ in range(r.randint(0, 60))]
        text = r.choice([" ", "\n", "\t\x0b\x0c\r"]).join(words * r.choice([1, 1, 2, 3]))
        rows.append((i, text, "en", "s", 1))
    return rows


def test_query_equals_plain_search(spark, tmp_path):
    docs = spark.createDataFrame(_rows(), edges.SCHEMA)
    for c in ("runs", "best", "collapsed", "start", "length", "period"):
        docs = docs.withColumn(c, F.lit(1))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = pr.op13_periodic_runs(spark, str(tmp_path))
    kinds = dict(got.dtypes)
    assert all(kinds[c] == "bigint" for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli"))
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(_expected(d, t) for d, t, *_ in _rows())


def test_long_text_and_empty_table(spark):
    long = [r for r in edges.rows() if r[0] == 8]
    text = long[0][1]
    docs = spark.createDataFrame([(1, f"{text} {text} {text}")], "doc_id long, text string")
    row = pr.periodic_runs(docs).first()
    assert [tuple(x) for x in row.runs] == [(0, 27_000, 9_000)] and row.collapsed == text
    assert pr.periodic_runs(edges.empty(spark)).count() == 0
