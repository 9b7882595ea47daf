import random

import numpy as np

from ordermart.llm import decontamination as dc

from . import edges


def _plain(t):
    return "".join(c for c in t.lower() if c.isalnum())


def _brute(text, item):
    """Least edits of any window of the item anywhere in the text, by the definition."""
    t, p = (np.array([ord(c) for c in _plain(x)]) for x in (text, item))
    w = min(dc.WINDOW, len(p))
    windows = np.lib.stride_tricks.sliding_window_view(p, w)
    ramp = np.arange(len(t) + 1)
    row = np.zeros((len(windows), len(t) + 1), dtype=int)
    for j in range(w):
        step = row + 1
        step[:, 1:] = np.minimum(step[:, 1:], row[:, :-1] + (t != windows[:, j:j + 1]))
        row = np.minimum.accumulate(step - ramp, axis=1) + ramp
    return int(row.min())


def _budget(item):
    w = min(dc.WINDOW, len(_plain(item)))
    return max(0, min(int(dc.ERROR_RATE * w), (w - dc.Q) // dc.Q)) if w >= dc.Q else -1


def _pairs(texts, items):
    return [{(i, e) for i, a, z, e in found} for found in dc.matches(texts, dc.build_index(items))]


def _brute_pairs(texts, items):
    out = []
    for t in texts:
        least = {i: _brute(t, x) for i, x in items if _budget(x) >= 0}
        out.append({(i, e) for i, e in least.items() if e <= _budget(dict(items)[i])})
    return out


def test_every_window_and_edit_count_equals_the_definition():
    r = random.Random(3)
    items = [(i, edges.words(300 + i, n)) for i, n in enumerate((3, 4, 5, 6, 8, 10, 12, 18, 25, 40))]
    texts = []
    for i, item in items:
        p = _plain(item)
        w = min(dc.WINDOW, len(p))
        for edits in range(_budget(item) + 3):
            for _ in range(3):
                s = r.randrange(len(p) - w + 1)
                texts.append(edges.words(r.randrange(9999), 12) + " " + _edit(p[s:s + w], edits, r) + " " + edges.words(r.randrange(9999), 12))
    got, want = _pairs(texts, items), _brute_pairs(texts, items)
    assert got == want and sum(map(len, want)) > len(texts) / 2


def test_substitutions_that_spread_evenly_are_found():
    p = _plain(edges.words(77, 60))[:200]
    k, texts = dc.WINDOW // 10, []
    for s in range(len(p) - dc.WINDOW + 1):
        part = list(p[s:s + dc.WINDOW])
        for j in range(k):                  # at equal distances: the fewest shared q-grams that k edits leave
            part[(j + 1) * dc.Q + j - 1] = "#"
        texts.append("0123456789" * 3 + "".join(part).replace("#", "7") + "9876543210" * 3)
    assert [{i for i, _ in x} for x in _pairs(texts, [(1, p)])] == [{1}] * len(texts)


def test_a_replaced_word_of_six_letters():
    r = random.Random(5)
    items, texts = [], []
    for i in range(100):
        words = edges.words(1000 + i, 18).split()
        items.append((i, " ".join(words)))
        at = r.choice([j for j, x in enumerate(words) if len(x) <= 6])
        texts.append(" ".join(words[:at] + ["zq" * (len(words[at]) // 2)] + words[at + 1:]))
    assert all(i in {j for j, _ in found} for i, found in enumerate(_pairs(texts, items)) if len(_plain(items[i][1])) >= 66)


def test_repeated_letters_are_cut_into_slices(monkeypatch):
    items = [(1, "a" * 90), (2, "ab" * 40), (3, edges.words(8, 30))]
    texts = ["a" * 150, "ab" * 60 + "b" + "ab" * 40, edges.words(8, 30), "a" * 40 + "b" * 7 + "a" * 40, ""]
    whole = dc.matches(texts, dc.build_index(items))
    assert _pairs(texts, items)[:4] == _brute_pairs(texts[:4], items)
    monkeypatch.setattr(dc, "PAIRS", 2_000)
    monkeypatch.setattr(dc, "ALIGNED", 7)
    assert dc.matches(texts, dc.build_index(items)) == whole


def test_a_benchmark_of_several_blocks(spark, monkeypatch):
    items, docs, want = _cases()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    one, kept = set(map(tuple, dc.contaminated(d, b).collect())), {r.doc_id for r in dc.remove_contaminated(d, b).collect()}
    monkeypatch.setattr(dc, "BLOCK_CHARS", 6_000)
    assert set(map(tuple, dc.contaminated(d, b).collect())) == one
    assert {r.doc_id for r in dc.remove_contaminated(d, b).collect()} == kept == {i for i, _ in docs} - set(want)


def _edit(text, n, r):
    out = list(text)
    for _ in range(n):
        at = r.randrange(len(out))
        kind = r.randrange(3)
        if kind == 0:
            out[at] = r.choice("abcxyz")
        elif kind == 1:
            out.insert(at, r.choice("abcxyz"))
        else:
            del out[at]
    return "".join(out)


def _cases():
    r = random.Random(7)
    items = [(i, edges.words(100 + i, r.randint(14, 45)).capitalize() + ".") for i in range(25)]
    docs, want = [], {}
    for i, (item, text) in enumerate(items):
        reduced = len("".join(c for c in text if c.isalnum()))
        budget = int(dc.build_index([(item, text)]).budget[0])
        copy = [text, text.upper().replace(" ", "\n"), _edit(text, budget // 2 if reduced <= dc.WINDOW else 2, r)][i % 3]
        docs.append((i, edges.words(500 + i, 50) + " " + copy + " " + edges.words(700 + i, 50)))
        want[i] = {item}
    docs += [(100 + i, edges.words(900 + i, 200)) for i in range(25)]
    return items, docs, want


def test_planted_passages(spark):
    items, docs, want = _cases()
    got = {}
    for r in dc.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                             spark.createDataFrame(items, "item_id long, text string")).collect():
        got.setdefault(r.doc_id, set()).add(r.item_id)
        assert 0 <= r.start < r.end <= len(dict(docs)[r.doc_id])
    assert got == want


def test_part_of_an_item_and_offsets():
    item = edges.words(41, 60)
    part = " ".join(item.split()[10:45])
    text = "Before it. " + part + " after it."
    (_, start, end, edits), = dc.matches([text], dc.build_index([(5, item)]))[0]
    assert edits == 0 and part[:20] in text and start >= 11 and end <= 11 + len(part)
    assert dc.matches([" ".join(item.split()[:5])], dc.build_index([(5, item)])) == [[]]


def test_given_tables_equal_plain_search(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in dc.contaminated(docs, bench).collect()}
    items = [(r.item_id, _plain(r.text)) for r in bench.collect()]
    verbatim = {(d.doc_id, i) for d in docs.collect() for i, t in items if t in _plain(d.text)}
    assert verbatim <= got and len(got - verbatim) <= 0.1 * len(verbatim) + 1


def test_edges(spark):
    bench = spark.createDataFrame([(1, edges.words(5, 80)), (2, None), (None, edges.words(4, 60)), (3, "short"), (4, ""),
                                   (1, edges.words(5, 80))], "item_id long, text string")
    docs = edges.clashing(spark)
    clean = dc.remove_contaminated(docs, bench)
    assert clean.columns == docs.columns
    ids = [r.doc_id for r in clean.collect()]
    assert 10 not in ids and ids.count(None) == 1 and {1, 2, 3, 4, 5, 6, 7, 8, 9, 11, 12} <= set(ids)
    assert dc.contaminated(edges.empty(spark), bench).count() == 0
    assert dc.remove_contaminated(docs, bench.filter("false")).count() == docs.count()
    assert dc.contaminated(docs, bench.filter("false")).count() == 0
