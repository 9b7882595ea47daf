import random

import numpy as np
from pyspark.sql import functions as F

from ordermart.llm import common, components
from ordermart.llm import near_dedup as nd
from ordermart.llm import substring_dedup as sd
from ordermart.llm.components import connected_components
from ordermart.llm.words import shingle_letters, shingles_of, words_of

from . import edges


def _sets(texts):
    out = []
    for t in texts:
        s, _ = shingles_of(words_of([t or ""]), nd.SHINGLE_WORDS)
        out.append(set(s.tolist()))
    return out


def _brute_classes(rows):
    """Least id of the component of each (id, text) under Jaccard similarity 0.8 of the shingle sets."""
    sets, parent = _sets([t for _, t in rows]), list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= nd.THRESHOLD * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: least[find(i)] for i, (d, _) in enumerate(rows)}


def _cloud():
    """A frequent passage, a group of near copies around the threshold, exact copies and singles."""
    r, rows = random.Random(3), []
    base, passage = edges.words(11, 90).split(), edges.words(12, 60)
    for i in range(120):
        w = list(base)
        for _ in range(r.randint(0, 5)):
            w[r.randrange(len(w))] = edges.words(1000 + i, 1)
        rows.append((i, " ".join(w)))
    rows += [(200 + i, edges.words(300 + i, r.randint(5, 60)) + " " + passage) for i in range(150)]
    rows += [(500 + i, rows[i % 7][1].upper() + "!") for i in range(40)]
    return rows


def test_classes_equal_brute_force(spark):
    rows = _cloud()
    got = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = _brute_classes(rows)
    assert {r.id: r.class_id for r in got} == want
    kept = [r.id for r in got if r.kept]
    assert sorted(kept) == sorted(set(want.values()))


def test_copies_whose_lines_repeat_differently_equal_brute_force(spark):
    rows = []
    for i in range(60):
        n, line, times = ((400, 12, 30), (200, 10, 100), (1000, 12, 200))[i % 3]
        text, last = edges.words(6000 + i, n), edges.words(7000 + i, line)
        rows += [(2 * i, f"{text}\n{last}"), (2 * i + 1, text + f"\n{last}" * times)]
    want = _brute_classes(rows)
    assert all(want[d] == d // 2 * 2 for d in want)
    got = {r.id: r.class_id for r in nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_given_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = {r.id: r.class_id for r in nd.near_duplicates(docs).collect()}
    assert got == _brute_classes([tuple(r) for r in docs.collect()])


def test_registers_estimate_probability_jaccard():
    rng = np.random.default_rng(1)
    items = np.arange(1, 61, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    wa, wb = rng.integers(0, 4, 60).astype(float), rng.integers(0, 4, 60).astype(float)
    exact = sum(1 / sum(max(wa[e] / wa[d], wb[e] / wb[d]) for e in range(60)) for d in range(60) if wa[d] and wb[d])
    ra, rb = (nd.prob_minhash(items[w > 0], w[w > 0], np.array([(w > 0).sum()]), 4000) for w in (wa, wb))
    assert abs((ra == rb).mean() - exact) < 0.04


def test_texts_agree_by_the_weights_of_their_shingles():
    """Letters of each shingle by the definition; bands meet as often as the weighted sets' Jaccard says."""
    texts = ["", "a bc", "one two three four five six", edges.words(41, 60) + " " + edges.words(42, 60) + " " + edges.words(43, 20),
             edges.words(41, 60) + " " + "internationalisation " * 9 + edges.words(42, 60)]
    w = words_of(texts)
    shingles, per = shingles_of(w, nd.SHINGLE_WORDS)
    letters = shingle_letters(w, nd.SHINGLE_WORDS)
    want = []
    for t in texts:
        x = t.split()
        want += [len("".join(x[k:k + 5])) for k in range(max(len(x) - 4, min(len(x), 1)))]
    assert letters.tolist() == want
    items, sizes, weights = nd.shingle_sets(shingles, per, letters)
    at = np.cumsum(sizes) - sizes
    a, b = (dict(zip(items[at[i]:at[i] + sizes[i]].tolist(), weights[at[i]:at[i] + sizes[i]].tolist())) for i in (3, 4))
    assert set(a) == _sets(texts)[3] and 1 < min(a.values()) and max(b.values()) == nd.MAX_WEIGHT
    exact = sum(a[k] for k in a.keys() & b.keys()) / sum({**a, **b}.values())
    registers = nd.prob_minhash(items, weights, sizes, 6000)
    assert abs((registers[3] == registers[4]).mean() - exact) < 0.03
    assert not registers[0].any()


def test_a_hot_node_is_dealt_over_salts(spark):
    """Two thirds of all edges on one node, adaptive execution off: no task of a star step gets them."""
    from ordermart.llm import components

    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    edge = spark.range(30_000).select(F.when(F.col("id") < 20_000, 0).otherwise(F.col("id") * 7).alias("v"),
                                      (F.col("id") + 1_000_000).alias("u"))
    try:
        for k, v in zip(before, ("false", "-1")):
            spark.conf.set(k, v)
        hung = components._hung(edge, True)
        sizes = [r["count"] for r in hung.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    # 20,000 and 40,000 rows of other edges: an even share is 7,500, the hot node's rows alone would be 20,000
    assert sum(sizes) == 60_000 and max(sizes) < 2 * 60_000 / int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_keep_one_edges(spark):
    kept = nd.keep_one(edges.clashing(spark))
    assert kept.columns == edges.clashing(spark).columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    ids = [d for d, _ in got]
    assert 1 in ids and 2 not in ids and 3 not in ids and ids.count(10) == 1
    assert {4, 5, 6, 7, 8, 9, 11, 12} <= set(ids) and ids.count(None) == 2
    assert nd.keep_one(edges.empty(spark)).count() == 0


def test_components(spark):
    r = random.Random(5)
    pairs = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(1000, 1000 + i) for i in range(1, 60)]
    want = {}
    for a, b in pairs:
        if a != b:
            x, y = want.setdefault(a, {a}), want.setdefault(b, {b})
            if x is not y:
                x |= y
                for e in y:
                    want[e] = x
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "x long, y long"), "x", "y").collect()}
    assert got == {k: min(v) for k, v in want.items()}


def test_repeated_passages_are_cut(spark):
    passage = "Xa bo cu de. " + edges.words(21, 60) + ". Last words of it here."
    alone = [edges.words(30 + i, 40) + "." for i in range(6)]
    rows = [(1, alone[0] + "\n" + passage + "\n" + alone[1]), (2, alone[2] + " " + passage.upper()),
            (3, alone[3] + "\nAll rights reserved.\n" + alone[4]), (4, alone[5] + "\nAll rights reserved."),
            (5, passage + "\n" + passage)]
    got = {r.doc_id: r for r in sd.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = dict(rows)
    assert got[1].text == text[1] and got[3].text == text[3] and got[4].text == text[4]
    assert got[2].text.strip() == alone[2] and got[5].text.strip() == ""
    for i, r in got.items():
        left, at = "", 0
        for s in r.removed_spans:
            left, at = left + text[i][at:s.start], s.end
        assert left + text[i][at:] == r.text


def _brute_cut(rows):
    """Texts after removal, unit by unit in plain Python over the rank order."""
    def units(t):
        w = words_of([t])
        edge, word, _ = sd.units_of(w)
        return [(min(int(a), len(t)), min(int(b), len(t)), tuple(w.hashes[x:y].tolist()))
                for a, b, x, y in zip(edge[:-1], edge[1:], word[:-1], word[1:])]

    first = {}
    for d, t in rows:
        for _, _, u in units(t):
            first[u] = min(first.get(u, d), d)
    out = {}
    for d, t in rows:
        seen, run, cut = set(), [], []
        for a, b, u in [*units(t), (None, None, None)]:
            if u is not None and (not u or u in seen or first[u] < d):
                run.append((a, b, len(u)))
            else:
                if sum(n for *_, n in run) >= sd.MIN_WORDS:
                    cut.append((run[0][0], run[-1][1]))
                run = []
            seen.add(u)
        for a, b in reversed(cut):
            t = t[:a] + t[b:]
        out[d] = t
    return out


def test_given_documents_cut_as_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r.text for r in sd.remove_repeats(docs).collect()}
    assert got == _brute_cut([tuple(r) for r in docs.collect()])


def _spliced():
    """Documents without sentence ends, with few and with mixed ones; passages of 50 words and more stand anywhere in them."""
    r, rows = random.Random(8), []
    common = edges.words(40, 60).split()

    def prose(seed, n, ends):
        w = [r.choice(common) if r.random() < 0.4 else x for x in edges.words(seed, n).split()]
        return [x + (r.choice([".", "!", ".\n", "?"]) if r.random() < ends else "") for x in w]

    for i in range(240):
        ends = (0, 0.03, 0.15)[i % 3]
        passage = prose(5000 + i, (50, 51, 60, 75)[i % 4], ends)
        for doc in (2 * i, 2 * i + 1):
            w = prose(9000 + doc, r.randint(60, 120), ends)
            at = r.randint(0, len(w))
            rows.append((doc, " ".join([*w[:at], *passage, *w[at:]]).replace("\n ", "\n")))
    return rows


def test_every_shared_run_of_50_words_is_cut(spark):
    rows = _spliced()
    got = {r.doc_id: r.removed_spans for r in sd.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    seen, shared = set(), 0
    for d, t in rows:
        w = words_of([t])
        gone = np.zeros(len(t) + 1, dtype=bool)
        for s in got[d]:
            gone[s.start:s.end] = True
        h = w.hashes.tolist()
        runs = [tuple(h[i:i + 50]) for i in range(len(h) - 49)]
        for i, run in enumerate(runs):
            if run in seen:
                shared += 1
                assert gone[w.start[i:i + 50]].sum() >= sd.MIN_WORDS
        assert not got[d] or any(run in seen for run in runs)
        seen.update(runs)
    assert shared >= 240


def test_units_of_a_passage_do_not_depend_on_its_sentence():
    passage = edges.words(77, 40)
    found = []
    for text in (passage, edges.words(78, 3) + " " + passage, edges.words(79, 90) + " " + passage + " " + edges.words(80, 90)):
        w = words_of([text])
        _, word, _ = sd.units_of(w)
        assert np.diff(word).max() <= 2 * sd.WINDOW
        found.append({tuple(w.hashes[a:b].tolist()) for a, b in zip(word[:-1], word[1:])})
    whole = found[0] & found[1] & found[2]
    assert sum(map(len, whole)) >= 40 - 2 * sd.WINDOW - 1


def test_cut_edges(spark):
    out = sd.remove_repeats(edges.clashing(spark))
    assert out.columns == [*edges.clashing(spark).columns, "removed_spans"]
    got = out.collect()
    assert len(got) == len(edges.rows()) and sum(r.text is None for r in got) == 2
    by = {r.doc_id: r.text for r in got if r.doc_id}
    assert by[1] == edges.rows()[0][1] and by[2] == "" and by[5] == "" and by[10] == edges.words(5, 80)
    assert sd.remove_repeats(edges.empty(spark)).count() == 0


def test_a_star_step_reads_its_edges_a_few_times(spark):
    """Plans that hold every input many times over cost the driver its memory."""
    edges = spark.range(40).selectExpr("id + 1 as u", "id as v")
    plan = components._stars(components._stars(edges, True), False)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") <= 9


def test_shuffle_files_go_with_the_write(spark):
    """What ``materialise`` has written is not also kept as shuffle files; the session's setting is as before."""
    spark.conf.set(common.SHUFFLE_CLEANUP, "false")
    rows = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    tracker = spark.sparkContext._jsc.sc().env().mapOutputTracker()
    before = tracker.shuffleStatuses().size()
    seen = [common.materialise(rows, "test").count() for _ in range(3)]
    assert seen == [7, 7, 7] and spark.conf.get(common.SHUFFLE_CLEANUP) == "false"
    # of each count's own exchange files may stay
    assert tracker.shuffleStatuses().size() - before <= 3


def test_workers_give_memory_back():
    """Freed memory does not stay with a process between batches."""
    import os
    import subprocess
    import sys

    code = """if True:
        from ordermart.llm import common

        def held():
            return int(open("/proc/self/statm").read().split()[1]) * 4096 >> 20

        common.give_back()
        before = held()
        texts = [bytes(3000) for _ in range(50_000)]
        pins = [bytes(3000) for _ in range(10)]
        del texts
        common.give_back()
        print(held() - before)
    """
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", code], cwd=top, capture_output=True, text=True, check=True).stdout
    assert int(out) < 60
