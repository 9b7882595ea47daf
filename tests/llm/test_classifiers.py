import itertools
import zlib

import numpy as np
from pyspark.sql import functions as F

from ordermart.llm import common
from ordermart.llm import language_id as li
from ordermart.llm import quality as q
from ordermart.llm import toxicity as tox

from . import edges

SF = "/root/testdata/sf0.01"


def _tables(spark):
    return (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))


def test_held_out_rows(spark):
    df = spark.createDataFrame([(i,) for i in range(200)] + [(None,)], "doc_id long")
    for r in df.select("doc_id", common.held_out_mod4(F.col("doc_id")).alias("a"), common.held_out_mod5(F.col("doc_id")).alias("b")).collect():
        crc = zlib.crc32(str(r.doc_id).encode()) if r.doc_id is not None else 1
        assert (r.a, r.b) == (crc % 4 == 2, crc % 5 == 0)


def _brute_bundle(text):
    """n-gram bundle by the definition, one n-gram at a time."""
    low = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text)
    low = " " + " ".join(low.split()) + " "
    out = np.zeros(li.DIMENSIONS)
    for gram in zip(*[low[k:] for k in range(li.NGRAM)]):
        if gram[1] != " ":
            v = np.ones(li.DIMENSIONS)
            for place, c in enumerate(gram):
                v *= np.roll(li.letter_vectors(np.array([ord(c)]))[0], li.NGRAM - 1 - place)
            out += v
    return out


def test_bundles_equal_the_definition():
    texts = ["Hello, World!", "", "a", "ÉÀ ßtraße 12 x", "!!", "数据 处理", "İstanbul q"]
    got = li.bundles(texts, np.arange(len(texts)), len(texts))
    assert all((g == _brute_bundle(t)).all() for g, t in zip(got, texts))
    assert (li.bundles(texts, np.zeros(len(texts), dtype=int), 1)[0] == got.sum(axis=0)).all()


def test_language_accuracy_on_held_out_rows(spark):
    docs, _ = _tables(spark)
    from ordermart.llm.registry import QUERIES
    got = {r.doc_id: r for r in QUERIES["op1_hyperdimensional_language"](spark, SF).collect()}
    held = [(r.lang, got[r.doc_id]) for r in docs.collect() if got[r.doc_id].held_out]
    assert len(got) == docs.count() and np.mean([lang == p.lang_pred for lang, p in held]) > 0.97
    assert all(0 <= p.score <= 1 for p in got.values())


def test_language_edges(spark):
    docs = edges.clashing(spark)
    learned = li.prototypes(docs, F.lit(False))
    assert set(learned) <= {"en", "de", "zh"}
    got = docs.select("doc_id", li.language_column(F.col("text"), learned, spark).alias("p")).select("doc_id", "p.*").collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(edges.rows())
    for i in (4, 5, 6, 7):
        assert (by[i].lang_pred, by[i].score) == ("und", 0.0)
    assert by[11].lang_pred == "zh" and by[8].lang_pred == "de"
    assert li.prototypes(edges.empty(spark), F.lit(False)) == {}
    none = docs.select(li.language_column(F.col("text"), {}, spark).alias("p")).select("p.*").distinct().collect()
    assert [tuple(r) for r in none] == [("und", 0.0)]


def test_transducers():
    g = tox.Grammar.of({"idiot": 3.0, "scum": 2.0})

    def one(text):
        x = tox.channels([text], g)[0]
        return {c: float(x[2 * i]) for i, c in enumerate(tox.CHANNELS) if x[2 * i]}

    for text in ("what an idiot", "they never ever was or had been idiot"):
        assert one(text) == {"asserted": 3.0}
    assert one("you are an idiot") == {"targeted": 3.0} and one("idiot you") == {"targeted": 3.0}
    assert one("not an idiot") == {"negated": 3.0} and one("the paper said idiot scum") == {"reported": 5.0}
    assert one("i will kill you") == {"threat": 1.0} and one("to kill a process") == {}
    # a word alone, or spoken of, matches nothing
    for text in ("idiot", "The word idiot is in the dictionary", "a story with idiot in it", "said nothing. idiot",
                 "the term idiot and the term scum", "idiot" + ". a" * tox.BARRAGE_SCOPE + ". scum"):
        assert one(text) == {}, text
    # bare insults count once a second one comes; the strongest clause holds both weights
    assert one("a scum here. and then idiot there") == {"barrage": 5.0}
    assert one("some scum. you idiot") == {"barrage": 2.0, "targeted": 3.0}


def _plain_channels(clauses, weight):
    """The grammar by its definition: each transducer walks by itself, clause after clause."""
    best, total = [0.0] * 6, [0.0] * 6
    held, since = None, None            # weight of a bare insult that waits, clauses since the last insult
    for words in clauses:
        since = None if since is None else since + 1
        sums, bare_before = [0.0] * 6, False

        def within(kind, k, n):
            return kind in words[max(0, k - n):k]
        for k, w in enumerate(words):
            was_bare, bare_before = bare_before, False
            if tox.MENTION in words[:k]:
                continue
            threat = (w == tox.THREAT and within(tox.TARGET, k, tox.TARGET_SCOPE)) or (
                w == tox.TARGET and within(tox.THREAT, k, tox.TARGET_SCOPE))
            if w != tox.INSULT and not threat:
                if w == tox.TARGET and was_bare and held is not None:
                    sums[tox.TARGETED] += held
                    held = None
                continue
            x = weight if w == tox.INSULT else 1.0
            if within(tox.NEGATION, k, tox.NEGATION_SCOPE):
                sums[tox.NEGATED] += x
            elif tox.REPORT in words[:k]:
                sums[tox.REPORTED] += x
            elif threat:
                sums[tox.THREATENED] += x
            else:
                again = since is not None and since < tox.BARRAGE_SCOPE
                if again and held is not None:
                    sums[tox.BARRAGE] += held
                    held = None
                if within(tox.TARGET, k, tox.TARGET_SCOPE):
                    sums[tox.TARGETED] += x
                elif within(tox.FRAME, k, tox.FRAME_SCOPE):
                    sums[tox.ASSERTED] += x
                else:
                    bare_before = True
                    if again:
                        sums[tox.BARRAGE] += x
                    else:
                        held = x
                since = 0
        best = [max(a, b) for a, b in zip(best, sums)]
        total = [a + b for a, b in zip(total, sums)]
    return [x for a, b in zip(best, total) for x in (a, np.log1p(b))]


def test_composed_grammar_equals_its_parts():
    """Random clauses, many texts in one chunk: composed table against transducers that walk one by one."""
    g = tox.Grammar.of({"idiot": 2.5})
    word = {tox.OTHER: "tree", tox.INSULT: "idiot", tox.THREAT: "kill", tox.TARGET: "you", tox.NEGATION: "not",
            tox.REPORT: "said", tox.FRAME: "what", tox.MENTION: "term"}
    rng = np.random.default_rng(5)
    docs = []
    for _ in range(1500):
        p = rng.dirichlet([4, 1, .7, .7, .4, .15, .5, .1])
        docs.append([rng.choice(8, rng.integers(1, 9), p=p).tolist() for _ in range(rng.integers(0, 40))])
    texts = [". ".join(" ".join(word[k] for k in c) for c in d) for d in docs]
    got = tox.channels(texts, g)
    want = np.array([_plain_channels(d, 2.5) for d in docs])
    assert np.allclose(got, want) and (want > 0).any(axis=0).all()


def test_toxicity_on_held_out_rows(spark):
    docs, labels = _tables(spark)
    from ordermart.llm.registry import QUERIES
    got = {r.doc_id: r for r in QUERIES["op7_toxicity"](spark, SF).collect()}
    held = [(r.toxic, got[r.doc_id]) for r in labels.collect() if r.doc_id in got and got[r.doc_id].held_out]
    assert len(got) == docs.count() and np.mean([t == p.predicted for t, p in held]) > 0.95


def _auc(pairs):
    pos, neg = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])


def test_quality_on_held_out_rows(spark):
    docs, labels = _tables(spark)
    from ordermart.llm.registry import QUERIES
    got = {r.doc_id: r for r in QUERIES["op10_factorisation_quality"](spark, SF).collect()}
    held = [(got[r.doc_id].score, r.quality) for r in labels.collect() if r.doc_id in got and got[r.doc_id].held_out]
    assert len(got) == docs.count() and _auc(held) > 0.95


def test_sum_of_squares_identity():
    rng = np.random.default_rng(3)
    m = q.Machine(0.3, rng.normal(size=q.FEATURES), rng.normal(size=(q.FEATURES, q.RANK)))
    texts = ["A small text, twice a small text.", "", "X | Y | Z\nX | Y | Z"]
    number, value, sizes = q.features(texts)
    got, at = m.logits(number, value, sizes), 0
    for z, n in zip(got, sizes):
        j, x = number[at:at + n], value[at:at + n]
        want = m.bias + (m.weight[j] * x).sum() + sum(
            m.vector[j[a]] @ m.vector[j[b]] * x[a] * x[b] for a, b in itertools.combinations(range(n), 2))
        assert abs(z - want) < 1e-8
        at += n


def test_classifier_edges(spark):
    docs = edges.clashing(spark)
    labels = spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(1, 13)] + [(None, 1, 1), (3, None, None), (2, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    for model, score in ((tox.fit(docs, labels), tox.score_column), (q.fit(docs, labels), q.score_column)):
        got = docs.select("doc_id", score(F.col("text"), model, spark).alias("s")).collect()
        assert len(got) == len(edges.rows()) and all(0 <= r.s <= 1 for r in got)
    for n in (0, 1):
        some = labels.limit(n)
        assert set(docs.select(tox.score_column(F.col("text"), tox.fit(docs, some), spark)).distinct().collect()[0]) == {0.0}
        assert docs.select(q.score_column(F.col("text"), q.fit(docs, some), spark)).distinct().count() == 1
    grammar = tox.Grammar.of({"extra": 9.0})
    # one insult alone matches nothing, so doc 3 stays until its insult is said of somebody
    docs = docs.withColumn("text", F.replace("text", F.lit(" extra"), F.lit(" you extra")))
    grammar.model = np.array([9.0] * (2 * len(tox.CHANNELS)) + [-5.0])
    kept = tox.remove_toxic(docs, grammar)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {d for d, *_ in edges.rows()} - {3}
    assert tox.remove_toxic(edges.empty(spark), grammar).count() == 0
