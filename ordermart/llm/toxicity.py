"""Operator 7: toxicity by a weighted finite-state pattern grammar.

Method.  Words belong to classes: insults (with a weight learned from
labelled documents), threats, targets, negations, reporting verbs, words of a
predicate or an address (are, what a, such) and words that speak of words
(word, term, dictionary).  Seven small transducers read the classes of a
clause and are composed once into one transition table; it writes, for each
word, the pattern that the word completes:

* ``targeted``: an insult with a target before it in reach, or right after it;
* ``asserted``: an insult as a predicate or an address (is an, what an);
* ``negated``, ``reported``: an insult or threat in that scope;
* ``threat``: a threat and a target in reach of each other;
* none in a clause that speaks of the word itself.

An insult that completes no pattern is bare.  A second transducer reads
these marks clause after clause: a bare insult is held, and counts (channel
``barrage``) only if another insult comes within ``BARRAGE_SCOPE`` clauses.
So a single insult word without a pattern around it scores nothing.  A
logistic model over the channels, fitted on the same labelled sample, gives
the score.

Insult weights are the log odds of a word in toxic against other labelled
documents, kept if the word is significantly more frequent in toxic ones;
near copies count once.

Scale.  Fitting reads a sample of ``SAMPLE_ROWS`` labelled documents at
most (``sampling``) and sends the learned words, a part of that sample's
words, to the tasks.  Scoring is one narrow pass without a shuffle; clauses
without an insult or threat are passed over in array code.

Results on edge cases.  Null, empty and wordless texts have empty channels
and the model's base score, below 0.5.  Without any labelled row of either
kind nothing is learned and every score is 0.0.  Repeated rows score alike;
other columns pass through whatever their names are.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from . import common
from .sampling import labelled_sample, partial_counts
from .words import Words, shingles_of, words_of

#: Most labelled documents that the fit reads.
SAMPLE_ROWS = 20_000
#: A word is learned if its log odds and the evidence for them (n times the divergence
#: of its toxic share from the average; 18 is a chance of about 1e-8) reach these.
MIN_ODDS, MIN_EVIDENCE = 3.0, 18.0
TOXIC_SCORE = 0.5

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, FRAME, MENTION = range(8)
#: Fixed word lists of the grammar; insults are learned.
WORDS = {
    THREAT: "kill hurt destroy beat burn shoot stab töten umbringen matar tuer frapper",
    TARGET: "you your yours yourself u he she they him her them du dich dir ihr euch sie tu te vous toi tú usted ustedes vosotros",
    NEGATION: "not never no nor without isn aren wasn weren don doesn didn nicht nie kein keine pas jamais aucun nunca jamás sin",
    REPORT: "said says say claimed called wrote reported quoted alleged sagte sagt schrieb dit disait écrit dijo dice escribió",
    FRAME: "am are is was were be been re what such hey bist ist sind war es est sont quel quelle eres son qué",
    MENTION: "word words term terms dictionary means meaning spelling wort wörter begriff wörterbuch mot mots terme dictionnaire palabra término diccionario",
}
CHANNELS = ("targeted", "asserted", "barrage", "negated", "reported", "threat")
TARGETED, ASSERTED, BARRAGE, NEGATED, REPORTED, THREATENED = range(6)
#: Marks of the clause table beside the channels: nothing, a bare insult, a target right after a bare insult.
NOTHING, BARE, ADDRESSED = -1, 6, 7
#: Words after which the scope of a negation, of a target or threat near by and of a predicate ends.
NEGATION_SCOPE, TARGET_SCOPE, FRAME_SCOPE = 3, 4, 3
#: Clauses within which a bare insult waits for another insult.
BARRAGE_SCOPE = 20


@dataclass(frozen=True)
class Transducer:
    """States 0..size-1, start 0; ``step`` gives the next state for (state, class)."""

    size: int
    step: object


def _countdown(trigger: int, scope: int) -> Transducer:
    """State k: the trigger was seen and its scope holds for k more words."""
    return Transducer(scope + 1, lambda s, c: scope if c == trigger else max(0, s - 1))


def _latch(trigger: int) -> Transducer:
    """State 1 from the trigger to the end of the clause."""
    return Transducer(2, lambda s, c: 1 if c == trigger else s)


PARTS = (_countdown(NEGATION, NEGATION_SCOPE), _latch(REPORT), _countdown(TARGET, TARGET_SCOPE),
         _countdown(THREAT, TARGET_SCOPE), _countdown(FRAME, FRAME_SCOPE), _latch(MENTION), _countdown(INSULT, 1))


def mark(state: tuple[int, ...], kind: int) -> int:
    """What a word of class ``kind`` completes in the states of PARTS before it."""
    negated, reported, target, threat, frame, mention, insult = state
    threatened = (kind == THREAT and target) or (kind == TARGET and threat)
    if mention or not (kind == INSULT or threatened or (kind == TARGET and insult)):
        return NOTHING
    if not (kind == INSULT or threatened):
        return ADDRESSED
    if negated or reported:
        return NEGATED if negated else REPORTED
    if threatened:
        return THREATENED
    return TARGETED if target else ASSERTED if frame else BARE


def compose(parts: tuple[Transducer, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Transition table [state, class] and the mark that an arc writes."""
    states = {s: i for i, s in enumerate(product(*[range(p.size) for p in parts]))}
    go = np.zeros((len(states), 8), dtype=np.int32)
    write = np.full((len(states), 8), NOTHING, dtype=np.int8)
    for state, i in states.items():
        for c in range(8):
            go[i, c] = states[tuple(p.step(s, c) for p, s in zip(parts, state))]
            write[i, c] = mark(state, c)
    return go, write


GO, WRITE = compose(PARTS)


@dataclass
class Grammar:
    """Sorted word hashes with class and weight, and the fitted logistic model."""

    hashes: np.ndarray
    kinds: np.ndarray
    weights: np.ndarray
    model: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @staticmethod
    def of(insults: dict[str, float]) -> "Grammar":
        table = {w: (k, 1.0) for k, words in WORDS.items() for w in words.split()}
        table |= {w: (INSULT, x) for w, x in insults.items()}
        words = list(table)
        hashes = words_of(["\n".join(words)]).hashes if words else np.zeros(0, dtype=np.uint64)
        order = np.argsort(hashes)
        kinds = np.array([table[w][0] for w in words], dtype=np.int8)
        weights = np.array([table[w][1] for w in words])
        return Grammar(hashes[order], kinds[order], weights[order])


def _clauses(w: Words) -> np.ndarray:
    """Number of the clause that each word is in: clauses end at . ! ? ; : and line feeds."""
    c = w.codes
    stop = np.zeros(len(c) + 1, dtype=np.int32)
    ends = (c == 10) | (c == 46) | (c == 33) | (c == 63) | (c == 59) | (c == 58)
    np.cumsum(ends, out=stop[1:])
    return stop[w.start]


def channels(texts: list[str], grammar: Grammar) -> np.ndarray:
    """Features of each text: for each channel the strongest clause and the log of the sum."""
    w = words_of(texts)
    out = np.zeros((len(texts), 2 * len(CHANNELS)))
    if not len(w.hashes):
        return out
    at = np.minimum(np.searchsorted(grammar.hashes, w.hashes), len(grammar.hashes) - 1)
    known = grammar.hashes[at] == w.hashes
    kinds = np.where(known, grammar.kinds[at], OTHER)
    weights = grammar.weights[at]
    hits = np.flatnonzero((kinds == INSULT) | (kinds == THREAT))
    if not len(hits):
        return out
    # clauses with a word, numbered through
    clause = np.cumsum(np.diff(_clauses(w), prepend=-1) != 0)
    owner = w.owner()
    text, last, waiting, held = -1, 0, 0, 0.0
    for c in np.unique(clause[hits]).tolist():
        a, b = np.searchsorted(clause, [c, c + 1])
        if owner[a] != text:
            text, waiting, held = owner[a], 0, 0.0
        waiting = max(0, waiting - (c - last))
        last, state, prior, sums = c, 0, NOTHING, [0.0] * len(CHANNELS)
        for kind, weight in zip(kinds[a:b].tolist(), weights[a:b].tolist()):
            wrote = WRITE[state, kind]
            state = GO[state, kind]
            if wrote == ADDRESSED and prior == BARE:
                sums[TARGETED] += held
                held = 0.0
            elif wrote in (BARE, TARGETED, ASSERTED):
                if waiting:     # another insult: the one that is held counts
                    sums[BARRAGE] += held
                    held = 0.0
                if wrote != BARE:
                    sums[wrote] += weight
                elif waiting:
                    sums[BARRAGE] += weight
                else:
                    held = weight
                waiting = BARRAGE_SCOPE
            elif 0 <= wrote < BARE:
                sums[wrote] += weight
            prior = wrote
        row = out[text]
        for i, x in enumerate(sums):
            if x:
                row[2 * i] = max(row[2 * i], x)
                row[2 * i + 1] += x
    out[:, 1::2] = np.log1p(out[:, 1::2])
    return out


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last weight is the bias."""
    z = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.diag([ridge] * x.shape[1] + [1e-6])
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (y - p) - penalty @ w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return w


def _words(text: str) -> set[str]:
    low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return set("".join(c if c.isalnum() else " " for c in low).split())


def one_of_copies(sample: DataFrame) -> DataFrame:
    """``sample`` thinned of copies: one text of those that share their least three-word shingle.

    Words of a toxic text with many near copies would pass as insults otherwise.
    """

    def least(texts, rows):
        shingles, per = shingles_of(words_of(texts), 3)
        at = np.concatenate([[0], np.cumsum(per)])
        low = [shingles[a:b].min() if b > a else 0 for a, b in zip(at[:-1], at[1:])]
        return {"text": pa.array(texts, pa.string()), "label": rows.column(0),
                "least": np.array(low, dtype=np.uint64).view(np.int64)}

    return (common.map_texts(sample, "text", least, "text string, label int, least long", ["label"])
            .groupBy("least", "label").agg(F.min("text").alias("text")).select("text", "label"))


def learn_insults(sample: DataFrame) -> dict[str, float]:
    """Weight of each word that is significantly more frequent in toxic documents of ``sample``."""

    def fn(texts, rows):
        seen: dict[str, list[int]] = {}
        for text, label in zip(texts, rows.column(0).to_pylist()):
            for word in _words(text):
                seen.setdefault(word, [0, 0])[int(label == 1)] += 1
        seen[""] = [sum(x != 1 for x in rows.column(0).to_pylist()), sum(x == 1 for x in rows.column(0).to_pylist())]
        return {"word": pa.array(list(seen), pa.string()), "clean": [v[0] for v in seen.values()],
                "toxic": [v[1] for v in seen.values()]}

    counts = common.materialise(partial_counts(sample, fn, "word string", ["clean", "toxic"]), "words")
    total = counts.filter("word = ''").first()
    if total is None or not total.toxic or not total.clean:
        return {}
    share = total.toxic / (total.toxic + total.clean)
    n, tiny = F.col("toxic") + F.col("clean"), F.lit(1e-12)
    p = F.col("toxic") / n
    evidence = n * (p * F.log(p / share + tiny) + (1 - p) * F.log((1 - p) / (1 - share) + tiny))
    odds = (F.log((F.col("toxic") + 0.5) / F.lit(total.toxic + 1.0))
            - F.log((F.col("clean") + 0.5) / F.lit(total.clean + 1.0)))
    best = (counts.filter((F.col("word") != "") & (F.col("toxic") > 0))
            .select("word", odds.alias("odds"), evidence.alias("evidence"))
            .filter((F.col("evidence") >= MIN_EVIDENCE) & (F.col("odds") >= MIN_ODDS))
            .orderBy("word"))
    found = {r.word: float(r.odds) for r in best.collect()}
    common.release(counts)
    return found


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Grammar:
    """Grammar and model from labelled documents that are not held out (crc32(doc_id) mod 5 is not 0)."""
    sample = common.materialise(
        labelled_sample(docs, labels, "toxic", common.held_out_mod5(F.col("doc_id")), rows), "sample")
    grammar = Grammar.of(learn_insults(one_of_copies(sample)))

    def features(texts, batch):
        x = channels(texts, grammar)
        return {"label": batch.column(0), "x": common.flat_lists(x.ravel(), [x.shape[1]] * len(x), pa.float64())}

    seen = common.map_texts(sample, "text", features, "label int, x array<double>", ["label"]).toPandas()
    common.release(sample)
    y = (seen["label"].to_numpy() == 1).astype(float) if len(seen) else np.zeros(0)
    if 0 < y.sum() < len(y):
        x = np.stack(seen["x"].to_numpy())
        order = np.lexsort([*x.T, y])       # rows arrive in any order; the fit is the same each time
        grammar.model = _logistic(x[order], y[order])
    return grammar


def score_column(text: Column, grammar: Grammar, spark: SparkSession) -> Column:
    """Score from 0 to 1 of a text column."""
    common.ship_package(spark)
    held = spark.sparkContext.broadcast(grammar)   # words of SAMPLE_ROWS documents at most

    @pandas_udf("double")
    def score(text):
        import pandas as pd
        g = held.value
        texts = [t if t is not None else "" for t in text]
        out = np.zeros(len(texts))
        if len(g.model):
            for a, b in common.in_chunks(texts):
                z = channels(texts[a:b], g) @ g.model[:-1] + g.model[-1]
                out[a:b] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        del texts
        common.give_back()
        return pd.Series(out)

    return score(text)


def remove_toxic(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """The rows of ``docs`` whose score is below TOXIC_SCORE, all columns kept."""
    name = common.free_name(docs, "__toxicity")
    return docs.withColumn(name, score_column(F.col("text"), grammar, docs.sparkSession)).filter(
        F.col(name) < TOXIC_SCORE).drop(name)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document: doc_id, held_out, score, predicted."""
    docs = common.table(spark, sf_dir, "documents")
    grammar = fit(docs, common.table(spark, sf_dir, "labels"))
    return (docs.select("doc_id", common.held_out_mod5(F.col("doc_id")).alias("held_out"),
                        score_column(F.col("text"), grammar, spark).alias("score"))
            .withColumn("predicted", (F.col("score") >= TOXIC_SCORE).cast("int")))
