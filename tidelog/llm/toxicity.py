"""Toxicity by a weighted finite-state grammar over clauses.

Five small transducers read a sentence's words as symbols (insult, threat, target, negation,
report, comma, other): each keeps how long its evidence reaches. Their composition, one table of
(state, symbol) -> (state, output), classifies every matched clause: a targeted, negated, reported
or repeated insult, a direct or attributed threat, and a bare insult, whose clause has no structure.
What scores is the class of the clause, weighted by its word's own weight; a bare insult is a class
like the others, with a weight learned from the labels. Where labels mark single words, as in
generated texts, that class does most of the work: README gives the figures with and without it.

Word weights are learned: document counts of words and word beginnings in labelled rows select
those tied to the label. Clause weights are a logistic regression on clause sums, drawn towards
the grammar's own prior weights, which stand alone where there are no labels.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, held_out, in_small_batches, labelled_sample, text_of

THRESHOLD = 0.3
#: Labelled rows learned from, at most about so many a class.
PER_CLASS = 4_000
PREFIXES = range(4, 8)

# Seed words in English, German, French and Spanish.
INSULTS = """idiot moron stupid fool loser scum trash pathetic worthless disgusting clown dumb garbage imbecile
dumm trottel abschaum versager depp widerlich imbécile stupide ordure crétin idiota estúpido imbécil basura tonto""".split()
THREATS = """kill hurt destroy beat burn shoot stab punch strangle töten schlagen umbringen verletzen tuer frapper
brûler détruire matar golpear quemar destruir""".split()
TARGETS = """you your yours yourself u he she they him her them people du dich dir dein euch ihr sie tu toi vous vos
ils elles tú te ti usted ustedes ellos vosotros""".split()
NEGATIONS = "not no never isn't aren't don't nobody nicht kein keine keinen niemals pas jamais aucun nunca jamás ninguno".split()
REPORTS = """said says called calls wrote writes claimed quoted quote sagte sagt nannte schrieb zitiert dit disait écrit
appelé dijo dice escribió llamó""".split()

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, COMMA = range(7)
PLAIN, TARGETED, NEGATED, REPORTED, MENACE, SAID_MENACE, LATE, AGAIN = CLASSES = range(8)
#: Weights of clause sums before any label is seen: by class, then the strongest clause, and the bias.
PRIOR = np.array([1.2, 1.6, 0.6, 0.6, 1.6, 0.4, 0.4, 1.2, 0.5, -3.5])
_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[.,;:!?\n|]")
_ENDS = frozenset(".;:!?\n|")


def _reach(symbol: int, n: int):
    """A transducer that remembers ``symbol`` for n words; a comma ends it."""

    def step(state: int, read: int) -> int:
        return n if read == symbol else 0 if read == COMMA else max(0, state - 1)

    return n + 1, step


def _latch(symbol: int):
    """A transducer that remembers ``symbol`` to the end of the sentence."""
    return 2, lambda state, read: 1 if read == symbol else state


PARTS = {INSULT: _reach(INSULT, 4), THREAT: _reach(THREAT, 6), TARGET: _reach(TARGET, 5), NEGATION: _reach(NEGATION, 3), REPORT: _latch(REPORT)}


def compose() -> dict[int, tuple[int, int]]:
    """(state * 7 + symbol) -> (state, clause class or -1), over the product of all parts."""
    sizes = [n for n, _ in PARTS.values()]

    def number(states) -> int:
        out = 0
        for s, n in zip(states, sizes):
            out = out * n + s
        return out

    table = {}
    for states in product(*map(range, sizes)):
        held = dict(zip(PARTS, states))
        for read in range(7):
            out = -1
            if read == INSULT:
                out = NEGATED if held[NEGATION] else REPORTED if held[REPORT] else TARGETED if held[TARGET] else AGAIN if held[INSULT] else PLAIN
            elif (read == THREAT and held[TARGET]) or (read == TARGET and held[THREAT]):
                out = SAID_MENACE if held[NEGATION] or held[REPORT] else MENACE
            elif read == TARGET and held[INSULT]:
                out = LATE
            after = [step(s, read) for (_, step), s in zip(PARTS.values(), states)]
            table[number(states) * 7 + read] = (number(after), out)
    return table


class Grammar:
    """The composed transducer with a lexicon: word or beginning + ``*`` -> weight."""

    def __init__(self, lexicon: dict[str, float]):
        self.table, self.lexicon, self.seen = compose(), lexicon, {}
        self.fixed = {w: s for s, words in ((REPORT, REPORTS), (NEGATION, NEGATIONS), (TARGET, TARGETS), (THREAT, THREATS)) for w in words}

    def read(self, word: str) -> tuple[int, float]:
        """Symbol and weight of a lower-case word or mark."""
        known = self.lexicon
        weight = max([known.get(word, 0.0), *(known.get(word[:n] + "*", 0.0) for n in PREFIXES if len(word) >= n)])
        if word in self.fixed:  # a word of the grammar keeps its part; what is learned of it weighs its clauses
            return self.fixed[word], max(1.0, weight)
        if weight > 0:
            return INSULT, weight
        return (COMMA, 0.0) if word == "," else (-1, 0.0) if word in _ENDS else (OTHER, 0.0)

    def clauses(self, text: str) -> np.ndarray:
        """Logarithms of the sums by clause class, and the strongest clause."""
        sums, strongest, state, seen = [0.0] * len(CLASSES), 0.0, 0, self.seen
        if len(seen) > 300_000:
            seen.clear()
        words = _TOKEN.findall(text.lower())
        for w in set(words):
            if w not in seen:
                seen[w] = self.read(w)
        reads = [seen[w] for w in words]
        if any(r[0] in (INSULT, THREAT) for r in map(seen.__getitem__, set(words))):
            table = self.table
            for symbol, weight in reads:
                if symbol < 0:
                    state = 0
                    continue
                state, out = table[state * 7 + symbol]
                if out >= 0:
                    sums[out] += weight
                    strongest = max(strongest, weight)
        return np.array([*map(math.log1p, sums), strongest])


def _score(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))


def _entries(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) >= n)]


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def out() -> pa.RecordBatch:
        rows = list(counts.items())
        counts.clear()
        entries, labels = zip(*(k for k, _ in rows))
        return pa.RecordBatch.from_arrays([pa.array(entries, pa.string()), pa.array(labels, pa.int32()), pa.array([n for _, n in rows], pa.int64())], names=["entry", "label", "n"])

    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = {e for w in {w for w in _TOKEN.findall(text.lower()) if w not in _ENDS and w != ","} for e in _entries(w)}
            counts.update((e, label) for e in found)
            if len(counts) > 400_000:
                yield out()
    if counts:
        yield out()


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Entries tied to label 1 beyond chance, with their log odds ratios as weights.

    An entry needs a log-likelihood ratio above 2 ln(entries seen) + 8, which no chance entry
    passes, and twenty times the odds. Seed words have weight 3 until 20 documents say otherwise.
    """
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    pos, neg = sizes.get(1, 0), sizes.get(0, 0)
    counts = sample.select("text", "label").mapInArrow(_document_counts, "entry string, label int, n long")
    of = lambda label: F.sum(F.when(F.col("label") == label, F.col("n")).otherwise(0))
    frequent = durable(counts.groupBy("entry").agg(of(1).alias("a"), of(0).alias("b")).where((F.col("a") >= 3) | F.col("entry").isin(INSULTS)))
    a, b = F.col("a"), F.col("b")
    weight = F.log((a + 0.5) * (neg + 1.0) / ((b + 0.5) * (pos + 1.0)))
    base = (pos + 0.5) / (pos + neg + 1.0)
    part = lambda n, share: F.when(n > 0, 2 * n * F.log(n / ((a + b) * F.lit(share)))).otherwise(0.0)
    tied = (weight >= 3) & (part(a, base) + part(b, 1 - base) >= 2 * math.log(max(2, frequent.count())) + 8)
    seed = F.col("entry").isin(INSULTS) & (a + b >= 20)
    lexicon = dict.fromkeys(INSULTS, 3.0)
    for r in frequent.where(tied | seed).withColumn("weight", weight).collect():  # few by that test, and bounded by the sample's own words
        lexicon[r["entry"]] = max(0.0, r["weight"])
    return lexicon


def fit_weights(x: np.ndarray, y: np.ndarray, w: np.ndarray, pull: float = 0.1) -> np.ndarray:
    """Logistic regression by Newton steps, drawn towards ``PRIOR``; w: weight of each row."""
    x1, beta = np.hstack([x, np.ones((len(x), 1))]), PRIOR.copy()
    for _ in range(40):
        p = _score(x, beta)
        grad = x1.T @ (w * (p - y)) + pull * (beta - PRIOR)
        curve = (x1 * (w * p * (1 - p))[:, None]).T @ x1 + pull * np.eye(len(beta))
        step = np.linalg.solve(curve, grad)
        beta = beta - step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return beta


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[dict[str, float], np.ndarray]:
    """Lexicon and clause weights from labelled rows that are not held out."""
    sample = durable(labelled_sample(docs, labels, "toxic", per_class))
    lexicon = learn_lexicon(sample)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(lexicon)
        for batch in batches:
            rows = [grammar.clauses(t).tolist() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1), batch.column(2)], names=["x", "label", "share"])

    rows = sample.select("text", "label", F.col("share").cast("double")).mapInArrow(work, "x array<double>, label int, share double").collect()
    if not {0, 1} <= {r["label"] for r in rows}:
        return lexicon, PRIOR
    rows.sort(key=lambda r: (r["label"], r["x"]))
    x, y = np.array([r["x"] for r in rows]), np.array([float(r["label"]) for r in rows])
    w = 1 / np.array([r["share"] for r in rows])
    return lexicon, fit_weights(x, y, w * len(w) / w.sum())


def score(docs: DataFrame, lexicon: dict[str, float], weights: np.ndarray) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``, over its whole text.

    Null and empty texts have no clause: their score is the bias alone. Long texts count whole;
    rows are independent, also where they or their ids repeat; a null id counts as held out; a score
    of just the threshold predicts 1; an empty table gives no rows; other columns are ignored.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(lexicon)
        for batch in batches:
            x = np.array([grammar.clauses(t.as_py()) for t in batch.column(1)]).reshape(-1, len(weights) - 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_score(x, weights))], names=["doc_id", "score"])

    found = in_small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text")).mapInArrow(work, "doc_id long, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_civil(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents predicted toxic, as in ``score``; all columns and repeated rows stay as they are."""
    lexicon, weights = learn(docs, labels)
    return in_small_batches(docs).mapInArrow(_civil(lexicon, weights, docs.columns.index("text")), docs.schema)


def _civil(lexicon: dict[str, float], weights: np.ndarray, at: int):
    """For mapInArrow: passes the rows whose text, in column ``at``, stays below the threshold."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(lexicon)
        for batch in batches:
            x = np.array([grammar.clauses(t.as_py() or "") for t in batch.column(at)]).reshape(-1, len(weights) - 1)
            yield batch.filter(pa.array(_score(x, weights) < THRESHOLD))

    return work
