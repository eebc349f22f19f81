import numpy as np
import pytest
from tidelog.llm import toxicity as tx


@pytest.fixture(scope="module")
def grammar():
    return tx.Grammar(dict.fromkeys(tx.INSULTS, 3.0))


def classes(grammar, text):
    return {k for k in range(7) if grammar.clauses(text)[k] > 0}


@pytest.mark.parametrize(("text", "found"), [
    ("what an idiot", {tx.PLAIN}), ("you are an idiot", {tx.TARGETED}), ("you are not an idiot", {tx.NEGATED}), ("not, idiot", {tx.PLAIN}),
    ("he said that was stupid", {tx.REPORTED}), ("he said so. stupid", {tx.PLAIN}), ("i will kill you", {tx.MENACE}), ("kill time", set()),
    ("they said i will kill you", {tx.SAID_MENACE}), ("idiot, go home", {tx.PLAIN}), ("idiot that you are", {tx.PLAIN, tx.LATE}), ("a fine day for you", set()), ("", set()), ("!!! ...", set()),
])
def test_clauses(grammar, text, found):
    assert classes(grammar, text) == found


def test_the_composition_agrees_with_its_parts():
    """Brute force: running the five parts side by side gives what the table gives."""
    table, rng = tx.compose(), np.random.default_rng(1)
    sizes = [n for n, _ in tx.PARTS.values()]
    states, at = [0] * 5, 0
    for read in rng.integers(0, 7, 3000).tolist():
        held = dict(zip(tx.PARTS, states))
        at, out = table[at * 7 + read]
        states = [step(s, read) for (_, step), s in zip(tx.PARTS.values(), states)]
        number = 0
        for s, n in zip(states, sizes):
            number = number * n + s
        assert number == at
        assert (out in (tx.PLAIN, tx.TARGETED, tx.NEGATED, tx.REPORTED)) == (read == tx.INSULT)
        if read == tx.INSULT and held[tx.NEGATION]:
            assert out == tx.NEGATED


def data(spark, n=600):
    rng, words, rows, marks = np.random.default_rng(3), ["alpha", "beta", "gamma", "delta", "omega"], [], []
    for i in range(n):
        text = " ".join(rng.choice(words, 40))
        toxic = i % 5 == 0
        if toxic:
            text += f". you zorgl{'abcdefgh'[i % 8]} and zorgl{'hgfedcba'[i % 8]}x"
        rows.append((i, text))
        marks.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")


def test_learns_stems_and_holds_on_held_out_rows(spark):
    docs, labels = data(spark)
    lexicon, weights = tx.learn(docs, labels)
    assert lexicon["zorgl*"] > 3
    rows = tx.score(docs, lexicon, weights).collect()
    assert {r.held_out for r in rows} == {True, False}
    assert all(r.predicted == (r.doc_id % 5 == 0) == (r.score >= 0.3) for r in rows if r.held_out)


def test_held_out_labels_do_not_matter(spark):
    import zlib

    docs, labels = data(spark, 200)
    flipped = spark.createDataFrame([(r.doc_id, 1 - r.toxic if zlib.crc32(str(r.doc_id).encode()) % 4 == 2 else r.toxic) for r in labels.collect()], "doc_id long, toxic int")
    a, b = tx.learn(docs, labels), tx.learn(docs, flipped)
    assert a[0] == b[0] and np.allclose(a[1], b[1])


def test_on_the_table(spark, sf_dir):
    d = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    rows = tx.score(docs, *tx.learn(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.toxic for r in rows) / len(rows)
    assert len(rows) > 50 and right >= 0.9
    assert sum(r.predicted for r in rows if not r.toxic) <= 0.02 * len(rows)


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(7, 1), (7, 0), (None, 1), (9, None), (99, 1)], "doc_id long, toxic int")
    for marks in (labels, labels.where("false")):
        lexicon, weights = tx.learn(odd_docs, marks)
        rows = tx.score(odd_docs, lexicon, weights).collect()
        assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
        assert tx.score(no_docs, lexicon, weights).count() == 0
        kept = tx.keep_civil(odd_docs, marks)
        assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
        assert tx.keep_civil(no_docs, marks).count() == 0
