import re
from collections import Counter

import numpy as np
import public_tokenizers as P
from tidelog.llm import quality_classifier as qc
from tidelog.llm import quality_rules as qr

PIECES, RANKS = P.path("piece_bpe_32k.model"), P.path("byte_bpe_50k.tiktoken")


def test_features_are_words_and_grams():
    buckets, sizes = qc.features(["ab", "abcd", "é𝔘", "x" * 50])
    assert sizes.tolist() == [1 + sum(max(0, n + 2 - g + 1) for g in (3, 4, 5)) for n in (2, 4, 2, 50)]
    one = qc.features(["abcd"])[0]
    assert buckets[sizes[0] : sizes[0] + sizes[1]].tolist() == one.tolist() and buckets.max() < qc.BUCKETS
    shared = set(qc.features(["xabc"])[0]) & set(qc.features(["yabc"])[0])
    assert shared  # the gram abc
    assert qc.document("")[0].size == 0
    buckets, shares = qc.document("a b a")
    assert abs(shares[buckets < qc.BUCKETS].sum() - 1) < 1e-9 and shares[buckets >= qc.BUCKETS].tolist() == [1, 1]  # each kind by itself
    assert qc.patterns("a a b\nc\nc\n\n", ["a", "a", "b", "c", "c"]).tolist() == [0.5, 0.5, 1 / 3, 2 / 3]


def test_scorer_equals_the_plain_average():
    rng = np.random.default_rng(0)
    weights, texts = rng.normal(size=qc.BUCKETS + qc.PATTERNS), ["one two two\nthree one", "", "  ", "é 😀 word\nword\nword", "a"]
    scorer = qc.Scorer(weights, 0.25)
    for _ in range(2):
        for text, got in zip(texts, scorer.scores(texts)):
            buckets, shares = qc.document(text)
            z = 0.25 + float(shares @ weights[buckets])
            assert abs(got - 1 / (1 + np.exp(-z))) < 1e-9


def test_classifier_on_held_out_rows(spark, sf_dir):
    d = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    model = qc.learn(docs, labels)
    again = qc.learn(docs.repartition(5), labels)
    assert np.array_equal(model[0], again[0]) and model[1] == again[1]
    rows = qc.score(docs, *model).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50 and sum(r.predicted == r.quality for r in rows) / len(rows) > 0.96
    assert all(r.predicted == int(r.score >= 0.7) for r in rows)


def test_the_sample_is_bounded_by_its_features(spark, sf_dir, monkeypatch):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    seen = []
    monkeypatch.setattr(qc, "FEATURES", 20_000)
    monkeypatch.setattr(qc, "train", lambda rows: seen.append(sum(len(r[0]) for r in rows)) or (np.zeros((qc.BUCKETS + qc.PATTERNS, 1)), np.zeros((1, 2)), np.zeros(2)))
    qc.learn(docs.unionByName(docs), labels)  # repeated ids are learned once
    assert 5_000 < seen[0] <= 20_000


def test_classifier_on_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(7, 1), (4, 0), (None, 1), (9, None), (20, 0)], "doc_id long, quality int")
    for marks in (labels, labels.where("false"), labels.where("quality = 1")):
        model = qc.learn(odd_docs, marks)
        rows = qc.score(odd_docs, *model).collect()
        assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert qc.score(no_docs, *model).count() == 0


def plain_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside)


def judged(docs):
    return sorted(((r.doc_id is None, r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in qr.judge(docs, PIECES, RANKS).collect()), key=str)


def expected(docs):
    out = []
    for r in docs.collect():
        n, *rest = plain_base(r.text or "")
        out.append((r.doc_id is None, r.doc_id, n, *rest, n < 50 or 100 * rest[-1] > 50 * n))
    return sorted(out, key=str)


def test_rules_base_by_brute_force(docs, odd_docs, no_docs):
    assert judged(docs) == expected(docs)
    assert judged(odd_docs) == expected(odd_docs)
    assert qr.judge(no_docs, PIECES, RANKS).count() == 0
    assert qr.judge(odd_docs.drop("lang"), PIECES, RANKS).count() == odd_docs.count()


def test_fertility_by_plain_encoding():
    f = qr.Fertility(PIECES, RANKS)
    words = ["hello", "wörld", "数据", "😀", "a", "hello"]
    raw = [w.encode() for w in words]
    f.add(set(raw))
    per_piece, per_byte, entropy, fallback = f.measure(raw, 20)
    ids = [k for w in words for k in f.pieces.encode(w)]
    counts = np.array(list(Counter(ids).values())) / len(ids)
    assert abs(per_piece - 20 / len(ids)) < 1e-9 and abs(per_byte - 20 / sum(len(f.byte_level.encode_ordinary(" " + w)) for w in words)) < 1e-9
    assert abs(entropy - float(-(counts * np.log(counts)).sum()) / np.log(len(ids))) < 1e-9
    assert abs(fallback - np.mean([f.pieces.is_byte(k) for k in ids])) < 1e-9


def test_rules_keep_good_and_reject_junk(spark):
    rng = np.random.default_rng(5)
    vocabulary = [w for w in "the people of this small town went to market every morning before school began and came home late with bread cheese and stories".split()]
    good = [" ".join(rng.choice(vocabulary, 200)) for _ in range(80)]
    junk = " ".join(f"{w}%%$#&*" for w in rng.choice(vocabulary, 200))
    bytes_ = " ".join("".join(chr(c) for c in rng.integers(0x1F300, 0x1F5FF, 4)) for _ in range(120))
    rows = [(i, t, "en") for i, t in enumerate([*good, junk, bytes_])]
    kept = {r.doc_id: (r.kept, r.reason) for r in qr.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string"), PIECES, RANKS).collect()}
    assert sum(k for i, (k, _) in kept.items() if i < 80) >= 78 and not kept[80][0] and not kept[81][0]
