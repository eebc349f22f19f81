import hashlib
import math
from collections import Counter

from tidelog.llm import mixing


def brute(rows, weights, size=None):
    chars = Counter()
    for _, t, _, s, *_ in rows:
        chars[s] += len(t or "")
    weight = {s: weights.get(s, 1.0) for s in chars}
    wanted, heavy, out = size or sum(chars.values()), sum(weight.values()), Counter()
    for d, _, _, s, *_ in rows:
        rate = weight[s] * wanted / heavy / chars[s] if chars[s] else 1.0
        u = int(hashlib.md5(f"mix-1:{'' if d is None else d}".encode()).hexdigest()[:13], 16) / 2**52
        p = c = math.exp(-rate)
        k = 0
        while c <= u and k < 3000:
            k += 1
            p *= rate / k
            c += p
        out.update([(d, s, k)])
    return out


def counts(rows, mixed):
    by = Counter((r.doc_id, r.source, r.n_copies) for r in mixed if r.copy == 0)
    assert sum(n * k for (*_, k), n in by.items()) == len(mixed)
    return by


def test_whole_table_and_weights(docs):
    rows, weights = [tuple(r) for r in docs.collect()], {"src0": 4.0, "src1": 2.0}
    want = Counter({k: n for k, n in brute(rows, weights).items() if k[2]})
    assert counts(rows, mixing.mix(docs, weights).collect()) == want


def test_the_mixture_meets_its_targets(spark):
    docs = spark.range(20000).selectExpr("id as doc_id", "repeat('x', 10) as text", "if(id % 3 = 0, 'hot', concat('s', id % 10)) as source")
    got = Counter(r.source for r in mixing.mix(docs, {"hot": 2.0}).select("source").collect())
    total = sum(got.values())
    assert abs(total - 20000) < 600
    assert abs(got["hot"] / total - 2 / 12) < 0.01 and all(abs(got[f"s{k}"] / total - 1 / 12) < 0.01 for k in range(10))


def test_odd_rows(odd_docs, no_docs, monkeypatch):
    rows = [tuple(r)[:5] for r in odd_docs.collect()]
    want = Counter({k: n for k, n in brute(rows, {"a": 3.0}, 400).items() if k[2]})
    for few in (2000, 0):  # broadcast and salted
        monkeypatch.setattr(mixing, "FEW_SOURCES", few)
        assert counts(rows, mixing.mix(odd_docs, {"a": 3.0}, 400).collect()) == want
        assert mixing.mix(no_docs).count() == 0


def test_large_means_are_drawn_in_parts(spark):
    docs = spark.createDataFrame([(i, "x") for i in range(40)], "doc_id long, text string").selectExpr("*", "'s' as source")
    n = [r.n_copies for r in mixing.mix(docs, size=40 * 2000.0).where("copy = 0").collect()]
    assert len(n) == 40 and abs(sum(n) / 40 - 2000) < 50


def test_the_draw_does_not_depend_on_partitions(docs):
    one = sorted((r.doc_id, r.copy) for r in mixing.mix(docs.repartition(1)).collect())
    assert one == sorted((r.doc_id, r.copy) for r in mixing.mix(docs.repartition(13)).collect())
