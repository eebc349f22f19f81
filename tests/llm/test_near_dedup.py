import re

import pytest
import xxhash
from tidelog.llm import near_dedup as nd


def plain_simhash(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, radius=2):
    fps = sorted({f for _, f in rows})
    home = {f: f for f in fps}

    def find(f):
        while home[f] != f:
            f = home[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= radius:
                home[find(a)] = find(b)
    least = {}
    for d, f in rows:
        if d is not None:
            least[find(f)] = min(least.get(find(f), d), d)
    return sorted(((d is None, d, f, least.get(find(f))) for d, f in rows), key=str)


def got(df):
    return sorted(((r.doc_id is None, r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in df.collect()), key=str)


def test_whole_table(docs):
    rows = [(r.doc_id, plain_simhash(r.text)) for r in docs.collect()]
    assert got(nd.near_duplicates(docs)) == brute(rows)


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, plain_simhash(r.text)) for r in odd_docs.collect()]
    assert got(nd.near_duplicates(odd_docs)) == brute(rows)
    assert nd.near_duplicates(no_docs).count() == 0
    kept = sorted((r.doc_id for r in nd.one_of_each(odd_docs).collect()), key=str)
    firsts = {c for *_, c in brute(rows)}
    assert kept == sorted(firsts, key=str)
    assert nd.one_of_each(odd_docs).columns == odd_docs.columns


@pytest.mark.parametrize("radius", [0, 2, 4])
def test_balls_and_chains(spark, radius):
    chain = [0]
    for k in range(40):  # a chain with steps of two bits, a far value, and top bits
        chain.append(chain[-1] ^ (0b11 << (k % 31) * 2) if k % 3 else chain[-1] ^ (1 << 63) ^ (1 << (k % 7)))
    rows = [(1000 - i, f) for i, f in enumerate(chain)] + [(2000, 0x0F0F0F0F0F0F0F0F)]
    signed = [(d, f - (1 << 64) if f >> 63 else f) for d, f in rows]
    nodes = spark.createDataFrame(signed, "node long, fp long").groupBy("fp").agg({"node": "min"}).withColumnRenamed("min(node)", "node")
    links = [(r.hub, r.fp) for r in nd.ball_links(nodes, radius).collect()]
    mask = (1 << 64) - 1
    assert all(((a ^ b) & mask).bit_count() <= radius for a, b in links)
    ids = {r.fp: r.node for r in nodes.collect()}
    reached = {}
    if links:
        pairs = spark.createDataFrame([(ids[a], ids[b]) for a, b in links], "a long, b long")
        reached = {r.node: r.component for r in nd.components(pairs).collect()}
    assert sorted({(f & mask, reached.get(n, n)) for f, n in ids.items()}) == sorted({(f, c) for _, _, f, c in brute(rows, radius)})


def test_odd_radius_is_refused(spark):
    with pytest.raises(ValueError):
        nd.ball_links(spark.createDataFrame([(1, 1)], "node long, fp long"), 3)


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.fixture
def by_number(monkeypatch):
    """Texts that are numbers are their own fingerprints, so that any constellation can be made."""
    monkeypatch.setattr(nd, "fingerprints", lambda docs, i="doc_id", t="text": docs.selectExpr(f"{i} as doc_id", f"xxhash64({i}, {t}) as k1", f"xxhash64(1, {t}, {i}) as k2", f"cast({t} as long) as fp"))


def test_a_row_without_an_id_connects_others(spark, by_number):
    assert got(nd.near_duplicates(table(spark, [(1, "0"), (None, "3"), (3, "15")]))) == [(False, 1, 0, 1), (False, 3, 15, 1), (True, None, 3, 1)]


def test_random_rows_with_null_and_repeated_ids(spark, by_number):
    import random

    rng = random.Random(5)
    for _ in range(4):
        rows = [(rng.choice([None, None, *range(12)]), sum(1 << b for b in rng.sample(range(16), rng.randrange(4)))) for _ in range(40)]
        assert got(nd.near_duplicates(table(spark, [(i, str(f)) for i, f in rows]))) == brute(rows)


def test_rows_are_chosen_and_not_ids(spark, by_number):
    rows = [(5, "0"), (5, "255"), (4, "254"), (5, "0"), (None, "65535"), (None, "65535"), (None, "4294967295"), (7, "1")]
    kept = sorted((r.doc_id is None, r.doc_id, r.text, r.k1) for r in nd.one_of_each(table(spark, rows).withColumn("k1", nd.F.lit("own"))).collect())
    assert kept == [(False, 4, "254", "own"), (False, 5, "0", "own"), (True, None, "4294967295", "own"), (True, None, "65535", "own")]
