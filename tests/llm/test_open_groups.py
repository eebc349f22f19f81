"""Sets of groups that stay open: what is dealt to cells follows the size of a group, and no link is lost."""

import random

import numpy as np
import pyarrow as pa
from tidelog.llm import near_dedup as nd

from test_near_copies import brute


def edited(rng, base, spots):
    words = list(base)
    for k in spots:
        words[k] = f"x{rng.randrange(10**9)}"
    return words


def group(seed, members, pairs=0):
    """A text and members with edits all along it, below 0.8 to it and to each other, and near copies of some of these."""
    rng = random.Random(seed)
    base = [f"w{k}" for k in range(200)]
    texts = [base] + [edited(rng, base, range(10 + rng.randrange(5), 195, 36)) for _ in range(members)]
    texts += [edited(rng, texts[1 + k], [rng.randrange(200)]) for k in range(pairs)]
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def dealt(spark, monkeypatch, rows):
    """(rows that each stage dealt to cells, ids with their component)."""
    counts, cells = [], nd._cells

    def counted(members, blocks, salt):
        out = cells(members, blocks, salt)
        counts.append(out.count())
        return out

    with monkeypatch.context() as m:
        m.setattr(nd, "SIDE", 10)
        m.setattr(nd, "_cells", counted)
        found = nd.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return counts, sorted(((r.doc_id, r.component_id) for r in found), key=str)


def test_what_is_dealt_does_not_grow_with_the_square_of_a_group(spark, monkeypatch):
    rows = group(1, 200, 20)  # blocks of 10 members
    counts, found = dealt(spark, monkeypatch, rows)
    assert found == brute(rows) and len({c for _, c in found}) == 201
    assert sum(counts) <= 2 * len(rows)


def test_a_band_of_one_component_and_a_few_costs_its_size(spark):
    at, few = 4_000, 7
    members = spark.range(at + few).selectExpr("id % 2 AS band", "id AS key", f"if(id < {at}, -1L, id) AS label", "20L AS parts")
    rows = [r.asDict() for r in nd._cells(members, "parts", 3).collect()]
    assert len(rows) < at + few * 25
    cells, labels = {}, {}
    for r in rows:
        cells.setdefault((r["band"], r["low"], r["high"]), []).append(r)
        labels[r["key"]] = r["label"]
    met = set()
    for (_, low, high), inside in cells.items():
        assert {r["block"] for r in inside} <= {low, high} and len(inside) < at // 8
        met |= {(a["key"], b["key"]) for a in inside for b in inside if a["label"] != b["label"] and (low == high or a["block"] != b["block"])}
    assert met == {(a, b) for a in labels for b in labels if labels[a] != labels[b] and a % 2 == b % 2}


def test_pairs_at_the_limit_share_a_band_and_stay(spark):
    rng = random.Random(5)
    hashes = lambda n: [rng.getrandbits(64) - (1 << 63) for _ in range(n)]
    sets = []
    for common, one, other in ((80, 10, 10), (80, 20, 0), (8, 1, 1), (4, 1, 0), (4, 0, 1), (36, 9, 0), (40, 5, 5), (1, 0, 0)):
        shared = hashes(common)
        both = [shared + hashes(one), shared + hashes(other)]
        sets += both + [rng.sample(shared, common // 2) + hashes(common) for _ in range(6)]  # make some shingles common
    rows = [(k, sorted(set(h))) for k, h in enumerate(sets)]
    words = [np.array(h, dtype="<i8").view("<u8") for _, h in rows]
    sims = [[int(x) for x in nd.wide_simhash(w).view("<i8")] for w in words]
    found = spark.createDataFrame(rows, "key long, hashes array<long>")
    among = spark.createDataFrame([(k, k, len(h), *sims[k]) for k, h in rows], "key long, label long, size long, s0 long, s1 long, s2 long")
    stay = {}
    for r in nd._open_members(among, found).collect():
        stay.setdefault(r.band, set()).add(r.key)
    bits = lambda a, b: sum(((x ^ y) & (1 << 64) - 1).bit_count() for x, y in zip(sims[a], sims[b]))
    pairs = 0
    for a, x in rows:
        for b, y in rows[:a]:
            shared = len(set(x) & set(y))
            if 9 * shared >= 4 * (len(x) + len(y)) and bits(a, b) <= nd.WIDE:
                pairs += 1
                assert any({a, b} <= keys for keys in stay.values())
    assert pairs >= 6


def test_a_partner_has_enough_from_the_band_on():
    names = ["band", "key", "size", "s0", "s1", "s2", "label", "block", "parts", "rank"]
    rows = [(1, 0, 100, 0, 0, 0, 0, 0, 1, 11), (1, 1, 100, 0, 0, 0, 1, 0, 1, 11), (1, 2, 100, 0, 0, 0, 2, 0, 1, 12), (1, 3, 80, 0, 0, 0, 3, 0, 1, 0), (1, 4, 79, 0, 0, 0, 4, 0, 1, 0)]
    kept = lambda part: nd.with_partner(pa.table([pa.array(c, pa.int64()) for c in zip(*part)], names=names)).column("key").to_pylist()
    assert kept(rows[:3]) == [0, 1]  # 89 of 100 and 100 are 0.8, 88 are not
    assert kept([rows[2], rows[3]]) == [2, 3] and kept([rows[2], rows[4]]) == []
