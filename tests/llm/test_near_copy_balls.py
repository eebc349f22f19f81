"""The near-duplicate stage finds its candidates by ball hashing of SimHash fingerprints, as op10 does."""

import random

import numpy as np
import pyarrow as pa
from tidelog.llm import near_dedup as nd

LOW = (1 << nd.SIM_BITS) - 1


def some_set(rng, n):
    return np.unique(np.array([rng.getrandbits(64) for _ in range(n)], dtype="<u8"))


def pair_at_least(rng, common, one, other):
    """Two sets with so many hashes in common and of their own."""
    h = [rng.getrandbits(64) for _ in range(common + one + other)]
    make = lambda part: np.unique(np.array(part, dtype="<u8"))
    return make(h[: common + one]), make(h[:common] + h[common + one :])


def of(hashes):
    sim = nd.wide_simhash(hashes)
    return sim, nd.prints(hashes, sim)


def bits(a, b):
    return sum((int(x) ^ int(y)).bit_count() for x, y in zip(a, b))


def meet(p, q):
    return p >> nd.SIM_BITS == q >> nd.SIM_BITS and (p ^ q).bit_count() <= nd.RADIUS


def test_the_fingerprint_is_the_majority_of_the_hashes():
    rng = random.Random(1)
    for n in (1, 2, 5, 40, 301):
        h = some_set(rng, n)
        sim, found = of(h)
        votes = [sum(int(x) >> b & 1 for x in h) for b in range(64)]
        assert int(sim[0]) == sum(1 << b for b in range(64) if 2 * votes[b] > n)
        whole = int(sim[0]) | int(sim[1]) << 64 | int(sim[2]) << 128
        assert [p & LOW for p in found] == [whole >> nd.SIM_BITS * k & LOW for k in range(nd.TABLES)]
    assert nd.prints(np.empty(0, dtype="<u8"), nd.wide_simhash(np.empty(0, dtype="<u8"))) == []


def test_pairs_at_the_limit_meet_and_unlike_ones_do_not():
    rng = random.Random(2)
    for common, one, other, least in ((80, 10, 10, 0.998), (80, 20, 0, 0.998), (8, 1, 1, 0.995), (4, 1, 0, 0.995), (20, 40, 40, 0)):
        found = 0
        for _ in range(1000):
            (s, p), (t, q) = map(of, pair_at_least(rng, common, one, other))
            found += bits(s, t) <= nd.WIDE and any(map(meet, p, q))
        assert found >= 1000 * least and (least or found < 30)


def test_buckets_are_the_balls_on_which_sets_meet(spark):
    rng = random.Random(3)
    fps = [rng.randrange(-3, 3) << nd.SIM_BITS | sum(1 << b for b in rng.sample(range(nd.SIM_BITS), rng.randrange(5))) for _ in range(120)]
    fps += [7 << nd.SIM_BITS, 8 << nd.SIM_BITS | 3, 8 << nd.SIM_BITS | 3]  # alone; met by its like only
    rows = nd._buckets(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()
    inside = {}
    for r in rows:
        inside.setdefault(r.band, set()).add(r.fp)
    assert len(rows) == sum(map(len, inside.values())) and all(len(v) <= nd.SIM_BITS + 1 for v in inside.values())
    together = {(a, b) for v in inside.values() for a in v for b in v if a < b}
    distinct = sorted(set(fps))
    assert together == {(a, b) for a in distinct for b in distinct if a < b and meet(a, b)}
    assert {f for f in distinct if f in inside and f in inside[f]} >= {f for f in distinct if fps.count(f) > 1}
    assert not any(7 << nd.SIM_BITS in v for v in inside.values())


def test_members_with_a_partner_by_brute_force():
    rng = random.Random(4)
    word = lambda: rng.getrandbits(64) - (1 << 63)
    base = [word() for _ in range(3)]
    for blocks in (1, 2):
        rows = []
        for k in range(400):  # around the variant 5, some farther
            sims = [s ^ sum(1 << b for b in rng.sample(range(63), rng.randrange(15))) for s in base]
            rows.append((5, k, 5 ^ (1 << rng.randrange(3)) ^ (1 << rng.randrange(3)) if k % 2 else 5 ^ 1 << rng.randrange(nd.SIM_BITS), rng.randrange(80, 120), *sims, rng.randrange(30), rng.randrange(blocks), 1))
        names = ["band", "key", "fp", "size", "s0", "s1", "s2", "label", "block", "parts"]
        found = nd.with_partner(pa.table([pa.array(c, pa.int64()) for c in zip(*rows)], names=names))

        def fits(x, y):
            low = (x[2] ^ y[2]) & -(x[2] ^ y[2])
            near = sum(((a ^ b) & (1 << 64) - 1).bit_count() for a, b in zip(x[4:7], y[4:7])) <= nd.WIDE
            here = min(x[2] ^ low, y[2] ^ low) == 5
            return near and here and x[7] != y[7] and 5 * min(x[3], y[3]) >= 4 * max(x[3], y[3]) and (blocks == 1 or x[8] != y[8])

        want = [x[1] for x in rows if any(fits(x, y) for y in rows)]
        assert found.column("key").to_pylist() == want and 0 < len(want) < 400


def test_texts_without_an_equal_fingerprint_are_joined(spark):
    rng = random.Random(6)
    pairs = []
    while len(pairs) < 5:
        words = [f"w{rng.randrange(10**6)}" for _ in range(120)]
        other = list(words)
        for k in rng.sample(range(120), 2):
            other[k] = f"x{rng.randrange(10**6)}"
        a, b = " ".join(words), " ".join(other)
        (_, p), (_, q) = of(nd.shingle_set(a.encode())), of(nd.shingle_set(b.encode()))
        if not set(p) & set(q):  # only the balls around their fingerprints meet
            pairs.append((a, b))
    df = spark.createDataFrame([(2 * k + i, t) for k, ab in enumerate(pairs) for i, t in enumerate(ab)], "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id) for r in nd.near_copies(df).collect()) == [(d, d - d % 2) for d in range(10)]


def test_small_cells_find_the_same(spark, monkeypatch):
    rng = random.Random(8)
    base = [f"w{k}" for k in range(100)]
    rows = []
    for i in range(60):
        words = list(base)
        for k in rng.sample(range(100), 3):
            words[k] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = lambda: sorted((r.doc_id, r.component_id) for r in nd.near_copies(df).collect())
    want = got()
    for name, value in (("SIDE", 5), ("CELL", 1_000), ("BLOCK", 7)):
        monkeypatch.setattr(nd, name, value)
    assert got() == want and 1 < len({c for _, c in want})
