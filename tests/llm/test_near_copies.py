"""The near-duplicate stage links texts by 5-word Jaccard similarity of 0.8 or more."""

import random

from tidelog.llm import near_dedup as nd


def shingles(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    home = list(range(len(rows)))

    def find(x):
        while home[x] != x:
            x = home[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                home[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def got(df):
    return sorted(((r.doc_id, r.component_id) for r in nd.near_copies(df).collect()), key=str)


def test_whole_tables_by_brute_force(docs, odd_docs, no_docs):
    for df in (docs, odd_docs):
        assert got(df) == brute([(r.doc_id, r.text) for r in df.collect()])
    assert nd.near_copies(no_docs).count() == 0
    assert nd.one_of_near_copies(odd_docs).columns == odd_docs.columns


def test_edited_copies_far_apart_in_bits(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    rows, at = [(0, " ".join(base))], 1
    for _ in range(40):  # each has four words of 300 replaced: Jaccard with the base about 0.87
        words = list(base)
        for k in rng.sample(range(300), 4):
            words[k] = f"x{rng.randrange(10**6)}"
        rows.append((at, " ".join(words)))
        at += 1
    rows.append((at, " ".join(f"v{rng.randrange(10**6)}" for _ in range(300))))
    assert max((nd.simhash(rows[0][1].encode()) ^ nd.simhash(t.encode())).bit_count() for _, t in rows[1:41]) > 2
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df) == brute(rows) and sorted(r.doc_id for r in nd.one_of_near_copies(df).collect()) == [0, at]


def shared_template(seed, members, copies):
    """Texts that share a template and are mostly below 0.8 to each other, and a few near copies of some."""
    rng = random.Random(seed)
    base = [f"w{k}" for k in range(200)]

    def changed(words, spots):
        words = list(words)
        for k in spots:
            words[k] = f"x{rng.randrange(10**6)}"
        return words

    texts = [changed(base, rng.sample(range(200), 3)) for _ in range(members)]
    texts += [changed(texts[rng.randrange(members)], rng.sample(range(200), 4)) for _ in range(copies)]
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def parted(pairs):
    """Classes as sets of ids."""
    classes = {}
    for d, c in pairs:
        classes.setdefault(c, set()).add(d)
    return sorted(map(sorted, classes.values()))


def test_a_large_bucket_of_mostly_unlike_texts_loses_no_link(spark, monkeypatch):
    rows = shared_template(7, 120, 60)
    want = brute(rows)
    assert 1 < len(parted(want)) < 120  # some are joined, most texts are not
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for cell, block in ((nd.CELL, nd.BLOCK), (2_000, 10)):  # one cell a bucket, then many of few members
        monkeypatch.setattr(nd, "CELL", cell)
        monkeypatch.setattr(nd, "BLOCK", block)
        assert got(df) == want


def test_cells_join_what_all_pairs_join():
    for seed, blocks in ((1, 1), (2, 1), (3, 2)):
        sets = [nd.shingle_set(t.encode()).view("<i8") for _, t in shared_template(seed, 50, 25)]
        rng = random.Random(seed)
        labels, places = nd.np.array([rng.randrange(60) - 30 for _ in sets]), nd.np.array([rng.randrange(blocks) for _ in sets])
        home = {int(x): int(x) for x in labels}

        def find(x):
            while home[x] != x:
                x = home[x]
            return x

        for i, a in enumerate(sets):
            for j in range(i):
                shared = len(nd.np.intersect1d(a, sets[j]))
                if 9 * shared >= 4 * (len(a) + len(sets[j])) and (blocks == 1 or places[i] != places[j]):
                    home[find(int(labels[i]))] = find(int(labels[j]))
        found = nd.cell_links(sets, labels, places)
        assert len(found) == len(home) - len({find(x) for x in home})  # a forest: each link joins two classes
        ours = {x: x for x in home}
        for a, b in found:
            a, b = (next(c for c in ours if c == x) for x in (a, b))
            old, new = ours[a], ours[b]
            ours = {k: new if v == old else v for k, v in ours.items()}
        assert parted(ours.items()) == parted((x, find(x)) for x in home)
