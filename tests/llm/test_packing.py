import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tidelog.llm import packing
from tokenizers import Tokenizer

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


SLOW = Tokenizer.from_file(VOCABULARY)


def plain_ids(text):
    return [*SLOW.encode(text or "", add_special_tokens=False).ids, 0]


def check(docs, rows):
    want, have = Counter(), Counter()
    for d in docs.collect():
        ids = np.array(plain_ids(d.text), dtype="<u4")
        first = len(ids) % 2048 or min(len(ids), 2048)
        edges = [0, *range(first, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            want[(d.doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    by = defaultdict(list)
    for r in rows:
        have[(r.doc_id, r.piece, r.start, r.length, r.ids_crc32)] += 1
        by[r.sequence_id].append((r.offset, r.length))
    assert want == have
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    return len(by), -(-sum(k[3] * n for k, n in have.items()) // 2048)


def test_whole_table(docs):
    used, least = check(docs, packing.pack(docs, VOCABULARY).collect())
    assert used <= least * 1.03 + 1


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs, packing.pack(odd_docs, VOCABULARY).collect())
    assert packing.pack(no_docs, VOCABULARY).count() == 0


def test_sequences_hold_the_ids(odd_docs):
    total = sum(len(plain_ids(r.text)) for r in odd_docs.collect())
    found = packing.sequences(odd_docs, VOCABULARY).collect()
    assert sum(len(r.ids) for r in found) == total and max(len(r.ids) for r in found) <= 2048


def test_both_encoders_agree():
    encode, slow = packing.encoder(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    assert encode("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]
    for text in ["", " a  b\n\n c\t\td  ", "it's we'LL 12 345,678!!! <|endoftext|> x", "ça ne l'été — “oui” ﬁ 数 \r\n\x0b 　x", "a" * 5000, "!?" * 3000, "\n " * 500]:
        assert encode(text).tolist() == slow.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=30))
def test_rounds_place_every_rank_once(counts):
    seen, fill = defaultdict(list), defaultdict(list)
    for length, first, end, sequence, offset in packing.plan_rounds(counts, 64):
        for rank in range(first, end):
            seen[length].append(rank)
            fill[sequence + rank - first].append((offset, length))
    assert {n: sorted(r) for n, r in seen.items()} == {n: list(range(c)) for n, c in counts.items()}
    for spans in fill.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64


def test_hot_lengths_are_ranked_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 7)
    docs = spark.createDataFrame([(i, "same text" if i % 3 else f"text {i}") for i in range(100)], "doc_id long, text string")
    check(docs, packing.pack(docs, VOCABULARY).collect())


def test_every_length_hot(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 1)
    docs = spark.range(4096).selectExpr("id as doc_id", "repeat(' a', cast(id % 2048 as int)) as text", "id as length", "'b' as block", "1 as rank", "2 as salt", "'k' as before")
    found = packing.pack(docs, VOCABULARY).collect()
    assert {r.length for r in found} == set(range(1, 2049))
    check(docs, found)


def test_equal_rows_share_the_blocks_of_a_length(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 5)
    docs = spark.createDataFrame([(1, "same")] * 60 + [(None, None)] * 30, "doc_id long, text string")
    check(docs, packing.pack(docs, VOCABULARY).collect())


def test_ten_million_characters(spark):
    docs = spark.range(1).selectExpr("id as doc_id", "repeat('word ', 2000000) as text")
    used, least = check(docs, packing.pack(docs, VOCABULARY).collect())
    assert used == least
