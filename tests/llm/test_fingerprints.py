import hashlib
import re

import pytest
import xxhash
from tidelog.llm import fingerprints as fp


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [(xxhash.xxh64_intdigest(p.encode(), 42), len(p.encode())) for p in parts]
    total = sum(w for _, w in hashes)
    return sum(1 << b for b in range(64) if 2 * sum(w for h, w in hashes if h >> b & 1) > total)


def brute(docs):
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    prints, out = [plain(t) for _, t in rows], []
    for k, (d, t) in enumerate(rows):
        nxt, q = rows[(k + 1) % len(rows)][1], len(t) // 4
        edited = t[: len(t) - q] + nxt[:q]
        a, b, c = prints[k], plain(edited), prints[(k + 1) % len(rows)]
        near = None if d is None or d % 50 else sum((a ^ x).bit_count() <= 3 for x in prints) - 1
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), f"{a:016x}", f"{b:016x}", 1 - (a ^ b).bit_count() / 64, 1 - (a ^ c).bit_count() / 64, near))
    return sorted(out, key=str)


@pytest.mark.parametrize("bucket", [2000, 7])
def test_whole_table(docs, monkeypatch, bucket):
    monkeypatch.setattr(fp, "BUCKET", bucket)
    assert sorted((tuple(r) for r in fp.edited_fingerprints(docs).collect()), key=str) == brute(docs)


@pytest.mark.parametrize("bucket", [2000, 1])
def test_odd_rows(odd_docs, no_docs, monkeypatch, bucket):
    monkeypatch.setattr(fp, "BUCKET", bucket)
    assert sorted((tuple(r) for r in fp.edited_fingerprints(odd_docs).collect()), key=str) == brute(odd_docs)
    assert fp.edited_fingerprints(no_docs).count() == 0


def test_one_document_is_its_own_next(spark):
    one = spark.createDataFrame([(5, "a b c d e f g h")], "doc_id long, text string")
    assert sorted((tuple(r) for r in fp.edited_fingerprints(one).collect()), key=str) == brute(one)


def test_general_interface(spark):
    texts = spark.createDataFrame([("k", "A b c d"), ("l", "")], "k string, text string")
    assert {r.k: r.fp & (1 << 64) - 1 for r in fp.simhash(texts, ["k"]).collect()} == {"k": plain("A b c d"), "l": 0}
    values = [0, 1, 3, 7, 15, 1 << 62, (1 << 62) | 1]
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    want = {(a, b, (a ^ b).bit_count()) for a in values for b in values if (a ^ b).bit_count() <= 2}
    assert {tuple(r) for r in fp.within(df, df, 2).collect()} == want
    with pytest.raises(ValueError):
        fp.within(df, df, 5)
