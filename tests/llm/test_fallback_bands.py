"""Byte fallback is judged by the group's own quartiles; a rare group is not rejected for being rare."""

import numpy as np
import public_tokenizers as P
from tidelog.llm import quality_rules as qr

PIECES, RANKS = P.path("piece_bpe_32k.model"), P.path("byte_bpe_50k.tiktoken")
ENGLISH = "the people of this small town went to market every morning before school began and came home late with bread cheese and stories".split()
AMHARIC = "ሰላም ለዓለም የኢትዮጵያ ህዝብ በየቀኑ ጠዋት ወደ ገበያ ይሄዳል ልጆች ትምህርት ቤት ይማራሉ መጽሐፍ ያነባሉ ቡና ዳቦ ውሃ ከተማ አዲስ አበባ".split()


def texts(words, n, seed):
    rng = np.random.default_rng(seed)
    return [" ".join(rng.choice(words, 200)) for _ in range(n)]


def judged(spark, *groups):
    rows = [(i, t, lang) for i, (t, lang) in enumerate((t, lang) for lang, found in groups for t in found)]
    return qr.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string"), PIECES, RANKS).collect()


def test_a_poorly_covered_language_is_kept_and_english_fallback_is_not(spark):
    mixed = texts(ENGLISH, 1, 3)[0].split()
    for k in range(0, 200, 27):
        mixed[k] = AMHARIC[0]
    rows = judged(spark, ("en", [*texts(ENGLISH, 80, 1), " ".join(mixed)]), ("am", texts(AMHARIC, 40, 2)))
    odd = next(r for r in rows if r.doc_id == 80)
    assert 0.1 < odd.fallback < 0.2 and not odd.kept
    amharic = [r for r in rows if r.group == "am"]
    assert min(r.fallback for r in amharic) > 0.5 and sum(r.kept for r in amharic) >= 39


def test_a_group_below_the_least_size_is_not_rejected_for_being_rare(spark):
    rows = judged(spark, ("en", texts(ENGLISH, 80, 1)), ("am", texts(AMHARIC, qr.LEAST - 1, 2)))
    assert all(r.kept for r in rows if r.group == "am")
