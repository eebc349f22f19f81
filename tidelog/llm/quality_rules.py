"""Quality rules on tokeniser fertility.

Two public vocabularies measure a text: characters per token (byte-level BPE, and pieces), share
of byte-fallback tokens (pieces), and token entropy against its maximum. What is usual differs by
language and script, so the bands are the far fences of each group's own quartiles over all
documents; a document outside any band is rejected. Byte fallback has an upper fence only: a
vocabulary may cover a language poorly, and much fallback is then usual there.

Words are encoded one by one, each once for a cache: no vocabulary joins letters across white space.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, in_small_batches, once_per_process, text_of

MIN_WORDS, MAX_REPEAT = 50, 50
#: Fences: so many quartile distances below and above the quartiles, and at least this share of the
#: median. Rare forms cost tokens, so junk lies low; the upper fence is for degenerate text only.
BELOW, ABOVE, SLACK = 2.5, 6.0, 0.03
#: The least distance of the fallback fence from its quartile, in share: most quartiles are 0.
FALLBACK_SLACK = 0.1
#: Groups with fewer documents than this are judged by the wider of their own bands and those of all.
LEAST = 30
#: Bands of up to so many groups (60 bytes each) are sent to every executor; more are shuffled.
FEW_GROUPS = 10_000
MEASURES = ("chars_per_piece", "chars_per_byte_token", "entropy")
SYMBOLS = "#*$%&|<>"
_KNOWN = 300_000
_SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


class Fertility:
    """Piece ids and byte-level token counts of words, each word encoded once and kept."""

    def __init__(self, pieces: str, ranks: str):
        import base64

        import public_tokenizers
        import sentencepiece
        import tiktoken

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.byte_level = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.fallback = np.array([self.pieces.is_byte(k) for k in range(self.pieces.vocab_size())])
        self.opens = np.zeros(max(table.values()) + 1, dtype=bool)
        self.opens[[k for token, k in table.items() if token[:1] == b" "]] = True
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.sizes, self.starts, self.byte_tokens = (np.empty(0, dtype=np.int64) for _ in range(4))

    def add(self, words: set[bytes]) -> None:
        """Afterwards all ``words`` are known; others may be forgotten."""
        fresh = [w for w in words if w not in self.known]
        if len(self.known) + len(fresh) > _KNOWN:
            self.forget()
            fresh = list(words)
        if not fresh:
            return
        texts = [w.decode() for w in fresh]
        found = self.pieces.encode(texts, num_threads=1)
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        # in one run: a token that begins with a space begins a word, as no word has a space
        tokens = np.array(self.byte_level.encode_ordinary(" " + " ".join(texts)), dtype=np.int64)
        if self.opens[tokens].sum() == len(fresh):
            counts = np.bincount(np.cumsum(self.opens[tokens]) - 1, minlength=len(fresh))
        else:  # words of other white space only may run together
            counts = np.array([len(self.byte_level.encode_ordinary(" " + t)) for t in texts])
        self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh))))
        self.starts = np.concatenate((self.starts, len(self.ids) + np.cumsum(sizes) - sizes))
        self.ids = np.concatenate((self.ids, np.fromiter(chain.from_iterable(found), dtype=np.int64, count=int(sizes.sum()))))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.byte_tokens = np.concatenate((self.byte_tokens, counts))

    def measure(self, words: list[bytes], chars: int) -> tuple:
        """Of known words: characters per piece, per byte-level token, entropy as a share of its maximum, fallback share."""
        which = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
        sizes = self.sizes[which]
        ends = np.cumsum(sizes)
        n = int(ends[-1])
        if not n:  # a vocabulary may drop every character
            return (None,) * 4
        ids = self.ids[np.repeat(self.starts[which] - (ends - sizes), sizes) + np.arange(n)]
        counts = np.bincount(ids)
        counts = counts[counts > 0]
        entropy = math.log(n) - float(counts @ np.log(counts)) / n
        return chars / n, chars / int(self.byte_tokens[which].sum()), entropy / math.log(n) if n > 1 else 1.0, float(self.fallback[ids].mean())


def base(text: str) -> tuple[list[bytes], int, int, int, int]:
    """Words, and the counts word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    raw = text.encode()
    words = raw.split()  # bytes split at ASCII white space only
    lines = [x for x in raw.split(b"\n") if x.split()] if b"\n" in raw else []
    repeats = 0
    if len(words) >= 3:
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
        size = len(number)
        pairs = ids[:-2] * size + ids[1:-1]
        if size > 2_000_000:  # a triple would not fit into 63 bits
            pairs = np.unique(pairs, return_inverse=True)[1]
        windows, counts = np.unique(pairs * size + ids[2:], return_inverse=True, return_counts=True)[1:]
        at = np.flatnonzero(counts[windows] > 1)
        inside = np.zeros(len(words), dtype=bool)
        for k in range(3):
            inside[at + k] = True
        repeats = int(inside.sum())
    return words, len(text) - sum(map(text.count, _SPACES)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeats


def measures(docs: DataFrame, pieces: str, ranks: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, group, the base counts, and the measures (null without words).

    group: the language, or where it is null the script of most letters (latin or other).
    """
    schema = "doc_id long, group string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, chars_per_piece double, chars_per_byte_token double, entropy double, fallback double"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fertility = once_per_process(("fertility", pieces, ranks), lambda: Fertility(pieces, ranks))
        for batch in (b.slice(k, 64) for b in batches for k in range(0, b.num_rows, 64)):
            texts = batch.column(2).to_pylist()
            bases, rows = [base(t) for t in texts], []
            fertility.add(set().union(*(b[0] for b in bases)))
            for doc_id, lang, t, (words, chars, *counts) in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, bases):
                group = lang if lang is not None else "latin" if 2 * sum(c < "ɐ" for c in t if c.isalpha()) >= sum(map(str.isalpha, t)) else "other"
                rows.append((doc_id, group, len(words), chars, *counts, *(fertility.measure(words, chars) if words else (None,) * 4)))
            columns = list(zip(*rows)) if rows else [[]] * 11
            kinds = [pa.int64(), pa.string(), *[pa.int64()] * 5, *[pa.float64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in schema.split(", ")])

    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    return in_small_batches(docs).select(F.col("doc_id").cast("long"), lang.alias("lang"), text_of(F.col("text")).alias("text")).mapInArrow(work, schema)


def _fences() -> list:
    out = []
    for m in MEASURES:
        q = F.percentile_approx(F.when(~F.col("base_failed"), F.col(m)), [0.25, 0.5, 0.75], 2000)
        wide = lambda n: F.greatest(n * (q[2] - q[0]), SLACK * q[1])
        out += [(q[0] - wide(BELOW)).alias(f"{m}_low"), (q[2] + wide(ABOVE)).alias(f"{m}_high")]
    q = F.percentile_approx(F.when(~F.col("base_failed"), F.col("fallback")), [0.25, 0.75], 2000)
    out.append((q[1] + F.greatest(ABOVE * (q[1] - q[0]), F.lit(FALLBACK_SLACK))).alias("fallback_high"))
    return [*out, F.sum(F.when(~F.col("base_failed"), 1).otherwise(0)).alias("judged")]


def judge(docs: DataFrame, pieces: str, ranks: str) -> DataFrame:
    """The measures with base_failed, kept, and the reason of a rejection (null if kept).

    base_failed: fewer than 50 words, or more than half of the words in repeated 3-word windows.
    Null and empty texts have no words and fail. Repeated rows are judged each for itself.
    """
    found = durable(measures(docs, pieces, ranks).withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))))
    own, every = found.groupBy("group").agg(*_fences()), found.agg(*_fences())
    names = [*[f"{m}_{side}" for m in MEASURES for side in ("low", "high")], "fallback_high"]
    bands = own.crossJoin(F.broadcast(every.select([F.col(n).alias(f"all_{n}") for n in names])))  # one row of bands of all
    wider = lambda n: (F.least if n.endswith("_low") else F.greatest)(n, f"all_{n}")
    bands = durable(bands.select("group", *[F.when(F.col("judged") >= LEAST, F.col(n)).otherwise(wider(n)).alias(n) for n in names]))
    bands = F.broadcast(bands) if bands.count() <= FEW_GROUPS else bands
    reason = F.when(F.col("base_failed"), F.lit("base"))
    for m in MEASURES:
        reason = reason.when(F.col(m) < F.col(f"{m}_low"), F.lit(f"{m} low")).when(F.col(m) > F.col(f"{m}_high"), F.lit(f"{m} high"))
    reason = reason.when(F.col("fallback") > F.col("fallback_high"), F.lit("byte fallback"))
    return found.join(bands, "group").withColumn("reason", reason).withColumn("kept", F.col("reason").isNull()).drop(*names)
