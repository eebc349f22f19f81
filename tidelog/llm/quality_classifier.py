"""Quality classifier on supervised subword embeddings.

A document is the average of learned vectors of its hashed words and character n-grams, plus, each
kind averaged by itself, those of its word pairs and of its lines (again or new: whether a unit
repeats is no part of any n-gram). A softmax layer reads the sum, and vectors and layer are trained
together by stochastic gradient descent in numpy, one document a step. As the layer is linear in
the averages, scoring needs one number for each bucket and, cached, one for each word.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, durable, held_out, in_small_batches, labelled_sample, text_of

THRESHOLD = 0.7
BUCKETS, DIM, GRAMS = 1 << 17, 16, (3, 4, 5)
#: Labelled rows learned from, at most about so many a class; passes over them.
#: A small sample is passed over more often, up to ten times as often, for as many steps.
PER_CLASS, EPOCHS, STEPS, RATE = 2_000, 5, 12_000, 0.5
#: Most features (distinct buckets over all documents) learned from, 8 bytes each on the driver: a
#: sample with more is thinned further by a hash of the id.
FEATURES = 16_000_000
#: Pattern features: pairs again, new; lines again, new.
PATTERNS = 4
_KNOWN = 300_000


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words' features, one after the other, and how many each word has.

    A word's features are itself and the 3- to 5-grams of its code points between ``<`` and ``>``.
    """
    marked = [f"<{w}>" for w in words]
    points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
    owner = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(points))  # code points from here to the word's end
    own = [np.arange(len(words))]
    buckets = [np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), dtype=np.uint64, count=len(words))]
    rolled = points.copy()
    for n in range(2, max(GRAMS) + 1):
        if len(points) < n:
            break
        rolled = rolled[:-1] * np.uint64(0x9E3779B97F4A7C15) + points[n - 1 :]
        if n in GRAMS:
            whole = np.flatnonzero(left[: len(rolled)] >= n)
            own.append(owner[whole])
            buckets.append((rolled[whole] * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32))
    who, what = np.concatenate(own), np.concatenate(buckets) % np.uint64(BUCKETS)
    order = np.argsort(who, kind="stable")
    return what[order].astype(np.int64), np.bincount(who, minlength=len(words))


def patterns(text: str, words: list[str]) -> np.ndarray:
    """Shares of word pairs again and new, and of lines again and new; the shares of a kind add up to 1, or are 0 where it has no unit."""
    same = sum(map(str.__eq__, words, words[1:]))
    lines = [x for x in map(str.strip, text.split("\n")) if x]
    again = len(lines) - len(set(lines))
    pairs = max(1, len(words) - 1)
    return np.array([same / pairs, (len(words) - 1 - same) / pairs, again / max(1, len(lines)), (len(lines) - again) / max(1, len(lines))])


def document(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares, which add up to 1 within each kind."""
    words = text.split()
    if not words:
        return np.empty(0, np.int64), np.empty(0)
    names, counts = np.unique(np.array(words, dtype=object), return_counts=True)
    buckets, sizes = features(list(names))
    total = np.bincount(buckets, weights=np.repeat(counts, sizes), minlength=BUCKETS + PATTERNS)
    total /= total.sum()
    total[BUCKETS:] += patterns(text, words)
    found = np.flatnonzero(total)
    return found, total[found]


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [document(t.as_py()) for t in batch.column(0)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0].astype(np.int32) for r in rows], pa.list_(pa.int32())), pa.array([r[1].astype(np.float32) for r in rows], pa.list_(pa.float32())), batch.column(1), batch.column(2), batch.column(3)],
            names=["buckets", "shares", "label", "share", "doc_id"],
        )


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, seed: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors, output weights and biases by stochastic gradient descent on (buckets, shares, label)."""
    rng = np.random.default_rng(seed)
    vectors = ((rng.random((BUCKETS + PATTERNS, DIM)) - 0.5) / DIM).astype(np.float32)
    out, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    epochs = max(epochs, min(10 * epochs, STEPS // max(1, len(rows))))
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            buckets, shares, label = rows[k]
            rate = RATE * (1 - done / steps)
            done += 1
            hidden = shares @ vectors[buckets]
            z = hidden @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            back = out @ p
            out -= rate * np.outer(hidden, p)
            bias -= rate * p
            # shares of single features are tiny; scaled by their norm, vectors and output move alike
            plain = shares[buckets < BUCKETS]
            pace = np.minimum(0.05 / max(1e-9, float(plain @ plain)) * shares, 0.5)
            vectors[buckets] -= (rate * pace)[:, None] * back
    return vectors, out, bias


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[np.ndarray, float]:
    """(one number for each bucket, bias): the difference of the two outputs before the softmax.

    Classes are learned in equal numbers; the bias is then moved to their true odds. Without rows
    of both classes every score is the share of class 1 (0.5 without any). Texts without words teach
    nothing. The driver holds at most ``FEATURES`` numbers of the sample, however long its texts.
    """
    sample = labelled_sample(docs, labels, "quality", per_class).select("text", "label", F.col("share").cast("double"), "doc_id")
    sparse = durable(sample.mapInArrow(_sparse, "buckets array<int>, shares array<float>, label int, share double, doc_id long"))
    sizes = sparse.select("doc_id", "label", "share", F.size("buckets").alias("n")).collect()
    sizes.sort(key=lambda r: (zlib.crc32(b"sample %d" % r.doc_id), r.doc_id))
    ends = np.cumsum([r.n for r in sizes])
    few = sizes[: max(1, int(np.searchsorted(ends, FEATURES, side="right")))]
    size = {v: float(sum(1 / r.share for r in sizes if r.label == v)) for v in (0, 1)}
    odds = float(np.log((size[1] + 0.5) / (size[0] + 0.5)))
    if not size[0] or not size[1]:
        return np.zeros(BUCKETS + PATTERNS, np.float32), odds if size[0] + size[1] else 0.0
    table = (sparse.where(F.col("doc_id").isin([r.doc_id for r in few])) if len(few) < len(sizes) else sparse).toArrow()
    discard(sparse)
    order = np.argsort(table["doc_id"].to_numpy(), kind="stable")
    label, buckets, shares = table["label"].to_numpy(), table["buckets"].combine_chunks(), table["shares"].combine_chunks()
    rows = [(buckets[k].values.to_numpy(), shares[k].values.to_numpy(), int(label[k])) for k in order.tolist() if len(buckets[k].values)]
    ones = sum(r[2] for r in rows)
    vectors, out, bias = train(rows)
    return vectors @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0]) + odds - float(np.log((ones + 0.5) / (len(rows) - ones + 0.5)))


class Scorer:
    """Scores texts; each word's features are added up once and kept."""

    def __init__(self, by_bucket: np.ndarray, bias: float):
        self.by_bucket, self.bias, self.known = by_bucket, bias, {}
        self.sums, self.sizes = np.empty(0), np.empty(0)

    def scores(self, texts: list[str]) -> np.ndarray:
        if len(self.known) > _KNOWN:
            self.known, self.sums, self.sizes = {}, np.empty(0), np.empty(0)
        known, split = self.known, [t.split() for t in texts]
        fresh = list(set().union(*split) - known.keys())
        if fresh:
            buckets, sizes = features(fresh)
            known.update(zip(fresh, range(len(known), len(known) + len(fresh))))
            ends = np.concatenate(([0], np.cumsum(self.by_bucket[buckets], dtype=np.float64)))
            stops = np.cumsum(sizes)
            self.sums = np.concatenate((self.sums, ends[stops] - ends[stops - sizes]))
            self.sizes = np.concatenate((self.sizes, sizes))
        out = np.full(len(texts), self.bias)
        for k, words in enumerate(split):
            if words:
                ids = np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))
                out[k] += self.sums[ids].sum() / self.sizes[ids].sum() + patterns(texts[k], words) @ self.by_bucket[BUCKETS:]
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def score(docs: DataFrame, by_bucket: np.ndarray, bias: float) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``, over its whole text.

    Null and empty texts have no features: their score is the bias alone. Long texts count whole;
    rows are independent, also where they or their ids repeat; a null id counts as held out; a score
    of just the threshold predicts 1; an empty table gives no rows; other columns are ignored. The model sent to the executors has ``BUCKETS + PATTERNS`` floats, whatever the data.
    """
    model = docs.sparkSession.sparkContext.broadcast((by_bucket.astype(np.float32), bias))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*model.value)
        for batch in batches:
            for part in (batch.slice(k, 256) for k in range(0, batch.num_rows, 256)):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scorer.scores(part.column(1).to_pylist()))], names=["doc_id", "score"])

    found = in_small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text")).mapInArrow(work, "doc_id long, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
