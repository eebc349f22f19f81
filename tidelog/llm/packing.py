"""Best-fit packing of documents into fixed-length sequences, in bulk-synchronous rounds.

A round sorts the unplaced documents (descending) and the gaps of open sequences (ascending);
one sweep over both gives every document its successor, the smallest gap that holds it.
Documents that want the same gaps are served by rank, each gap takes at most one document, the
gaps are updated, and the next round begins. Where a round places nothing, the longest documents
left open as many sequences as their tokens need at least.

Documents of one length are interchangeable, and so are gaps of one size, so the rounds work on
the run-length encoding of the two sorted lists: at most ``capacity`` classes with counts,
whatever the number of documents. All that is done per document is distributed: its length, its
rank in its class, and the look-up of the place that the rounds gave to that rank.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, in_small_batches, once_per_process, text_of

CAPACITY, END = 2048, 0
#: Ranks are counted in blocks of about so many pieces.
BLOCK = 2_000
#: Bits of a rank in a range's key; lengths are above them.
_RANK_BITS = 48
#: Characters on which the fast encoder has been tested equal to the plain one.
PLAIN = r"[\n\t\x20-\x7e¡-ɏ‐-‧]*"


def encoder(vocabulary: str):
    """The encoder of ``vocabulary``, read once in a process."""
    return once_per_process(("encoder", vocabulary), lambda: read_encoder(vocabulary))


def read_encoder(vocabulary: str):
    """text -> numpy array of ids by the tokenizers file ``vocabulary``, no special tokens added.

    Names of the file's special tokens in a text give those tokens, as the tokenizers library has
    it. If the same vocabulary lies beside the file as ranks (``.tiktoken``), texts of plain
    characters without such names are encoded by it, four times as fast, to the same ids.
    """
    import base64
    import os
    import re

    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(vocabulary)
    ranks_file = vocabulary.removesuffix(".json") + ".tiktoken"
    if not os.path.exists(ranks_file):
        return lambda text: np.array(slow.encode(text, add_special_tokens=False).ids, dtype="<u4")
    import public_tokenizers
    import tiktoken

    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    plain = re.compile(PLAIN)
    names = [t.content for t in slow.get_added_tokens_decoder().values()]

    def encode(text: str) -> np.ndarray:
        if plain.fullmatch(text) and not any(name in text for name in names):
            return np.array(fast.encode_ordinary(text), dtype="<u4")
        return np.array(slow.encode(text, add_special_tokens=False).ids, dtype="<u4")

    return encode


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: only the first may be shorter than the capacity."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    return [(0, first)] * bool(first) + [(s, capacity) for s in range(first, n, capacity)]


def document_ids(text: str, vocabulary: str) -> np.ndarray:
    """A document's tokens: its ids, then the end mark."""
    return np.append(encoder(vocabulary)(text), np.array([END], dtype="<u4")).astype("<u4")


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): every document's pieces; null text is empty."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ids_of = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = document_ids(text.as_py() or "", vocabulary)
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    part = ids[start : start + length]
                    rows.append((doc_id, k, start, length, zlib.crc32(part.tobytes())))
                    if with_ids:
                        ids_of.append(part.astype("<i4"))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids_of, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return in_small_batches(docs).select(F.col("doc_id").cast("long"), text_of(F.col("text")).alias("text")).mapInArrow(work, schema)


def plan_rounds(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, sequence of the first rank, offset) for all pieces.

    counts: number of pieces of each length, 1 to ``capacity``. Ranks count from 0 within a length.
    """
    left = {n: c for n, c in counts.items() if c}
    done: dict[int, int] = defaultdict(int)
    places: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # size -> (first sequence, how many)
    opened = 0

    def put(length: int, gap: int, sequence: int, many: int) -> None:
        places.append((length, done[length], done[length] + many, sequence, capacity - gap))
        done[length] += many
        left[length] -= many
        if not left[length]:
            del left[length]

    def open_new(length: int, many: int) -> None:
        nonlocal opened
        first = opened
        opened += many
        put(length, capacity, first, many)
        if length < capacity:
            gaps[capacity - length].append((first, many))

    for length in [n for n in left if 2 * n > capacity]:
        open_new(length, left[length])
    while left:
        sizes, after, placed = sorted(s for s in gaps if gaps[s]), [], False
        for length in sorted(left, reverse=True):
            at = bisect_left(sizes, length)
            while at < len(sizes) and length in left:
                size = sizes[at]
                first, many = gaps[size].pop()
                take = min(many, left[length])
                put(length, size, first, take)
                placed = True
                if size > length:
                    after.append((size - length, first, take))
                if take < many:
                    gaps[size].append((first + take, many - take))
                if not gaps[size]:
                    sizes.pop(at)
        for size, first, many in after:
            gaps[size].append((first, many))
        if not placed:
            need = -(-sum(n * c for n, c in left.items()) // capacity)
            for length in sorted(left, reverse=True):
                if need <= 0:
                    break
                many = min(need, left[length])
                need -= many
                open_new(length, many)
    return places


def _places(places: list[tuple[int, int, int, int, int]]) -> tuple[np.ndarray, ...]:
    """(key, first rank, sequence, offset) of all ranges by ascending key, which is length and first rank in one number."""
    length, first, _, sequence, offset = (np.array(c, dtype=np.int64) for c in (zip(*places) if places else [()] * 5))
    key = length << _RANK_BITS | first
    order = np.argsort(key)
    return key[order], first[order], sequence[order], offset[order]


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): where every piece goes.

    Each row of ``docs`` is a document of its own, also where ids or rows repeat or an id is null;
    an empty or null text is the end mark alone; a text of any length is cut whole into pieces;
    pieces of one length are served in the order of a hash, so ties change no count; an empty table
    gives no rows. Other columns of ``docs`` are ignored, whatever their names. Sequences are
    gapless from offset 0.

    What goes to every executor is bounded by the capacity, whatever the number of documents: how
    many blocks each length has, and the ranges of the rounds. A range ends its length or uses up a
    gap, which only shrinks, so there are at most 2 * capacity ** 2 of them (some thousands in practice).
    """
    spark = docs.sparkSession
    # the salt is written with the pieces, so that every later step sees the same one, also after a retry
    found = durable(pieces(docs, vocabulary, capacity).withColumn("salt", F.monotonically_increasing_id()))
    lengths = found.groupBy("length").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in lengths.collect()}
    blocks = lengths.select("length", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    marked = found.join(F.broadcast(blocks), "length").withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "salt"), F.col("blocks"))).drop("blocks")
    own = Window.partitionBy("length", "block").orderBy("doc_id", "piece", "ids_crc32", "salt")
    sizes = marked.groupBy("length", "block").agg(F.count("*").alias("n"))
    before = sizes.select("length", "block", (F.sum("n").over(Window.partitionBy("length").orderBy("block")) - F.col("n")).alias("before"))
    ranked = marked.withColumn("rank", F.row_number().over(own) - 1).join(before, ["length", "block"])
    sent = spark.sparkContext.broadcast(_places(plan_rounds(counts, capacity)))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, sequence, offset = sent.value
        for batch in batches:
            length, rank = (batch.column(k).to_numpy() for k in (3, 5))
            at = np.searchsorted(key, length << _RANK_BITS | rank, side="right") - 1
            made = [pa.array(sequence[at] + rank - first[at]), pa.array(offset[at])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *made], names=[f.split()[0] for f in schema.split(", ")])

    rows = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))
    return rows.mapInArrow(look_up, schema)


def sequences(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """(sequence_id, ids): the packed token sequences themselves, for a trainer.

    Encodes a second time instead of storing all ids between the steps. A sequence has at most
    ``capacity`` tokens, so no group is unbounded.
    """
    where = pack(docs, vocabulary, capacity)
    ids = pieces(docs, vocabulary, capacity, with_ids=True).dropDuplicates(["doc_id", "piece", "ids_crc32"]).select("doc_id", "piece", "ids_crc32", "ids")
    same = where["doc_id"].eqNullSafe(ids["doc_id"]) & (where["piece"] == ids["piece"]) & (where["ids_crc32"] == ids["ids_crc32"])
    return (
        where.join(ids, same)
        .groupBy("sequence_id")
        .agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
    )
