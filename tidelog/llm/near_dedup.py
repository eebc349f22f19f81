"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints at distance <= 2 share a *variant*: a value at distance <= 1 of both. So
every distinct fingerprint emits the 65 values of its radius-1 ball, the variants are shuffled,
and fingerprints that meet on one are linked. A variant has at most 65 distinct fingerprints
around it, whatever the data, so no group is unbounded: copies of a text share one fingerprint
and are folded before anything is emitted. Members of a ball meet pairwise within the radius;
each link is verified by its bit count all the same.

Links go from the smallest member to the others, which keeps connectivity without all pairs, and
components are found by minimum-label propagation with pointer jumping over durable tables.

The corpus stage (``near_copies``) links texts whose sets of 5-word shingles have Jaccard
similarity 0.8 or more. Their SimHashes of 192 bits differ in some 29, too many for one ball. So each
set has 12 fingerprints, each 8 of these bits below a hash of two sampled shingles, and the same ball
hashing at radius 2 finds in each table which fingerprints meet: a bucket is a variant. Pairs that met
are verified by the bit count of the whole SimHash, at a radius wide enough for 0.8, and then on the
whole sets. In a bucket a member first meets a few others. A bucket whose members these links have all
joined is done. The members of all others are compared exactly, each set once and not once for each of
its buckets: two sets at 0.8 or more have one of their first shingles in common, in any order of all
shingles, so only sets of different components that share one of these are looked at, by rank, size and
bit count and, those that have a partner, on the whole sets. The order begins with shingles that only
one component has, which join nothing, and goes on with the rarest, so a large group is parted by what
its members have of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations, pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, durable, free_name, in_small_batches

BITS, RADIUS, SHINGLE, SEED = 64, 2, 3, 42
_CHUNK = 1 << 15
#: Near copies: words of a shingle, and the least Jaccard similarity as a fraction.
WORDS, LEAST_SHARED = 5, (4, 5)
#: Fingerprints of a set, the SimHash bits in each and the sampled shingles above them. At 0.8 a bit differs
#: with probability 0.15, so a table keeps a pair with 0.8 ** 2 * 0.89 and all miss it with 0.00004; sets
#: of 4 and 5 shingles, the worst, differ in a bit with 0.19 and are missed with 0.00013.
TABLES, SIM_BITS, SAMPLES = 12, 8, 2
#: Most differing bits of the whole SimHash: even the worst pairs at 0.8 lie beyond with probability 0.000011.
WIDE = 60
#: A member of a bucket first meets the bucket's first and so many before itself; each bucket has
#: an order of its own, so a large bucket that is one component costs its size and not its square.
AFTER = 2
#: Members of a bucket that one task orders, about.
BLOCK = 10_000
#: Hashes of one block of the sets at a common first shingle, about; a cell compares two blocks.
CELL = 1 << 20
#: Members of one block of the sets at a common first shingle whose bit counts are compared with another's.
SIDE = 2_000
_ODD, _MIX = (np.random.default_rng(SEED).integers(0, 1 << 63, (2, TABLES * SAMPLES), dtype=np.uint64) << np.uint64(1)) + np.uint64(1)


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of UTF-8 text: bit i is set if it is set in over half the shingle hashes.

    A-Z are lower-cased; words are runs of anything but ASCII white space. A text with fewer
    words than a shingle has its whole sequence as one; a text without words has fingerprint 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest, n = xxhash.xxh64_intdigest, len(words) - shingle + 1
    votes = np.zeros(BITS, dtype=np.int64)
    first, last = starts[:n].tolist(), ends[shingle - 1 :].tolist()
    for at in range(0, n, _CHUNK):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(first[at : at + _CHUNK], last[at : at + _CHUNK])], dtype="<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([simhash(t or b"") for t in batch.column(3).to_pylist()], dtype="<u8").view("<i8")
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found)], names=["doc_id", "k1", "k2", "fp"])


def _row_key(doc_id: Column, text: Column) -> list[Column]:
    """128 bits of a row's id and text; never null."""
    return [F.xxhash64(doc_id, text), F.xxhash64(F.lit(1), text, doc_id)]


def _rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, k1, k2, text as bytes): what the Python side reads of each row."""
    doc_id, text = F.col(id_col).cast("long"), F.col(text_col)
    k1, k2 = _row_key(doc_id, text)
    return in_small_batches(docs).select(doc_id.alias("doc_id"), k1.alias("k1"), k2.alias("k2"), text.cast("binary").alias("text"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, k1, k2, fp): one row per row of ``docs``; null text has fingerprint 0. k1 and k2 hash the row's id and text."""
    return _rows(docs, id_col, text_col).mapInArrow(_fingerprint_batches, "doc_id long, k1 long, k2 long, fp long")


def ball_groups(distinct: DataFrame, bits: int = BITS) -> DataFrame:
    """(variant, members): distinct fingerprints that meet on a variant, two or more; the ``bits`` lowest bits are flipped.

    A group is its centre plus a 64-bit mask of the flipped bits: plain long aggregates.
    """
    step = F.explode(F.sequence(F.lit(-1), F.lit(bits - 1))).alias("bit")
    flip = F.when(F.col("bit") < 0, F.lit(0).cast("long")).otherwise(F.expr("shiftleft(1L, bit)"))
    members = F.expr(
        f"concat(if(centre = 1, array(variant), cast(array() as array<bigint>)), transform(filter(sequence(0, {bits - 1}), "
        "i -> (mask & shiftleft(1L, i)) != 0), i -> variant ^ shiftleft(1L, i)))"
    )
    return (
        distinct.select("fp", step)
        .select(F.col("fp").bitwiseXOR(flip).alias("variant"), flip.alias("mask"), F.when(F.col("bit") < 0, 1).otherwise(0).alias("centre"))
        .groupBy("variant")
        .agg(F.bit_or("mask").alias("mask"), F.max("centre").alias("centre"))
        .where(F.bit_count("mask") + F.col("centre") > 1)
        .select("variant", members.alias("members"))
    )


def ball_links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(hub, fp): links between distinct fingerprints at distance <= ``radius`` (even).

    Any two fingerprints within the radius are joined by a path of links, and no link is longer.
    """
    if radius % 2:
        raise ValueError("the radius must be even: each side emits half of it")
    # by number, so that the few bytes of the fingerprints are not gathered before each makes 65 rows
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct, half = fps.select("fp").repartition(parts, "fp").distinct(), radius // 2
    if half == 0:
        return distinct.select(F.col("fp").alias("hub"), "fp").where(F.lit(False))
    if half == 1:
        groups = ball_groups(distinct)
    else:
        masks = [reduce(lambda a, b: a | (1 << b), c, 0) for n in range(half + 1) for c in combinations(range(BITS), n)]
        signed = [m - (1 << 64) if m >> 63 else m for m in masks]
        groups = (
            distinct.select("fp", F.explode(F.array(*[F.lit(m).cast("long") for m in signed])).alias("mask"))
            .groupBy(F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"))
            .agg(F.collect_set("fp").alias("members"))  # at most the size of a ball
            .where(F.size("members") > 1)
        )
    return (
        groups.select("members")
        .select(F.array_min("members").alias("hub"), F.explode("members").alias("fp"))
        .where("hub != fp")
        .where(F.bit_count(F.col("hub").bitwiseXOR(F.col("fp"))) <= radius)
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node reachable.

    Each round takes the least label of the neighbours, then that label's own label (pointer
    jumping), so a chain of n links needs about log n rounds. Labels live in durable tables, each
    removed when the next is written. Where many nodes have one label or one neighbour, the
    engine's adaptive joins split that key.
    """
    both = durable(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct())
    table = durable(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")))
    while True:
        labels = table.select("node", "label")
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        hooked = labels.join(near, labels["node"] == near["a"]).select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        target = labels.select(F.col("node").alias("via"), F.col("label").alias("onward"))
        after = durable(
            hooked.join(target, F.col("label") == F.col("via"), "left").select("node", "was", F.least("label", F.coalesce("onward", "label")).alias("label"))
        )
        discard(table)
        table = after
        if not after.where("was != label").limit(1).count():
            discard(both)
            return after.select("node", F.col("label").alias("component"))


def _with_component(nodes: DataFrame, reached: DataFrame, key: str) -> DataFrame:
    """``nodes`` and the component of their ``key``; a key without links is its own."""
    return nodes.join(reached.withColumnRenamed("node", key), key, "left").withColumn("component", F.coalesce("component", key))


def _classes(named: DataFrame, key: str) -> DataFrame:
    """(key, component, component_id) of (key, node, component): the least ``node`` (a doc_id) of each class, null where it has none.

    Links are between keys and not ids, so a text whose ids are all null still connects others.
    """
    least = named.groupBy("component").agg(F.min("node").alias("component_id"))
    return named.join(least, "component").select(key, "component", "component_id")


def _linked(docs: DataFrame, radius: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, k1, k2, fp, component, component_id) of each row."""
    marked = durable(fingerprints(docs, id_col, text_col))
    nodes = durable(marked.groupBy("fp").agg(F.min("doc_id").alias("node")))
    links = ball_links(nodes, radius).select(F.col("hub").alias("a"), F.col("fp").alias("b"))
    return marked.join(_classes(_with_component(nodes, components(links), "fp"), "fp"), "fp")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id): one row per row of ``docs``.

    Fingerprints link at ``radius`` or fewer differing bits; ``component_id`` is the smallest
    doc_id reachable. Equal texts always share a component; empty and null texts have
    fingerprint 0, linked like any other; texts of any length count whole; a null doc_id takes
    part, connects others, and never names a group that has another id; repeated ids may be in
    several groups; an empty table gives no rows; other columns are ignored, whatever their names.
    """
    return _linked(docs, radius, id_col, text_col).select("doc_id", "fp", "component_id")


def hex64(fp):
    """16 lowercase hex digits of a long."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``docs`` without near-duplicates: of each group the row with the smallest doc_id stays.

    Rows are chosen, not ids: of rows with the chosen id, the one with the least hash of its text,
    and one of those equal in both. A group without any id keeps one row. Null and empty texts are
    one group. All columns stay as they are; an empty table stays empty.
    """
    return _firsts(docs, _linked(docs, radius))


def _firsts(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Of the rows of each component (doc_id, k1, k2, component) the first.

    Only keys of rows that go, or that occur several times, meet the texts: where they are few (by
    the engine's measure of their table) they are sent, and no text is shuffled.
    """
    rows = durable(found.groupBy("k1", "k2").agg(F.first("component").alias("component"), F.first("doc_id").alias("doc_id"), F.count("*").alias("n")))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "k2")).alias("r")
    chosen = rows.groupBy("component").agg(first).select("r.k1", "r.k2", F.lit(True).alias("chosen"))
    marked = rows.join(chosen, ["k1", "k2"], "left").withColumn("chosen", F.coalesce("chosen", F.lit(False)))
    apart = durable(marked.where("not chosen or n > 1").select("k1", "k2", "chosen"))
    a, b = free_name(docs, "k1"), free_name(docs, "k2")
    k1, k2 = _row_key(F.col("doc_id").cast("long"), F.col("text"))
    keyed = docs.withColumn(a, k1).withColumn(b, k2)
    apart = apart.select(F.col("k1").alias(a), F.col("k2").alias(b), "chosen")
    single = keyed.join(apart.select(a, b), [a, b], "left_anti")
    several = keyed.join(apart.where("chosen").select(a, b), [a, b], "left_semi").dropDuplicates([a, b])
    return single.select(docs.columns).unionByName(several.select(docs.columns))


def shingle_set(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words; a shorter text is one run, none without words."""
    found = text.lower().split()
    if not found:
        return np.empty(0, dtype="<u8")
    joined = b" ".join(found)
    ends = (np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)) + 1) - 1).tolist()
    starts = [0, *(e + 1 for e in ends[:-1])]
    spans = zip(starts, ends[words - 1 :]) if len(found) > words else [(0, len(joined))]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8"))


def wide_simhash(hashes: np.ndarray) -> np.ndarray:
    """SimHash of a set in three words of 64 bits: a bit is set if it is set in over half the hashes."""
    votes = np.zeros(3 * BITS, dtype=np.int64)
    for at in range(0, len(hashes), _CHUNK):
        h = hashes[at : at + _CHUNK].astype("<u8")
        words = [h]
        for odd, mix in zip(_ODD[:2], _MIX[:2]):
            h = (h ^ mix) * odd
            h = (h ^ (h >> np.uint64(32))) * odd
            words.append(h ^ (h >> np.uint64(29)))
        votes += np.unpackbits(np.stack(words, axis=1).view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")


def prints(hashes: np.ndarray, sim: np.ndarray) -> list[int]:
    """One signed fingerprint a table: its bits of the SimHash ``sim`` below a hash of the table's samples; none for no hashes.

    A sample is the shingle with the least hash of a function of its own, so two sets have it in common
    with the probability of their Jaccard similarity.
    """
    if not len(hashes):
        return []
    least = np.full(TABLES * SAMPLES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 4096):
        np.minimum(least, ((hashes[at : at + 4096, None] ^ _MIX) * _ODD).min(axis=0), out=least)
    above = [xxhash.xxh64_intdigest(row.tobytes(), k) for k, row in enumerate(least.reshape(TABLES, SAMPLES))]
    whole = int.from_bytes(sim.tobytes(), "little")
    below = [whole >> k * SIM_BITS & (1 << SIM_BITS) - 1 for k in range(TABLES)]
    return np.array([(a << SIM_BITS | b) & (1 << 64) - 1 for a, b in zip(above, below)], dtype="<u8").view("<i8").tolist()


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(t or b"") for t in batch.column(3).to_pylist()]
        keys = [xxhash.xxh64_intdigest(h.tobytes(), SEED) - (1 << 63) for h in sets]
        sims = [wide_simhash(h) for h in sets]
        words = np.array(sims, dtype="<u8").reshape(-1, 3).view("<i8")
        found = [pa.array(keys, pa.int64()), pa.array(map(len, sets), pa.int64()), *(pa.array(words[:, k].copy()) for k in range(3))]
        found.append(pa.array(map(prints, sets, sims), pa.list_(pa.int64())))
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], *found], names=["doc_id", "k1", "k2", "key", "size", "s0", "s1", "s2", "prints"])


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(t or b"") for t in batch.column(0).to_pylist()]
        keys = [xxhash.xxh64_intdigest(h.tobytes(), SEED) - (1 << 63) for h in sets]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([h.view("<i8") for h in sets], pa.list_(pa.int64()))], names=["key", "hashes"])


def _buckets(fps: DataFrame) -> DataFrame:
    """(band, fp): fingerprints (fp, one row per set and table) by the variants on which two sets or more meet.

    Only bits below the samples are flipped, so a fingerprint whose samples no other set has can meet
    none; below one hash of samples there are at most 2 ** ``SIM_BITS``, and around a variant one more
    than ``SIM_BITS``. A fingerprint of several sets is a bucket, too.
    """
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = fps.groupBy(F.shiftright("fp", SIM_BITS).alias("above"), "fp").agg(F.count("*").alias("n"))
    shared = counted.groupBy("above").agg(F.collect_list(F.struct("fp", "n")).alias("all"), F.sum("n").alias("sets")).where("sets > 1")
    live = durable(shared.select(F.explode("all").alias("p")).select("p.*"))
    # two fingerprints meet on two variants; only the lesser one keeps them, as in _fit
    low = "((a ^ b) & -(a ^ b))"
    kept = F.expr(f"filter(members, a -> exists(members, b -> a != b and least(a ^ {low}, b ^ {low}) = variant))")
    met = ball_groups(live.select("fp").repartition(parts, "fp"), SIM_BITS).select(F.col("variant").alias("band"), F.explode(kept).alias("fp"))
    return met.union(live.where("n > 1").select(F.col("fp").alias("band"), "fp")).distinct()


def _fit(a: str, b: str) -> Column:
    """Whether two members (fp, size, s0, s1, s2) of a band are compared there.

    Their sizes and the bit count of their SimHashes allow the similarity, and of the two variants on
    which two fingerprints meet the band is the lesser one; equal ones meet on their own.
    """
    some, whole = LEAST_SHARED
    bits = reduce(lambda x, y: x + y, [F.bit_count(F.col(f"{a}.s{k}").bitwiseXOR(F.col(f"{b}.s{k}"))) for k in range(3)])
    apart = F.col(f"{a}.fp").bitwiseXOR(F.col(f"{b}.fp"))
    low = apart.bitwiseAND(-apart)
    here = F.col("band") == F.least(F.col(f"{a}.fp").bitwiseXOR(low), F.col(f"{b}.fp").bitwiseXOR(low))
    return here & (whole * F.least(f"{a}.size", f"{b}.size") >= some * F.greatest(f"{a}.size", f"{b}.size")) & (bits <= WIDE)


def _meetings(members: DataFrame, *place: str) -> DataFrame:
    """(band, x, y): each member ``x`` (a struct with a key) of a place with the place's first and the ``AFTER`` before it, in an order of the place's own."""
    along = Window.partitionBy(*place).orderBy(F.xxhash64("x.key", "band"), "x.key")
    others = F.array(F.first("x").over(along), *[F.lag("x", k).over(along) for k in range(1, AFTER + 1)])
    found = members.select("band", "x", others.alias("others")).select("band", "x", F.explode(F.array_distinct("others")).alias("y"))
    return found.where("y is not null and x.key != y.key").where(_fit("x", "y"))


def _candidates(members: DataFrame) -> DataFrame:
    """Pairs of a bucket's members (band, x). A large bucket is cut into blocks, whose firsts then meet as a bucket of their own."""
    sizes = members.groupBy("band").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")).where("blocks > 1")
    placed = members.join(sizes, "band", "left").withColumn("block", F.coalesce(F.pmod(F.xxhash64("x.key", F.lit(BLOCK)), F.col("blocks")), F.lit(0))).drop("blocks")
    firsts = placed.where("block is not null").groupBy("band", "block").agg(F.min_by("x", F.struct(F.xxhash64("x.key", "band"), "x.key")).alias("x"))
    return _meetings(placed, "band", "block").unionByName(_meetings(firsts, "band"))


def cell_links(sets: list[np.ndarray], labels: np.ndarray, blocks: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of labels that join what similar sets join: a forest, not all pairs.

    Sets of one label are known to be connected. If ``blocks`` differ, only sets of different blocks
    are compared, as each block has a cell of its own. Of any two sets with different labels one is
    outside the commonest label, so only those are looked up, in an index of all hashes.
    """
    n, some, whole = len(sets), *LEAST_SHARED
    sizes = np.array([len(h) for h in sets], dtype=np.int64)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    order = np.argsort(flat, kind="stable")
    holders, fresh = owner[order], np.ones(len(flat), dtype=bool)
    fresh[1:] = np.diff(flat[order]) != 0
    starts = np.flatnonzero(fresh)
    ends = np.append(starts[1:], len(flat))
    place = np.empty(len(flat), dtype=np.int64)
    place[order] = np.cumsum(fresh) - 1
    first = np.append(0, np.cumsum(sizes))
    home = np.unique(labels, return_inverse=True)[1]
    links, apart = [], blocks.min() != blocks.max()
    for x in np.flatnonzero(home != np.bincount(home).argmax()):
        at = place[first[x] : first[x + 1]]
        at = at[ends[at] - starts[at] > 1]
        shared = np.zeros(n, dtype=np.int64)
        turns = np.cumsum(ends[at] - starts[at]) // CELL  # a turn looks at so many holders, about
        for part in np.split(at, np.flatnonzero(np.diff(turns)) + 1):
            if len(part):
                shared += np.bincount(np.concatenate([holders[starts[k] : ends[k]] for k in part]), minlength=n)
        near = (shared * (some + whole) >= some * (sizes + sizes[x])) & (home != home[x])
        if apart:
            near &= blocks != blocks[x]
        for y in np.flatnonzero(near):
            if home[y] != home[x]:
                links.append((int(labels[x]), int(labels[y])))
                home[home == home[y]] = home[x]
    return links


def _cell_tables(cell: pa.Table) -> pa.Table:
    sets = [h.values.to_numpy() for h in cell.column("hashes")]
    found = cell_links(sets, cell.column("label").to_numpy(), cell.column("block").to_numpy())
    return pa.table([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"])


def _cells(members: DataFrame, blocks: str, salt: int) -> DataFrame:
    """``members``, each once for each cell (low, high): two of the ``blocks`` (a column) that its band is cut into.

    In a band of several blocks the commonest label has blocks of its own, which meet those of the others
    only: so a group that is one component but for a few sets costs its size, with each of the few.
    """
    labels = members.where(F.col(blocks) > 1).groupBy("band", "label").agg(F.count("*").alias("n"), F.max(blocks).alias("all"))
    large = labels.groupBy("band").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("n"), F.max("all").alias("all"))
    share = F.col("all") * F.col("top.n") / F.col("n")
    large = large.select("band", F.col("top.label").alias("commonest"), F.ceil(share).alias("tops"), F.greatest(F.lit(1), F.ceil(F.col("all") - share)).alias("others"))
    placed = members.join(large, "band", "left").withColumn("commonest", F.col("label").eqNullSafe(F.col("commonest")))
    tops, others, hashed = F.coalesce("tops", F.lit(0)), F.coalesce("others", F.lit(1)), F.xxhash64("key", F.lit(salt))
    block = F.when(F.col("commonest"), F.pmod(hashed, F.greatest(F.lit(1), tops))).otherwise(tops + F.pmod(hashed, others))
    met = F.sequence(F.when(F.col("commonest"), tops).otherwise(0).cast("long"), (tops + others - 1).cast("long"))
    cells = placed.withColumn("block", block.cast("long")).withColumn("other", F.explode(met))
    return cells.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")).drop(blocks, "other", "commonest", "tops", "others")


def _in_cells(cells: DataFrame, of_cell: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """``of_cell`` of each cell (band, low, high), one after another: a task holds one cell, and small cells cost little."""
    place, parts = ["band", "low", "high"], int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None
        for batch in batches:
            where = np.stack([batch.column(name).to_numpy() for name in place])
            cuts = np.flatnonzero((where[:, 1:] != where[:, :-1]).any(axis=0)) + 1
            for a, b in pairwise([0, *cuts.tolist(), len(batch)]) if len(batch) else ():
                if held and at != tuple(where[:, a]):
                    yield from of_cell(pa.Table.from_batches(held)).to_batches()
                    held = []
                at = tuple(where[:, a])
                held.append(batch.slice(a, b - a))
        if held:
            yield from of_cell(pa.Table.from_batches(held)).to_batches()

    return in_small_batches(cells).repartition(parts, *place).sortWithinPartitions(*place).mapInArrow(run, schema)


def with_partner(cell: pa.Table) -> pa.Table:
    """(band, key, label, parts) of those members (band, key, size, s0, s1, s2, label, parts, block) that have a partner in their cell.

    A partner has another label, and size and bit count fit; if the cell has two blocks, it is in the other.
    With a ``rank`` (the shingles before the band's in the order of all), the sets have no more in common than
    what either has from the band on. With an ``fp``, the band is the lesser variant, as in ``_fit``.
    """
    col = {name: cell.column(name).to_numpy() for name in ("band", "size", "label", "block", "rank", "fp") if name in cell.column_names}
    sims, (some, whole) = [cell.column(f"s{k}").to_numpy().view(np.uint64) for k in range(3)], LEAST_SHARED
    found, apart = np.zeros(len(cell), dtype=bool), col["block"].min() != col["block"].max()
    for at in range(0, len(cell), 256):
        one = {name: c[at : at + 256, None] for name, c in col.items()}
        fits = (one["label"] != col["label"]) & (whole * np.minimum(one["size"], col["size"]) >= some * np.maximum(one["size"], col["size"]))
        if apart:
            fits &= one["block"] != col["block"]
        if "rank" in col:
            most = np.minimum(one["size"] - one["rank"], col["size"] - col["rank"])
            fits &= (some + whole) * most >= some * (one["size"] + col["size"])
        if "fp" in col:
            low = one["fp"] ^ col["fp"]
            low &= -low
            fits &= np.minimum(one["fp"] ^ low, col["fp"] ^ low) == col["band"]
        if fits.any():
            fits &= sum(np.bitwise_count(s[at : at + 256, None] ^ s).astype(np.int64) for s in sims) <= WIDE
        found[at : at + 256] = fits.any(axis=1)
    return cell.select(["band", "key", "label", "parts"]).filter(pa.array(found))


def _open_sets(members: DataFrame, buckets: DataFrame, named: DataFrame) -> DataFrame:
    """(key, label): sets in a bucket (band, fp) that is still open, of members (key, fp) and their labels (key, label).

    A bucket is open if not all its members have met and they have different labels. It is counted by
    fingerprints, of which it has few, so a set is not told again for each of its buckets.
    """
    inside = members.select("key", "fp").distinct().join(named, "key")
    prints = inside.groupBy("fp").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"))
    counts = buckets.join(prints, "fp").groupBy("band").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    still_open = counts.where((F.col("n") > AFTER + 2) & (F.col("low") != F.col("high")))
    fps = buckets.join(still_open.select("band"), "band", "left_semi").select("fp").distinct()
    return inside.join(fps, "fp", "left_semi").select("key", "label").distinct()


def _first_shingles(among: DataFrame, sets: DataFrame) -> DataFrame:
    """(band, key, rank): the first shingles (as bands) of sets (key, label, size), those left out that sets of one label alone have.

    All shingles have one order: first those of one label, then by the number of sets that have them. Of
    two sets at 0.8 or more the least common shingle is among the first fifth of either, and one more.
    """
    some, whole = LEAST_SHARED
    held = sets.join(among.select("key", "label", "size"), "key").select("key", "label", "size", F.explode("hashes").alias("band"))
    holders = held.groupBy("band").agg(F.count("*").alias("holders"), F.min("label").alias("low"), F.max("label").alias("high"))
    mixed = held.join(holders.where("low != high").select("band", "holders"), "band")
    each = mixed.groupBy("key").agg(F.first("size").alias("size"), F.array_sort(F.collect_list(F.struct("holders", "band"))).alias("mixed"))
    each = each.select("key", "mixed", F.expr("size - size(mixed)").alias("own"), F.expr(f"size - ({some} * size + {whole} - 1) div {whole} + 1").alias("first"))
    each = each.where("first > own").select("key", "own", F.posexplode(F.expr("slice(mixed, 1, cast(first - own as int))")).alias("at", "shingle"))
    return each.select("shingle.band", "key", (F.col("own") + F.col("at")).alias("rank"))


def _open_members(among: DataFrame, sets: DataFrame) -> DataFrame:
    """(band, key, label, parts): of sets (key, label, size, s0, s1, s2) those with a partner at one of their first shingles.

    A set whose shingles from the band on are too few for the smallest set there goes at once; the others
    are compared in cells of two blocks, so a shingle that is many sets' first is many tasks.
    """
    some, whole = LEAST_SHARED
    placed = durable(_first_shingles(among, sets).join(among, "key"))
    least = placed.groupBy("band").agg(F.min("size").alias("least"), F.min("label").alias("low"), F.max("label").alias("high")).where("low != high")
    other = F.greatest("least", F.expr(f"({some} * size + {whole} - 1) div {whole}"))
    able = placed.join(least.select("band", "least"), "band").where((some + whole) * (F.col("size") - F.col("rank")) >= some * (F.col("size") + other)).drop("least")
    able = durable(able)
    discard(placed)
    counts = able.groupBy("band").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"), F.sum("size").alias("hashes"))
    shared = counts.where("low != high").select("band", F.ceil(F.col("n") / SIDE).alias("blocks"), F.ceil(F.col("hashes") / CELL).alias("parts"))
    cells = _cells(able.join(shared, "band"), "blocks", SIDE)
    return _in_cells(cells, with_partner, "band long, key long, label long, parts long").distinct()


def _open_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): links of labels that members (band, key, label, parts) of bands have.

    A band is cut into parts, and each two of them are one cell: memory is bounded and a hot band
    is many tasks.
    """
    return _in_cells(_cells(members, "parts", CELL).join(sets, "key"), _cell_tables, "a long, b long")


def _sets(rows: DataFrame, nodes: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, hashes): the whole sets of ``keys``, made of their texts again."""
    ends = nodes.join(keys.distinct(), "key", "left_semi").select("row.*")
    texts = rows.join(ends, ["k1", "k2"], "left_semi").select("text")
    return durable(in_small_batches(texts).mapInArrow(_hash_batches, "key long, hashes array<long>").dropDuplicates(["key"]))


def _near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, k1, k2, key, component, component_id) of each row."""
    rows, sim = _rows(docs, id_col, text_col), ("s0", "s1", "s2")
    marked = durable(rows.mapInArrow(_set_batches, "doc_id long, k1 long, k2 long, key long, size long, s0 long, s1 long, s2 long, prints array<long>"))
    nodes = durable(
        marked.groupBy("key").agg(*(F.first(c).alias(c) for c in ("size", *sim, "prints")), F.min("doc_id").alias("node"), F.min(F.struct("k1", "k2")).alias("row"))
    )
    buckets = durable(_buckets(nodes.select(F.explode("prints").alias("fp"))))
    members = durable(nodes.select("key", "size", *sim, F.explode("prints").alias("fp")).join(buckets, "fp"))
    pairs = durable(
        _candidates(members.select("band", F.struct("key", "fp", "size", *sim).alias("x")))
        .select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b"))
        .distinct()
    )
    sets = _sets(rows, nodes, pairs.select(F.explode(F.array("a", "b")).alias("key")))
    side = lambda name: sets.select(F.col("key").alias(name), F.col("hashes").alias(f"{name}_hashes"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    some, whole = LEAST_SHARED
    shared = F.size(F.array_intersect("a_hashes", "b_hashes"))
    links = both.where(shared * (some + whole) >= some * (F.size("a_hashes") + F.size("b_hashes"))).select("a", "b")
    named = durable(_with_component(nodes.select("key", "node"), components(links), "key").withColumnRenamed("component", "label"))
    discard(sets)
    discard(pairs)
    among = durable(_open_sets(members, buckets, named.select("key", "label")).join(nodes.select("key", "size", *sim), "key"))
    discard(members)
    discard(buckets)
    sets = _sets(rows, nodes, among.select("key"))
    further = components(_open_links(durable(_open_members(among, sets)), sets))
    discard(sets)
    joined = named.join(further.withColumnRenamed("node", "label"), "label", "left").withColumn("component", F.coalesce("component", "label"))
    return marked.select("doc_id", "k1", "k2", "key").join(_classes(joined, "key"), "key")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, key, component_id): one row per row of ``docs``; ``key`` stands for the set of shingles.

    Texts link where their sets of 5-word shingles have Jaccard similarity 0.8 or more, verified on
    the whole sets; no link is lost in a bucket, however large it is. ``component_id`` is the smallest doc_id reachable. Texts of one set always share
    a component, as do texts without words, null ones too. Null and repeated ids, long texts, empty
    tables and other columns are as in ``near_duplicates``.
    """
    return _near(docs, id_col, text_col).select("doc_id", "key", "component_id")


def one_of_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without near copies: of each group the row with the smallest doc_id stays, as in ``one_of_each``."""
    return _firsts(docs, _near(docs))
