"""SimHash document fingerprints, in DataFrame operations only.

Every three-word shingle votes on each bit by its hash, with its length as weight. 32 sums of
two 32-bit counters each hold the 64 votes of a hash, so a row costs 32 additions inside generated
code, and partial sums leave the map side as one row per document.

``within`` finds all fingerprints within a Hamming radius r of the query fingerprints by permuted
block tables: the bits are cut into blocks, and two fingerprints at distance <= r agree on all
but r blocks at most, so each choice of (blocks - r) blocks is the key of one table.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, durable, text_of

BITS, RADIUS, BLOCKS = 64, 3, 5
#: Documents in a bucket of the ascending order, about.
BUCKET = 2_000
_PAIR = 0x0000000100000001


def shingles(text: Column) -> Column:
    """Overlapping three-word shingles; fewer words: the whole sequence; no word: none."""
    flat = F.trim(F.regexp_replace(text, SPACE, " "))
    found = F.regexp_extract_all(flat, F.lit(r"(?<![^ ])(?=([^ ]++ [^ ]++ [^ ]++))[^ ]++"), F.lit(1))
    return F.when(F.size(found) > 0, found).when(F.length(flat) > 0, F.array(flat)).otherwise(F.array().cast("array<string>"))


def _votes(h: Column, weight: Column) -> list[Column]:
    sums = [F.sum(F.shiftright(h, g).bitwiseAND(F.lit(_PAIR)) * weight).alias(f"v{g}") for g in range(BITS // 2)]
    return [*sums, F.sum(weight).alias("weight")]


def _bits() -> Column:
    """The fingerprint: a bit for each counter that has more than half of the weight."""
    out = F.lit(0).cast("long")
    for g in range(BITS // 2):
        low, high = F.col(f"v{g}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(F.col(f"v{g}"), 32)
        for counter, bit in ((low, g), (high, g + 32)):
            mask = (1 << bit) - (1 << 64 if bit == 63 else 0)
            out = out.bitwiseOR(F.when(2 * counter > F.col("weight"), F.lit(mask).cast("long")).otherwise(F.lit(0).cast("long")))
    return out


def simhash(texts: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """(keys..., fp): a fingerprint for every combination of ``keys``, which name texts uniquely."""
    terms = texts.select(*keys, F.explode_outer(shingles(F.col(text_col))).alias("_term"))
    hashed = terms.select(*keys, F.xxhash64("_term").alias("_h"), F.when(F.col("_term").isNull(), 0).otherwise(F.octet_length("_term")).cast("long").alias("_w"))
    return hashed.groupBy(*keys).agg(*_votes(F.col("_h"), F.col("_w"))).select(*keys, _bits().alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def in_order(docs: DataFrame) -> DataFrame:
    """(doc_id, text, next_id, next_text): each row with the next one, ascending (doc_id, text).

    After the last comes the first. The order is cut at ids that occur, in two levels (parts, and
    buckets inside each part), so that a row is compared with about the square root of the number
    of buckets, and a bucket keeps its size however many rows there are. The first rows of each
    bucket are also dealt to the bucket before, so none needs another and no task sees all rows. A
    null id comes first; repeated rows follow each other; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text"))
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    n, least = rows.agg(F.count("*"), F.min(key)).first()
    if not n:
        return rows.select("doc_id", "text", F.col("doc_id").alias("next_id"), F.col("text").alias("next_text"))
    side = math.ceil(math.sqrt(n / BUCKET))
    # percentile_approx returns values that occur, so each cut is the id of a row
    shares = [k / side for k in range(1, side)]
    edges = sorted({least, *(rows.select(F.percentile_approx(key, shares, 100 * side)).first()[0] if shares else [])})
    up_to = lambda cuts, k: F.size(F.filter(cuts, lambda c: c <= k)).cast("int")
    placed = rows.withColumn("key", key).withColumn("part", up_to(F.array(*[F.lit(e).cast("long") for e in edges]), F.col("key")))
    inner = F.percentile_approx("key", shares, 100 * side) if shares else F.array().cast("array<bigint>")
    own = F.array_sort(F.array_union(F.array(F.min("key")), inner)).alias("cuts")
    cuts = placed.groupBy("part").agg(own).withColumn("buckets", F.size("cuts"))
    by_part = Window.orderBy("part")  # one row for each part
    last = F.last(F.struct("part", F.col("buckets").alias("bucket"))).over(by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    before = F.coalesce(F.lag(F.struct("part", F.col("buckets").alias("bucket"))).over(by_part), last).alias("before")
    cuts = durable(cuts.select("part", "cuts", before))
    at = F.struct("part", F.col("bucket")).alias("b")
    previous = F.when(F.col("bucket") > 1, F.struct("part", (F.col("bucket") - 1).alias("bucket"))).otherwise(F.col("before")).alias("b")
    home, halo = F.struct(at, F.lit(0).alias("halo")), F.struct(previous, F.lit(1).alias("halo"))
    spots = F.when(F.array_contains("cuts", F.col("key")), F.array(home, halo)).otherwise(F.array(home))
    along = Window.partitionBy("b").orderBy("halo", "key", "text")
    return (
        placed.join(cuts, "part")
        .withColumn("bucket", up_to(F.col("cuts"), F.col("key")))
        .select("doc_id", "text", "key", F.explode(spots).alias("s"))
        .select("doc_id", "text", "key", "s.b", "s.halo")
        .withColumn("next_id", F.lead("doc_id").over(along))
        .withColumn("next_text", F.lead("text").over(along))
        .where("halo = 0")
        .select("doc_id", "text", "next_id", "next_text")
    )


def within(fps: DataFrame, queries: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(query, fp, distance): all pairs of a distinct query value and a distinct ``fps`` value.

    fps, queries: a column fp. Exact: every pair within the radius meets in a table; a pair that
    meets in several counts once.
    """
    if not 0 <= radius < blocks:
        raise ValueError("there must be more blocks than the radius")
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    ones = lambda a, b: sum(1 << i for i in range(a, b))
    tables = []
    for chosen in combinations(range(blocks), blocks - radius):
        mask = sum(ones(edges[c], edges[c + 1]) for c in chosen)
        tables.append(mask - (1 << 64) if mask >> 63 else mask)
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key")) for k, m in enumerate(tables)]))
    keyed = lambda df, name: df.select("fp").distinct().select(F.col("fp").alias(name), rows.alias("_r")).select(name, "_r.t", "_r.key")
    distance = F.bit_count(F.col("query").bitwiseXOR(F.col("fp")))
    return keyed(queries, "query").join(keyed(fps, "fp"), ["t", "key"]).where(distance <= radius).select("query", "fp", distance.cast("int").alias("distance")).distinct()


def edited_fingerprints(docs: DataFrame, radius: int = RADIUS, every: int = 50) -> DataFrame:
    """Per row: fingerprints of its text and of its edited text, and their likeness.

    The edited text has its last floor(n_chars / 4) code points replaced by the first as many (or
    all) of the next document. A single document is its own next. n_within: for ids divisible by
    ``every``, how many other rows have a fingerprint within ``radius``; else null. Null and empty
    texts have fingerprint 0; texts of any length count whole; equal rows count each for itself; rows
    without an id come first and are no queries; an empty table gives no rows; other columns are ignored.
    """
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - quarter), F.substring("next_text", F.lit(1), quarter))
    whole = in_order(docs).withColumn("_row", F.monotonically_increasing_id())
    sha = F.sha2(F.col("edited").cast("binary"), 256)
    digest = [F.conv(F.substring(sha, 16 * k + 1, 16), 16, -10).cast("long").alias(f"s{k}") for k in range(4)]  # as longs, which sums can carry
    facts = whole.select(
        "_row", "doc_id", "next_id", n.cast("long").alias("n_chars"), F.xxhash64("text").alias("th"), F.xxhash64("next_text").alias("nh"),
        "text", edited.alias("edited"),
    )
    carried = ["doc_id", "next_id", "n_chars", "th", "nh", "s0", "s1", "s2", "s3"]
    sides = facts.select("*", *digest).select(
        "_row", *carried, F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("t")), F.struct(F.lit(1).alias("side"), F.col("edited").alias("t")))).alias("_x")
    )
    terms = sides.select("_row", *carried, "_x.side", F.explode_outer(shingles(F.col("_x.t"))).alias("_term"))
    weight = F.when(F.col("_term").isNull(), 0).otherwise(F.octet_length("_term")).cast("long")
    keep = [F.max(c).alias(c) for c in carried]
    voted = terms.groupBy("_row", "side").agg(*_votes(F.xxhash64("_term"), weight), *keep).select("_row", "side", *carried, _bits().alias("fp"))
    marked = durable(
        voted.groupBy("_row").agg(*[F.max(c).alias(c) for c in carried], F.max(F.when(F.col("side") == 0, F.col("fp"))).alias("fp"), F.max(F.when(F.col("side") == 1, F.col("fp"))).alias("efp"))
    )
    following = marked.groupBy(F.col("doc_id").alias("next_id"), F.col("th").alias("nh")).agg(F.max("fp").alias("nfp"))
    near_next = marked.join(following, marked["next_id"].eqNullSafe(following["next_id"]) & (marked["nh"] == following["nh"])).drop(following["next_id"]).drop(following["nh"])
    copies = marked.groupBy("fp").agg(F.count("*").alias("copies"))
    found = within(copies, marked.where(F.col("doc_id") % every == 0), radius)
    near = found.join(copies, "fp").groupBy("query").agg((F.sum("copies") - 1).alias("n_within"))
    asked = near_next.join(near, (near_next["fp"] == near["query"]) & (near_next["doc_id"] % every == 0), "left")
    hex64 = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    return asked.select(
        "doc_id", "n_chars", F.concat(*[hex64(f"s{k}") for k in range(4)]).alias("edited_sha256"),
        hex64("fp").alias("fingerprint"), hex64("efp").alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("efp")).alias("near_edited"), likeness(F.col("fp"), F.col("nfp")).alias("near_next"), "n_within",
    )
