"""Mixing sources to target weights by Poisson replication.

Each source has a mean repetition rate (target size over present size). A document's copies are
the inverse of its source's Poisson distribution at a number in [0, 1) hashed from seed and id,
so the draw is the same in every run, on every cluster and after every retry; the rows are then
exploded by their counts and dealt out by a hash of (seed, id, copy): a global shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, free_name

SEED = "mix-1"
#: A mean above this is drawn as a sum of equal parts, as exp(-mean) would underflow.
PART = 500.0
#: At most so many sources are sent to every executor (about 100 bytes each, and their
#: distributions); more are joined by a salted shuffle, with a salt for each shuffle partition.
FEW_SOURCES = 2_000


def uniform(*parts: Column) -> Column:
    """52 bits of md5 over the parts, as a double in [0, 1)."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def poisson_cdf(mean: Column) -> Column:
    """array: P(X <= k) for k = 0, 1, ... as far as a double can tell it from 1."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 30).cast("int")
    first = F.exp(-mean)
    start = F.struct(first.alias("p"), first.alias("sum"), F.array(first).alias("cdf"))

    def step(acc, k):
        p = acc["p"] * mean / k
        total = acc["sum"] + p
        return F.struct(p.alias("p"), total.alias("sum"), F.concat(acc["cdf"], F.array(total)).alias("cdf"))

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda acc: acc["cdf"])


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, size: float | None = None) -> DataFrame:
    """(source, chars, rate): how often each source's documents are to occur on average.

    weights: relative target sizes by source; a source not named has weight 1, a null source is
    a source of its own. size: characters wanted over all; by default as many as there are. A
    source without characters keeps rate 1.
    """
    own = docs.groupBy("source").agg(F.sum(F.length(F.coalesce("text", F.lit("")))).alias("chars"))
    weight = F.lit(1.0)
    for name, w in (weights or {}).items():
        weight = F.when(F.col("source") == name, F.lit(float(w))).otherwise(weight)
    own = durable(own.withColumn("weight", weight))
    total = own.agg(F.sum("chars").alias("c"), F.sum("weight").alias("w")).first()
    wanted, heavy = float(size if size is not None else total["c"] or 0), float(total["w"] or 1.0)
    rate = F.when(F.col("chars") > 0, F.col("weight") * wanted / heavy / F.col("chars")).otherwise(F.lit(1.0))
    return own.select("source", "chars", rate.cast("double").alias("rate"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, size: float | None = None, seed: str = SEED) -> DataFrame:
    """``docs`` replicated and shuffled; adds copy (from 0), n_copies and rate.

    A document with n_copies 0 does not occur. Rows with the same id draw the same count, rows
    without an id that of the empty id; null and empty texts count no characters and are drawn like
    any other, long ones whole; a null source is a source of its own; an empty table stays empty.
    Columns named copy, n_copies or rate in the input are replaced, any other name may occur.
    """
    docs = docs.drop("copy", "n_copies", "rate")
    spark, rates = docs.sparkSession, source_rates(docs, weights, size)
    source, parts, cdf, salt, number, place = (free_name(docs, n) for n in ("drawn_source", "parts", "cdf", "salt", "number", "place"))
    many_parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART).cast("int"))
    drawn = rates.select(F.col("source").alias(source), F.col("rate"), many_parts.alias(parts), poisson_cdf(F.col("rate") / many_parts).alias(cdf))
    same = docs["source"].eqNullSafe(drawn[source])
    if rates.count() <= FEW_SOURCES:
        joined = docs.join(F.broadcast(drawn), same)
    else:  # a hot source is spread over the salts
        salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spread = drawn.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        salted = docs.withColumn(salt, F.pmod(F.xxhash64("doc_id", "text"), F.lit(salts)).cast("int"))
        joined = salted.join(spread, salted["source"].eqNullSafe(spread[source]) & (salted[salt] == spread[salt])).drop(salt)

    def draw(j):
        u = uniform(F.lit(seed), F.col("doc_id"), j)
        return F.size(F.filter(F.col(cdf), lambda c: c <= u))

    one = F.size(F.filter(F.col(cdf), lambda c: c <= F.col(number)))
    many = F.aggregate(F.sequence(F.lit(1), F.col(parts)), F.lit(0), lambda acc, j: acc + draw(j))
    counted = joined.withColumn(number, uniform(F.lit(seed), F.col("doc_id"))).withColumn("n_copies", F.when(F.col(parts) == 1, one).otherwise(many))
    copies = counted.where("n_copies > 0").withColumn("copy", F.explode(F.expr("sequence(0, n_copies - 1)")))
    dealt = copies.drop(source, parts, cdf, number).withColumn(place, F.xxhash64(F.lit(seed), F.col("doc_id"), F.xxhash64("text"), F.col("copy")))
    return dealt.repartition(place).sortWithinPartitions(place).drop(place)
