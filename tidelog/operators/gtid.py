"""GTID sets as relations (sid, start, end): parse, merge, serialise, track, resume."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .order import with_previous

#: Intervals of one server are merged in blocks of so many transaction numbers first.
BLOCK = 1 << 24
#: Transaction numbers of one server that one task compares with an executed set.
SPAN = 1 << 16


def _islands(df: DataFrame, *keys: str) -> DataFrame:
    along = Window.partitionBy(*keys).orderBy("start", "end")
    reach = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    opens = df.withColumn("_new", F.when(reach.isNull() | (F.col("start") > reach + 1), 1).otherwise(0))
    return opens.withColumn("_island", F.sum("_new").over(along)).groupBy(*keys, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_island")


def merge_intervals(df: DataFrame) -> DataFrame:
    """Overlapping or adjacent intervals of a server become one.

    Intervals with a zero end, or that end before they start, are dropped. One server may hold
    almost all intervals, so they are merged within blocks of numbers first, and only what is
    left of a block (in an ordinary set: one interval) meets the other blocks.
    """
    valid = df.select("sid", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end")).where("start > 0 and end >= start")
    blocks = _islands(valid.withColumn("_block", F.floor(F.col("start") / BLOCK)), "sid", "_block")
    return _islands(blocks.select("sid", "start", "end"), "sid")


def parse_set(text: Column) -> Column:
    """Array of (sid, start, end) of a set's text: ``sid:1-3:7,sid2:5``; sections without a colon are skipped."""

    def section(s):
        parts = F.split(s, ":", -1)
        bounds = F.filter(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda x: x != "")

        def interval(x):
            start = F.split_part(x, F.lit("-"), F.lit(1)).try_cast("long")
            end = F.coalesce(F.nullif(F.split_part(x, F.lit("-"), F.lit(2)), F.lit("")).try_cast("long"), F.lit(0))
            return F.struct(parts[0].alias("sid"), start.alias("start"), F.when(end == 0, start).otherwise(end).alias("end"))

        return F.transform(bounds, interval)

    return F.flatten(F.transform(F.split(text, ",", -1), section))


def explode_set(df: DataFrame, column: str) -> DataFrame:
    """(sid, start, end) of all set texts in a column."""
    return df.select(F.explode(parse_set(F.col(column))).alias("i")).select("i.*").where("start is not null")


def serialise(df: DataFrame) -> DataFrame:
    """One row, gtid_set: servers sorted, ``sid:s-e:s-e``; an empty set is the empty text.

    df: merged intervals.
    """
    by = df.groupBy("sid").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("i"))
    text = by.select("sid", F.concat_ws(":", "sid", F.array_join(F.transform("i", lambda x: F.concat_ws("-", x["start"], x["end"])), ":")).alias("t"))
    return text.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("sid", "t"))), lambda x: x["t"]), ",").alias("gtid_set"))


def union_sets(*sets: DataFrame) -> DataFrame:
    """The merged union."""
    both = sets[0].select("sid", "start", "end")
    for s in sets[1:]:
        both = both.unionByName(s.select("sid", "start", "end"))
    return merge_intervals(both)


def is_empty(df: DataFrame) -> bool:
    """G5."""
    return df.isEmpty()


def committed(marks: DataFrame) -> DataFrame:
    """Commit rows with the GTID they apply: the last one announced, if none was applied since.

    marks: log_file, start_pos, kind ('G' or 'C'; other rows are skipped), gtid. A GTID replaced
    before its commit is dropped, and a commit without one is none.
    """
    rows = marks.where(F.col("kind").isin("G", "C"))
    return with_previous(rows, ["kind", "gtid"]).where("kind = 'C' and prev_kind = 'G'").drop("kind", "gtid", "prev_kind").withColumnRenamed("prev_gtid", "gtid")


def as_intervals(df: DataFrame, column: str = "gtid") -> DataFrame:
    """``sid:n`` texts as intervals of one."""
    n = F.substring_index(column, ":", -1).try_cast("long")
    return df.select(F.substring_index(column, ":", 1).alias("sid"), n.alias("start"), n.alias("end")).where("start is not null")


def skip_executed(transactions: DataFrame, executed: DataFrame, sid: str = "sid", gno: str = "gno") -> DataFrame:
    """Transactions that are not in the executed set (intervals, merged or not); one without a server or number stays.

    A number is executed if the intervals that start at or before it reach it. So both are dealt out
    by server and ``SPAN`` of numbers, and each span is gone through once; how far the spans before
    reach is a small table of one row for each span. The set may have any number of intervals.
    """
    done = executed.where("sid is not null and start is not null and end is not null")
    done = done.select(F.col("sid").alias("_sid"), F.col("start").cast("long").alias("_at"), F.col("end").cast("long").alias("_end"))
    asked = transactions.withColumn("_sid", F.col(sid)).withColumn("_at", F.col(gno).cast("long")).withColumn("_end", F.lit(None).cast("long")).withColumn("_asked", F.lit(True))
    both = asked.unionByName(done.withColumn("_asked", F.lit(False)), allowMissingColumns=True).withColumn("_span", F.floor(F.col("_at") / SPAN))
    spans = both.groupBy(F.col("_sid").alias("_s"), F.col("_span").alias("_k")).agg(F.max("_end").alias("_most"))
    before = spans.withColumn("_before", F.max("_most").over(Window.partitionBy("_s").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1))).drop("_most")
    inside = F.max("_end").over(Window.partitionBy("_sid", "_span").orderBy("_at"))  # a range: an interval that starts at the number counts
    joined = both.join(before, (both["_sid"] == before["_s"]) & (both["_span"] == before["_k"]), "left").withColumn("_reach", F.greatest(inside, "_before"))
    return joined.where("_asked").where(~F.coalesce(F.col("_reach") >= F.col("_at"), F.lit(False))).select(transactions.columns)
