"""Transactions: commit points, grouping, durable points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..types import ANONYMOUS_GTID, GTID, QUERY, ROTATE, XID
from .gtid import as_intervals, committed, union_sets
from .metadata import as_of
from .order import with_running_sum


def query_kind(query: Column) -> Column:
    """begin, commit, savepoint or other."""
    word = F.lower(F.trim(F.regexp_replace(query, r"[;\s]+", " ")))
    return F.when(word.isin("begin", "start transaction"), "begin").when(word.isin("commit", "rollback"), "commit").when(word.rlike(r"^(savepoint|rollback to|release savepoint)\b"), "savepoint").otherwise("other")


def mark(events: DataFrame) -> DataFrame:
    """Adds mark: G announces a GTID, B begins, C commits; null else.

    Commits are XID, COMMIT, and a statement that stands alone: a QUERY that is neither BEGIN nor
    a savepoint, outside an open transaction. Events that are neither (rows, maps) may be left out.
    """
    kind = query_kind(F.col("query.query"))
    own = (
        F.when(F.col("type").isin(GTID, ANONYMOUS_GTID), "G")
        .when(F.col("type") == XID, "C")
        .when((F.col("type") == QUERY) & (kind == "begin"), "B")
        .when((F.col("type") == QUERY) & (kind == "commit"), "C")
        .when((F.col("type") == QUERY) & (kind == "other"), "Q")
    )
    # a statement stands alone if the last border before it is not a BEGIN
    border = F.col("_m").isin("B", "C", "G")
    state = as_of(events.withColumn("_m", own).withColumn("_all", F.lit(1)), border, F.col("_m"), key="_all", order="start_pos", name="_state")
    return state.withColumn("mark", F.when(F.col("_m") != "Q", F.col("_m")).when((F.col("_m") == "Q") & ~F.col("_state").eqNullSafe("B"), F.lit("C"))).drop("_m", "_all", "_state")


def commits(marked: DataFrame) -> DataFrame:
    """(log_file, start_pos, seq, gtid) of commits that apply a GTID."""
    return committed(marked.select("log_file", "start_pos", "seq", F.col("mark").alias("kind"), "gtid"))


def executed(marked: DataFrame, *before: DataFrame) -> DataFrame:
    """Merged intervals of all committed GTIDs, and of the sets ``before``."""
    return union_sets(as_intervals(commits(marked)), *before)


def transactions(marked: DataFrame) -> DataFrame:
    """Events with txn_id, the number of GTIDs announced so far."""
    return with_running_sum(marked, F.when(F.col("mark") == "G", 1).otherwise(0), "txn_id")


def durable_points(marked: DataFrame) -> DataFrame:
    """(log_file, position) up to which each file is applied: the end of its last commit; a rotate names the next file."""
    ends = marked.where("mark = 'C'").groupBy("log_file").agg(F.max("next_position").alias("position"))
    turns = marked.where(F.col("type") == ROTATE).select(F.col("rotate.next_binlog").alias("log_file"), F.col("rotate.position").cast("long").alias("position"))
    return ends.unionByName(turns).groupBy("log_file").agg(F.max("position").alias("position"))
