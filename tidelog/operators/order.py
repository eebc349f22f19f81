"""Order-dependent operators over the whole log without a single task.

The log is ordered by (file, position) and cut into files; files by their number, then their name,
as mysql-bin.1000000 follows mysql-bin.999999. A window runs inside each file, and what crosses
files (the last row before, the count before) is a small table of one row per file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def file_number(log_file: Column) -> Column:
    """The number at the end of a log file's name; 0 without one."""
    return F.coalesce(F.regexp_extract(log_file.cast("string"), r"(\d+)$", 1).try_cast("long"), F.lit(0))


def by_file(name: str) -> list[Column]:
    """How files are ordered."""
    return [file_number(F.col(name)), F.col(name)]


def with_previous(df: DataFrame, columns: list[str], order: str = "start_pos", file: str = "log_file", prefix: str = "prev_") -> DataFrame:
    """Adds prev_<column>: the value in the row before, over all files."""
    inside = Window.partitionBy(file).orderBy(order)
    ends = df.groupBy(F.col(file).alias("_file")).agg(F.max_by(F.struct(*columns), F.col(order)).alias("_last"))
    ends = ends.withColumn("_before", F.lag("_last").over(Window.orderBy(*by_file("_file")))).select("_file", "_before")  # one row per file
    out = df.join(ends, df[file].eqNullSafe(ends["_file"]), "left").withColumn("_n", F.row_number().over(inside))
    for c in columns:
        out = out.withColumn(prefix + c, F.when(F.col("_n") == 1, F.col("_before")[c]).otherwise(F.lag(c).over(inside)))
    return out.drop("_file", "_before", "_n")


def with_running_sum(df: DataFrame, value: Column, name: str, order: str = "start_pos", file: str = "log_file") -> DataFrame:
    """Adds the running sum of ``value`` over all files."""
    marked = df.withColumn("_v", value.cast("long"))
    totals = marked.groupBy(F.col(file).alias("_file")).agg(F.sum("_v").alias("_total"))
    before = totals.select("_file", (F.sum("_total").over(Window.orderBy(*by_file("_file"))) - F.col("_total")).alias("_sum_before"))  # one row per file
    inside = F.sum("_v").over(Window.partitionBy(file).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return marked.join(before, marked[file].eqNullSafe(before["_file"]), "left").withColumn(name, inside + F.col("_sum_before")).drop("_file", "_v", "_sum_before")


def with_dense_sequence(df: DataFrame, name: str = "seq_no", order: str = "start_pos", file: str = "log_file") -> DataFrame:
    """T4: 1, 2, 3, ... in log order."""
    return with_running_sum(df, F.lit(1), name, order, file)


def with_positions(df: DataFrame) -> DataFrame:
    """The start of each event is the end of the one before; the first of a file starts at 4."""
    inside = Window.partitionBy("log_file").orderBy("next_position")
    return df.withColumn("event_start", F.coalesce(F.lag("next_position").over(inside), F.lit(4)))
