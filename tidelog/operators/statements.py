"""Statement synthesis as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import literal, quote_identifier, terminate
from ..types import ANONYMOUS_GTID, GTID, QUERY, XID
from .header import sequence_key

BEGIN, COMMIT = "BEGIN;\n", "COMMIT;\n"


def table_name(schema: Column, table: Column) -> Column:
    return F.concat(quote_identifier(schema), F.lit("."), quote_identifier(table))


def _pairs(cells: Column, columns: Column) -> Column:
    return F.filter(F.arrays_zip(cells.alias("cell"), columns.alias("col")), lambda x: x["cell"]["present"])


def _equal(x: Column) -> Column:
    """``name = literal``, or ``name IS NULL``."""
    name = quote_identifier(x["col"]["name"])
    return F.when(x["cell"]["is_null"], F.concat(name, F.lit(" IS NULL"))).otherwise(F.concat(name, F.lit(" = "), literal(x["cell"])))


def predicate(cells: Column, columns: Column) -> Column:
    """Q5: by the primary key if all of it is present, else by complete unique columns, else by all that is present; null if nothing is."""
    pairs = _pairs(cells, columns)
    text = lambda p: F.array_join(F.transform(p, _equal), " AND ")

    def key(flag: str) -> Column:
        wanted = F.size(F.filter(columns, lambda c: c[flag]))
        found = F.filter(pairs, lambda x: x["col"][flag])
        return F.when((wanted > 0) & (F.size(found) == wanted), text(found))

    uk_present = F.filter(pairs, lambda x: x["col"]["uk"] & ~x["col"]["pk"] & ~x["cell"]["is_null"])
    uk_wanted = F.size(F.filter(columns, lambda c: c["uk"] & ~c["pk"]))
    by_unique = F.when((uk_wanted > 0) & (F.size(uk_present) == uk_wanted), text(uk_present))
    return F.coalesce(key("pk"), by_unique, F.when(F.size(pairs) > 0, text(pairs)))


def insert(schema: Column, table: Column, after: Column, columns: Column) -> Column:
    """Q2: present columns only."""
    pairs = _pairs(after, columns)
    names = F.array_join(F.transform(pairs, lambda x: quote_identifier(x["col"]["name"])), ", ")
    values = F.array_join(F.transform(pairs, lambda x: literal(x["cell"])), ", ")
    return F.concat(F.lit("INSERT INTO "), table_name(schema, table), F.lit(" ("), names, F.lit(") VALUES ("), values, F.lit(");\n"))


def _no_predicate(schema: Column, table: Column) -> Column:
    return F.concat(F.lit("/* skipped row without columns: "), table_name(schema, table), F.lit(" */;\n"))


def update(schema: Column, table: Column, before: Column, after: Column, columns: Column) -> Column:
    """Q3: sets the present columns of the new image where the old one is."""
    sets = F.array_join(F.transform(_pairs(after, columns), lambda x: F.concat(quote_identifier(x["col"]["name"]), F.lit(" = "), literal(x["cell"]))), ", ")
    where = predicate(before, columns)
    made = F.concat(F.lit("UPDATE "), table_name(schema, table), F.lit(" SET "), sets, F.lit(" WHERE "), where, F.lit(";\n"))
    return F.coalesce(F.when(sets != "", made), _no_predicate(schema, table))


def delete(schema: Column, table: Column, before: Column, columns: Column) -> Column:
    """Q4."""
    made = F.concat(F.lit("DELETE FROM "), table_name(schema, table), F.lit(" WHERE "), predicate(before, columns), F.lit(";\n"))
    return F.coalesce(made, _no_predicate(schema, table))


def row_statements(changes: DataFrame) -> DataFrame:
    """Q1, Q11: changes with their statement in ``sql``; a fault becomes a comment statement."""
    s, t, c = F.col("schema"), F.col("table"), F.col("columns")
    comment = F.concat(F.lit("/* "), F.replace(F.col("error"), F.lit("*/"), F.lit("* /")), F.lit(" */;\n"))
    sql = (
        F.when(F.col("error").isNotNull(), comment)
        .when(F.col("op") == "insert", insert(s, t, F.col("after"), c))
        .when(F.col("op") == "update", update(s, t, F.col("before"), F.col("after"), c))
        .otherwise(delete(s, t, F.col("before"), c))
    )
    return changes.withColumn("sql", sql)


def gtid_comment(gtid: Column, include: bool = True) -> Column:
    """Q7."""
    return F.concat(F.lit("/* GTID "), gtid, F.lit(" */\n")) if include else F.lit("")


def coordinates(log_file: Column, start_pos: Column, include: bool = True) -> Column:
    """Q9: nothing without a file."""
    if not include:
        return F.lit("")
    return F.when(log_file.isNotNull() & (log_file != ""), F.concat(F.lit("/* binlog "), log_file, F.lit(":"), start_pos.cast("string"), F.lit(" */\n"))).otherwise(F.lit(""))


def event_statements(marked: DataFrame, include_gtid: bool = True, dedupe_begin: bool = True) -> DataFrame:
    """Q6 to Q8, Q10: (log_file, start_pos, row_idx, sql) of GTID, QUERY and XID events; empty ones are dropped.

    marked: events with ``transactions.mark``. One BEGIN opens a transaction: that of its QUERY,
    not one after the GTID comment. With ``dedupe_begin`` off, each GTID gives one more.
    """
    kind = F.col("type")
    extra = F.lit("") if dedupe_begin else F.lit(BEGIN)
    sql = (
        F.when(F.col("gtid").isNotNull(), F.concat(gtid_comment(F.col("gtid"), include_gtid), extra))
        .when((kind == QUERY) & F.col("query").isNotNull(), terminate(F.col("query.query")))
        .when(kind == XID, F.lit(COMMIT))
    )
    return marked.where(kind.isin(QUERY, XID, GTID, ANONYMOUS_GTID)).select("log_file", "start_pos", F.lit(0).alias("row_idx"), sql.alias("sql")).where("sql is not null and length(sql) > 0")


def assemble(event_sql: DataFrame, row_sql: DataFrame, include_coords: bool = True) -> DataFrame:
    """Q9, Q10: (seq, row_idx, log_file, start_pos, sql) of all statements; coordinates before the first of an event."""
    both = event_sql.unionByName(row_sql.select("log_file", "start_pos", "row_idx", "sql"))
    prefix = F.when(F.col("row_idx") == 0, coordinates(F.col("log_file"), F.col("start_pos"), include_coords)).otherwise(F.lit(""))
    return both.select(sequence_key(F.col("log_file"), F.col("start_pos")).alias("seq"), "row_idx", "log_file", "start_pos", F.concat(prefix, F.col("sql")).alias("sql"))

