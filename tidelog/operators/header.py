"""Event headers and fixed-layout payloads as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binary import byte_at, le_uint, uuid_text
from ..types import ANONYMOUS_GTID, FORMAT_DESCRIPTION, GTID, HEADER, QUERY, ROTATE, XID
from .order import file_number


def sequence_key(log_file: Column, start_pos: Column) -> Column:
    """T4: a sortable number of the place in the log: file number, then position; gaps are fine."""
    return F.shiftleft(file_number(log_file), 40) + start_pos


def with_header(raw: DataFrame) -> DataFrame:
    """Header fields; events too short for a header are dropped (see ``counters``)."""
    b = F.col("body")
    return raw.where(F.length(b) >= HEADER).select(
        "*", sequence_key(F.col("log_file"), F.col("start_pos")).alias("seq"),
        le_uint(b, 0, 4).alias("ts"), byte_at(b, 4).alias("type"), le_uint(b, 5, 4).alias("server_id"),
        le_uint(b, 9, 4).alias("event_size"), le_uint(b, 13, 4).alias("next_position"), le_uint(b, 17, 2).cast("int").alias("flags"),
    )


def checksum_algorithm(body: Column) -> Column:
    """Of a FORMAT_DESCRIPTION event; 0 is off, 1 is CRC32."""
    return F.when(F.length(body) < 25, F.lit(0)).otherwise(byte_at(body, F.length(body) - 5))


def checksum_ok(body: Column) -> Column:
    """Whether the last four bytes are the CRC32 of what is before them."""
    return F.crc32(F.substring(body, F.lit(1), F.length(body) - 4)) == le_uint(body, F.length(body) - 4, 4)


def formats(events: DataFrame) -> DataFrame:
    """(file, formats): places and checksum algorithms of each file's FORMAT_DESCRIPTION events, one or a few."""
    found = F.struct("start_pos", checksum_algorithm(F.col("body")).alias("alg"))
    return events.where(F.col("type") == FORMAT_DESCRIPTION).groupBy(F.col("log_file").alias("_file")).agg(F.sort_array(F.collect_set(found)).alias("_formats"))


def with_payload(events: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Payload without header and checksum, and crc_ok (null without checksums; a mismatch is kept).

    The algorithm is that of the last FORMAT_DESCRIPTION before the event in its file, of
    ``known`` (``formats`` of the same log) or of the events themselves; no window over the log.
    """
    before = F.filter("_formats", lambda f: f["start_pos"] <= F.col("start_pos"))
    alg = F.coalesce(F.try_element_at(before, F.lit(-1))["alg"], F.lit(0))
    on = (F.col("_alg") == 1) & (F.length("body") >= HEADER + 4)
    size = F.length("body") - F.when(on, HEADER + 4).otherwise(HEADER)
    own = formats(events) if known is None else known
    return (
        events.join(own, events["log_file"] == own["_file"], "left")
        .withColumn("_alg", alg)
        .withColumn("crc_ok", F.when(on, checksum_ok(F.col("body"))))
        .withColumn("payload", F.substring("body", F.lit(HEADER + 1), size))
        .drop("_file", "_formats", "_alg", "body")
    )


def fixed_payloads(events: DataFrame) -> DataFrame:
    """One nullable struct for each kind of fixed layout."""
    p, kind = F.col("payload"), F.col("type")
    cut = lambda at, n=None: F.substring(p, F.lit(at + 1) if isinstance(at, int) else at + 1, n if n is not None else F.length(p))
    text = lambda b: F.make_valid_utf8(b.cast("string"))
    format_description = F.struct(
        le_uint(p, 0, 2).cast("int").alias("version"), F.split(text(cut(2, F.lit(50))), "\\x00")[0].alias("server"),
        le_uint(p, 52, 4).alias("created"), byte_at(p, 56).alias("header_length"),
    )
    schema_length, status = byte_at(p, 8), le_uint(p, 11, 2).cast("int")
    query = F.struct(
        text(F.substring(p, F.lit(14) + status, schema_length)).alias("schema"),
        text(F.substring(p, F.lit(15) + status + schema_length, F.length(p))).alias("query"),
    )
    rotate = F.struct(le_uint(p, 0, 8).alias("position"), text(cut(8)).alias("next_binlog"))
    gtid = F.concat_ws(":", uuid_text(p, 1), le_uint(p, 17, 8).cast("string"))
    return (
        events.withColumn("format_desc", F.when((kind == FORMAT_DESCRIPTION) & (F.length(p) >= 57), format_description))
        .withColumn("query", F.when((kind == QUERY) & (F.length(p) >= 13), query))
        .withColumn("rotate", F.when((kind == ROTATE) & (F.length(p) >= 8), rotate))
        .withColumn("xid", F.when((kind == XID) & (F.length(p) >= 8), le_uint(p, 0, 8)))
        .withColumn("gtid", F.when(kind.isin(GTID, ANONYMOUS_GTID) & (F.length(p) >= 25), gtid))
    )


def events(raw: DataFrame) -> DataFrame:
    """Headers, payloads and fixed layouts of raw events (log_file, start_pos, body)."""
    return fixed_payloads(with_payload(with_header(raw)))


def counters(raw: DataFrame, *read: DataFrame) -> DataFrame:
    """One row: packets, parse_errors (no header, or a payload its kind cannot have), and by checksum.

    read: the events of ``raw`` with their payloads, if they are at hand; those without ``fixed_payloads`` are rows.
    """

    def told(df: DataFrame) -> DataFrame:
        bad = (F.col("type") == QUERY) & F.col("query").isNull() | (F.col("type") == XID) & F.col("xid").isNull()
        return df.select((bad if "query" in df.columns else F.lit(False)).alias("bad"), "crc_ok")

    found = reduce(DataFrame.unionByName, [told(df) for df in read or [events(raw)]])
    short = raw.agg(F.count("*").alias("packets"), F.sum(F.when(F.length("body") < HEADER, 1).otherwise(0)).alias("short"))
    rest = found.agg(F.sum(F.when(F.col("bad"), 1).otherwise(0)).alias("bad"), F.sum(F.when(~F.col("crc_ok"), 1).otherwise(0)).alias("crc_mismatches"))
    zero = F.lit(0).cast("long")
    return short.join(rest, F.lit(True)).select("packets", (F.coalesce("short", zero) + F.coalesce("bad", zero)).alias("parse_errors"), F.coalesce("crc_mismatches", zero).alias("crc_mismatches"))
