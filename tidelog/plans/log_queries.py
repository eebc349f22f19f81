"""Queries over whole log files: sources, every event kind and column type, sinks, the stream, and the wire's codecs.

``orders`` is written as binary log files with checksums: each order is a transaction that inserts
two rows, updates one with a partial new image, or deletes one by a partial old image; some have DDL
between table map and rows, and some checksums are wrong. The files are read by the data source.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import ddl_targets
from ..operators import gtid as G
from ..operators import header as H
from ..operators import order as O
from ..operators import rows as R
from ..operators import transactions as TX
from ..sinks.sql import Checkpoint, SqlSink, load_checkpoint, store_checkpoint, write_text
from ..sources.binlog import MAGIC, register
from ..store import shared_dir, stored
from ..types import CODES, RAW
from .catalogue import MONEY, _le, query, raw_log, table
from .changes import per_event, read_log, row_changes, statements

SID = "00000000-0000-0000-0000-000000000001"


def encode_event(kind: int, payload: bytes, at: int = 4, ts: int = 1, server: int = 1, flags: int = 0, crc: bool = False) -> bytes:
    size = 19 + len(payload) + 4 * crc
    body = struct.pack("<IBIIIH", ts, kind, server, size, at + size, flags) + payload
    return body + (struct.pack("<I", zlib.crc32(body)) if crc else b"")


def encode_query(text: str, schema: str = "db") -> bytes:
    return struct.pack("<IIBHH", 1, 0, len(schema), 0, 0) + schema.encode() + b"\0" + text.encode()


def encode_map(table_id: int, schema: str, name: str, columns: list[tuple[str, bytes]]) -> bytes:
    """columns: (type name, metadata bytes); all may be null."""
    metas, text = b"".join(m for _, m in columns), lambda s: bytes([len(s)]) + s.encode() + b"\0"
    bits = ((1 << len(columns)) - 1).to_bytes((len(columns) + 7) // 8, "little")
    return table_id.to_bytes(6, "little") + b"\1\0" + text(schema) + text(name) + bytes([len(columns)]) + bytes(CODES[t] for t, _ in columns) + bytes([len(metas)]) + metas + bits


def encode_rows(table_id: int, n: int, images: list[dict[int, bytes | None]], masks: list[int]) -> bytes:
    """A rows event of version 2; an image has the bytes of each column in its mask, None for null."""
    width = (n + 7) // 8
    out = table_id.to_bytes(6, "little") + b"\1\0\2\0" + bytes([n]) + b"".join(m.to_bytes(width, "little") for m in masks)
    for k, image in enumerate(images):
        own = [c for c in range(n) if masks[k % len(masks)] >> c & 1]
        nulls = sum(1 << i for i, c in enumerate(own) if image[c] is None)
        out += nulls.to_bytes((len(own) + 7) // 8, "little") + b"".join(image[c] or b"" for c in own)
    return out


def encode_decimal(cents: int) -> bytes:
    """DECIMAL(15, 2)."""
    whole, part = divmod(abs(cents), 100)
    out = bytearray((whole // 10**9).to_bytes(2, "big") + (whole % 10**9).to_bytes(4, "big") + part.to_bytes(1, "big"))
    out[0] ^= 0x80
    return bytes(x ^ 0xFF for x in out) if cents < 0 else bytes(out)


ORDER_COLUMNS = [("LONGLONG", b""), ("LONGLONG", b""), ("NEWDECIMAL", bytes([15, 2])), ("VARCHAR", struct.pack("<H", 20))]


def order_transaction(key: int, cust: int, cents: int, status: str) -> list[tuple[int, bytes]]:
    full = {0: struct.pack("<q", key), 1: struct.pack("<q", cust), 2: encode_decimal(cents if key % 2 else -cents), 3: bytes([len(status)]) + status.encode()}
    if key % 3 == 0:
        change = (30, encode_rows(7, 4, [full, full | {0: struct.pack("<q", key + 10**6), 1: None}], [15]))
    elif key % 3 == 1:
        change = (31, encode_rows(7, 4, [full, full | {3: None}], [15, 9]))
    else:
        change = (32, encode_rows(7, 4, [full], [1 if key % 2 else 10]))
    ddl = [(2, encode_query("ALTER TABLE orders ADD x INT"))] if key % 50 == 49 else []
    the_map = (19, encode_map(7, "db", "orders", ORDER_COLUMNS))
    return [(33, b"\1" + bytes(15) + b"\1" + struct.pack("<Q", key + 1)), (2, encode_query("BEGIN")), the_map, *ddl, change, (16, struct.pack("<Q", key))]


def log_folder(spark: SparkSession, sf_dir: str) -> str:
    """Writes the files, one for each 1,000 keys, and returns their folder."""
    folder = f"{shared_dir(spark)}/tidelog/{spark.sparkContext.applicationId}/log-{uuid.uuid4().hex}".removeprefix("file:")
    os.makedirs(folder)

    def work(group):
        import pyarrow as pa

        rows = sorted(zip(*(group.column(k).to_pylist() for k in range(5))), key=lambda r: r[1])
        number, first = rows[0][0], rows[0][1]
        previous = struct.pack("<Q", 1) + bytes(15) + b"\1" + struct.pack("<QQQ", 1, 1, first + 1) if first else struct.pack("<Q", 0)
        fmt = struct.pack("<H", 4) + b"8.0.30-log".ljust(50, b"\0") + struct.pack("<IB", 0, 19) + bytes([19, 1])
        parts = [(15, fmt), (35, previous), *[p for r in rows for p in order_transaction(*r[1:])], (4, struct.pack("<Q", 4) + b"mysql-bin.%06d" % (number + 1))]
        out, at = bytearray(MAGIC), 4
        for kind, payload in parts:
            body = bytearray(encode_event(kind, payload, at, crc=True))
            if kind == 16 and struct.unpack("<Q", payload)[0] % 97 == 0:
                body[-1] ^= 1
            out += body
            at += len(body)
        beside = f"{folder}/.{number}"
        with open(beside, "wb") as f:
            f.write(out)
        os.replace(beside, f"{folder}/mysql-bin.{number:06d}")
        return pa.table({"n": [len(parts)]})

    o = table(spark, sf_dir, "orders").select((F.col("o_orderkey").cast("long")).alias("key"), F.col("o_custkey").cast("long"), F.round(F.col("o_totalprice") * 100).cast("long"), "o_orderstatus")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))  # by number: the rows are small, the work on them is not
    o.select(F.floor(F.col("key") / 1000 + 1).cast("long").alias("file"), "*").repartition(parts, "file").groupBy("file").applyInArrow(work, "n long").count()
    return folder


def file_log(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    register(spark)
    return spark.read.format("binlog").options(path=log_folder(spark, sf_dir), **options).load()


def order_catalog(spark: SparkSession) -> DataFrame:
    names = [("o_key", "PRI"), ("o_cust", ""), ("price", ""), ("status", "")]
    return spark.createDataFrame([("db", "orders", n, k, key) for k, (n, key) in enumerate(names, 1)], "schema string, table string, column string, ordinal int, column_key string")


FILES = """WITH o AS (SELECT o_orderkey::BIGINT AS k, o_custkey::VARCHAR AS c, CASE WHEN o_orderkey % 2 = 1 OR o_totalprice = 0 THEN '' ELSE '-' END || """ + MONEY + """ AS p, o_orderstatus AS s,
    'mysql-bin.' || lpad((o_orderkey // 1000 + 1)::VARCHAR, 6, '0') AS log_file FROM orders)"""
_SQL = """, parts AS (
    SELECT k, log_file, 1 AS i, '/* GTID 00000000-0000-0000-0000-000000000001:' || (k + 1)::VARCHAR || ' */' AS sql FROM o
    UNION ALL SELECT k, log_file, 2, 'BEGIN;' FROM o
    UNION ALL SELECT k, log_file, 3, 'ALTER TABLE orders ADD x INT;' FROM o WHERE k % 50 = 49
    UNION ALL SELECT k, log_file, 4, CASE WHEN k % 50 = 49 THEN '/* skipped row event: missing metadata for table_id=7 */;'
        WHEN k % 3 = 0 THEN 'INSERT INTO `db`.`orders` (`o_key`, `o_cust`, `price`, `status`) VALUES (' || k::VARCHAR || ', ' || c || ', ' || p || ', ''' || s || ''');'
        WHEN k % 3 = 1 THEN 'UPDATE `db`.`orders` SET `o_key` = ' || k::VARCHAR || ', `status` = NULL WHERE `o_key` = ' || k::VARCHAR || ';'
        WHEN k % 2 = 1 THEN 'DELETE FROM `db`.`orders` WHERE `o_key` = ' || k::VARCHAR || ';'
        ELSE 'DELETE FROM `db`.`orders` WHERE `o_cust` = ' || c || ' AND `status` = ''' || s || ''';' END FROM o
    UNION ALL SELECT k, log_file, 5, 'INSERT INTO `db`.`orders` (`o_key`, `o_cust`, `price`, `status`) VALUES (' || (k + 1000000)::VARCHAR || ', NULL, ' || p || ', ''' || s || ''');'
        FROM o WHERE k % 3 = 0 AND k % 50 <> 49
    UNION ALL SELECT k, log_file, 6, 'COMMIT;' FROM o)"""


@query(FILES + " SELECT log_file, count(*) * 5 + count(*) FILTER (WHERE k % 50 = 49) + 3 AS n, 4::BIGINT AS first_pos FROM o GROUP BY log_file")
def binlog_source(spark, d):  # S1, S5, S8, T3, T10: the data source
    return file_log(spark, d).groupBy("log_file").agg(F.count("*").alias("n"), F.min("start_pos").alias("first_pos"))


@query(FILES + " SELECT '00000000-0000-0000-0000-000000000001:' || (k + 1)::VARCHAR AS gtid, 1::BIGINT AS n FROM o WHERE k + 1 > 700 AND (k + 1) NOT BETWEEN 900 AND 1300")
def binlog_resume(spark, d):  # S2, S22, J4: transactions of an executed set are left out at the source
    return H.events(file_log(spark, d, startGtid=f"{SID}:1-700:900-1300")).where("gtid is not null").groupBy("gtid").agg(F.count("*").alias("n"))


@query(FILES + """ SELECT log_file, 'format' AS kind, '4 8.0.30-log 19' AS value FROM o GROUP BY log_file
    UNION ALL SELECT log_file, 'rotate', '4 mysql-bin.' || lpad((min(k) // 1000 + 2)::VARCHAR, 6, '0') FROM o GROUP BY log_file UNION ALL SELECT log_file, 'xid', k::VARCHAR FROM o
    UNION ALL SELECT log_file, 'query', 'db ' || 'ALTER TABLE orders ADD x INT' FROM o WHERE k % 50 = 49""")
def binlog_payloads(spark, d):  # D7 to D9, D12
    e = H.events(file_log(spark, d))
    f, r = F.col("format_desc"), F.col("rotate")
    kind = F.when(f.isNotNull(), "format").when(r.isNotNull(), "rotate").when(F.col("xid").isNotNull(), "xid").when(F.col("query.query") != "BEGIN", "query")
    text = F.when(f.isNotNull(), F.concat_ws(" ", f["version"], f["server"], f["header_length"])).when(r.isNotNull(), F.concat_ws(" ", r["position"], r["next_binlog"])).when(F.col("xid").isNotNull(), F.col("xid").cast("string")).otherwise(F.concat_ws(" ", "query.schema", "query.query"))
    return e.select("log_file", kind.alias("kind"), text.alias("value")).where("kind is not null")


@query(FILES + " SELECT '00000000-0000-0000-0000-000000000001' AS sid, 1::BIGINT AS start, min(k) AS \"end\" FROM o GROUP BY log_file HAVING min(k) > 0")
def previous_gtids(spark, d):  # D14
    return R.previous_gtids(H.events(file_log(spark, d)))


@query(FILES + """ SELECT log_file, true AS crc_ok, count(*) * 5 + count(*) FILTER (WHERE k % 50 = 49) - count(*) FILTER (WHERE k % 97 = 0) + 3 AS n FROM o GROUP BY log_file
    UNION ALL SELECT log_file, false, count(*) FROM o WHERE k % 97 = 0 GROUP BY log_file""")
def checksum_verify(spark, d):  # D3 to D6, T8: a mismatch is kept
    return H.events(file_log(spark, d)).groupBy("log_file", "crc_ok").agg(F.count("*").alias("n"))


@query("""WITH s AS (SELECT event_id, event_id // 1000 AS f, CASE WHEN event_id % 97 = 0 THEN event_id % 2 END AS alg FROM events)
    SELECT event_id, coalesce(last_value(alg IGNORE NULLS) OVER (PARTITION BY f ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) = 1 AS checked FROM s""")
def checksum_carry(spark, d):  # D5, D6, T8: a format description each 97 events turns checksums on or off
    e = table(spark, d, "events").select("event_id", (F.col("event_id") % 97 == 0).alias("fmt"), (F.col("event_id") % 2).alias("alg"))
    fixed = F.lit(struct.pack("<H", 4) + bytes(50) + struct.pack("<IB", 0, 19) + bytes([19]))
    payload = F.when(F.col("fmt"), F.concat(fixed, _le(F.col("alg"), 1))).otherwise(F.lit(bytes(8)))
    kind = F.when(F.col("fmt"), _le(F.lit(15), 1)).otherwise(_le(F.lit(3), 1))
    body = F.concat(F.lit(bytes(4)), kind, F.lit(bytes(14)), payload)
    body = F.concat(body, _le(F.crc32(body), 4))
    raw = e.select("event_id", F.concat(F.lit("log."), (F.floor(F.col("event_id") / 1000) + 1).cast("string")).alias("log_file"), F.col("event_id").cast("long").alias("start_pos"), body.alias("body"))
    return H.with_payload(H.with_header(raw)).select("event_id", F.col("crc_ok").isNotNull().alias("checked"))


@query("SELECT doc_id, doc_id % 7 <> 0 AS crc_ok, doc_id % 7 <> 0 AS expected FROM documents")
def crc_check(spark, d):  # D3, D4 against another implementation of the checksum
    def work(batches):
        import pyarrow as pa

        for batch in batches:
            bodies = [t.encode() + struct.pack("<I", zlib.crc32(t.encode()) ^ (i % 7 == 0)) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bodies, pa.binary())], names=["doc_id", "body"])

    bodies = table(spark, d, "documents").select("doc_id", "text").mapInArrow(work, "doc_id long, body binary")
    return bodies.select("doc_id", H.checksum_ok(F.col("body")).alias("crc_ok"), (F.col("doc_id") % 7 != 0).alias("expected"))


@query("""SELECT 'log.000001' AS log_file, event_id::BIGINT * 200 AS start_pos, (1::BIGINT << 40) + event_id::BIGINT * 200 AS seq, event_id::BIGINT * 77777 % 4294967296 AS ts, (event_id % 42)::INTEGER AS type, user_id::BIGINT * 65537 % 4294967296 AS server_id,
    27::BIGINT AS event_size, event_id::BIGINT * 200 + 27 AS next_position, (event_id % 65536)::INTEGER AS flags FROM events""")
def header_fields(spark, d):  # D1: every field
    k = F.col("event_id").cast("long")
    body = F.concat(_le(k * 77777 % (1 << 32), 4), _le(k % 42, 1), _le(F.col("user_id").cast("long") * 65537 % (1 << 32), 4), _le(F.lit(27), 4), _le(k * 200 + 27, 4), _le(k % 65536, 2), F.lit(bytes(8)))
    raw = table(spark, d, "events").select(F.lit("log.000001").alias("log_file"), (k * 200).alias("start_pos"), body.alias("body"))
    return H.with_header(raw).drop("body")


@query("SELECT count(*) * 5 + count(*) FILTER (WHERE o_orderkey % 10 = 3) AS packets, count(*) FILTER (WHERE o_orderkey % 10 = 3) + count(*) FILTER (WHERE o_orderkey % 10 = 4) AS parse_errors, 0::BIGINT AS crc_mismatches FROM orders")
def event_counters(spark, d):  # G6, D18: events cut short, within the header and behind it
    raw = raw_log(spark, d)
    key = (F.regexp_extract("log_file", r"(\d+)$", 1).cast("long") - 1) * 1000 + F.floor((F.col("start_pos") - 4) / 1000)
    xid = F.substring("body", 5, 1) == F.lit(bytes([16]))
    short = raw.where(xid & (key % 10 == 3)).withColumn("body", F.substring("body", 1, 10))
    cut = raw.withColumn("body", F.when(xid & (key % 10 == 4), F.substring("body", 1, 22)).otherwise(F.col("body")))
    return H.counters(cut.unionByName(short))


@query("SELECT count(*) = 0 AS is_empty, 'events' AS what FROM events UNION ALL SELECT true, 'none'")
def gtid_empty(spark, d):  # G5
    spans = table(spark, d, "events").select(F.lit("s").alias("sid"), F.col("event_id").alias("start"), F.col("event_id").alias("end"))
    found = [(G.is_empty(G.merge_intervals(spans)), "events"), (G.is_empty(G.merge_intervals(spans.withColumn("end", F.lit(0)))), "none")]
    return spark.createDataFrame(found, "is_empty boolean, what string")


@query(FILES + """, g AS (SELECT k + 1 AS n, k + 1 - row_number() OVER (ORDER BY k) AS island FROM o)
    SELECT '00000000-0000-0000-0000-000000000001' AS sid, min(n) AS start, max(n) AS "end" FROM g GROUP BY island""")
def log_executed_set(spark, d):  # T1, T2, D13, G2, G7 on binary events
    return TX.executed(read_log(file_log(spark, d))[0])


@query(FILES + " SELECT log_file, 2 * count(*) AS n_marks, max(k) - min(k) + 1 >= count(*) AS ok FROM o GROUP BY log_file")
def transaction_marks(spark, d):  # T2, T9 on binary events: DDL inside a transaction is no commit
    marked = TX.transactions(read_log(file_log(spark, d))[0]).where("mark in ('G', 'C')")
    return marked.groupBy("log_file").agg(F.count("*").alias("n_marks"), (F.max("txn_id") - F.min("txn_id") + 1 == F.count("*") / 2).alias("ok"))


@query(FILES + _SQL + " SELECT log_file, string_agg(sql || chr(10), '' ORDER BY i) AS sql FROM parts WHERE i IN (4, 5) GROUP BY k, log_file")
def row_events_sql(spark, d):  # D10, D11, D15, D17, J2, J3, Q1 to Q5, Q11: one text for each rows event
    made = per_event(statements(file_log(spark, d), order_catalog(spark), include_coords=False))
    return made.where(F.col("sql").rlike("^(INSERT|UPDATE|DELETE|/\\* skipped)")).select("log_file", "sql")


@query(FILES + _SQL + " SELECT log_file, sql || chr(10) AS sql FROM parts")
def log_to_sql_all(spark, d):  # the whole plan: every statement of every kind
    return statements(file_log(spark, d), order_catalog(spark), include_coords=False).select("log_file", "sql")


@query(FILES + _SQL + " SELECT sql AS line FROM parts")
def text_sink(spark, d):  # K3 at scale: a folder of text files
    path = f"{shared_dir(spark)}/tidelog/{spark.sparkContext.applicationId}/sql-{uuid.uuid4().hex}"
    write_text(statements(file_log(spark, d), order_catalog(spark), include_coords=False), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query(FILES + _SQL + """ SELECT row_number() OVER (ORDER BY k, i) AS n, sql AS line FROM parts
    UNION ALL SELECT 0, 'mysql-bin.' || lpad((max(k) // 1000 + 2)::VARCHAR, 6, '0') || ' 4' FROM o""")
def stream_to_sql(spark, d):  # A1, S19, K1 to K5, T2, T5 to T8, T10, B7: the stream, its ordered file, and the durable point (line 0)
    from ..config import Config
    from ..streaming.service import start

    folder = log_folder(spark, d)
    config = Config(log_dir=folder, checkpoint_file=f"{folder}/.point", start_file=sorted(n for n in os.listdir(folder) if n[0] != ".")[0], include_coords=False, decode_queue_size=1 << 20)
    seen = [0]

    def count(_: str) -> None:
        seen[0] += 1

    start(spark, config, SqlSink(f"{folder}/.out", count), f"{folder}/.state", available_now=True, catalog=order_catalog(spark)).awaitTermination()
    point = load_checkpoint(config.checkpoint_file)
    lines, n = numbered_lines(spark, f"{folder}/.out")
    assert seen[0] == n
    return stored(lines.unionByName(spark.createDataFrame([(0, f"{point.file} {point.position}")], "n long, line string")))


def numbered_lines(spark: SparkSession, path: str, most: int = 50_000) -> tuple[DataFrame, int]:
    """((n, line) of a text file in a shared folder, from 1, how many): the driver only looks where each ``most`` lines begin."""
    parts, n, at = [], 0, 0
    with open(path, "rb") as f:
        while lines := list(islice(f, most)):
            size = sum(map(len, lines))
            parts.append((n, at, size))
            n, at = n + len(lines), at + size

    def work(batches):
        import pyarrow as pa

        for batch in batches:
            for first, start, size in zip(*(c.to_pylist() for c in batch.columns)):
                with open(path, "rb") as f:
                    f.seek(start)
                    texts = f.read(size).decode().removesuffix("\n").split("\n")
                yield pa.RecordBatch.from_arrays([pa.array(range(first + 1, first + 1 + len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["n", "line"])

    tasks = spark.createDataFrame(parts, "first long, start long, size long").repartition(max(1, len(parts)))
    return tasks.mapInArrow(work, "n long, line string"), n


@query("SELECT event_id, row_number() OVER (ORDER BY event_id) AS seq_no, lag(event_id) OVER (ORDER BY event_id) AS prev_event_id FROM events")
def file_order(spark, d):  # T1, T3, T4: files go by their number, also from 999999 to 1000000
    name = F.concat(F.lit("mysql-bin."), F.lpad((F.floor(F.col("event_id") / 500) + 999_995).cast("string"), 6, "0"))
    name = F.when(F.col("event_id") >= 2500, F.concat(F.lit("mysql-bin."), (F.floor(F.col("event_id") / 500) + 999_995).cast("string"))).otherwise(name)
    e = table(spark, d, "events").select("event_id", name.alias("log_file"), (F.col("event_id") % 500).alias("start_pos"))
    return O.with_previous(O.with_dense_sequence(e), ["event_id"]).select("event_id", "seq_no", "prev_event_id")


@query("SELECT c_custkey, 'db' AS schema, 't' || c_custkey::VARCHAR || '_' || i::VARCHAR AS \"table\" FROM customer, range(0, 40) r(i)")
def ddl_target_list(spark, d):  # lists of any length
    names = F.transform(F.sequence(F.lit(0), F.lit(39)), lambda i: F.concat(F.lit("t"), F.col("c_custkey").cast("string"), F.lit("_"), i.cast("string")))
    text = F.concat(F.lit("/* "), F.repeat(F.lit("note "), 900), F.lit("*/ DROP TABLE IF EXISTS "), F.array_join(names, ", "))
    return table(spark, d, "customer").select("c_custkey", F.explode(ddl_targets(text, F.lit("db"))).alias("t")).select("c_custkey", "t.schema", "t.table")


# every column type (D16, F9 to F18 in the decoder)
def _types(k: int, name: str) -> list[tuple[str, bytes, bytes]]:
    """(type, metadata, value) of each column of customer ``k``."""
    b = name.encode()
    day, sec = 1 + k % 28, k % 86400
    h, m, s = sec // 3600, sec // 60 % 60, sec % 60
    dt = 0x8000000000 + ((2000 + k % 50) * 13 + 1 + k % 12 << 22 | day << 17 | h << 12 | m << 6 | s)
    one, two = bytes([len(b)]) + b, struct.pack("<H", len(b)) + b
    return [
        ("TINY", b"", struct.pack("<b", k % 256 - 128)), ("SHORT", b"", struct.pack("<h", k % 65536 - 32768)), ("INT24", b"", (k - 500).to_bytes(3, "little", signed=True)),
        ("LONG", b"", struct.pack("<i", -k)), ("LONGLONG", b"", struct.pack("<q", -k * 10**12)), ("FLOAT", b"\4", struct.pack("<f", k / 4)), ("DOUBLE", b"\10", struct.pack("<d", -k / 8)),
        ("TIMESTAMP", b"", struct.pack("<I", k * 1000)), ("YEAR", b"", bytes([k % 200])), ("DATE", b"", ((2000 + k % 50) << 9 | (1 + k % 12) << 5 | day).to_bytes(3, "little")),
        ("TIME", b"", (-(h * 10000 + m * 100 + s)).to_bytes(3, "little", signed=True)), ("DATETIME", b"", struct.pack("<Q", 20240000000000 + (1 + k % 12) * 10**8 + day * 10**6 + h * 10000 + m * 100 + s)),
        ("TIMESTAMP2", b"\2", struct.pack(">IB", k, k % 100)), ("DATETIME2", b"\3", dt.to_bytes(5, "big") + (k % 1000 * 10).to_bytes(2, "big")), ("TIME2", b"\0", (0x800000 + (h << 12 | m << 6 | s)).to_bytes(3, "big")),
        ("BIT", bytes([1, 1]), struct.pack(">H", k % 512)), ("ENUM", b"\1", bytes([1 + k % 9])), ("SET", b"\2", struct.pack("<H", k % 512)), ("VARCHAR", struct.pack("<H", 300), two), ("VAR_STRING", struct.pack("<H", 100), one),
        ("STRING", bytes([0xFE, 100]), one), ("STRING", bytes([0xF7, 1]), bytes([3])), ("TINY_BLOB", b"\1", one), ("BLOB", b"\2", two), ("MEDIUM_BLOB", b"\3", len(b).to_bytes(3, "little") + b),
        ("LONG_BLOB", b"\4", struct.pack("<I", len(b)) + b), ("GEOMETRY", b"\4", struct.pack("<I", len(b)) + b), ("JSON", b"\4", struct.pack("<I", len(b)) + b), ("NEWDECIMAL", bytes([15, 2]), encode_decimal(-k)), ("DECIMAL", b"", b""),
    ]


_HMS = "printf('%02d:%02d:%02d', k % 86400 // 3600, k % 86400 // 60 % 60, k % 60)"
_MD = "printf('%02d-%02d', 1 + k % 12, 1 + k % 28)"
_TEXTS = [
    "(k % 256 - 128)::VARCHAR", "(k % 65536 - 32768)::VARCHAR", "(k - 500)::VARCHAR", "(-k)::VARCHAR", "(-k * 1000000000000)::VARCHAR", "printf('%.6f', k / 4.0)", "printf('%.6f', -k / 8.0)",
    "(k * 1000)::VARCHAR", "(1900 + k % 200)::VARCHAR", f"(2000 + k % 50)::VARCHAR || '-' || {_MD}", f"CASE WHEN k % 86400 = 0 THEN '' ELSE '-' END || {_HMS}", f"'2024-' || {_MD} || ' ' || {_HMS}",
    "k::VARCHAR || '.' || lpad((k % 100)::VARCHAR, 2, '0')", f"(2000 + k % 50)::VARCHAR || '-' || {_MD} || ' ' || {_HMS} || '.' || lpad((k % 1000)::VARCHAR, 3, '0')", _HMS, "(k % 512)::VARCHAR", "(1 + k % 9)::VARCHAR", "(k % 512)::VARCHAR",
    "t", "t", "t", "'3'", "t", "t", "t", "t", "t", "t", "CASE WHEN k = 0 THEN '' ELSE '-' END || (k // 100)::VARCHAR || '.' || lpad((k % 100)::VARCHAR, 2, '0')",
]


@query("WITH c AS (SELECT c_custkey::BIGINT AS k, c_name AS t FROM customer), texts AS (SELECT k, [" + ", ".join(_TEXTS) + "] AS texts FROM c) SELECT k, i::INTEGER AS i, texts[i + 1] AS text FROM texts, range(0, " + str(len(_TEXTS)) + ") r(i)")
def all_types(spark, d):  # D15, D16: 29 column types of one table; absent and null cells are in row_events_sql
    def work(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for k, name in zip(*(batch.column(c).to_pylist() for c in range(2))):
                cells, at = _types(k, name)[:-1], 4
                the_map = encode_map(k, "db", "types", [c[:2] for c in cells])
                change = encode_rows(k, len(cells), [{i: c[2] for i, c in enumerate(cells)}], [(1 << len(cells)) - 1])
                for kind, payload in ((19, the_map), (30, change)):
                    body = encode_event(kind, payload, at)
                    out.append((f"log.{k + 1}", at, body))
                    at += len(body)
            columns = list(zip(*out)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.binary()))], names=["log_file", "start_pos", "body"])

    raw = table(spark, d, "customer").select(F.col("c_custkey").cast("long"), "c_name").mapInArrow(work, RAW)
    return row_changes(raw).select(F.col("table_id").alias("k"), F.posexplode("after").alias("i", "cell")).select("k", "i", F.col("cell.as_string").alias("text"))


# codecs of the wire and the driver's own steps
@query("""WITH c AS (SELECT c_custkey::BIGINT AS k, c_name AS p, unhex(substr(sha1(c_name), 1, 40)) AS nonce FROM customer),
    t AS (SELECT k, p, unhex(sha1(p)) AS a, unhex(sha1(nonce || unhex(sha1(unhex(sha1(p)))))) AS b, unhex(sha256(p)) AS x, unhex(sha256(unhex(sha256(unhex(sha256(p)))) || nonce)) AS y FROM c)
    SELECT k, lower(hex(xor(a::BIT, b::BIT)::BLOB)) AS native, lower(hex(xor(x::BIT, y::BIT)::BLOB)) AS sha2, k * 300 AS number, p AS text, k % 3 = 0 AS ok, k % 3 = 1 AS eof, true AS gtid_round_trip FROM t""")
def wire_codecs(spark, d):  # S3, S4, S9, S13, S14, S17, S23
    def work(batches):
        import hashlib

        import pyarrow as pa

        from ..sources import wire as W

        for batch in batches:
            out = []
            for k, p in zip(*(batch.column(c).to_pylist() for c in range(2))):
                nonce, whole = hashlib.sha1(p.encode()).digest(), W.write_lenenc(k * 300) + W.write_lenenc(len(p)) + p.encode()
                number, at = W.lenenc_int(whole)
                packet = [bytes(7), b"\xfe\0\0\2\0", b"\1abcdefg"][k % 3]
                sid = f"{k:08x}-0000-0000-0000-000000000001"
                binary = W.encode_gtid_set(f"{sid}:1-{k + 1}: {k + 5}\n")
                back = R.decoder.previous_gtids(binary)
                out.append((k, W.native_token(p, nonce).hex(), W.sha2_token(p, nonce).hex(), number, W.lenenc_string(whole, at)[0].decode(), W.is_ok(packet), W.is_eof(packet), back == [(sid, 1, k + 1), (sid, k + 5, k + 5)]))
            names = ["k", "native", "sha2", "number", "text", "ok", "eof", "gtid_round_trip"]
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema=pa.schema(list(zip(names, [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.bool_(), pa.bool_()]))))

    schema = "k long, native string, sha2 string, number long, text string, ok boolean, eof boolean, gtid_round_trip boolean"
    return table(spark, d, "customer").select(F.col("c_custkey").cast("long"), "c_name").mapInArrow(work, schema)


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '-' ELSE 'f.' || event_id::VARCHAR END || ' ' || event_id::VARCHAR || CASE WHEN event_id % 2 = 0 THEN ' a:1-' || event_id::VARCHAR ELSE '' END AS text,
    CASE WHEN event_id % 3 = 0 THEN '' ELSE 'f.' || event_id::VARCHAR END AS file FROM events""")
def checkpoint_text(spark, d):  # S19, K5, B22
    def work(batches):
        import pyarrow as pa

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            points = [Checkpoint.parse(t) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([p.text() for p in points]), pa.array([p.file for p in points])], names=["event_id", "text", "file"])

    k = F.col("event_id").cast("string")
    text = F.concat(F.when(F.col("event_id") % 3 == 0, "").otherwise(F.concat(F.lit("f."), k)), F.lit(" "), k, F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(" a:1-"), k)).otherwise(""))
    return table(spark, d, "events").select(F.col("event_id").cast("long"), text.alias("t")).mapInArrow(work, "event_id long, text string, file string")


@query("""SELECT * FROM (VALUES ('backoff', '0.5 1.0 2.0 4.0 8.0 8.0'), ('lease', 'a takes, b waits, b takes over, a is lost'), ('start', 'x.000001 7 | (none) 4 b:1 | f.000003 99 a:1-5 | error'),
    ('options', '1 f.000001 9 False trace parser 1001'), ('dump', '00000000  61 62 00'), ('point', 'f.000009 12345 A:1-9')) v(what, value)""")
def driver_steps(spark, d):  # S19 to S22, K5, K6, A3 to A7, A12
    from ..cli import parse
    from ..config import Config, start_position
    from ..logs import hex_dump
    from ..sources.wire import backoff
    from ..streaming.ha import Lease

    folder = f"{shared_dir(spark)}/tidelog/{spark.sparkContext.applicationId}/steps-{uuid.uuid4().hex}".removeprefix("file:")
    os.makedirs(folder)
    now, waits = [100.0], backoff(500, 8000)
    a, b = (Lease(f"{folder}/lease", n, 15, lambda: now[0]) for n in "ab")
    lease = [f"a {'takes' if a.try_take() else 'waits'}", f"b {'takes' if b.try_take() else 'waits'}"]
    now[0] += 16
    lease += [f"b {'takes over' if b.try_take() else 'waits'}", f"a is {'kept' if a.beat() else 'lost'}"]

    def place(config, point=None):
        try:
            p = start_position(config, point)
            return " ".join(str(x) for x in (p["file"] or "(none)", p["pos"], p["gtid_set"]) if x is not None)
        except ValueError:
            return "error"

    starts = [place(Config(start_file="x.000001", start_pos=7)), place(Config(start_gtid="b:1")), place(Config(), Checkpoint("f.000003", 99, "a:1-5")), place(Config())]
    c = parse("--user u --password p --port 1 --start-binlog f.000001 --start-pos 9 --no-gtid -vv --log-category parser".split())
    store_checkpoint(f"{folder}/point", Checkpoint("f.000009", 12345, "A:1-9"))
    rows = [
        ("backoff", " ".join(str(next(waits)) for _ in range(6))), ("lease", ", ".join(lease)), ("start", " | ".join(starts)),
        ("options", f"{c.port} {c.start_file} {c.start_pos} {c.include_gtid} {c.verbosity} {c.categories[0]} {c.server_id}"),
        ("dump", hex_dump(b"ab\0")[:18].rstrip()), ("point", load_checkpoint(f"{folder}/point").text()),
    ]
    return spark.createDataFrame(rows, "what string, value string")
