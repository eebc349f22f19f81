"""Queries of every operator over the driver's tables, and the same in DuckDB's SQL.

The operator inventory works on a log, which the tables do not hold; ``change_log`` derives one
from ``events``: signups announce GTIDs and table maps, purchases commit, views and clicks change
rows, errors are DDL. Byte layouts are built from ids and dates, then unpacked by the operators.
"""

from __future__ import annotations

import struct

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import binary as B
from ..functions import temporal as D
from ..functions import text as X
from ..operators import gtid as G
from ..operators import header as H
from ..operators import metadata as M
from ..operators import order as O
from ..operators import rows as R
from ..operators import statements as S
from ..operators import transactions as TX
from ..types import CODES, RAW
from .changes import ordered, read_log, row_changes, statements

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, log_file, start_pos, table_id, sid, gno, kind of each event."""
    e = table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type") == "signup", "G").when(F.col("event_type") == "purchase", "C").when(F.col("event_type") == "error", "D").otherwise("R")
    return e.select(
        (F.col("event_id") + 1).alias("seq"),
        F.concat(F.lit("mysql-bin."), F.lpad((F.floor(F.col("event_id") / 1000) + 1).cast("string"), 6, "0")).alias("log_file"),
        (4 + 100 * (F.col("event_id") % 1000)).alias("start_pos"),
        (F.col("user_id") % 7).alias("table_id"), F.concat(F.lit("s"), (F.col("user_id") % 3).cast("string")).alias("sid"),
        (F.col("event_id") + 1).alias("gno"), kind.alias("kind"),
        F.concat_ws(":", F.concat(F.lit("s"), (F.col("user_id") % 3).cast("string")), (F.col("event_id") + 1).cast("string")).alias("gtid"),
    )


LOG = """WITH log AS (
    SELECT event_id + 1 AS seq, 'mysql-bin.' || lpad((event_id // 1000 + 1)::VARCHAR, 6, '0') AS log_file,
           4 + 100 * (event_id % 1000) AS start_pos, user_id % 7 AS table_id, 's' || (user_id % 3)::VARCHAR AS sid, event_id + 1 AS gno,
           CASE event_type WHEN 'signup' THEN 'G' WHEN 'purchase' THEN 'C' WHEN 'error' THEN 'D' ELSE 'R' END AS kind,
           's' || (user_id % 3)::VARCHAR || ':' || (event_id + 1)::VARCHAR AS gtid
    FROM events)"""


# GTID sets
def _spans(spark, d):
    return change_log(spark, d).where("kind = 'G'").select("sid", F.col("gno").alias("start"), (F.col("gno") + F.col("gno") % 9 - 1).alias("end"))


MERGE = """, spans AS (SELECT sid, gno AS start, gno + gno % 9 - 1 AS "end" FROM log WHERE kind = 'G'),
    good AS (SELECT * FROM spans WHERE start > 0 AND "end" >= start),
    flagged AS (SELECT *, max("end") OVER (PARTITION BY sid ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM good),
    islands AS (SELECT *, sum(CASE WHEN reach IS NULL OR start > reach + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY sid ORDER BY start, "end") AS island FROM flagged),
    merged AS (SELECT sid, min(start) AS start, max("end") AS "end" FROM islands GROUP BY sid, island)"""


@query(LOG + MERGE + ' SELECT sid, start, "end" FROM merged')
def gtid_interval_merge(spark, d):  # G1, G2
    return G.merge_intervals(_spans(spark, d))


@query(LOG + MERGE + """, by_sid AS (SELECT sid, sid || ':' || string_agg(start || '-' || "end", ':' ORDER BY start) AS t FROM merged GROUP BY sid)
    SELECT coalesce(string_agg(t, ',' ORDER BY sid), '') AS gtid_set FROM by_sid""")
def gtid_set_text(spark, d):  # G4
    return G.serialise(G.merge_intervals(_spans(spark, d)))


@query("""WITH parts AS (SELECT 's' || (user_id % 3)::VARCHAR AS sid, event_id % 50 AS a FROM events)
    SELECT sid, a AS start, a + 3 AS "end" FROM parts WHERE a > 0 UNION ALL SELECT sid, a + 9, a + 9 FROM parts""")
def gtid_set_parse(spark, d):  # G3, F8 on every event; a zero start is met once in 50
    e = table(spark, d, "events").selectExpr("concat('s', user_id % 3, ':', event_id % 50, '-', event_id % 50 + 3, ':', event_id % 50 + 9, ',nocolon') AS t")
    return G.explode_set(e, "t").where("start > 0")


@query(LOG + """, marks AS (SELECT *, lag(kind) OVER (ORDER BY seq) AS k, lag(gtid) OVER (ORDER BY seq) AS g FROM log WHERE kind IN ('G', 'C'))
    SELECT seq, log_file, start_pos, g AS gtid FROM marks WHERE kind = 'C' AND k = 'G'""")
def gtid_tracker_committed(spark, d):  # T1, T2
    return G.committed(change_log(spark, d).select("seq", "log_file", "start_pos", "kind", "gtid"))


@query(LOG + """, marks AS (SELECT *, lag(kind) OVER (ORDER BY seq) AS k, lag(sid) OVER (ORDER BY seq) AS s, lag(gno) OVER (ORDER BY seq) AS g FROM log WHERE kind IN ('G', 'C')),
    done AS (SELECT s AS sid, g AS n, g - row_number() OVER (PARTITION BY s ORDER BY g) AS island FROM marks WHERE kind = 'C' AND k = 'G')
    SELECT sid, min(n) AS start, max(n) AS "end" FROM done GROUP BY sid, island""")
def gtid_executed_set(spark, d):  # G7
    return G.union_sets(G.as_intervals(gtid_tracker_committed(spark, d)))


@query(LOG + MERGE + """ SELECT seq, l.sid, gno FROM log l WHERE kind = 'G' AND NOT EXISTS
    (SELECT 1 FROM merged m WHERE m.sid = l.sid AND l.gno BETWEEN m.start + 2 AND m."end")""")
def gtid_resume_skip(spark, d):  # J4, S2
    done = G.merge_intervals(_spans(spark, d)).withColumn("start", F.col("start") + 2).where("start <= end")
    return G.skip_executed(change_log(spark, d).where("kind = 'G'").select("seq", "sid", "gno"), done)


# schema binding
def _maps(spark, d):
    log = change_log(spark, d)
    name = F.concat(F.lit("t"), F.col("table_id").cast("string"))
    return log.withColumn("map", F.struct("seq", F.lit("db").alias("schema"), name.alias("table")))


@query(LOG + """, bound AS (SELECT *, max(CASE WHEN kind = 'G' THEN seq END) OVER w AS map_seq, max(CASE WHEN kind = 'D' THEN seq END) OVER w AS ddl_seq
      FROM log WINDOW w AS (PARTITION BY table_id ORDER BY seq))
    SELECT seq, table_id, CASE WHEN map_seq > coalesce(ddl_seq, 0) THEN map_seq END AS map_seq FROM bound WHERE kind = 'R'""")
def table_map_asof(spark, d):  # J1, J2, T7
    rows = M.as_of(_maps(spark, d).withColumnRenamed("map", "_m"), F.col("kind") == "G", F.col("_m"))
    ddl = change_log(spark, d).where("kind = 'D'").select("log_file", "seq", F.lit("db").alias("schema"), F.concat(F.lit("t"), F.col("table_id").cast("string")).alias("table"))
    return M.valid(rows.where("kind = 'R'"), ddl).select("seq", "table_id", F.col("map.seq").alias("map_seq"))


@query("""SELECT r_name AS "table", n_name AS "column", row_number() OVER (PARTITION BY r_name ORDER BY n_nationkey) AS ordinal,
      n_nationkey % 5 = 0 AS pk, n_nationkey % 5 IN (0, 1) AS uk FROM nation JOIN region ON n_regionkey = r_regionkey""")
def catalog_join(spark, d):  # J3, S18
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    key = F.when(F.col("n_nationkey") % 5 == 0, "PRI").when(F.col("n_nationkey") % 5 == 1, "UNI").otherwise("")
    catalog = n.join(r, n.n_regionkey == r.r_regionkey).select(F.lit("db").alias("schema"), F.col("r_name").alias("table"), F.col("n_name").alias("column"), F.col("n_nationkey").alias("ordinal"), key.alias("column_key"))
    sizes = catalog.groupBy("schema", "table").agg(F.count("*").cast("int").alias("n"))
    maps = sizes.select("schema", "table", *[F.array_repeat(F.lit(v).cast(t), F.col("n")).alias(c) for c, v, t in (("types", 3, "smallint"), ("metas", 0, "int"), ("nullable", True, "boolean"))])
    named = M.with_names(maps, catalog).select("table", F.posexplode("columns"))
    return named.select("table", F.col("col.name").alias("column"), (F.col("pos") + 1).cast("long").alias("ordinal"), "col.pk", "col.uk")


DDL_CASES = [
    "CREATE TABLE t1 (a INT)", "create  table if not exists `s 2`.`t``2` (a int)", "ALTER TABLE db.t3 ADD x INT", "DROP TABLE IF EXISTS a, b.c;",
    "TRUNCATE t4", "RENAME TABLE a TO b, c TO d.e", "CREATE UNIQUE INDEX i ON t5 (a)", "DROP INDEX i ON db.t6", "CREATE OR REPLACE VIEW v AS SELECT 1",
    "CREATE TEMPORARY TABLE tmp (x INT)", "INSERT INTO t1 VALUES (1)", "/* note */ ALTER TABLE t7 DROP y", "BEGIN", "", "drop temporary table tt",
]


@query("""SELECT * FROM (VALUES (0, 'def', 't1'), (1, 's 2', 't`2'), (2, 'db', 't3'), (3, 'def', 'a'), (3, 'b', 'c'), (4, 'def', 't4'), (5, 'def', 'a'), (5, 'def', 'b'),
    (5, 'def', 'c'), (5, 'd', 'e'), (6, 'def', 't5'), (7, 'db', 't6'), (8, 'def', 'v'), (9, 'def', 'tmp'), (11, 'def', 't7'), (14, 'def', 'tt')) v(n, "schema", "table")""")
def ddl_target(spark, d):  # F5 to F7, B26
    cases = spark.createDataFrame(list(enumerate(DDL_CASES)), "n int, q string")
    return cases.select("n", F.explode(X.ddl_targets(F.col("q"), F.lit("def"))).alias("t")).select("n", "t.schema", "t.table")


# order (T3, T4, T9, T2, G6)
@query(LOG + """, g AS (SELECT *, sum(CASE WHEN kind = 'G' THEN 1 ELSE 0 END) OVER (ORDER BY seq)::BIGINT AS txn_id FROM log)
    SELECT txn_id, count(*) AS n, min(seq) AS first_seq, max(seq) AS last_seq FROM g GROUP BY txn_id""")
def txn_groups(spark, d):  # T9
    log = change_log(spark, d).withColumn("mark", F.col("kind"))
    return TX.transactions(log).groupBy("txn_id").agg(F.count("*").alias("n"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))


@query(LOG + " SELECT log_file, start_pos, row_number() OVER (ORDER BY log_file, start_pos) AS seq_no FROM log")
def event_sequence(spark, d):  # T4
    return O.with_dense_sequence(change_log(spark, d).select("log_file", "start_pos"))


@query(LOG + " SELECT log_file, start_pos + 100 AS next_position, coalesce(lag(start_pos + 100) OVER (PARTITION BY log_file ORDER BY start_pos), 4) AS event_start FROM log")
def event_positions(spark, d):  # T3
    return O.with_positions(change_log(spark, d).select("log_file", (F.col("start_pos") + 100).alias("next_position")))


@query(LOG + " SELECT log_file, max(start_pos + 100) AS position FROM log WHERE kind = 'C' GROUP BY log_file")
def durable_points(spark, d):  # T2, K5, B6, B7
    log = change_log(spark, d).select("log_file", (F.col("start_pos") + 100).alias("next_position"), F.col("kind").alias("mark"), F.lit(0).alias("type"), F.lit(None).cast("struct<position:decimal(20,0),next_binlog:string>").alias("rotate"))
    return TX.durable_points(log)


# scalars (B-1 to B-8, F1 to F19)
def _le(x, n):
    h = F.lpad(F.hex(x.cast("long")), 2 * n, "0")
    return F.unhex(F.concat(*[F.substring(h, 2 * k + 1, 2) for k in reversed(range(n))]))


@query("SELECT o_orderkey, o_orderkey * 1000003 AS six, ((o_orderkey * 7919) % 65536) - CASE WHEN (o_orderkey * 7919) % 65536 >= 32768 THEN 65536 ELSE 0 END AS signed, (o_orderkey * 4294967291)::DECIMAL(20,0) AS eight FROM orders")
def le_int_decode(spark, d):  # B-1, B-2
    o = table(spark, d, "orders").select("o_orderkey", _le(F.col("o_orderkey") * 1000003, 6).alias("a"), _le(F.col("o_orderkey") * 7919 % 65536, 2).alias("b"), _le(F.col("o_orderkey") * 4294967291, 8).alias("c"))
    return o.select("o_orderkey", B.le_uint(F.col("a"), 0, 6).alias("six"), B.le_int(F.col("b"), 0, 2).alias("signed"), B.le_uint(F.col("c"), 0, 8).alias("eight"))


@query("SELECT o_orderkey, (o_orderkey % 251)::DECIMAL(20,0) AS one, (o_orderkey % 65536)::DECIMAL(20,0) AS two, (o_orderkey * 5)::DECIMAL(20,0) AS three, 'x' || o_orderkey::VARCHAR AS name FROM orders")
def lenenc_decode(spark, d):  # B-3, B-4
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    name = F.concat(F.lit("x"), k.cast("string")).cast("binary")
    mark = lambda m, x: F.concat(F.unhex(F.lit(m)), x)
    made = o.select("o_orderkey", _le(k % 251, 1).alias("a"), mark("FC", _le(k % 65536, 2)).alias("b"), mark("FE", _le(k * 5, 8)).alias("c"), F.concat(_le(F.length(name), 1), name).alias("d"))
    return made.select("o_orderkey", B.lenenc_int(F.col("a")).alias("one"), B.lenenc_int(F.col("b")).alias("two"), B.lenenc_int(F.col("c")).alias("three"), B.lenenc_string(F.col("d")).cast("string").alias("name"))


@query("SELECT event_id, list_transform(range(0, 10), lambda i: ((event_id % 1024) >> i) & 1 = 1) AS bits FROM events")
def bitmap_decode(spark, d):  # B-5
    return table(spark, d, "events").select("event_id", B.bitmap(_le(F.col("event_id") % 1024, 2), 10).alias("bits"))


@query("SELECT c_custkey, '0x' || lower(hex(encode(c_name))) AS hexed, (c_custkey % 7 + 1) // 2 AS fraction FROM customer")
def hex_literal(spark, d):  # B-6, B-7
    return table(spark, d, "customer").select("c_custkey", B.hex_literal(F.col("c_name").cast("binary")).alias("hexed"), B.fraction_bytes(F.col("c_custkey") % 7).cast("long").alias("fraction"))


@query("WITH h AS (SELECT c_custkey, md5(c_name) AS h FROM customer) SELECT c_custkey, substr(h,1,8)||'-'||substr(h,9,4)||'-'||substr(h,13,4)||'-'||substr(h,17,4)||'-'||substr(h,21,12) AS uuid, true AS round_trip FROM h")
def uuid_text(spark, d):  # B-8, S4
    c = table(spark, d, "customer").select("c_custkey", F.unhex(F.md5(F.col("c_name"))).alias("b"))
    return c.select("c_custkey", B.uuid_text(F.col("b")).alias("uuid"), (B.uuid_bytes(B.uuid_text(F.col("b"))) == F.col("b")).alias("round_trip"))


@query("SELECT o_orderkey, printf('%.6f', o_totalprice) AS fixed FROM orders")
def number_text(spark, d):  # F18
    return table(spark, d, "orders").select("o_orderkey", X.fixed6(F.col("o_totalprice")).alias("fixed"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def date_unpack(spark, d):  # F9
    return table(spark, d, "orders").select("o_orderkey", D.date_text(D.pack_date(F.col("o_orderdate"))).alias("day"))


@query("SELECT o_orderkey, strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%Y-%m-%d %H:%M:%S') || '.' || lpad(((o_orderkey % 1000) * 1000 // 1000)::VARCHAR, 3, '0') AS moment FROM orders")
def datetime2_unpack(spark, d):  # F13, B10, B11
    t = (F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(secs=(F.col("o_orderkey") % 86400).cast("decimal(18,6)"))).alias("t")
    o = table(spark, d, "orders").select("o_orderkey", t)
    return o.select("o_orderkey", D.datetime2_text(D.pack_datetime2(F.col("t")), F.col("o_orderkey") % 1000 * 1000, 3).alias("moment"))


@query("""SELECT event_id, printf('%02d:%02d:%02d', (event_id * 37 % 360000) // 3600, (event_id * 37 % 360000) // 60 % 60, event_id * 37 % 360000 % 60) || '.' || lpad((event_id % 100)::VARCHAR, 2, '0') AS span FROM events""")
def time2_unpack(spark, d):  # F11, B12
    s = F.col("event_id") * 37 % 360000
    return table(spark, d, "events").select("event_id", D.time2_text(D.pack_time2(s, F.col("event_id") % 100 * 10000), 2).alias("span"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 1 THEN '-' ELSE '' END || printf('%02d:%02d:%02d', event_id % 100, event_id % 60, event_id % 59) AS span FROM events")
def time_text(spark, d):  # F10, B13
    k = F.col("event_id")
    packed = (k % 100 * 10000 + k % 60 * 100 + k % 59) * F.when(k % 2 == 1, -1).otherwise(1)
    return table(spark, d, "events").where("event_id % 100 != 0 OR event_id % 2 = 0").select("event_id", D.time_text(packed).alias("span"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS moment FROM orders")
def datetime_split(spark, d):  # F12
    return table(spark, d, "orders").select("o_orderkey", D.datetime_text(F.date_format("o_orderdate", "yyyyMMddHHmmss").cast("long")).alias("moment"))


@query("SELECT o_orderkey, epoch(o_orderdate)::BIGINT::VARCHAR || '.' || lpad((o_orderkey % 10)::VARCHAR, 1, '0') AS epoch, year(o_orderdate)::VARCHAR AS year, (o_orderkey % 65536)::DECIMAL(20,0) AS bits FROM orders")
def epoch_text(spark, d):  # F14 to F17
    o = table(spark, d, "orders")
    seconds = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    be = F.unhex(F.lpad(F.hex(F.col("o_orderkey") % 65536), 4, "0"))
    return o.select("o_orderkey", D.epoch_text(seconds, F.col("o_orderkey") % 10 * 100000, 1).alias("epoch"), D.year_text(F.year("o_orderdate") - 1900).alias("year"), B.be_uint(be).alias("bits"))


# statements
QUOTED = "replace(replace(replace(replace(replace(replace(replace({0}, chr(92), chr(92)||chr(92)), chr(0), chr(92)||'0'), chr(39), chr(92)||chr(39)), chr(34), chr(92)||chr(34)), chr(10), chr(92)||'n'), chr(13), chr(92)||'r'), chr(9), chr(92)||'t')"


def _cell(kind: str, text, present=None, is_null=None):
    return F.struct(
        (is_null if is_null is not None else F.lit(False)).alias("is_null"), (present if present is not None else F.lit(True)).alias("present"),
        F.lit(CODES[kind] - (256 if CODES[kind] > 32767 else 0)).cast("smallint").alias("type"), text.cast("string").cast("binary").alias("raw"), text.cast("string").alias("as_string"),
    )


def _columns(*names: str, pk: tuple = (), uk: tuple = ()):
    return F.array(*[F.struct(F.lit(n).alias("name"), F.lit(3).cast("smallint").alias("type"), F.lit(0).alias("meta"), F.lit(True).alias("nullable"), F.lit(n in pk).alias("pk"), F.lit(n in pk or n in uk).alias("uk")) for n in names])


@query(f"SELECT doc_id, 'INSERT INTO `db`.`docu``ments` (`doc_id`, `text`) VALUES (' || doc_id::VARCHAR || ', ' || chr(39) || {QUOTED.format('text')} || chr(39) || ');' || chr(10) AS sql FROM documents")
def insert_sql(spark, d):  # Q2, F1 to F3
    cells = F.array(_cell("LONGLONG", F.col("doc_id")), _cell("VAR_STRING", F.col("text")), _cell("VAR_STRING", F.col("lang"), present=F.lit(False)))
    return table(spark, d, "documents").select("doc_id", S.insert(F.lit("db"), F.lit("docu`ments"), cells, _columns("doc_id", "text", "lang", pk=("doc_id",))).alias("sql"))


@query(f"""SELECT c_custkey, 'UPDATE `db`.`customer` SET `c_custkey` = ' || c_custkey::VARCHAR || ', `c_name` = ' || CASE WHEN c_custkey % 5 = 0 THEN 'NULL' ELSE chr(39) || {QUOTED.format('c_name')} || chr(39) END
    || ' WHERE `c_custkey` = ' || c_custkey::VARCHAR || ';' || chr(10) AS sql FROM customer""")
def update_sql(spark, d):  # Q3, Q5
    cells = F.array(_cell("LONGLONG", F.col("c_custkey")), _cell("VAR_STRING", F.col("c_name"), is_null=F.col("c_custkey") % 5 == 0))
    return table(spark, d, "customer").select("c_custkey", S.update(F.lit("db"), F.lit("customer"), cells, cells, _columns("c_custkey", "c_name", pk=("c_custkey",))).alias("sql"))


@query(f"""SELECT c_custkey, 'DELETE FROM `db`.`customer` WHERE ' || CASE WHEN c_custkey % 3 = 0 THEN '`c_name` = ' || chr(39) || {QUOTED.format('c_name')} || chr(39)
      ELSE '`c_custkey` = ' || c_custkey::VARCHAR END || ';' || chr(10) AS sql FROM customer""")
def delete_sql(spark, d):  # Q4, Q5, B20
    cells = F.array(_cell("LONGLONG", F.col("c_custkey"), present=F.col("c_custkey") % 3 != 0), _cell("VAR_STRING", F.col("c_name")))
    return table(spark, d, "customer").select("c_custkey", S.delete(F.lit("db"), F.lit("customer"), cells, _columns("c_custkey", "c_name", pk=("c_custkey",), uk=("c_name",))).alias("sql"))


@query("""SELECT l_orderkey, l_linenumber, '`l_orderkey` = ' || l_orderkey::VARCHAR || ' AND `l_linenumber` = ' || l_linenumber::VARCHAR || ' AND `l_returnflag` ' ||
      CASE WHEN l_returnflag = 'R' THEN 'IS NULL' ELSE '= ' || chr(39) || l_returnflag || chr(39) END AS predicate FROM lineitem""")
def predicate_fallback(spark, d):  # Q5, B18
    cells = F.array(_cell("LONGLONG", F.col("l_orderkey")), _cell("LONG", F.col("l_linenumber")), _cell("STRING", F.col("l_returnflag"), is_null=F.col("l_returnflag") == "R"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", S.predicate(cells, _columns("l_orderkey", "l_linenumber", "l_returnflag")).alias("predicate"))


@query("SELECT event_id, replace(replace(props, chr(92), chr(92)||chr(92)), chr(39), chr(39)||chr(39)) AS escaped, starts_with(lower(event_type), 'pu') AS pu, replace(event_type || '`', '`', '') AS bare FROM events")
def metadata_escape(spark, d):  # F4 to F6
    return table(spark, d, "events").select("event_id", X.escape_ansi(F.col("props")).alias("escaped"), X.starts_ci(F.col("event_type"), "PU").alias("pu"), X.strip_ticks(F.concat(F.col("event_type"), F.lit("`"))).alias("bare"))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN chr(10) WHEN 1 THEN event_type || ';' || chr(10) ELSE event_type || ';' || chr(10) END AS sql FROM events")
def query_passthrough(spark, d):  # Q6, F19
    q = F.when(F.col("event_id") % 3 == 0, "").when(F.col("event_id") % 3 == 1, F.col("event_type")).otherwise(F.concat(F.col("event_type"), F.lit(";")))
    return table(spark, d, "events").select("event_id", X.terminate(q).alias("sql"))


@query(LOG + " SELECT seq, '/* binlog ' || log_file || ':' || start_pos::VARCHAR || ' */' || chr(10) AS coords, '/* GTID ' || gtid || ' */' || chr(10) AS gtid, '' AS without FROM log")
def annotations(spark, d):  # Q7 to Q9
    return change_log(spark, d).select("seq", S.coordinates(F.col("log_file"), F.col("start_pos")).alias("coords"), S.gtid_comment(F.col("gtid")).alias("gtid"), F.concat(S.coordinates(F.lit(""), F.col("start_pos")), S.gtid_comment(F.col("gtid"), False)).alias("without"))


@query(LOG + """, parts AS (SELECT seq, log_file, start_pos, CASE kind WHEN 'G' THEN '/* GTID ' || gtid || ' */' || chr(10) WHEN 'C' THEN 'COMMIT;' || chr(10) END AS s FROM log WHERE kind IN ('G', 'C'))
    SELECT row_number() OVER (ORDER BY seq) AS n, '/* binlog ' || log_file || ':' || start_pos::VARCHAR || ' */' || chr(10) || s AS sql FROM parts""")
def ordered_sql(spark, d):  # K1, Q8, Q10
    log = change_log(spark, d).where("kind in ('G', 'C')")
    sql = F.when(F.col("kind") == "G", S.gtid_comment(F.col("gtid"))).otherwise(F.lit(S.COMMIT))
    made = S.assemble(log.select("log_file", "start_pos", F.lit(0).alias("row_idx"), sql.alias("sql")), log.where("false").select("log_file", "start_pos", F.lit(0).alias("row_idx"), F.lit("").alias("sql")))
    return O.with_dense_sequence(ordered(made), "n").select("n", "sql")


# whole events (D1 to D19): orders become a log, which is decoded
def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A real binary log of ``orders``: for each, a transaction with GTID, BEGIN, map, one insert, and XID."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"), F.col("o_orderstatus").alias("status"))

    def work(batches):
        import pyarrow as pa

        fixed = bytes([CODES["LONGLONG"], CODES["LONGLONG"], CODES["NEWDECIMAL"], CODES["VARCHAR"]])
        the_map = (7).to_bytes(6, "little") + b"\1\0" + b"\2db\0" + b"\6orders\0" + b"\4" + fixed + b"\4" + bytes([15, 2]) + struct.pack("<H", 20) + b"\x0c"
        for batch in batches:
            out = []
            for key, cust, cents, status in zip(*(batch.column(k).to_pylist() for k in range(4))):
                whole, part = divmod(cents, 100)
                money = bytearray((whole // 10**9).to_bytes(2, "big") + (whole % 10**9).to_bytes(4, "big") + part.to_bytes(1, "big"))  # 13 digits before the point
                money[0] ^= 0x80
                text = status.encode()
                image = b"\0" + struct.pack("<qq", key, cust) + bytes(money) + bytes([len(text)]) + text
                begin = struct.pack("<IIBHH", 1, 0, 2, 0, 0) + b"db\0BEGIN"
                parts = [(33, b"\1" + bytes(16) + struct.pack("<Q", key + 1)), (2, begin), (19, the_map), (30, (7).to_bytes(6, "little") + b"\1\0\2\0" + b"\4\x0f" + image), (16, struct.pack("<Q", key))]
                at = 4 + 1000 * (key % 1000)
                for kind, payload in parts:
                    size = 19 + len(payload)
                    out.append((f"mysql-bin.{key // 1000 + 1:06d}", at, struct.pack("<IBIIIH", 1, kind, 1, size, at + size, 0) + payload))
                    at += size
            columns = list(zip(*out)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.binary()))], names=["log_file", "start_pos", "body"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return o.repartition(parts, "o_orderkey").mapInArrow(work, RAW)  # one small file is one task otherwise


@query("SELECT t.type, count(*) AS n FROM orders, (VALUES (33), (2), (19), (30), (16)) t(type) GROUP BY t.type")
def header_decode(spark, d):  # D1, D2
    return H.with_header(raw_log(spark, d)).groupBy(F.col("type")).agg(F.count("*").alias("n"))


MONEY = "(round(o_totalprice * 100)::BIGINT // 100)::VARCHAR || '.' || lpad((round(o_totalprice * 100)::BIGINT % 100)::VARCHAR, 2, '0')"


@query(f"SELECT o_orderkey::VARCHAR AS key, o_custkey::VARCHAR AS cust, {MONEY} AS price, o_orderstatus AS status FROM orders")
def rows_decode(spark, d):  # D8 to D17, J1
    found = row_changes(raw_log(spark, d))
    return found.select(*[F.col("after")[k]["as_string"].alias(n) for k, n in enumerate(("key", "cust", "price", "status"))])


@query(f"""SELECT o_orderkey AS k, 'INSERT INTO `db`.`orders` (`col1`, `col2`, `col3`, `col4`) VALUES (' || o_orderkey::VARCHAR || ', ' || o_custkey::VARCHAR || ', ' || {MONEY} || ', ' || chr(39) || o_orderstatus || chr(39) || ');' || chr(10) AS sql FROM orders""")
def log_to_sql(spark, d):  # the whole plan: D1 to D17, J1 to J3, Q1 to Q11
    made = statements(raw_log(spark, d), include_coords=False).where(F.startswith("sql", F.lit("INSERT")))
    return made.select(F.regexp_extract("sql", r"VALUES \((\d+)", 1).cast("long").alias("k"), "sql")


@query("SELECT o_orderkey AS k, '/* skipped row event: missing metadata for table_id=7 */;' || chr(10) AS sql FROM orders")
def parse_error_tolerance(spark, d):  # D18, D19
    raw = H.with_header(raw_log(spark, d)).where("type != 19").select("log_file", "start_pos", "body")
    cut = raw.unionByName(raw.where(F.substring("body", 5, 1) == F.lit(bytes([33]))).withColumn("body", F.substring("body", 1, 10)))  # a fifth again, without a whole header
    found = S.row_statements(R.changes(H.events(cut)))
    key = (F.regexp_extract("log_file", r"(\d+)$", 1).cast("long") - 1) * 1000 + F.floor((F.col("start_pos") - 4) / 1000)
    return found.select(key.alias("k"), "sql")


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: a binary log to ordered SQL."""
    return ordered(statements(raw_log(spark, sf_dir)))
