import os
import socket
import struct
import threading
import time

import encode as E
import pytest
from tidelog import types as T
from tidelog.cli import parse
from tidelog.config import Config, start_position
from tidelog.logs import hex_dump, parse_category
from tidelog.operators.order import with_dense_sequence
from tidelog.operators.transactions import commits
from tidelog.plans.changes import read_log, statements
from tidelog.sinks.sql import Checkpoint, SqlSink, load_checkpoint, store_checkpoint, write_text
from tidelog.sources import binlog, wire
from tidelog.streaming.ha import Lease
from tidelog.streaming.service import Pipeline, run, start

UUID = "01020304050607080900010203040506"


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def transaction(k):
    image = E.image([struct.pack("<i", k), b"\1x"])
    return [
        (33, E.gtid(UUID, k)), (2, E.query("BEGIN")), (19, E.table_map(9, "test", "items", [("LONG", b""), ("VARCHAR", struct.pack("<H", 100))])),
        (30, E.rows(9, 2, [image, image], version=2)), (16, struct.pack("<Q", k)),
    ]


def write_log(folder, file, parts):
    rows = E.log([(15, E.format_description(1)), *parts], file, crc=True)
    (folder / file).write_bytes(binlog.MAGIC + b"".join(bytes(b) for *_, b in rows))
    return rows


@pytest.fixture
def logs(tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    a = [x for k in range(1, 8) for x in transaction(k)] + [(2, E.query("ALTER TABLE items ADD y INT")), (4, struct.pack("<Q", 4) + b"mysql-bin.000002")]
    b = [x for k in range(8, 12) for x in transaction(k)]
    return folder, write_log(folder, "mysql-bin.000001", a) + write_log(folder, "mysql-bin.000002", b)


def texts(df):
    return [r.sql for r in df.orderBy("seq", "row_idx").collect()]


def test_batch_source(spark, logs):
    folder, rows = logs
    binlog.register(spark)
    read = lambda **o: spark.read.format("binlog").options(path=str(folder), **o).load()
    want = [(f, p, bytes(b)) for f, p, b in rows]
    got = lambda df: sorted((r.log_file, r.start_pos, bytes(r.body)) for r in df.collect())
    assert got(read()) == sorted(want)
    assert got(binlog.read_files(spark, str(folder))) == sorted(want)
    assert got(read(startFile="mysql-bin.000002", startPos=str(rows[-1][1]))) == [want[-1]]
    assert got(read().where("log_file = 'mysql-bin.000001'")) == sorted(w for w in want if w[0].endswith("1"))
    with open(folder / "mysql-bin.000002", "ab") as f:
        f.write(b"\0" * 30)  # a part of an event
    assert got(read()) == sorted(want)


@pytest.mark.parametrize("batch", [31, 1000])
def test_stream_equals_batch_and_resumes(spark, logs, tmp_path, batch):
    folder, rows = logs
    want = texts(statements(spark.createDataFrame([(f, p, bytearray(b)) for f, p, b in rows], T.RAW)))
    got, state = [], str(tmp_path / "state")
    config = Config(log_dir=str(folder), checkpoint_file=str(tmp_path / "cp"), start_file="mysql-bin.000001", decode_queue_size=batch, threads=1)
    sink = SqlSink(str(tmp_path / "out.sql"), got.append)

    def until(n):
        query, ends = start(spark, config, sink, state), time.time() + 240
        while len(got) < n and query.isActive and time.time() < ends:
            time.sleep(0.3)
        query.processAllAvailable() if n == len(want) else None
        query.stop()
        assert query.exception() is None

    if batch == 31:
        until(5)  # then a restart goes on where it stopped; a batch cut short comes again
    until(len(want))
    distinct = list(dict.fromkeys(got)) if batch == 31 else got
    assert distinct == list(dict.fromkeys(want)) if batch == 31 else got == want
    assert (tmp_path / "out.sql").read_text() == "".join(got)
    point = load_checkpoint(config.checkpoint_file)
    assert point.gtid_set == "01020304-0506-0708-0900-010203040506:1-11"


def test_executed_transactions_are_left_out(spark, logs):
    folder, rows = logs
    binlog.register(spark)
    read = lambda **o: [(r.log_file, r.start_pos) for r in spark.read.format("binlog").options(path=str(folder), **o).load().collect()]
    sid = "01020304-0506-0708-0900-010203040506"
    left = read(startGtid=f"{sid}:1-6:8, {sid.upper()}:9-9:10-11,x:1")
    starts = [k for k, (_, _, b) in enumerate(rows) if b[4] == 33]
    want = [*rows[: starts[0]], *rows[starts[6] : starts[7]]]
    assert sorted(left) == sorted((f, p) for f, p, _ in want)
    inside = rows[starts[6] + 2]  # a start inside a transaction that is left out
    assert (inside[0], inside[1]) not in read(startFile=inside[0], startPos=str(inside[1]), startGtid=f"{sid}:7")
    assert binlog.Executed("a:5-9:1-20:30").spans["a"] == [(1, 20), (5, 20), (30, 30)]


def test_a_repeated_batch_goes_on_where_it_stopped(spark, tmp_path, logs):
    got, state = [], str(tmp_path / "state")

    def fails_once(sql):
        if len(got) == 7 and not state_of["failed"]:
            state_of["failed"] = True
            raise RuntimeError("the sink is full")
        got.append(sql)

    state_of = {"failed": False}
    folder, rows = logs
    config = Config(log_dir=str(folder), checkpoint_file=str(tmp_path / "cp"), start_file="mysql-bin.000001")
    with pytest.raises(Exception, match="full"):
        start(spark, config, SqlSink(None, fails_once), state, available_now=True).awaitTermination()
    start(spark, config, SqlSink(None, fails_once), state, available_now=True).awaitTermination()
    assert got == texts(statements(spark.createDataFrame([(f, p, bytearray(b)) for f, p, b in rows], T.RAW)))


def test_column_names_come_from_the_server_once_and_again_after_ddl(spark, tmp_path):
    asked, got = [], []

    def lookup(tables):
        asked.append(tables)
        if len(asked) == 1:
            raise OSError("not yet")
        return [("test", "items", "label", "2", None), ("test", "items", "id", "1", "PRI")]

    pipeline = Pipeline(Config(checkpoint_file=str(tmp_path / "cp")), SqlSink(None, got.append), str(tmp_path / "carried"), lookup=lookup)
    ddl = [(2, E.query("ALTER TABLE items ADD y INT"))]
    at = 4
    for k, parts in enumerate([transaction(1), transaction(2), transaction(3), [*ddl, *transaction(4)]]):
        rows = E.log(parts, start=at)
        at = rows[-1][1] + len(rows[-1][2])
        pipeline.run(spark.createDataFrame(rows, T.RAW), k)
    assert asked == [[("test", "items")]] * 3  # refused, answered, known, and again after the DDL
    inserts = [s.split("(")[1][:13] for s in got if "INSERT" in s]
    assert inserts == ["`col1`, `col2"] * 2 + ["`id`, `label`"] * 6
    assert pipeline.counted["packets"] == 21 and pipeline.counted["parse_errors"] == 0


def test_files_are_ordered_by_number(spark):
    a = E.log([(33, E.gtid(UUID, 1)), (2, E.query("BEGIN")), (19, E.table_map(9, "test", "items", [("LONG", b"")]))], "mysql-bin.999999")
    b = E.log([(30, E.rows(9, 1, [E.image([struct.pack("<i", 5)])], version=2)), (16, struct.pack("<Q", 1))], "mysql-bin.1000000")
    raw = spark.createDataFrame([(f, p, bytearray(x)) for f, p, x in a + b], T.RAW)
    events, _ = read_log(raw)
    assert [r.gtid[-2:] for r in commits(events).collect()] == [":1"]
    assert [s for s in texts(statements(raw, include_coords=False)) if "INSERT" in s] == ["INSERT INTO `test`.`items` (`col1`) VALUES (5);\n"]
    order = with_dense_sequence(raw.select("log_file", "start_pos")).orderBy("seq_no").collect()
    assert [r.log_file[-2:] for r in order] == ["99"] * 3 + ["00"] * 2


def test_run_needs_a_start_and_stops(spark, logs, tmp_path):
    config = Config(log_dir=str(logs[0]), checkpoint_file=str(tmp_path / "cp"))
    assert run(spark, config, [].append) == 1
    config.start_file = "mysql-bin.000001"
    config.ha_lease_file = str(tmp_path / "lease")
    got, stop = [], threading.Event()

    def stop_after_the_first():
        ends = time.time() + 240
        while not got and time.time() < ends:
            time.sleep(0.3)
        stop.set()

    threading.Thread(target=stop_after_the_first).start()
    assert run(spark, config, got.append, stop) == 0 and got


def test_start_positions():
    point = Checkpoint("f.000003", 99, "a:1-5")
    assert start_position(Config(start_file="x.000001", start_pos=7), point) == {"file": "x.000001", "pos": 7, "gtid_set": None}
    assert start_position(Config(start_gtid="b:1"), point) == {"file": "", "pos": 4, "gtid_set": "b:1"}
    assert start_position(Config(), point) == {"file": "f.000003", "pos": 99, "gtid_set": "a:1-5"}
    with pytest.raises(ValueError):
        start_position(Config(), None)


def test_checkpoints(tmp_path):
    path = str(tmp_path / "cp")
    assert load_checkpoint(path) is None
    for point in (Checkpoint("mysql-bin.000009", 12345, "A:1-9"), Checkpoint("binlog.000001", 123), Checkpoint("", 4, "1bc:1-5")):
        store_checkpoint(path, point)
        assert load_checkpoint(path) == point
    assert Checkpoint.parse(" 4 1bc:1-5") == Checkpoint("", 4, "1bc:1-5")
    assert Checkpoint.parse("junk") is None and os.listdir(tmp_path) == ["cp"]


def test_sinks_order_statements(spark, tmp_path, capsys):
    df = spark.createDataFrame([(2, 0, "second;\n"), (1, 0, "first;\n"), (3, 1, "fourth;\n"), (3, 0, "third;\n")], T.STATEMENTS)
    got = []
    assert SqlSink("-", got.append).write(df) == 4
    assert got == ["first;\n", "second;\n", "third;\n", "fourth;\n"] and capsys.readouterr().out.endswith("".join(got))
    write_text(df, str(tmp_path / "text"))
    files = sorted(p for p in (tmp_path / "text").iterdir() if p.name.startswith("part-"))
    assert "".join(p.read_text() for p in files) == "".join(got)
    with pytest.raises(OSError):
        SqlSink(str(tmp_path / "no" / "such")).write(df)


def test_lease(tmp_path):
    now = [100.0]
    a, b = (Lease(str(tmp_path / "lease"), n, 15, lambda: now[0]) for n in "ab")
    assert a.try_take() and a.try_take() and not b.try_take()
    now[0] += 16
    assert b.try_take() and not a.try_take() and a.read()[0] == "b"
    c = Lease(str(tmp_path / "lease2"), "c", 0.2)
    assert c.acquire()
    Lease(str(tmp_path / "lease2"), "d")._write()
    assert c.lost.wait(2)
    c.release()
    assert not Lease("", "x").acquire()


def test_a_lease_that_went_stale_is_lost(tmp_path):
    now = [100.0]
    a, b = (Lease(str(tmp_path / "lease"), n, 15, lambda: now[0]) for n in "ab")
    assert a.try_take() and a.beat()
    now[0] += 16  # a stalls: whether or not b took over meanwhile, a must not go on
    assert not a.beat() and b.try_take() and not a.beat() and b.beat() and b.read()[0] == "b"


def test_command_line():
    c = parse("--user u --password p --port 1 --start-binlog f.000001 --start-pos 9 --no-gtid --no-binlog-coords --ssl -vv --log-category parser --ha-timeout 3".split())
    assert (c.port, c.start_file, c.start_pos, c.include_gtid, c.include_coords, c.use_tls, c.verbosity, c.categories, c.ha_timeout) == (1, "f.000001", 9, False, False, True, "trace", ("parser",), 3)
    assert parse(["--user", "u", "--password", "p"]).server_id == 1001
    for bad in (["--user", "u"], ["--user", "u", "--password", "p", "--port"], ["--user", "u", "--password", "p", "--log-category", "x"]):
        with pytest.raises(SystemExit):
            parse(bad)
    with pytest.raises(ValueError):
        parse_category("x")
    assert hex_dump(b"ab\0").startswith("00000000  61 62 00")
    assert "hunter2" not in repr(Config(password="hunter2"))


class Server(threading.Thread):
    """A server on loopback that logs in, answers one query, and dumps a log."""

    def __init__(self, events, plugin, full=False):
        super().__init__(daemon=True)
        self.events, self.plugin, self.full, self.seen = events, plugin, full, []
        self.sock = socket.create_server(("127.0.0.1", 0))
        self.port = self.sock.getsockname()[1]

    def run(self):
        sock, _ = self.sock.accept()
        link = wire.Connection("", 0, "", sock=sock)
        nonce = bytes(range(1, 21))
        able = wire.PROTOCOL_41 | wire.SECURE | wire.PLUGIN_AUTH
        link.write_packet(b"\x0a8.0\0" + struct.pack("<I", 1) + nonce[:8] + b"\0" + struct.pack("<HBHHB10x", able & 0xFFFF, 45, 0, able >> 16, 21) + nonce[8:] + b"\0" + wire.NATIVE.encode() + b"\0")
        answer = link.read_packet()
        assert wire.native_token("secret", nonce) in answer and b"repl\0" in answer
        if self.plugin != wire.NATIVE:
            link.write_packet(b"\xfe" + self.plugin.encode() + b"\0" + nonce[::-1] + b"\0")
            assert link.read_packet() == wire.sha2_token("secret", nonce[::-1])
            link.write_packet(b"\1\3")
        link.write_packet(b"\0\0\0\2\0\0\0")
        while True:
            try:
                command = link.read_packet()
            except ConnectionError:
                return
            self.seen.append(command)
            if command[1:7] == b"SELECT":
                row = wire.write_lenenc(1) + b"a" + b"\xfb"
                for packet in (b"\2", b"def1", b"def2", b"\xfe\0\0\2\0", row, b"\xfe\0\0\2\0"):
                    link.write_packet(packet)
            elif command[0] == wire.COM_QUERY:
                link.write_packet(b"\0\0\0\2\0\0\0")
            else:
                for body in self.events:
                    link.write_packet(b"\0" + body)
                link.write_packet(b"\xfe\0\0\2\0")


@pytest.mark.parametrize("plugin", [wire.NATIVE, wire.SHA2])
def test_wire_reader(tmp_path, plugin):
    rows = E.log([(15, E.format_description(1)), *transaction(1)], crc=True)
    rotate = E.event(4, struct.pack("<Q", 4) + b"mysql-bin.000001", 0)[:13] + b"\0\0\0\0\x20\0" + struct.pack("<Q", 4) + b"mysql-bin.000001"
    server = Server([rotate, *[bytes(b) for *_, b in rows]], plugin)
    server.start()
    connect = lambda: wire.Connection("127.0.0.1", server.port, "repl", "secret", 5)
    wire.dump_to_files(str(tmp_path), connect, 7, "", 4, f"{UUID[:8]}-0506-0708-0900-010203040506:1-3:7")
    assert [b for _, b in binlog.read_events(str(tmp_path / "mysql-bin.000001"))] == [bytes(b) for *_, b in rows]
    dump = server.seen[-1]
    assert dump[0] == wire.COM_BINLOG_DUMP_GTID and dump.endswith(bytes.fromhex(UUID) + struct.pack("<QQQQQ", 2, 1, 4, 7, 8))
    other = Server([], plugin)
    other.start()
    with wire.Connection("127.0.0.1", other.port, "repl", "secret", 5) as link:
        assert link.query("SELECT x") == [("a", None)]
        assert list(link.dump(7, "f.000001", 9)) == []
    assert other.seen[-1] == bytes([wire.COM_BINLOG_DUMP]) + struct.pack("<IHI", 9, 0, 7) + b"f.000001"


def test_wire_codecs():
    for n in (0, 250, 251, 65535, 65536, 1 << 24, 1 << 40):
        assert wire.lenenc_int(wire.write_lenenc(n))[0] == n
    assert wire.lenenc_int(b"\xfb") == (None, 1)
    waits = wire.backoff(500, 8000)
    assert [next(waits) for _ in range(6)] == [0.5, 1, 2, 4, 8, 8]
    assert wire.parse_uuid("x") is None and wire.encode_gtid_set("junk") == bytes(8)
    with pytest.raises(wire.ServerError):
        wire.Connection._check(b"\xff\x10\x04#08004Too many")


def test_a_run_that_ends_by_itself_takes_as_many_batches_as_the_log_needs(spark, logs, tmp_path):
    folder, rows = logs
    want = texts(statements(spark.createDataFrame([(f, p, bytearray(b)) for f, p, b in rows], T.RAW)))
    got = []
    config = Config(log_dir=str(folder), checkpoint_file=str(tmp_path / "cp"), start_file="mysql-bin.000001", decode_queue_size=40, threads=1)
    start(spark, config, SqlSink(None, got.append), str(tmp_path / "state"), available_now=True).awaitTermination()
    assert got == want and len(rows) > 40


def test_small_files_share_a_task_and_large_ones_have_their_own(spark, logs, monkeypatch):
    folder, rows = logs
    reader = binlog.BinlogStreamReader({"path": str(folder)})
    whole = lambda: reader.partitions(reader.initialOffset(), reader.latestOffset())
    read = lambda tasks: [(f, p, b) for t in tasks for batch in reader.read(t) for f, p, b in zip(*(c.to_pylist() for c in batch.columns))]
    assert len(whole()) == 1 and read(whole()) == [(f, p, bytes(b)) for f, p, b in rows]
    monkeypatch.setattr(binlog, "TASK_BYTES", 100)
    assert len(whole()) == 2 and read(whole()) == [(f, p, bytes(b)) for f, p, b in rows]


def test_a_file_has_what_the_callback_has_taken(spark, tmp_path):
    df = spark.createDataFrame([(k, 0, f"é{k};\n") for k in range(50)], T.STATEMENTS)
    got = []

    def refuses(sql):
        if len(got) == 20 and "20" in sql and not failed:
            failed.append(sql)
            raise RuntimeError("the sink is full")
        got.append(sql)

    failed = []
    sink = SqlSink(str(tmp_path / "out.sql"), refuses)
    with pytest.raises(RuntimeError, match="full"):
        sink.write(df)
    assert (tmp_path / "out.sql").read_text() == "".join(got) and sink.last == (19, 0)
    assert sink.write(df, sink.last) == 30
    assert (tmp_path / "out.sql").read_text() == "".join(got) == "".join(f"é{k};\n" for k in range(50))


def test_a_batch_is_planned_over_files_not_over_the_plans_before(spark, tmp_path, monkeypatch):
    sizes = []
    sink = SqlSink(None, lambda s: None)
    monkeypatch.setattr(sink, "write", lambda df, after: sizes.append(len(df._jdf.queryExecution().toString())) or 0)
    pipeline = Pipeline(Config(checkpoint_file=str(tmp_path / "cp")), sink, str(tmp_path / "carried"))
    pipeline.run(spark.createDataFrame(E.log(transaction(1)), T.RAW), 0)
    assert sizes[0] < 20_000
