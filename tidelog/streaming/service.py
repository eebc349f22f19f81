"""The service: a stream of log events to ordered SQL with a durable point.

Each micro-batch runs the batch plan over its events together with a few *carried* ones: of each
file the last format description, of each table id the last map, DDL since the oldest of these,
and the open transaction's GTID and BEGIN. What the carried events say again is cut off by place.
The carried events are a table of their own, written for each batch; the checkpoint is stored
after the sink has everything, so a fault repeats a batch and never skips one. What a batch had
emitted before a fault is noted by place, and the repeated batch goes on behind it; only where the
process itself dies between a statement and the note are statements emitted twice.

The state lies in ``state_dir``, which executors write to: on a cluster, a folder in a shared store.
"""

from __future__ import annotations

import json
import os
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import Config, start_position
from ..functions.binary import le_uint
from ..functions.text import ddl_targets
from ..logs import logger, set_up
from ..operators.gtid import explode_set, serialise
from ..operators.header import counters, sequence_key
from ..operators.metadata import ddl_places
from ..operators.order import by_file
from ..operators.rows import SENT, previous_gtids, table_maps
from ..operators.transactions import durable_points, executed
from ..plans.changes import of_events, read_log
from ..sinks.sql import Checkpoint, SqlSink, load_checkpoint, store_checkpoint
from ..sources.binlog import locate, log_files, register
from ..store import children, discard, remove, stored
from ..types import FORMAT_DESCRIPTION, QUERY, RAW, TABLE_MAP
from .ha import Lease


def carried(raw: DataFrame, marked: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The raw events that the next batch needs; a few for each file in use, table and transaction.

    marked: the same events, read and marked.
    """
    now = marked.agg(F.max(F.struct("seq", "log_file")).alias("m"), F.coalesce(F.max(F.when(F.col("mark") == "C", F.col("seq"))), F.lit(-1)).alias("closed")).first()
    file, closed = now["m"]["log_file"] if now["m"] else None, now["closed"]
    last = Window.partitionBy(le_uint(F.col("payload"), 0, 6)).orderBy(F.desc("seq"))
    maps = marked.where(F.col("type") == TABLE_MAP).withColumn("_n", F.row_number().over(last)).where("_n = 1")
    ddl = (F.col("type") == QUERY) & (F.length("query.query") >= 10) & (F.size(ddl_targets(F.col("query.query"), F.col("query.schema"))) > 0)
    open_ = F.col("mark").isin("G", "B") & (F.col("seq") > closed)
    others = marked.where((F.col("type") == FORMAT_DESCRIPTION) & (F.col("log_file") == file) | ddl | open_)
    places = keep(maps.select("log_file", "start_pos").unionByName(others.select("log_file", "start_pos")))
    return raw.join(F.broadcast(places) if places.count() <= SENT else places, ["log_file", "start_pos"], "left_semi").select("log_file", "start_pos", "body").distinct()


Lookup = Callable[[list[tuple[str, str]]], list[tuple]]


class Pipeline:
    """What ``foreachBatch`` calls; keeps its state under ``state_dir``.

    lookup: asks the server for the columns of (schema, table) pairs, as rows of a catalog; asked
    once for each table, and again after DDL on it. Without one ``catalog`` is used.
    """

    def __init__(self, config: Config, sink: SqlSink, state_dir: str, catalog: DataFrame | None = None, gtid_set: str | None = None, lookup: Lookup | None = None):
        self.config, self.sink, self.state_dir, self.catalog, self.gtid_set, self.lookup = config, sink, state_dir, catalog, gtid_set, lookup
        self.known: dict[tuple[str, str], list[tuple]] = {}
        self.counted = {"packets": 0, "parse_errors": 0, "crc_mismatches": 0, "statements": 0}

    def _state(self, batch_id: int) -> str:
        return f"{self.state_dir}/carried-{batch_id}"

    def run(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        c = self.config
        held: list[DataFrame] = []

        def keep(df: DataFrame) -> DataFrame:  # in files: a plan over persisted tables carries all of their plans, and the driver's work and memory grow with it
            held.append(stored(df))
            return held[-1]

        fresh = batch.select(*[f.split()[0] for f in RAW.split(", ")]).persist()  # a batch is bounded, so memory and disk of the executors hold it
        try:
            first = fresh.agg(F.min(sequence_key(F.col("log_file"), F.col("start_pos"))).alias("s")).first()["s"]
            if first is None:
                return
            before = sorted((int(n.rpartition("-")[2]) for n in children(spark, self.state_dir) if n.startswith("carried-")), reverse=True)
            known = next((k for k in before if k < batch_id), None)
            raw = fresh if known is None else fresh.unionByName(spark.read.schema(RAW).parquet(self._state(known)))
            events, rows = read_log(raw, keep)
            out = keep(of_events(events, rows, self._names(events), c.include_gtid, c.include_coords, c.dedupe_begin, keep).where(F.col("seq") >= first).select("seq", "row_idx", "sql"))
            n = self._emit(out, batch_id)
            new = F.col("seq") >= first
            self._count(fresh, events.where(new), rows.where(new), n, batch_id)
            self._store(events, first, batch_id)
            carried(raw, events, keep).coalesce(1).write.mode("overwrite").parquet(self._state(batch_id))
            for k in before:
                if k < batch_id - 1:  # the last one stays, should this batch be repeated
                    remove(spark, self._state(k))
        finally:
            fresh.unpersist()
            for table in held:
                discard(table)

    def _emit(self, out: DataFrame, batch_id: int) -> int:
        """K2: to the sink, behind what a failed run of the same batch had emitted."""
        path = f"{self.config.checkpoint_file}.emitted"
        try:
            with open(path) as f:
                note = json.load(f)
        except (FileNotFoundError, ValueError):
            note = {}
        self.sink.last = after = tuple(note["last"]) if note.get("batch") == batch_id and note.get("last") else None
        try:
            return self.sink.write(out, after)
        finally:
            with open(f"{path}.tmp", "w") as f:
                json.dump({"batch": batch_id, "last": self.sink.last}, f)
            os.replace(f"{path}.tmp", path)

    def _count(self, fresh: DataFrame, events: DataFrame, rows: DataFrame, statements: int, batch_id: int) -> None:
        """Totals of the run; events that cannot be read are counted and logged, never fatal."""
        now = counters(fresh, events, rows).first().asDict() | {"statements": statements}
        for name, n in now.items():
            self.counted[name] += n
        logger("output").debug("batch %d: %d statements", batch_id, statements)
        if now["parse_errors"] or now["crc_mismatches"]:
            logger("parser").warning("batch %d: %d events cannot be read, %d checksums do not match", batch_id, now["parse_errors"], now["crc_mismatches"])

    def _names(self, events: DataFrame) -> DataFrame | None:
        """The catalog, or what the server says of the tables in this batch; a fault leaves colN."""
        if self.lookup is None:
            return self.catalog
        changed = {(r["schema"], r["table"]) for r in ddl_places(events).select("schema", "table").distinct().collect()}
        self.known = {k: v for k, v in self.known.items() if k not in changed}
        used = [tuple(r) for r in table_maps(events).where("error is null").select("schema", "table").distinct().collect()]
        missing = [t for t in used if t not in self.known]
        try:
            found = self.lookup(missing) if missing else []
        except Exception as e:  # noqa: BLE001  names are a help, the log is what counts
            logger("metadata").warning("no column names: %s", e)
            found = []
        for schema, table, column, ordinal, key in found:
            self.known.setdefault((schema, table), []).append((schema, table, column, int(ordinal), key or ""))
        return events.sparkSession.createDataFrame([r for t in used for r in self.known.get(t, [])], "schema string, table string, column string, ordinal int, column_key string")

    def _store(self, marked: DataFrame, first: int, batch_id: int) -> None:
        """The end of the last commit of this batch and the executed set."""
        spark, point = marked.sparkSession, load_checkpoint(self.config.checkpoint_file)
        ends = durable_points(marked.where(F.col("seq") >= first)).orderBy(*[c.desc() for c in by_file("log_file")]).limit(1).collect()
        if not ends:
            return
        text = (point.gtid_set if point else None) or self.gtid_set or ""
        sets = [explode_set(spark.createDataFrame([(text,)], "t string"), "t"), previous_gtids(marked)]
        done = serialise(executed(marked, *sets)).first()["gtid_set"]
        store_checkpoint(self.config.checkpoint_file, Checkpoint(ends[0]["log_file"], ends[0]["position"], done or None))
        logger("checkpoint").debug("batch %d: %s", batch_id, ends[0])


def start(spark: SparkSession, config: Config, sink: SqlSink, state_dir: str, available_now: bool = False, catalog: DataFrame | None = None, lookup: Lookup | None = None):
    """Starts the stream over ``config.log_dir``, and returns the running query.

    available_now: it ends by itself behind what the log holds now, in as many batches as that takes.
    (The engine's own trigger of that name asks a Python source for one offset only, so it would end
    after the first ``maxEventsPerBatch`` events.)
    """
    register(spark)
    place = start_position(config, load_checkpoint(config.checkpoint_file))
    options = {"path": config.log_dir, "maxEventsPerBatch": str(config.events_per_batch)}
    if place["file"]:
        options |= {"startFile": place["file"], "startPos": str(place["pos"])}
    if place["gtid_set"]:
        options["startGtid"] = place["gtid_set"]
    names = log_files(config.log_dir)
    if available_now and names:
        options |= {"endFile": names[-1], "endPos": str(os.path.getsize(locate(config.log_dir, names[-1])))}
    pipeline = Pipeline(config, sink, f"{state_dir}/carried", catalog, place["gtid_set"], lookup)
    writer = spark.readStream.format("binlog").options(**options).load().writeStream.foreachBatch(pipeline.run)
    writer = writer.option("checkpointLocation", f"{state_dir}/offsets")
    query = writer.trigger(processingTime="0 seconds" if available_now else "1 second").start()
    if available_now:
        threading.Thread(target=_end_when_done, args=(query,), daemon=True).start()
    return query


def _end_when_done(query) -> None:
    try:
        query.processAllAvailable()
        query.stop()
    except Exception:  # noqa: BLE001  a fault of the query is raised by its awaitTermination
        return


def run(spark: SparkSession, config: Config, sink: SqlSink | Callable[[str], None] | None = None, stop: threading.Event | None = None, state_dir: str | None = None) -> int:
    """A1: runs until stopped; 0 if that went well, 1 without a start position or on a fault.

    Without ``log_dir`` events come from the server: a thread stores them as log files, and the
    stream reads those.
    """
    set_up(config.verbosity, config.categories)
    stop = stop or threading.Event()
    sink = sink if isinstance(sink, SqlSink) else SqlSink(config.output if sink is None else None, sink)
    state_dir = state_dir or f"{config.checkpoint_file}.state"
    try:
        place = start_position(config, load_checkpoint(config.checkpoint_file))
    except ValueError as e:
        logger("service").error("%s", e)
        return 1
    lease = Lease(config.ha_lease_file, config.ha_node_id, config.ha_timeout)
    if lease.enabled and not lease.acquire(stop.is_set):
        return 0
    fault: list[BaseException] = []
    lookup = None
    try:
        if config.log_dir is None:
            lookup = None if config.catalog else lambda tables: _columns(config, tables)
            config.log_dir = os.path.join(state_dir, "log")
            threading.Thread(target=_dump, args=(config, place, stop, fault), daemon=True).start()
            while not (stop.is_set() or fault or os.path.isdir(config.log_dir) and os.listdir(config.log_dir)):
                stop.wait(0.2)
        catalog = spark.read.parquet(config.catalog) if config.catalog else None
        query = start(spark, config, sink, state_dir, catalog=catalog, lookup=lookup)
        while query.isActive and not stop.wait(0.2) and not lease.lost.is_set() and not fault:
            pass
        failed = query.exception()
        query.stop()
        for e in [failed, *fault]:
            if e:
                logger("service").error("%s", e)
        return int(bool(failed or fault))
    finally:
        lease.release()


def _columns(config: Config, tables: list[tuple[str, str]]) -> list[tuple]:
    """Columns of tables by a connection of its own, in the form of ``metadata.catalog_columns``."""
    from ..sources.wire import Connection, columns_query, escape

    with Connection(config.host, config.port, config.user, config.password, config.io_timeout_ms / 1000, config.use_tls) as link:
        return link.query(columns_query(tables, escape))


def _dump(config: Config, place: dict, stop: threading.Event, fault: list) -> None:
    from ..sources.wire import Connection, dump_to_files

    def connect() -> Connection:
        return Connection(config.host, config.port, config.user, config.password, config.io_timeout_ms / 1000, config.use_tls)

    try:
        dump_to_files(
            config.log_dir, connect, config.server_id, place["file"], place["pos"], place["gtid_set"], stop.is_set,
            (config.reconnect_delay_ms, config.reconnect_delay_max_ms), lambda s: stop.wait(s),
        )
    except Exception as e:  # noqa: BLE001  reported by the run
        fault.append(e)
