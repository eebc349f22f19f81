"""Arrow-batched decoding of table maps, rows and GTID sets."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.binary import le_uint
from ..types import CHANGES, COLUMN, DELETES, MAPS, PREVIOUS_GTIDS, ROWS, TABLE_MAP, UPDATES
from . import decoder
from .metadata import ddl_places, timeline, with_names

#: Rows of one event that go into one batch at most.
BATCH = 2_000
#: States of a table id that are looked through at once; more are cut into chunks, about as many as a chunk has states.
CHUNK = 256
#: Places of states, or columns of maps, up to which a table of them may be sent to all tasks. In memory they take many
#: times their size on disk, by which the engine decides; a larger table is dealt out with the rows.
SENT = 250_000


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def table_maps(events: DataFrame, *more: str) -> DataFrame:
    """Every TABLE_MAP; one that cannot be decoded has an error and no columns. ``more``: columns of text to keep."""
    ddl = MAPS + "".join(f", {c} string" for c in more)
    schema = _arrow(ddl)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for log_file, start_pos, payload, *kept in zip(*(column.to_pylist() for column in batch.columns)):
                row = {"log_file": log_file, "start_pos": start_pos, "error": None} | dict(zip(more, kept))
                try:
                    row |= decoder.table_map(payload)
                except decoder.DecodeError as e:
                    row |= {"table_id": int.from_bytes(payload[:6], "little"), "error": str(e)}
                out.append(row)
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return events.where(F.col("type") == TABLE_MAP).select("log_file", "start_pos", "payload", *more).mapInArrow(work, ddl)


def previous_gtids(events: DataFrame) -> DataFrame:
    """(sid, start, end) of all PREVIOUS_GTIDS events."""
    ddl = "sid string, start long, end long"
    schema = _arrow(ddl)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for payload in batch.column(0).to_pylist():
                try:
                    out += [dict(zip(("sid", "start", "end"), i)) for i in decoder.previous_gtids(payload)]
                except decoder.DecodeError:
                    continue  # counted by ``header.counters``, as any event that cannot be read
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return events.where(F.col("type") == PREVIOUS_GTIDS).select("payload").mapInArrow(work, ddl)


def bound_rows(events: DataFrame, catalog: DataFrame | None = None, rows: DataFrame | None = None, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Rows events with the table map in force when they were written (null if there is none).

    rows: the rows events, if ``events`` does not hold them. Their payloads meet the places of each
    table id's states, and then the map of the state; if ``keep`` makes these tables first, the engine
    knows their size, and sends them to the rows where they are small instead of dealing these out.
    A table id with many states (DDL all along the log) has them in chunks: a row finds its chunk,
    then its place in it, each by a binary search, so it never carries more than a chunk.
    """
    said = events.where(F.col("type") == TABLE_MAP).select("log_file", "start_pos", "seq", "type", "payload", le_uint(F.col("payload"), 0, 6).alias("table_id"), F.md5("payload").alias("digest"))
    # a log repeats its maps: each distinct one is decoded and named once
    once = said.groupBy("digest").agg(F.min_by(F.struct("log_file", "start_pos", "type", "payload"), "seq").alias("e"))
    decoded = table_maps(once.select("e.*", "digest"), "digest").where("error is null")
    known = with_names(decoded, catalog).select("digest", "schema", "table", "columns")
    known = keep(known) if keep else known
    columns = known.agg(F.sum(F.size("columns"))).first()[0] if keep else 0
    maps = said.join(known.select("digest", "schema", "table"), "digest").select("log_file", "seq", "table_id", F.struct("schema", "table", "digest").alias("map"))
    chunks = state_chunks(timeline(maps, ddl_places(events)).select("table_id", "seq", F.col("map.digest").alias("digest")))
    outer, inner, cut = 0, 0, True
    if keep:
        chunks = keep(chunks)
        n = F.size("starts")
        outer, inner = chunks.agg(F.sum(F.when(F.col("cut"), 1).otherwise(n)), F.sum(F.when(F.col("cut"), n))).first()
        cut = inner is not None
    one = F.min_by(F.struct("starts", "digests"), "chunk")
    firsts = F.transform(F.sort_array(F.collect_list(F.struct("chunk", F.col("starts")[0].alias("seq")))), lambda c: c["seq"])
    ids = chunks.groupBy(F.col("table_id").alias("_id")).agg(F.when(F.first("cut"), firsts).otherwise(one["starts"]).alias("_starts"), F.when(~F.first("cut"), one["digests"]).alias("_digests"))
    own = (events if rows is None else rows).where(F.col("type").isin(*ROWS)).withColumn("table_id", le_uint(F.col("payload"), 0, 6))
    own = own.join(_sized(ids, outer), own["table_id"] == ids["_id"], "left").withColumn("_n", reached(F.col("_starts"), F.col("seq")) - 1)
    own = own.withColumn("_digest", F.get("_digests", "_n")).withColumn("_chunk", F.when(F.col("_digests").isNull(), F.col("_n"))).drop("_id", "_starts", "_digests", "_n")
    if cut:
        parts = chunks.where("cut").select(F.col("table_id").alias("_id"), F.col("chunk").alias("_of"), "starts", "digests")
        own = own.join(_sized(parts, inner), (own["table_id"] == parts["_id"]) & (own["_chunk"] == parts["_of"]), "left")
        own = own.withColumn("_digest", F.coalesce("_digest", F.get("digests", reached(F.col("starts"), F.col("seq")) - 1))).drop("_id", "_of", "starts", "digests")
    whole = known.select(F.col("digest").alias("_said"), F.struct("schema", "table", "columns").alias("map"))
    return own.join(_sized(whole, columns), own["_digest"] == whole["_said"], "left").drop("_chunk", "_digest", "_said")


def _sized(table: DataFrame, n: int | None) -> DataFrame:
    """``table``, never sent to all tasks if it holds more than ``SENT``."""
    return table.hint("merge") if (n or 0) > SENT else table


def state_chunks(states: DataFrame) -> DataFrame:
    """(table_id, chunk, cut, starts, digests) of (table_id, seq, digest): each table id's states in order, in chunks from 0; ``cut`` if there are several."""
    own = Window.partitionBy("table_id")
    size = F.when(F.col("_n") > CHUNK, F.greatest(F.lit(CHUNK), F.ceil(F.sqrt("_n")))).otherwise(F.col("_n"))
    placed = states.withColumn("_n", F.count("*").over(own)).withColumn("chunk", F.floor((F.row_number().over(own.orderBy("seq")) - 1) / size).cast("int"))
    inside = F.sort_array(F.collect_list(F.struct("seq", "digest")))
    found = placed.groupBy("table_id", "chunk", (F.col("_n") > CHUNK).alias("cut")).agg(inside.alias("_s"))
    return found.select("table_id", "chunk", "cut", F.col("_s.seq").alias("starts"), F.col("_s.digest").alias("digests"))


def reached(starts: Column, at: Column) -> Column:
    """How many of the sorted ``starts`` are at or before ``at``, by a binary search; 0 for none or null."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(31))])
    return F.aggregate(steps, F.lit(0), lambda n, step: F.when((step <= F.size(starts) - n) & (F.get(starts, n + step - 1) <= at), n + step).otherwise(n))


def operation(kind: Column) -> Column:
    return F.when(kind.isin(*UPDATES), "update").when(kind.isin(*DELETES), "delete").otherwise("insert")


def changes(events: DataFrame, catalog: DataFrame | None = None, rows: DataFrame | None = None, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One row for each changed row, in the order of ``row_idx`` within its event; ``rows`` and ``keep`` as in ``bound_rows``.

    An event without a table map, or that cannot be decoded, gives one row with an error, and
    no images; rows of it decoded before the fault are dropped, as their end is not certain.
    """
    schema = _arrow(CHANGES)
    kept = ("log_file", "start_pos", "table_id", "schema", "table", "op", "columns")

    def batch_of(batch: pa.RecordBatch, where: list[int], index: list[int], before: _Images, after: _Images, errors: list) -> pa.RecordBatch:
        at = pa.array(where, pa.int64())
        made = {n: batch.column(batch.schema.get_field_index(n)).take(at) for n in kept}
        made |= {"row_idx": pa.array(index, pa.int32()), "before": before.array(schema), "after": after.array(schema), "error": pa.array(errors, pa.string())}
        return pa.RecordBatch.from_arrays([made[n] if made[n].type == schema.field(n).type else made[n].cast(schema.field(n).type) for n in schema.names], schema=schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = where, index, before, after, errors = [], [], _Images(), _Images(), []
            fields = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("table_id", "types", "metas", "type", "payload")]
            for k, (table_id, types, metas, kind, payload) in enumerate(zip(*fields)):
                try:
                    if types is None:
                        raise decoder.DecodeError(f"skipped row event: missing metadata for table_id={table_id}")
                    images, error = decoder.rows_event(kind, payload, types, metas), None
                except decoder.DecodeError as e:
                    images, error = [(None, None)], str(e)
                for n, (old, new) in enumerate(images):
                    where.append(k)
                    index.append(n)
                    before.add(old)
                    after.add(new)
                    errors.append(error)
                    if len(where) >= BATCH:
                        yield batch_of(batch, *out)
                        out = where, index, before, after, errors = [], [], _Images(), _Images(), []
            yield batch_of(batch, *out)

    bound = bound_rows(events, catalog, rows, keep).select(
        "log_file", "start_pos", "table_id", F.col("map.schema").alias("schema"), F.col("map.table").alias("table"),
        operation(F.col("type")).alias("op"), F.col("map.columns").alias("columns"), "type", "payload",
        F.transform("map.columns", lambda c: c["type"].cast("int").bitwiseAND(F.lit(255))).alias("types"), F.col("map.columns.meta").alias("metas"),
    )
    return bound.mapInArrow(work, CHANGES)


class _Images:
    """Row images, kept by field, as an Arrow array is."""

    def __init__(self):
        self.ends: list[int | None] = [0]
        self.size = 0
        self.fields: tuple[list, ...] = ([], [], [], [], [])

    def add(self, cells: list[dict] | None) -> None:
        if cells is None:
            self.ends[-1] = None  # a null list is marked at its start
            self.ends.append(self.size)
            return
        for values, name in zip(self.fields, ("is_null", "present", "type", "raw", "as_string")):
            values.extend(c[name] for c in cells)
        self.size += len(cells)
        self.ends.append(self.size)

    def array(self, schema: pa.Schema) -> pa.Array:
        kind = schema.field("before").type.value_type
        flat = pa.StructArray.from_arrays([pa.array(v, f.type) for v, f in zip(self.fields, kind)], fields=list(kind))
        return pa.ListArray.from_arrays(pa.array(self.ends, pa.int32()), flat).cast(schema.field("before").type)


def typed(changed: DataFrame, schema: str, table: str, columns: list[tuple[str, str]], image: str = "after") -> DataFrame:
    """One table's images as typed columns: columns are (name, Spark type) in order; absent and null are null."""
    own = changed.where((F.col("schema") == schema) & (F.col("table") == table) & F.col(image).isNotNull())

    def value(k: int, kind: str) -> Column:
        cell = F.col(image)[k]
        text = cell["as_string"]
        if kind == "binary":
            return cell["raw"]
        if kind == "timestamp":
            return text.try_cast("decimal(20,6)").cast("timestamp")
        return text.try_cast(kind)

    return own.select("log_file", "start_pos", "row_idx", "op", *[value(k, kind).alias(name) for k, (name, kind) in enumerate(columns)])
