"""The batch plan: raw events to ordered SQL. Streaming runs the same functions on each batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.header import fixed_payloads, formats, with_header, with_payload
from ..operators.rows import SENT, changes
from ..operators.statements import assemble, event_statements, row_statements
from ..operators.transactions import mark
from ..store import stored
from ..types import ROWS


def read_log(raw: DataFrame, keep=stored) -> tuple[DataFrame, DataFrame]:
    """(events, rows): all events but rows events, read and marked, and the rows events with their payloads.

    The log is read twice in all: once for the small events, which are kept (``stored``) as several steps look at them, and once for the rows, whose payloads are never
    kept or shuffled. Header fields that no step asks for are not made.
    """
    headed = with_header(raw).drop("ts", "server_id", "event_size", "flags")
    of_rows = F.col("type").isin(*ROWS)
    small = keep(headed.where(~of_rows))
    known = file_formats(small, keep)
    return keep(mark(fixed_payloads(with_payload(small, known)))), with_payload(headed.where(of_rows), known)


def file_formats(small: DataFrame, keep=stored) -> DataFrame:
    """``formats``, made once; sent to all tasks unless there are very many, so that no event is moved to meet its file's."""
    known = keep(formats(small))
    n = known.agg(F.sum(F.size("_formats"))).first()[0] or 0
    return F.broadcast(known) if n <= SENT else known.hint("merge")


def row_changes(raw: DataFrame, catalog: DataFrame | None = None) -> DataFrame:
    """Every changed row of a raw log, as in ``operators.rows.changes``."""
    events, rows = read_log(raw)
    return changes(events, catalog, rows, stored)


def statements(raw: DataFrame, catalog: DataFrame | None = None, include_gtid: bool = True, include_coords: bool = True, dedupe_begin: bool = True) -> DataFrame:
    """(seq, row_idx, log_file, start_pos, sql) of a raw log; order by (seq, row_idx) to replay."""
    return of_events(*read_log(raw), catalog, include_gtid, include_coords, dedupe_begin)


def of_events(events: DataFrame, rows: DataFrame, catalog: DataFrame | None = None, include_gtid: bool = True, include_coords: bool = True, dedupe_begin: bool = True, keep=stored) -> DataFrame:
    """``statements`` of a log that ``read_log`` has read."""
    made = row_statements(changes(events, catalog, rows, keep))
    return assemble(event_statements(events, include_gtid, dedupe_begin), made, include_coords)


def ordered(statements_: DataFrame) -> DataFrame:
    """K1: in log order. A range sort over all tasks, not one."""
    return statements_.orderBy("seq", "row_idx")


def per_event(statements_: DataFrame) -> DataFrame:
    """Q11: one text for each event, its statements in row order."""
    parts = F.sort_array(F.collect_list(F.struct("row_idx", "sql")))
    return statements_.groupBy("seq", "log_file", "start_pos").agg(F.array_join(F.transform(parts, lambda x: x["sql"]), "").alias("sql"))
