"""Data source ``binlog``: replication log files as batch and streaming DataFrames.

    spark.dataSource.register(BinlogSource)
    spark.read.format("binlog").option("path", folder).load()
    spark.readStream.format("binlog").option("path", folder).option("maxEventsPerBatch", 10000).load()

Options: path (a folder, or a file), startFile and startPos (where to begin), startGtid (a GTID set
that is applied already: its transactions are left out), maxEventsPerBatch (admission for streams),
endFile and endPos (where a stream ends: later events are left for another).
Rows: log_file, start_pos, body. The folder is opened by path on the driver and on executors, so on
a cluster it is a mount that all have; ``read_files`` reads the same through Spark's own file
readers, from any store.
"""

from __future__ import annotations

import mmap
import os
import re
import struct
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, InputPartition

from ..types import ANONYMOUS_GTID, FORMAT_DESCRIPTION, GTID, HEADER, PREVIOUS_GTIDS, RAW, ROTATE

MAGIC = b"\xfebin"
START = 4
NAME = re.compile(r".+\.\d+$")


def log_files(path: str) -> list[str]:
    """Names of log files (``name.000001``) in a folder, in order; or the one file."""
    if os.path.isdir(path):
        return sorted((n for n in os.listdir(path) if NAME.match(n)), key=lambda n: int(n.rpartition(".")[2]))
    return [os.path.basename(path)] if os.path.exists(path) else []


def locate(path: str, name: str) -> str:
    return os.path.join(path, name) if os.path.isdir(path) else path


def _open(f):
    """The bytes of an open log file, mapped: an event takes no calls of the system."""
    return mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ) if os.fstat(f.fileno()).st_size else b""


def read_places(data, start: int = START, end: int | None = None) -> Iterator[tuple[int, int]]:
    """(position, length) of the whole events of a log's bytes from ``start``; stops before a part of one."""
    at, size, length_at = max(start, START), len(data), struct.Struct("<I").unpack_from
    while at + HEADER <= size and (end is None or at < end):
        length = length_at(data, at + 9)[0]
        if length < HEADER or at + length > size:
            return
        yield at, length
        at += length


def read_events(file: str, start: int = START, end: int | None = None) -> Iterator[tuple[int, bytes]]:
    """(position, bytes) of the whole events from ``start``; stops before a part of one."""
    with open(file, "rb") as f:
        data = _open(f)
        if data[:4] != MAGIC:
            raise ValueError(f"{file} is no log file")
        for at, length in read_places(data, start, end):
            yield at, data[at : at + length]


def scan_end(file: str, start: int, most: int, end: int | None = None) -> tuple[int, int]:
    """(position after at most ``most`` whole events, how many), none beyond ``end``: reads the headers only."""
    with open(file, "rb") as f:
        data = _open(f)
        n, at = 0, max(start, START)
        size, length_at = len(data) if end is None else min(len(data), end), struct.Struct("<I").unpack_from
        while n < most and at + HEADER <= size:
            length = length_at(data, at + 9)[0]
            if length < HEADER or at + length > size:
                break
            at, n = at + length, n + 1
    return at, n


class Executed:
    """A GTID set that can be asked for a transaction; section and interval syntax as in ``operators.gtid``."""

    def __init__(self, text: str):
        self.spans: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for section in text.split(","):
            sid, *intervals = section.strip().split(":")
            for part in intervals:
                first, _, last = part.partition("-")
                if first.isdigit() and (not last or last.isdigit()):
                    self.spans[sid.replace("-", "").lower()].append((int(first), int(last or first) or int(first)))
        for spans in self.spans.values():
            spans.sort()
            reach = 0
            for k, (first, last) in enumerate(spans):  # ends that grow, so that one look decides
                reach = max(reach, last)
                spans[k] = (first, reach)

    def __contains__(self, payload: bytes) -> bool:
        """Whether a GTID event's transaction is in the set."""
        spans, number = self.spans.get(payload[1:17].hex(), []), int.from_bytes(payload[17:25], "little")
        at = bisect_right(spans, (number, 1 << 64)) - 1
        return at >= 0 and spans[at][1] >= number


#: What ends a transaction that is left out: the next one, or an event that belongs to none.
_BORDERS = (ANONYMOUS_GTID, ROTATE, FORMAT_DESCRIPTION, PREVIOUS_GTIDS)


class Span(InputPartition):
    """Events of one file between two positions."""

    def __init__(self, file: str, name: str, start: int, end: int | None, executed: str = ""):
        self.file, self.name, self.start, self.end, self.executed = file, name, start, end, executed


class Spans(InputPartition):
    """Spans that one task reads."""

    def __init__(self, spans: list[Span]):
        self.spans = spans


#: Bytes of log files that one task reads; a larger file is a task of its own.
TASK_BYTES = 4 << 20


def dealt(spans: list[Span]) -> list[Spans]:
    """Spans, in their order, in tasks of about ``TASK_BYTES``, so that many small files take few tasks."""
    out, size = [], 0
    for span in spans:
        own = max(0, (os.path.getsize(span.file) if span.end is None else span.end) - span.start)
        if not out or size + own > TASK_BYTES:
            out.append([])
            size = 0
        out[-1].append(span)
        size += own
    return [Spans(s) for s in out]


def _batches(span: Span) -> Iterator[pa.RecordBatch]:
    """Rows of a span in batches of 4,096 events or 8 MB, about."""
    if not span.executed:
        yield from _whole(span)
        return
    out, size = [], 0
    for row in _rows(span):
        out.append(row)
        size += len(row[2])
        if len(out) >= 4096 or size > 8 << 20:
            yield _batch(out)
            out, size = [], 0
    if out:
        yield _batch(out)


def _whole(span: Span) -> Iterator[pa.RecordBatch]:
    """``_batches`` where nothing is left out: the events lie one behind the other, so their column is a piece of the file."""

    def batch() -> pa.RecordBatch:
        first, size = starts[0], ends[-1] - starts[0]
        offsets = pa.array([s - first for s in starts] + [size], pa.int32())
        bodies = pa.Array.from_buffers(pa.binary(), len(starts), [None, offsets.buffers()[1], pa.py_buffer(data[first : first + size])])
        return pa.RecordBatch.from_arrays([pa.array([span.name] * len(starts), pa.string()), pa.array(starts, pa.int64()), bodies], names=["log_file", "start_pos", "body"])

    with open(span.file, "rb") as f:
        data = _open(f)
        if data[:4] != MAGIC:
            raise ValueError(f"{span.file} is no log file")
        starts, ends = [], []
        for at, length in read_places(data, span.start, span.end):
            if starts and (len(starts) >= 4096 or at + length - starts[0] > 8 << 20):
                yield batch()
                starts, ends = [], []
            starts.append(at)
            ends.append(at + length)
        if starts:
            yield batch()


def _rows(span: Span) -> Iterator[tuple]:
    done, skip = Executed(span.executed), False
    for at, body in read_events(span.file, START, span.end):  # from the head: a span may begin inside a transaction
        if body[4] == GTID:
            skip = body[HEADER:] in done
        elif body[4] in _BORDERS:
            skip = False
        if at >= span.start and not skip:
            yield span.name, at, body


class BinlogReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.first, self.at = options["path"], options.get("startfile"), int(options.get("startpos", START))
        self.only: str | None = None
        self.executed = options.get("startgtid") or ""

    def pushFilters(self, filters: list) -> Iterator:
        """A condition log_file = x leaves the other files unread."""
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("log_file",):
                self.only = f.value
            yield f  # rows are filtered again, as files may share a name

    def partitions(self) -> list[Spans]:
        names = log_files(self.path)
        if self.first:
            if self.first not in names:
                raise ValueError(f"there is no log file {self.first} in {self.path}")
            names = names[names.index(self.first) :]
        kept = [n for n in names if self.only in (None, n)]
        return dealt([Span(locate(self.path, n), n, self.at if n == self.first else START, None, self.executed) for n in kept]) or [Spans([])]

    def read(self, partition: Spans) -> Iterator[pa.RecordBatch]:
        return (b for span in partition.spans for b in _batches(span))


class BinlogStreamReader(DataSourceStreamReader):
    """Offsets are {file, pos}; a batch ends after ``maxEventsPerBatch`` events, whole ones only."""

    def __init__(self, options: dict):
        self.path, self.most = options["path"], int(options.get("maxeventsperbatch", 100_000))
        self.first, self.at = options.get("startfile"), int(options.get("startpos", START))
        self.last, self.end = options.get("endfile"), int(options.get("endpos", 0))
        self.reached: dict | None = None
        self.executed = options.get("startgtid") or ""

    def initialOffset(self) -> dict:
        names = log_files(self.path)
        return {"file": self.first or (names[0] if names else ""), "pos": self.at}

    def latestOffset(self) -> dict:
        at = dict(self.reached or self.initialOffset())
        left, names = self.most, log_files(self.path)
        for name in names[names.index(at["file"]) if at["file"] in names else 0 :]:
            if name != at["file"]:
                at = {"file": name, "pos": START}
            at["pos"], n = scan_end(locate(self.path, name), at["pos"], left, self.end if name == self.last else None)
            left -= n
            if left <= 0 or name == self.last:
                break
        self.reached = at
        return at

    def partitions(self, start: dict, end: dict) -> list[Spans]:
        self.reached = end if self.reached is None else self.reached
        out, inside = [], False
        for name in log_files(self.path):
            inside = inside or name == start["file"] or not start["file"]
            if inside:
                a, b = (start["pos"] if name == start["file"] else START), (end["pos"] if name == end["file"] else None)
                if b is None or b > a:
                    out.append(Span(locate(self.path, name), name, a, b, self.executed))
            if name == end["file"]:
                break
        return dealt(out)

    def read(self, partition: Spans) -> Iterator[pa.RecordBatch]:
        return (b for span in partition.spans for b in _batches(span))

    def commit(self, end: dict) -> None:
        """Log files stay where they are."""


class BinlogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "binlog"

    def schema(self) -> str:
        return RAW

    def reader(self, schema) -> BinlogReader:
        return BinlogReader(self.options)

    def streamReader(self, schema) -> BinlogStreamReader:
        return BinlogStreamReader(self.options)


def register(spark: SparkSession) -> None:
    """Makes ``format("binlog")`` known, and lets filters reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BinlogSource)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Raw events of all log files under ``path``, through Spark's readers: any store, one task for a file (below 2 GB)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = memoryview(content.as_buffer()).cast("B")  # the batch's own bytes, not a copy
                if data[:4] != MAGIC:
                    raise ValueError(f"{name} is no log file")
                at, out, size = START, [], 0
                while at + HEADER <= len(data):
                    length = struct.unpack_from("<I", data, at + 9)[0]
                    if length < HEADER or at + length > len(data):
                        break
                    out.append((name, at, bytes(data[at : at + length])))
                    at, size = at + length, size + length
                    if size > 8 << 20:
                        yield _batch(out)
                        out, size = [], 0
                yield _batch(out)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where(F.col("path").rlike(r"\.\d+$"))
    return files.select(F.element_at(F.split("path", "/"), -1).alias("log_file"), "content").mapInArrow(work, RAW)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.binary()))], names=["log_file", "start_pos", "body"])
