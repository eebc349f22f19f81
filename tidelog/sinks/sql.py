"""Sinks of ordered SQL and the durable point."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Checkpoint:
    """The place up to which everything is applied, and the executed GTID set if known."""

    file: str
    position: int
    gtid_set: str | None = None

    def text(self) -> str:
        """``file position [set]``; a dash stands for no file."""
        return " ".join([self.file or "-", str(self.position), *([self.gtid_set] if self.gtid_set else [])])

    @classmethod
    def parse(cls, text: str) -> Checkpoint | None:
        """Both forms: with a dash, and with nothing, for no file; None if it is neither."""
        words = text.split()
        if text[:1].isspace() and words and words[0].isdigit():
            words = ["-", *words]
        if len(words) < 2 or not words[1].isdigit():
            return None
        return cls("" if words[0] == "-" else words[0], int(words[1]), words[2] if len(words) > 2 else None)


def load_checkpoint(path: str) -> Checkpoint | None:
    """S19."""
    try:
        with open(path) as f:
            return Checkpoint.parse(f.read())
    except FileNotFoundError:
        return None


def store_checkpoint(path: str, point: Checkpoint) -> None:
    """K5: written beside it, synced, and renamed over it."""
    beside = f"{path}.tmp"
    with open(beside, "w") as f:
        f.write(point.text())
        f.flush()
        os.fsync(f.fileno())
    os.replace(beside, path)


@dataclass
class SqlSink:
    """K2 to K4: a stream or a path (``-`` is standard output), a callback, or both; both get everything.

    Statements come in log order, in blocks that the executors make, so the driver holds the blocks of
    two partitions at a time. A file gets a block at once; where a callback refuses one of its statements
    the rest is taken back, so both have the same. Elsewhere (standard output, pipes) they go one by one.
    """

    path: str | None = None
    callback: Callable[[str], None] | None = None
    #: Place of the last statement that was emitted.
    last: tuple[int, int] | None = None

    def write(self, statements: DataFrame, after: tuple[int, int] | None = None) -> int:
        """Emits statements in order of (seq, row_idx), those beyond ``after`` only, and returns their number."""
        n = 0
        if after:
            statements = statements.where((F.col("seq") > after[0]) | (F.col("seq") == after[0]) & (F.col("row_idx") > after[1]))
        out = self._open()
        try:
            for seq, row_idx, sql in self.blocks(statements):
                done = 0
                try:
                    for done in self._emit(out, sql):  # noqa: B007
                        pass
                finally:
                    if done:
                        self.last = (seq[done - 1], row_idx[done - 1])
                        n += done
        finally:
            if out and out is not sys.stdout:
                out.close()
        return n

    def _open(self):
        if self.path == "-":
            return sys.stdout
        return open(self.path, "a", encoding="utf-8") if self.path else None  # a path that cannot be opened fails at once

    def _emit(self, out, texts: list[str]) -> Iterator[int]:
        """Emits a block and says, as it goes, how many of its statements are emitted."""
        at_once = out is not None and out is not sys.stdout and out.seekable()
        start = out.tell() if at_once else 0
        if at_once:
            try:
                out.write("".join(texts))
                out.flush()
            except BaseException:
                os.truncate(self.path, start)
                raise
        done = 0
        try:
            if at_once and not self.callback:
                done = len(texts)
                yield done
                return
            for text in texts:
                if out and not at_once:
                    out.write(text)
                    out.flush()
                if self.callback:
                    self.callback(text)
                done += 1
                yield done
        finally:
            if at_once and done < len(texts):
                os.truncate(self.path, start + len("".join(texts[:done]).encode()))

    @staticmethod
    def blocks(statements: DataFrame) -> Iterator[tuple[list[int], list[int], list[str]]]:
        """(seq, row_idx, sql) of all statements in order, in blocks; the sort and the blocks are made by all tasks before the first is fetched."""

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema) as writer:
                    writer.write_batch(batch)
                yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block"])

        made = statements.orderBy("seq", "row_idx").select("seq", "row_idx", "sql").mapInArrow(work, "block binary").persist()
        try:
            made.count()
            for row in made.toLocalIterator(prefetchPartitions=True):
                table = pa.ipc.open_stream(row.block).read_all()
                yield tuple(table.column(k).to_pylist() for k in range(3))
        finally:
            made.unpersist()


def write_text(statements: DataFrame, path: str) -> None:
    """K3 at scale: a folder of text files, whose names and lines are in log order."""
    lines = F.regexp_replace("sql", r"\n\z", "").alias("sql")  # the writer ends each with a newline
    statements.orderBy("seq", "row_idx").select(lines).write.mode("append").text(path)
