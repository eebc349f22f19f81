"""Shared helpers: durable intermediate tables and the label split."""

from __future__ import annotations

import re
import sys
from collections.abc import Callable
from types import ModuleType

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..store import discard, shared_dir  # noqa: F401  used by the operators
from ..store import stored as durable  # noqa: F401

#: Words are maximal runs of anything but these six ASCII white-space characters.
SPACE = r"[\x20\x09-\x0D]+"


def free_name(df: DataFrame, stem: str) -> str:
    """A column name beginning with ``stem`` that ``df`` does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def held_out(doc_id: Column) -> Column:
    """True for rows that no model may learn from: crc32 of the id's text modulo 4 is 2.

    A null id counts as held out, so that it is never learned from.
    """
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def text_of(column: Column) -> Column:
    """Null text is the empty text."""
    return F.coalesce(column, F.lit(""))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """Labelled rows to learn from: (doc_id, text, label, share), at most about ``per_class`` a class.

    ``share`` is the part of its class that was taken. Held-out rows never enter. Repeated or
    contradictory labels of an id count once, by their maximum, and so does an id that repeats in
    ``docs``, by its least text. A class above the bound is thinned by a hash of the id, so the
    sample is the same in every run and does not depend on the order of rows.
    """
    marks = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    sizes = {r["label"]: r["n"] for r in marks.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for value, n in sizes.items():
        share = F.when(F.col("label") == value, F.lit(min(1.0, per_class / n))).otherwise(share)
    point = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(17)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    marks = marks.where(point < share).withColumn("share", share)
    # at most about 2 * per_class rows of three numbers: small by its parameter, so only the sample's texts are shuffled
    return (
        docs.select("doc_id", text_of(F.col("text")).alias("text"))
        .join(F.broadcast(marks), "doc_id")
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.first("label").alias("label"), F.first("share").alias("share"))
    )


def once_per_process(key, make: Callable):
    """``make()``, kept for all later tasks of this Python process.

    Functions reach an executor by value, so a module's own globals would be new in every task.
    """
    held = sys.modules.setdefault("_tidelog_held", ModuleType("_tidelog_held")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose texts are to go to Python in batches of at most 1,000 rows or 16 MB.

    The engine's default of 10,000 rows would hold tens of MB of text several times over (engine,
    transport, worker) for each task. The two options are those of the session and have effect when
    a query runs, which is after the operator returned: so they are lowered for good, where larger.
    """
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", 1_000), ("spark.sql.execution.arrow.maxBytesPerBatch", 16 << 20)):
        now = int(re.sub(r"\D", "", conf.get(key)) or 0)
        if not 0 < now <= most:
            conf.set(key, str(most))
    return df
