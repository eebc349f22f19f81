"""Durable intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_swept: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only where that is unset and driver and executors are one process, a temporary folder."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        holder = spark.sparkContext._jsc.sc().getCheckpointDir()
        if holder.isDefined():
            path = holder.get()
        elif not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        else:
            folder = tempfile.TemporaryDirectory(prefix="tidelog-")
            atexit.register(folder.cleanup)
            path = folder.name
            spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """``df``, written once into the shared folder and read back; the session's tables go when it ends."""
    spark = df.sparkSession
    own = f"{shared_dir(spark)}/tidelog/{spark.sparkContext.applicationId}"
    path = f"{own}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    if own not in _swept:
        _swept.add(own)
        atexit.register(remove, spark, own)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_path = path
    return table


def discard(table: DataFrame) -> None:
    """Removes a table that ``stored`` made and nothing reads any more."""
    remove(table.sparkSession, table.stored_path)


def file_system(spark: SparkSession, path: str):
    """(file system, path) of the store that ``path`` is in, as the executors' writers see it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where it does not exist."""
    fs, place = file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    try:
        fs, place = file_system(spark, path)
        fs.delete(place, True)
    except Exception:  # noqa: BLE001  the engine may be gone; what is left is only disk
        return
