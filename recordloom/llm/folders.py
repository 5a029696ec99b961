"""The folder that driver and executors share, and files in it.

Workers reach it through ``pyarrow.fs``, which opens local paths, HDFS and object
stores by their URI. A file written by a task has a name of its own for each attempt;
readers open only the names that the finished job returned, so an attempt that was
lost or run twice leaves nothing that is read.
"""

from __future__ import annotations

import mmap
import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.sources.scratch import scratch_path
from recordloom.sources.workers import ship_package

__all__ = ["SharedWriter", "join_hot", "mapped", "open_input", "shared_folder", "ship_package", "table"]


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; workers may write files into it."""
    ship_package(spark)
    path = scratch_path(spark, label)
    system, inner = fs.FileSystem.from_uri(path)
    system.create_dir(inner, recursive=True)
    return path


def table(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, lineage cut."""
    ship_package(df.sparkSession)
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class SharedWriter:
    """A new file in a shared folder."""

    def __init__(self, folder: str, label: str):
        self.path = f"{folder}/{label}-{uuid.uuid4().hex}"
        system, inner = fs.FileSystem.from_uri(self.path)
        self._stream = system.open_output_stream(inner)

    def write(self, data: bytes) -> None:
        self._stream.write(data)

    def close(self) -> None:
        self._stream.close()


def open_input(path: str):
    """A random-access file of the shared folder."""
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def mapped(path: str) -> memoryview:
    """The file's bytes, mapped and not read.

    A file on a mounted folder is mapped where it is. One in an object store is first
    streamed into an unnamed file of this worker, which ends with the mapping.
    """
    system, inner = fs.FileSystem.from_uri(path)
    if isinstance(system, fs.LocalFileSystem):
        with open(inner, "rb") as file:
            return memoryview(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))
    with tempfile.TemporaryFile() as file, system.open_input_stream(inner) as source:
        while chunk := source.read(1 << 22):
            file.write(chunk)
        file.flush()
        return memoryview(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))


#: Rows of one key from which it is joined apart, if they are also above the thousandth part of all.
HOT_ROWS = 1000


def join_hot(rows: DataFrame, table_: DataFrame, key: str, total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table_``, which has each ``key`` once, without bringing the rows of a hot key together.

    ``rows`` must be cheap to read again (written). Keys of more than ``HOT_ROWS`` rows, and more than the
    thousandth part of the ``total``, are fewer than 1,000: their rows stay where they are and
    the table's rows for them are broadcast.
    """
    most = max(HOT_ROWS, total // 1000)
    if total <= most:
        return rows.join(table_, key, how)
    hot = table(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select(key), "hot")
    few = F.broadcast(table_.join(F.broadcast(hot), key, "left_semi"))
    apart = rows.join(F.broadcast(hot), key, "left_semi").join(few, key, how)
    rest = rows.join(F.broadcast(hot), key, "left_anti").join(table_, key, how)
    return rest.unionByName(apart)
