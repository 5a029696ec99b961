"""Shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the session's checkpoint folder.

    That is the folder named by ``spark.checkpoint.dir`` or set on the context, which driver and
    executors share: a mounted one has a ``file:`` path too. A session without it is given a
    temporary folder if it is local, else one in the warehouse that it names.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base and re.fullmatch(r"local(\[.*)?", context.master):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="recordloom-"))
        base = context.getCheckpointDir()
    elif not base:
        base = _in_warehouse(spark)
    if base.startswith("/") and not context.master.startswith("local"):
        found = _qualified(spark, base)
        base = base if found.startswith("file:") else found
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _in_warehouse(spark: SparkSession) -> str:
    """The scratch folder in the warehouse, unless that is Spark's default below the driver's working folder."""
    warehouse = _qualified(spark, spark.conf.get("spark.sql.warehouse.dir"))
    if warehouse == _qualified(spark, "spark-warehouse") and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{warehouse}/recordloom-scratch"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a written table: computed once, and with its lineage cut."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _path(spark: SparkSession, path: str):
    """A Hadoop path with its file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _qualified(spark: SparkSession, path: str) -> str:
    found, system = _path(spark, path)
    return found.makeQualified(system.getUri(), system.getWorkingDirectory()).toString()


def hand_over(spark: SparkSession, fresh: str, target: str) -> None:
    """Put the finished folder ``fresh`` in the place of ``target``, which may exist.

    The earlier folder is moved aside before, and deleted after. If that is cut short between any two
    steps, ``settle`` leaves the earlier or the new folder whole. A store without renaming
    copies folders instead; give it a new ``target`` for each run.
    """
    settle(spark, target)
    found, system = _path(spark, target)
    system.mkdirs(found.getParent())
    aside = None
    if system.exists(found):
        aside = _path(spark, f"{target.rstrip('/')}{_ASIDE}{uuid.uuid4().hex}")[0]
        _rename(system, found, aside)
    try:
        _rename(system, _path(spark, fresh)[0], found)
    except Exception:
        if aside is not None:
            _rename(system, aside, found)
        raise
    if aside is not None:
        system.delete(aside, True)


#: In the name of a folder that was moved aside.
_ASIDE = "-replaced-"


def settle(spark: SparkSession, target: str) -> None:
    """Finish or undo a hand-over that was cut short; nothing to do after any other."""
    found, system = _path(spark, target)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    asides = [status.getPath() for status in system.globStatus(hadoop(f"{target.rstrip('/')}{_ASIDE}*")) or ()]
    if asides and not system.exists(found):
        _rename(system, asides.pop(), found)
    for aside in asides:
        system.delete(aside, True)


def _rename(system, source, target) -> None:
    if not system.rename(source, target):
        raise OSError(f"{source.toString()} could not be moved to {target.toString()}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file."""
    found, system = _path(spark, path)
    stream = system.create(found, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, or None if there is none."""
    found, system = _path(spark, path)
    if not system.exists(found):
        return None
    stream = system.open(found)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def first_bytes(spark: SparkSession, uri: str, count: int) -> bytes:
    """The first bytes of a file, opened by the codec of its name."""
    hadoop = spark._jvm.org.apache.hadoop
    found = hadoop.fs.Path(spark._jvm.java.net.URI(uri))
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    stream = found.getFileSystem(conf).open(found)
    codec = hadoop.io.compress.CompressionCodecFactory(conf).getCodec(found)
    if codec is not None:
        stream = codec.createInputStream(stream)
    try:
        read = [stream.read() for _ in range(count)]
    finally:
        stream.close()
    return bytes(b for b in read if b >= 0)


def drop(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package wrote."""
    found, system = _path(spark, path)
    system.delete(found, True)


def hidden_files(spark: SparkSession, path: str) -> list[str]:
    """Names under ``path``, a file, a folder or a pattern, that Spark passes over, but for those that writers leave."""
    found, system = _path(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    names = []
    for pattern in (path, f"{path.rstrip('/')}/[_.]*", f"{path.rstrip('/')}/*/[_.]*"):
        for status in system.globStatus(hadoop(pattern)) or ():
            inside = status.getPath()
            written = any(part.startswith(_MARKS) or part.endswith(".crc") for part in inside.toString().split("/"))
            if inside.getName().startswith(("_", ".")) and not written:
                names.append(inside.getName())
    return names


# Names that writers give to what is no data.
_MARKS = ("_SUCCESS", "_temporary", "_committed_", "_started_", "_metadata", "_common_metadata")
