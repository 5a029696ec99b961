"""The session in which documents are read."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from recordloom.sources.errors import BrokenExport

SETTINGS = {
    # The JVM compiles no method above this size, and the conversions of one wide row,
    # generated as one method, soon are. Spark then takes the path that splits them.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Of a key that occurs twice in a nested cell, the last value counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

_BROKEN = ("MALFORMED_RECORD", "USER_RAISED_EXCEPTION", "MALFORMED_VARIANT", "CANNOT_PARSE_JSON")


def reading_session(spark: SparkSession) -> SparkSession:
    """A session of its own with the caller's settings and ``SETTINGS``; the caller's stays as it is."""
    own = spark.newSession()
    for key, value in {**spark.conf.getAll, **SETTINGS}.items():
        if key.startswith("spark.sql.") and own.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


@contextmanager
def broken_documents() -> Iterator[None]:
    """Tell a document that can't be parsed from other failures of a job."""
    try:
        yield
    except (PySparkException, Py4JJavaError) as error:
        said = str(error)
        if any(name in said for name in _BROKEN):
            raise BrokenExport(next(x for x in said.splitlines() if any(n in x for n in _BROKEN))) from error
        raise
