"""The package's own code on the workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship_package(spark: SparkSession) -> None:
    """Give this package's code to the session's workers, where it may not be installed; once."""
    context = spark.sparkContext
    if getattr(context, "_recordloom_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = f"{tempfile.mkdtemp(prefix='code-')}/{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for file in sorted(package.rglob("*.py")):
            packed.write(file, file.relative_to(package.parent))
    context.addPyFile(archive)
    context._recordloom_shipped = True
