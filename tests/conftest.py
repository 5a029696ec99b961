import json
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.checkpoint.dir", str(base / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def document(tmp_path):
    """Write an export document; returns its path."""

    def write(data, columns, name="export.json", text=None, **layout):
        path = tmp_path / name
        if text is None:
            envelope = {"meta": {"view": {"columns": columns}}, "data": data}
            text = json.dumps(envelope, **layout)
        path.write_text(text, encoding="utf-8")
        return str(path)

    return write
