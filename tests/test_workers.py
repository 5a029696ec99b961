"""Workers that do not have the package: neither installed, nor on their path."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

NUMBERED = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from recordloom.operators.schema import dedup_names

folder = sys.argv[2]
settings = {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2", "spark.checkpoint.dir": f"file://{folder}/shared",
            "spark.sql.warehouse.dir": f"{folder}/warehouse", "spark.driver.host": "127.0.0.1"}
spark = SparkSession.builder.master("local[2]").config(map=settings).getOrCreate()
rows = spark.sql("select id, if(id % 2 = 0, 'a', 'a_1') as name from range(4)")
found = dedup_names(rows, "name", "id", "new").orderBy("id").collect()
print("names", *(row.new for row in found))
spark.stop()
"""


def test_names_are_numbered_by_workers_without_the_package(tmp_path):
    env = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    command = [sys.executable, "-c", NUMBERED, REPO, str(tmp_path)]
    run = subprocess.run(command, cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "names a a_1 a_2 a_1_1" in run.stdout, run.stderr[-2000:]
