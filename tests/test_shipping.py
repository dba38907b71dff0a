"""Queries work where only the driver can import the package."""

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
import __spark_entry__ as e
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
assert e.entry(spark).count() == 1500
assert e.queries()["ptype_array_fastpath"](spark, {sf!r}).count() == 1500
"""


def test_workers_get_the_package(tmp_path, sf):
    root = str(Path(__file__).resolve().parents[1])
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH" and not k.startswith(("SPARK", "PYSPARK_"))}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(root=root, sf=sf)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert done.returncode == 0, done.stderr[-2000:]
