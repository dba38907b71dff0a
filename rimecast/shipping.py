"""Make this package importable in Python workers, wherever they run."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = Path(__file__).resolve().parent
#: An Arrow batch on its way to Python holds about so many bytes.
_BATCH = 8 << 20


def ship(spark: SparkSession) -> None:
    """Send the package to the workers once per application, unless PYTHONPATH already gives it to them."""
    sc = spark.sparkContext
    known = {os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    if str(_ROOT.parent) in known or getattr(sc, "_rimecast_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="rimecast-")
    shutil.copytree(_ROOT, Path(folder, "tree", _ROOT.name), ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(str(Path(folder, _ROOT.name)), "zip", Path(folder, "tree")))
    sc._rimecast_shipped = True


def small_batches(spark: SparkSession) -> None:
    """Send the package, and bound Arrow batches in bytes: ten thousand rows of long arrays would be gigabytes. The bound holds for the session."""
    ship(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)) <= _BATCH:
        spark.conf.set(key, f"{_BATCH}b")
