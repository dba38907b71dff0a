"""Where intermediate tables go: a folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where unset, one beside the warehouse,
    or a temporary folder if the whole session runs in one local process."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        local = spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master
        found = f"file://{tempfile.mkdtemp(prefix='rimecast-')}" if local else f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
        spark.conf.set("spark.checkpoint.dir", found)
    return found
