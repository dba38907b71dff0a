"""What produced a run: the engine, its session, the packages, the sources' commit."""

from __future__ import annotations

import sys
from importlib import metadata
from pathlib import Path

from pyspark.sql import SparkSession

#: Settings that change how a run is carried out.
SETTINGS = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.executor.instances", "spark.executor.memory", "spark.executor.cores", "spark.sql.session.timeZone")


def commit_of(sources: Path) -> str | None:
    """The commit that a checkout stands on, as its own files say."""
    folder = sources / ".git"
    try:
        head = (folder / "HEAD").read_text().strip()
        if not head.startswith("ref: "):
            return head or None
        name = head[5:]
        if (folder / name).exists():
            return (folder / name).read_text().strip()
        packed = (folder / "packed-refs").read_text().splitlines()
        return next((line.split()[0] for line in packed if line.endswith(f" {name}")), None)
    except OSError:
        return None


def snapshot(spark: SparkSession, sources: Path | None = None) -> dict:
    java = spark.sparkContext._jvm.java.lang.System.getProperty
    return {
        "engine": {
            "spark": spark.version,
            "java": java("java.version"),
            "scala": spark.sparkContext._jvm.scala.util.Properties.versionNumberString(),
            "platform": f"{java('os.name')} {java('os.version')} {java('os.arch')}",
            "python": sys.version.split()[0],
        },
        "session": {"application": spark.sparkContext.applicationId, "master": spark.sparkContext.master, "settings": {k: spark.conf.get(k, None) for k in SETTINGS}},
        "packages": {d: metadata.version(d) for d in ("pyspark", "pyarrow", "numpy")},
        "commit": commit_of(sources or Path(__file__).resolve().parents[2]),
        "command": list(sys.argv),
    }
