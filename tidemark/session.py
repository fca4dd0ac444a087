"""Session settings and the shared working folder."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job relies on. Adaptive execution sizes shuffle
# partitions, splits skewed join partitions and drops branches that turn out
# empty (the hot-key branch of an unskewed table, for one).
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for name, value in RUNTIME.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = 8, app: str = "tidemark") -> SparkSession:
    """A local session for tests and the benchmark."""
    shuffle = str(cores) if str(cores).isdigit() else "8"
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", shuffle)
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
    )
    for name, value in RUNTIME.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session; only a local session
    without it falls back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")
