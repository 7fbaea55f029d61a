"""Session settings the library is tuned for, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits a hot key's partition even where that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Generated methods above 8000 bytes are not compiled by the JVM; fall back to smaller ones there.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Recording the Python call site of every column expression slows plan building.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks; a cluster job brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("creditframe")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder iterative fits cut their lineage in.

    A cluster names a shared folder in ``spark.checkpoint.dir``. Only a local master, which has one
    machine, gets a temporary folder of its own.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current:
        return current
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="creditframe-checkpoint-")
    context.setCheckpointDir(configured)
    return configured
