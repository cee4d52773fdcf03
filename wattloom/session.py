"""Session settings the operators are designed for."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# SQL settings that can be changed on a running session.
RUNTIME_SETTINGS = {
    # Timestamps are wall-clock values; results must not depend on the host.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lets a join and the aggregate above it share one exchange when they
    # are clustered on a subset of the join keys (see operators.disagg).
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # A filtered building table that is too large to broadcast still sends a
    # Bloom filter of its keys below the shuffle of the series.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1GB",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "10GB",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to ``spark`` and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(
    cpus: int | str = "*", app: str = "wattloom", memory: str = "8g"
) -> SparkSession:
    """A local session for tests and ``bench.py``."""
    shuffle = os.cpu_count() if cpus == "*" else int(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # plans name whole paths, also of a deep temporary folder
        .config("spark.sql.maxMetadataStringLength", "500")
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


# The folder of a process without a cluster.
_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only where the setting is missing and everything runs in one process (tests)
    is a new local folder made; a cluster without the setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if "folder" not in _own:
            _own["folder"] = f"file://{tempfile.mkdtemp(prefix='run-', dir='/tmp')}"
        folder = _own["folder"]
    return folder.rstrip("/")
