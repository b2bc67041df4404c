"""Session settings for local runs, tests and the bench.

On a cluster only the adaptive settings matter; the cluster sets the rest.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when that costs one more shuffle downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def local_session(cpus: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("limpid")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in ADAPTIVE.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
