"""Session defaults for running outside a cluster that brings its own."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int = 8, memory: str = "8g", partitions: int | None = None) -> SparkSession:
    """A local session with adaptive execution and UTC; on a cluster use the one that is there."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quarry")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions or cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
