"""Incremental, idempotent processing with Structured Streaming, and windows over event streams (an extension)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.upsert import last_of, upsert


def process_available(source: DataFrame, step: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, keys: list[str], order: list[str]) -> None:
    """Takes all that is new in a stream once: step, then the latest row of each key is merged into a Parquet table.

    Each batch writes a new version of the table beside the old one; a batch that runs again after a
    failure writes the same version, so the result is the same.
    """
    from quarry.sources.files import exists

    def merge(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        changes = last_of(step(batch), keys, order)
        old = f"{target}/v={epoch - 1}"
        new = upsert(spark.read.parquet(old), changes, keys) if exists(spark, old) else changes
        new.write.mode("overwrite").parquet(f"{target}/v={epoch}")

    q = source.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def current(spark: SparkSession, target: str) -> DataFrame:
    """The latest version of a table that process_available keeps."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(target)
    names = [s.getPath().getName() for s in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)]
    last = max(int(n[2:]) for n in names if n.startswith("v="))
    return spark.read.parquet(f"{target}/v={last}")


def tumbling(events: DataFrame, width: str, late: str | None = None) -> DataFrame:
    """Counts and sums by window and type; with late, a watermark bounds the state of a stream."""
    e = events if late is None else events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    g = e.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return g.select(F.col("w.start").alias("start"), F.col("w.end").alias("stop"), "event_type", "n", "total")


def sliding(events: DataFrame, width: str, slide: str) -> DataFrame:
    g = events.groupBy(F.window("ts", width, slide).alias("w")).agg(F.count("*").alias("n"))
    return g.select(F.col("w.start").alias("start"), "n")


def sessions(events: DataFrame, gap: str) -> DataFrame:
    """Sessions of users: events no further apart than a gap."""
    g = events.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))
    return g.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("stop"), "n")
