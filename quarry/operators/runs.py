"""An extraction run: from blocks of pending documents to stored metrics, statuses and kinds of failure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import numbers as N
from quarry.sources import files

from . import layout as L
from . import upsert as U
from . import validate as V

# Kinds of failure.
NO_TABLE, WRONG_ROW, NO_NUMBER, OTHER = "table_not_found", "wrong_row", "value_parsing_error", "unknown"


def extract(blocks: DataFrame, quarterly: Column, done: DataFrame | None = None, limit: int | None = None, keep: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(metrics, statuses) of documents that aren't done, the first by id only where a limit is asked for.

    statuses: doc_id, found, unmatched, status; documents without any metric are among them.
    keep: where the run's metrics are stored, so that statuses and whatever is done with both don't extract them again.
    """
    docs = blocks.select("doc_id").distinct()
    if done is not None:
        docs = files.pending(docs, done, "doc_id")
    if limit is not None:
        docs = docs.orderBy("doc_id").limit(limit)
    if done is not None or limit is not None:
        blocks = blocks.join(docs, "doc_id", "left_semi")
    metrics = L.extract_metrics(L.clean_blocks(blocks), quarterly)
    if keep is not None:
        files.swap_in(metrics, keep)
        metrics = files.stored(blocks.sparkSession, keep)
    found = metrics.groupBy("doc_id").agg(F.count("*").alias("found"))
    n = F.coalesce("found", F.lit(0))
    counted = docs.join(found, "doc_id", "left").select("doc_id", n.alias("found"), (F.lit(len(L.METRIC_LABELS)) - n).alias("unmatched"))
    return metrics, counted.withColumn("status", N.filing_status(F.col("found"), F.col("unmatched")))


def store(metrics: DataFrame, statuses: DataFrame, path: str) -> None:
    """Puts a run into the tables of metrics and filings at path: what a run before had of its documents is replaced."""
    spark = metrics.sparkSession
    old = files.stored(spark, f"{path}/metrics")
    gone = statuses.select("doc_id")
    files.swap_in(metrics if old is None else U.delete(old, gone, ["doc_id"]).unionByName(metrics), f"{path}/metrics")
    old = files.stored(spark, f"{path}/filings")
    files.swap_in(statuses if old is None else U.upsert(old, statuses, ["doc_id"]), f"{path}/filings")


def failure_kinds(blocks: DataFrame, quarterly: Column, truth: DataFrame) -> DataFrame:
    """(doc_id, metric_name, kind): no table, no such row, no number in it, or a value that isn't the truth's. truth: filing_id, metric_name, value."""
    lost = L.extraction_failures(blocks, quarterly)
    tables = L.statement_rows(blocks, None).select("doc_id").distinct().withColumn("some", F.lit(True))
    kind = F.when(F.col("reason") == "parse_error", NO_NUMBER).when(F.col("some"), WRONG_ROW).otherwise(NO_TABLE)
    lost = lost.join(tables, "doc_id", "left").select("doc_id", "metric_name", kind.alias("kind"))
    found = L.extract_metrics(blocks, quarterly).withColumnRenamed("doc_id", "filing_id")
    wrong = V.against_truth(truth, found).where("match_status = 'mismatch'")
    return lost.unionByName(wrong.select(F.col("filing_id").alias("doc_id"), "metric_name", F.lit(OTHER).alias("kind")))
