"""Batch drivers as whole-table expressions: what to parse, how it went, test sets for retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import text as T

from . import sampling as M


def display_names(manifest: DataFrame, companies: DataFrame) -> DataFrame:
    """Manifest rows with the best name: the resolved one, the manifest's, the ticker."""
    c = companies.select("ticker", F.col("name").alias("__name"))
    return manifest.join(c, "ticker", "left").withColumn("display_name", F.coalesce("__name", "company_name", "ticker")).drop("__name")


def parse_statuses(manifest: DataFrame, done: DataFrame, chunks: DataFrame, force: bool = False) -> DataFrame:
    """(filing_id, status): no_pdf without a path, skipped if done before, failed if parsing gave no row, empty if no chunk, else ok.

    chunks: (filing_id, n), n null where parsing failed.
    """
    d = done.select("filing_id").distinct().withColumn("__done", F.lit(True))
    j = manifest.select("filing_id", F.nullif("pdf_path", F.lit("")).alias("pdf_path")).join(d, "filing_id", "left").join(chunks.select("filing_id", "n"), "filing_id", "left")
    known = F.lit(False) if force else F.coalesce("__done", F.lit(False))
    return j.select("filing_id", F.when(F.col("pdf_path").isNull(), "no_pdf").when(known, "skipped").when(F.col("n").isNull(), "failed").when(F.col("n") == 0, "empty").otherwise("ok").alias("status"))


def retrieval_test_set(chunks: DataFrame, key: F.Column, kinds: tuple[str, ...], n: int, seed: int = 42, least: int = 200) -> DataFrame:
    """(anchor_chunk_id, filing_id, query_type, relevant_chunk_ids): drawn prose chunks, each with its neighbours in its section.

    chunks: chunk_id, filing_id, doc_id, pos, section_name, chunk_text.
    """
    w = Window.partitionBy("doc_id", "section_name").orderBy("pos")
    around = chunks.withColumn("near", F.array_compact(F.array(F.col("chunk_id"), F.lag("chunk_id").over(w), F.lead("chunk_id").over(w))))
    pool = around.where((F.length("chunk_text") >= least) & F.col("section_name").isin(*T.PROSE))
    return M.scheduled(pool, kinds, key, n, seed).select(F.col("chunk_id").alias("anchor_chunk_id"), "filing_id", "turn", "query_type", F.col("near").alias("relevant_chunk_ids"))
