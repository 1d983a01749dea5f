"""The corpus pipeline: quality, line dedup, near-duplicate removal, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet
and read again as the next one's docs. All but the last return the columns of docs, whatever
further columns there are; n_chars, where there is one, follows the text.

Defined results: a null text is scored as an empty one and is one from line dedup on; empty texts are near duplicates of each other, so one stays; texts of any
length are taken whole; of documents of equal class the smallest id stays (of equal rows one, rows
without an id all); different texts under one id are documents of their own, but lines count by id;
an empty table gives an empty result at each stage; further columns are carried whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontaminate, line_dedup, near_dedup, packing, quality_crf
from quarry.llm.queries import quality_model, tokenizer_file
from quarry.llm.shared import discard, table, unlike, written

#: Documents whose score is at least this stay.
MIN_QUALITY = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier doesn't reject."""
    name = unlike("score", docs.columns)
    scored = quality_crf.score(docs, quality_model(spark, docs, sf_dir), name=name)
    return scored.where(F.col(name) >= MIN_QUALITY).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a document of smaller id holds too."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]  # id and text go through the operator once
    out = line_dedup.drop_repeated_lines(docs, keep=[*rest, "doc_id"])
    text = F.col("kept")
    kind = docs.schema["n_chars"].dataType if "n_chars" in docs.columns else None
    new = {"text": text} | ({"n_chars": F.length(text).cast(kind)} if kind else {})
    return out.select(*[new[c].alias(c) if c in new else F.col("row")[c].alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dedup.keep_one(docs).select(*docs.columns)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark; those that are mostly such passages go."""
    out = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens."""
    return packing.pack(docs, tokenizer_file())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("line_dedup", lines),
    ("near_dedup", near_duplicates),
    ("decontaminate", benchmarks),
    ("pack", packed),
]
#: A trained classifier isn't SQL; tests/llm holds a brute-force version against run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), None
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
            if last is not None:
                discard(last)
            last = docs
    return docs
