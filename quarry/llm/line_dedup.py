"""Line dedup: lines that several documents hold stay only in the document with the smallest id.

Lines are exploded, normalised and hashed to 128 bits; per hash the smallest and the largest
document id are kept (two ids that differ mean two documents at least), so counting combines on
the map side whatever the skew. Hits go back to their documents as positions, and what is left is put
together again by position, in time linear in the lines.

Defined results: a null or empty text is one empty line; a null id never counts and loses no
line; rows with equal id and text get equal results; rows of one id are one document; texts of any
length are split whole; an empty table gives no rows; other columns are ignored whatever their
names, or carried in `row` where `keep` names them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import spread_join, written

SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, keep: list[str] | None = None) -> DataFrame:
    """Per row: the id, n_lines, n_dropped, kept (the text left); keep names columns that are carried along in a struct `row`."""
    carried = [F.struct(*keep).alias("__row")] if keep else []
    base = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"), *carried).withColumn("__t", F.xxhash64("__text"))
    lines = (
        base.where(F.col("__id").isNotNull())
        .select("__id", "__t", F.posexplode(F.split("__text", "\n")).alias("__pos", "__line"))
        .select("__id", "__t", "__pos", line_key(F.col("__line")).alias("__key"))
        .where(F.length("__key") >= min_chars)
        .select("__id", "__t", "__pos", F.xxhash64("__key").alias("__h"), F.xxhash64(F.lit(1), F.col("__key")).alias("__g"))
    )
    lines = written(lines, "lines")
    held = lines.groupBy("__h", "__g").agg(F.min("__id").alias("__first"), F.max("__id").alias("__last")).where(F.col("__first") != F.col("__last")).drop("__last")
    hits = spread_join(lines, held, ["__h", "__g"]).where(F.col("__id") != F.col("__first"))
    gone = hits.groupBy("__id", "__t").agg(F.collect_set("__pos").alias("__gone"))
    out = base.join(gone.withColumnsRenamed({"__id": "__i", "__t": "__u"}), (F.col("__id") == F.col("__i")) & (F.col("__t") == F.col("__u")), "left")
    # Worked out once: an inlined struct keeps the optimizer from splitting the text anew for each line.
    parts = F.struct(F.split("__text", "\n").alias("lines"), F.when(F.col("__gone").isNotNull(), F.array_except(F.sequence(F.lit(0), F.size(F.split("__text", "\n")) - 1), "__gone")).alias("stay"))
    out = out.select("__id", "__text", "__gone", *(["__row"] if keep else []), F.inline(F.array(parts)))
    left = F.when(F.col("stay").isNull(), F.col("__text")).otherwise(F.array_join(F.transform("stay", lambda i: F.get("lines", i)), "\n"))
    return out.select(
        F.col("__id").alias(id_col),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_dropped"),
        left.alias("kept"),
        *([F.col("__row").alias("row")] if keep else []),
    )
