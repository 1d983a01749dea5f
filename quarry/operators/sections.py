"""Sections of full texts: by markers, else by headings; consecutive ones of a kind are merged.

texts: doc_id, full_text. Results: doc_id, ord, section, start, stop (offsets of characters), text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.functions.numbers import strip

NAMES = tuple(n for n, _ in T.SECTIONS)


def marked_spans(texts: DataFrame) -> DataFrame:
    """What follows each marker, up to the next; unknown names and blank spans are dropped."""
    names = F.regexp_extract_all("full_text", F.lit(T.MARKER), F.lit(1))
    between = F.split("full_text", T.MARKER)
    p = texts.select("doc_id", F.arrays_zip(F.slice(between, F.lit(2), F.size(between)).alias("body"), names.alias("name")).alias("ms"), F.length(F.element_at(between, 1)).alias("head"))
    m = p.select("doc_id", "head", F.posexplode("ms").alias("ord", "m")).select("doc_id", "ord", "head", "m.*")
    w = Window.partitionBy("doc_id").orderBy("ord")
    size = F.length(F.concat(F.lit("[SECTION:]"), F.col("name"))) + F.length("body")
    stop = F.col("head") + F.sum(size).over(w)
    m = m.withColumn("stop", stop.cast("int")).withColumn("start", F.col("stop") - F.length("body"))
    return m.where(F.col("name").isin(*NAMES) & (strip(F.col("body")) != "")).select("doc_id", "ord", F.col("name").alias("section"), "start", "stop", strip(F.col("body")).alias("text"))


def headed_spans(texts: DataFrame) -> DataFrame:
    """From the first heading of each section to the next such heading."""
    found = F.array(*[F.struct(F.regexp_instr("full_text", F.lit("(?iU)" + p)).alias("at"), F.lit(n).alias("section"), F.lit(i).alias("turn")) for i, (n, p) in enumerate(T.SECTIONS)])
    s = texts.select("doc_id", "full_text", F.array_sort(F.filter(found, lambda x: x["at"] > 0)).alias("fs")).select("doc_id", "full_text", F.posexplode("fs").alias("ord", "f"), "fs")
    nxt = F.try_element_at("fs", F.col("ord") + 2)["at"]
    s = s.select("doc_id", "ord", F.col("f.section").alias("section"), (F.col("f.at") - 1).alias("start"), F.coalesce(nxt - 1, F.length("full_text")).alias("stop"), "full_text")
    s = s.withColumn("text", strip(F.substring(F.col("full_text"), F.col("start") + 1, F.col("stop") - F.col("start"))))
    return s.where(F.col("text") != "").drop("full_text")


def merged(spans: DataFrame) -> DataFrame:
    """Runs of one section as one: gaps and islands over ord."""
    w = Window.partitionBy("doc_id").orderBy("ord")
    new = (~F.col("section").eqNullSafe(F.lag("section").over(w))).cast("int")
    s = spans.withColumn("new", new).withColumn("island", F.sum("new").over(w))
    g = s.groupBy("doc_id", "island").agg(F.first("section").alias("section"), F.min("start").alias("start"), F.max("stop").alias("stop"), F.array_sort(F.collect_list(F.struct("ord", "text"))).alias("ts"))
    return g.select("doc_id", F.col("island").cast("int").alias("ord"), "section", "start", "stop", F.array_join(F.transform("ts", lambda t: t["text"]), "\n\n").alias("text"))


def detect(texts: DataFrame) -> DataFrame:
    """Marked sections; for texts without any marker, headed ones."""
    has = F.col("full_text").rlike(T.MARKER)
    return merged(marked_spans(texts.where(has)).unionByName(headed_spans(texts.where(~has))))
