"""Chunks of prose sections, cut by cumulative token counts, with one sentence of overlap.

A section is a list of units: a paragraph that fits the limit is one, a longer one gives a unit for
each of its sentences. With the running sums of tokens, the end of a chunk is a binary search: the
last unit up to which the sum stays within the limit, one unit at least. A chunk that is full hands
its last sentence to the next. A long paragraph closes the chunk before it and takes over the
sentence that was handed on last (or the end of the long paragraph before, if that came later).

Paragraphs, sentences and token counts are native expressions; the searches run per document in
Arrow batches.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate, pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import text as T

from .sampling import draw

MAX_TOKENS, MIN_TOKENS = 384, 50


def spans(tokens: list[int], tails: list[int], runs: list[int], limit: int) -> Iterator[tuple[int, int, int]]:
    """(unit whose last sentence leads, or -1; first unit; end) of each chunk.

    tails: tokens of the last sentence of each unit; runs: at the first sentence of a long
    paragraph the number of its sentences, else 0.
    """
    sums = [0, *accumulate(tokens)]
    edges = sorted({0, len(tokens), *(i for i, r in enumerate(runs) if r)})
    handed = -1
    for start, end in pairwise(edges):
        lead = handed if runs[start] else -1
        if runs[start]:
            handed = start + runs[start] - 1
            if lead >= 0 and tails[lead] + tokens[start] > limit:
                yield lead, start, start
        while start < end:
            room = limit + sums[start] - (tails[lead] if lead >= 0 else 0)
            stop = max(start + 1, bisect_right(sums, room, start, end + 1) - 1)
            yield lead, start, stop
            if stop < end:
                lead = stop - 1
                handed = max(handed, lead)
            start = stop


def _chunks(limit: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, sections in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                index = 0
                for s in sections:
                    units = s["units"]
                    for lead, start, stop in spans([u["tokens"] for u in units], [u["tail_tokens"] for u in units], [u["run"] for u in units], limit):
                        text = " ".join(([units[lead]["tail"]] if lead >= 0 else []) + [u["text"] for u in units[start:stop]]).strip()
                        n = max(1, int(len(text.split()) * 1.33))
                        if n >= least:
                            rows.append({"filing_id": doc, "section": s["section"], "text": text, "token_count": n, "chunk_index": index})
                            index += 1
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("filing_id", pa.string()), ("section", pa.string()), ("text", pa.string()), ("token_count", pa.int32()), ("chunk_index", pa.int32())]))

    return run


def units(text: Column, limit: int) -> Column:
    """The units of a section: text, tokens, tail (its last sentence), tail_tokens, run."""
    unit = lambda t, tail, run: F.struct(t.alias("text"), T.token_estimate(t).alias("tokens"), tail.alias("tail"), T.token_estimate(tail).alias("tail_tokens"), run.cast("int").alias("run"))
    sentences = lambda p: F.transform(T.sentences(p), lambda s, i: unit(s, s, F.when(i == 0, F.size(T.sentences(p))).otherwise(0)))
    return F.flatten(F.transform(T.paragraphs(text), lambda p: F.when(T.token_estimate(p) > limit, sentences(p)).otherwise(F.array(unit(p, F.element_at(T.sentences(p), -1), F.lit(0))))))


def chunk_sections(sections: DataFrame, limit: int = MAX_TOKENS, least: int = MIN_TOKENS) -> DataFrame:
    """(filing_id, section, text, token_count, chunk_index, chunk_id) from sections (filing_id, ord, section, text); only prose is chunked."""
    prose = sections.where(F.col("section").isin(*T.PROSE)).select("filing_id", F.struct("ord", "section", units(F.col("text"), limit).alias("units")).alias("s"))
    docs = prose.groupBy("filing_id").agg(F.array_sort(F.collect_list("s")).alias("ss"))
    out = docs.mapInArrow(_chunks(limit, least), "filing_id string, section string, text string, token_count int, chunk_index int")
    return out.withColumn("chunk_id", T.chunk_key(F.col("filing_id"), F.col("chunk_index")))


def numbered(chunks: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Chunks with an index from 0 within a key."""
    return chunks.withColumn("chunk_index", F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1)


def neighbours(chunks: DataFrame, group: list[str], order: list[str], key: str) -> DataFrame:
    """The keys before and after each chunk in its group."""
    w = Window.partitionBy(*group).orderBy(*order)
    return chunks.select(*group, key, F.lag(key).over(w).alias("before"), F.lead(key).over(w).alias("after"))


def training_pairs(chunks: DataFrame, group: list[str], order: list[str], text: str, number: Column, share: float = 0.3, least: int = 4) -> DataFrame:
    """Pairs of adjacent texts, and for a drawn share of the texts of groups of at least so many one further on; number: an integer that names a group."""
    w = Window.partitionBy(*group).orderBy(*order)
    c = chunks.withColumns({"i": F.row_number().over(w) - 1, "n": F.count("*").over(Window.partitionBy(*group)), "second": F.lead(text).over(w)})
    near = c.where(F.col("second").isNotNull()).select(*group, F.col(text).alias("first"), "second", F.lit("adjacent").alias("kind"))
    seed = number * 1009 + F.col("i")
    room = F.col("n") - F.col("i") - 2
    pick = c.where((F.col("n") >= least) & (room > 0) & (draw(seed) % 1000 < int(share * 1000))).withColumn("j", F.col("i") + 2 + draw(seed, 7) % room)
    other = c.select(*[F.col(g).alias(f"o_{g}") for g in group], F.col("i").alias("o_i"), F.col(text).alias("o_text"))
    on = F.col("j") == F.col("o_i")
    for g in group:
        on = on & (F.col(g) == F.col(f"o_{g}"))
    far = pick.join(other, on).select(*group, F.col(text).alias("first"), F.col("o_text").alias("second"), F.lit("distant").alias("kind"))
    return near.unionByName(far)
