"""Queries of batch drivers and of models' stand-ins."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import batch as B
from quarry.operators import models as O
from quarry.operators import sampling as M
from quarry.sources import standin as S

from .registry import query


@query("display_names", "SELECT o_orderkey AS k, coalesce(c.c_name, CASE WHEN o_orderkey % 2 = 0 THEN 'M' || o_orderkey END, 'C' || o_custkey) AS display_name FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') c ON c_custkey = o_custkey")
def display_names(spark, sf_dir):
    m = S.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.concat(F.lit("C"), "o_custkey").alias("ticker"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("M"), "o_orderkey")).alias("company_name"))
    return B.display_names(m, S.companies(spark, sf_dir).where(F.col("sector") != "BUILDING")).select("k", "display_name")


@query("parse_statuses", "SELECT status, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'no_pdf' WHEN o_orderkey % 5 = 0 THEN 'skipped' WHEN o_orderkey % 3 = 0 THEN 'failed' WHEN o_orderkey % 4 = 0 THEN 'empty' ELSE 'ok' END AS status FROM orders) GROUP BY status")
def parse_statuses(spark, sf_dir):
    k = F.col("o_orderkey")
    o = S.table(spark, sf_dir, "orders").select("o_orderkey", k.alias("filing_id"))
    m = o.withColumn("pdf_path", F.when(k % 7 == 0, F.when(k % 2 == 0, "")).otherwise("p.pdf"))
    chunks = o.withColumn("n", F.when(k % 3 != 0, F.when(k % 4 == 0, 0).otherwise(5)))
    return B.parse_statuses(m, o.where(k % 5 == 0), chunks).groupBy("status").agg(F.count("*").alias("n"))


@query(
    "retrieval_test_set",
    S.with_relations(
        """WITH a AS (SELECT *, list_filter([chunk_id, lag(chunk_id) OVER w, lead(chunk_id) OVER w], lambda x: x IS NOT NULL) AS near, doc_id * 10000 + pos AS k FROM chunks WINDOW w AS (PARTITION BY doc_id, section_name ORDER BY pos)),
p AS (SELECT *, row_number() OVER (ORDER BY ((k + 42) % 1000003 * 48271 + 42) % 2147483647, k) - 1 AS turn FROM a WHERE length(chunk_text) >= 200 AND section_name IN ('Relatório da Administração', 'Notas Explicativas'))
SELECT chunk_id AS anchor_chunk_id, filing_id, turn::INT AS turn, ['factual', 'temporal', 'comparative'][turn % 3 + 1] AS query_type, array_to_string(near, ',') AS relevant FROM p WHERE turn < 94""",
        "chunks",
    ),
)
def retrieval_test_set(spark, sf_dir):
    t = B.retrieval_test_set(S.chunks(spark, sf_dir), F.col("doc_id") * 10000 + F.col("pos"), ("factual", "temporal", "comparative"), 94)
    return t.select("anchor_chunk_id", "filing_id", "turn", "query_type", F.array_join("relevant_chunk_ids", ",").alias("relevant"))


@query("filled_prompts", "SELECT c_custkey AS k, 'Company ' || c_name || ' (' || c_mktsegment || '): ' AS prompt FROM customer")
def filled_prompts(spark, sf_dir):
    return S.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), O.fill("Company {name} ({sector}): {lack}", name=F.col("c_name"), sector=F.col("c_mktsegment"), lack=F.lit(None)).alias("prompt"))


@query("bootstrapped_labels", "WITH s AS (SELECT doc_id AS k, text FROM documents ORDER BY ((doc_id + 42) % 1000003 * 48271 + 42) % 2147483647, doc_id LIMIT 500) SELECT k AS doc_id, CASE WHEN lower(t) LIKE '%optimistic%' THEN 'optimistic' WHEN lower(t) LIKE '%neutral%' THEN 'neutral' WHEN lower(t) LIKE '%pessimistic%' THEN 'pessimistic' ELSE 'neutral' END AS label FROM (SELECT k, CASE k % 3 WHEN 0 THEN 'Optimistic' WHEN 1 THEN 'pessimistic, I think' ELSE '?' END AS t FROM s)")
def bootstrapped_labels(spark, sf_dir):
    d = M.sample(S.table(spark, sf_dir, "documents"), F.col("doc_id"), 500)
    told = d.withColumn("told", F.when(F.col("doc_id") % 3 == 0, "Optimistic").when(F.col("doc_id") % 3 == 1, "pessimistic, I think").otherwise("?"))
    return O.bootstrap_labels(told, "doc_id", "told", "Label this text.\n[text] {text}").select("doc_id", "label")


@query("embedded_texts")
def embedded_texts(spark, sf_dir):
    """No oracle: vectors of the stand-in embedder."""
    return O.embed(S.table(spark, sf_dir, "documents"), "doc_id", "text")
