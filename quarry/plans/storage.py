"""Queries of tables and files that the query itself writes and reads back, each with its oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import layout as L
from quarry.operators import runs
from quarry.operators import validate as V
from quarry.sources import files
from quarry.sources import standin as S

from . import extraction as E
from .registry import query


@query("appended_metrics", S.with_relations("SELECT metric_name, count(*) AS n, count(extracted_value) AS found FROM metric_values GROUP BY 1", "metric_values"))
def appended_metrics(spark, sf_dir):
    m, path = S.metric_values(spark, sf_dir), files.fresh_path(spark, "appended")
    for part in range(2):
        files.append_rows(m.where(F.pmod(F.hash("filing_id"), F.lit(2)) == part), path)
    return files.stored(spark, path).groupBy("metric_name").agg(F.count("*").alias("n"), F.count("extracted_value").alias("found"))


@query("loaded_chunks", S.with_relations("SELECT section_name, count(*) AS n, 0::BIGINT AS labelled FROM chunks GROUP BY 1", "chunks"))
def loaded_chunks(spark, sf_dir):
    """Truncate and load, over a table that is there already; sentiment starts anew."""
    c, path = S.chunks(spark, sf_dir), files.fresh_path(spark, "chunks")
    files.truncate_and_load(c.limit(5), path)
    files.truncate_and_load(c, path)
    return files.stored(spark, path).groupBy("section_name").agg(F.count("*").alias("n"), F.count("sentiment_label").alias("labelled"))


@query("vector_upsert", "SELECT vec_id, CASE WHEN vec_id % 3 = 0 THEN -1 ELSE label END::INT AS label FROM embeddings UNION ALL SELECT vec_id + 1000000, 7 FROM embeddings WHERE vec_id % 5 = 0")
def vector_upsert(spark, sf_dir):
    v, path = S.table(spark, sf_dir, "embeddings"), files.fresh_path(spark, "vectors")
    files.save_vectors(v, path, "vec_id", reindex=True)
    changed = v.where("vec_id % 3 = 0").withColumn("label", F.lit(-1)).unionByName(v.where("vec_id % 5 = 0").withColumns({"vec_id": F.col("vec_id") + 1000000, "label": F.lit(7)}))
    files.save_vectors(changed, path, "vec_id")
    return files.load_vectors(spark, path).select("vec_id", "label")


@query("stored_report", S.with_relations("SELECT match_status, count(*) AS n FROM metrics GROUP BY 1", "metrics"))
def stored_report(spark, sf_dir):
    """A report as JSON and back."""
    path = files.fresh_path(spark, "report")
    files.write_report(V.status_counts(V.compare(S.metric_values(spark, sf_dir))), path)
    return spark.read.json(path).select("match_status", "n")


@query("delimited_round_trip", "SELECT c_custkey::VARCHAR AS key, c_name AS name, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS segment FROM customer")
def delimited_round_trip(spark, sf_dir):
    """Delimited text as it is written and read: all columns are strings, empty cells null."""
    c, path = S.table(spark, sf_dir, "customer"), files.fresh_path(spark, "delimited")
    files.write_delimited(c.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")).alias("segment")), path)
    return files.read_delimited(spark, [path, path + "-missing"]).select("key", "name", "segment")


@query("document_tables", "SELECT doc_id::VARCHAR AS doc_id, (doc_id % 4 + 1)::INT AS n_rows FROM documents WHERE doc_id % 4 > 0")
def document_tables(spark, sf_dir):
    """Tables of documents with more than one row: documents have a line of prose and doc_id % 4 + 1 lines with tabs."""
    line = F.concat(F.lit("Receita\t"), F.col("doc_id").cast("string"))
    text = F.concat(F.lit("prose\n"), F.array_join(F.array_repeat(line, (F.col("doc_id") % 4 + 1).cast("int")), "\n"))
    d = S.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), F.encode(text, "UTF-8").alias("content"))
    return files.document_tables(d).select("doc_id", F.size("rows").alias("n_rows"))


@query("parsed_documents", "SELECT 'F' || o_orderkey AS doc_id, CASE o_orderkey % 4 WHEN 0 THEN 'Balanço Patrimonial' WHEN 1 THEN 'DRE' WHEN 2 THEN 'DRE' ELSE NULL END AS marked FROM orders")
def parsed_documents(spark, sf_dir):
    """Whole texts of documents from their blocks: the section that the first marker names."""
    t = L.full_texts(L.clean_blocks(E.blocks(spark, sf_dir)))
    return t.select("doc_id", F.nullif(F.regexp_extract("full_text", T.MARKER, 1), F.lit("")).alias("marked"))


_FOUND = f"{E._NAMED}, done AS (SELECT doc_id, count(DISTINCT metric_name) AS found FROM vals WHERE {E._VALUE} IS NOT NULL GROUP BY 1), st_run AS (SELECT doc_id, coalesce(found, 0) AS found, {len(L.METRIC_LABELS)} - coalesce(found, 0) AS unmatched FROM top LEFT JOIN done USING (doc_id))"
_STATUS = "CASE WHEN found = 0 THEN 'failed' WHEN unmatched > 2 THEN 'partial' ELSE 'success' END AS status"


@query("extraction_run", f"WITH {_FOUND} SELECT doc_id, found, unmatched, {_STATUS} FROM st_run")
def extraction_run(spark, sf_dir):
    """A run over all documents into stored tables, in two parts: the second takes what the first hasn't done."""
    path, b = files.fresh_path(spark, "run"), E.blocks(spark, sf_dir)
    part = b.where(F.pmod(F.hash("doc_id"), F.lit(2)) == 0)
    runs.store(*runs.extract(part, E._quarterly(), keep=files.fresh_path(spark, "first")), path)
    runs.store(*runs.extract(b, E._quarterly(), done=files.stored(spark, f"{path}/filings"), keep=files.fresh_path(spark, "second")), path)
    counted = files.stored(spark, f"{path}/metrics").groupBy("doc_id").agg(F.count("*").alias("kept"))
    out = files.stored(spark, f"{path}/filings").join(counted, "doc_id", "left")
    return out.select("doc_id", F.coalesce("kept", F.lit(0)).alias("found"), "unmatched", "status")


@query("extraction_head", f"WITH {_FOUND} SELECT doc_id, {_STATUS} FROM st_run ORDER BY doc_id LIMIT 25")
def extraction_head(spark, sf_dir):
    """A run over the first documents only, as it is asked for."""
    return runs.extract(E.blocks(spark, sf_dir), E._quarterly(), limit=25)[1].select("doc_id", "status")


@query("failure_kinds", f"WITH {E._NAMED}, {E._STATEMENTS}, ex AS (SELECT doc_id AS filing_id, metric_name, {E._VALUE} AS value FROM vals WHERE {E._VALUE} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id, metric_name ORDER BY y, code) = 1), every AS (SELECT doc_id AS filing_id, unnest({E._list(tuple(m for m, _ in L.METRIC_LABELS))}) AS metric_name FROM top), kinds AS (SELECT CASE WHEN filing_id IN (SELECT doc_id FROM tab JOIN top USING (doc_id) WHERE head LIKE 'DFs Consolidadas%') THEN 'wrong_row' ELSE 'table_not_found' END AS kind FROM every ANTI JOIN ex USING (filing_id, metric_name) UNION ALL SELECT 'unknown' FROM (SELECT ex.value AS e, truth.value AS t FROM truth JOIN ex USING (filing_id, metric_name)) WHERE CASE WHEN abs(t) < 0.01 THEN abs(e) >= 0.01 ELSE abs(e - t) / abs(t) > 0.01 END) SELECT kind, count(*) AS n FROM kinds GROUP BY 1")
def failure_kinds(spark, sf_dir):
    k = runs.failure_kinds(E.blocks(spark, sf_dir), E._quarterly(), E.ground_truth(spark, sf_dir))
    return k.groupBy("kind").agg(F.count("*").alias("n"))
