"""Relations of filings derived from the driver's tables, and the same as SQL for oracles.

companies ← customer, filings ← orders, metrics ← lineitem with a perturbed truth, chunks ← lines
of documents, sentiment ← labels, vectors ← embeddings, questions ← benchmark.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

METRICS = ("revenue", "cogs", "gross_profit", "net_income", "total_assets", "total_equity", "operating_cash_flow")
SECTION_CYCLE = ("Relatório da Administração", "Notas Explicativas", "Balanço Patrimonial", "DRE")
MIN_CHUNK_CHARS = 40


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder; Python workers are told where this package lies, if nothing else does.

    Documents in fewer files than there are cores are dealt to all cores, as text functions are what costs.
    """
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if name == "documents" and len(df.inputFiles()) < cores else df


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.concat(F.lit("C"), F.col("c_custkey")).alias("ticker"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("sector"))


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit("F"), F.col("o_orderkey")).alias("filing_id"),
        F.concat(F.lit("C"), F.col("o_custkey")).alias("ticker"),
        F.when(F.month("o_orderdate") % 4 == 0, "DFP").otherwise("ITR").alias("filing_type"),
        F.to_date("o_orderdate").alias("reference_date"),
        F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "partial").otherwise("failed").alias("extraction_status"),
    )


def metric_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracted and validated values before comparison: one in ten is missing, close, off, or of zero truth each."""
    m = table(spark, sf_dir, "lineitem")
    turn = (F.col("l_orderkey") + F.col("l_linenumber")) % 10
    price = F.col("l_extendedprice")
    names = F.array(*[F.lit(x) for x in METRICS])
    return m.select(
        F.concat(F.lit("F"), F.col("l_orderkey")).alias("filing_id"),
        F.element_at(names, (F.col("l_linenumber") - 1) % len(METRICS) + 1).alias("metric_name"),
        F.when(turn != 0, price).alias("extracted_value"),
        F.when(turn == 1, price * 1.005).when(turn == 2, price * 1.5).when(turn == 3, F.lit(0.0)).otherwise(price).alias("validated_value"),
    )


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents of MIN_CHUNK_CHARS or more, numbered within a document, with a label where there is one."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "chunk_text")).where(F.length("chunk_text") >= MIN_CHUNK_CHARS)
    lab = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("l_id"), F.when(F.col("quality") == 0, "neutral").when(F.col("toxic") == 1, "pessimistic").otherwise("optimistic").alias("sentiment_label"))
    return d.join(lab, d.doc_id == lab.l_id, "left").select(
        F.format_string("D%d_%04d", "doc_id", "pos").alias("chunk_id"),
        F.col("doc_id"),
        F.concat(F.lit("F"), F.col("doc_id") + 1).alias("filing_id"),
        F.col("pos").cast("long").alias("pos"),
        F.element_at(F.array(*[F.lit(x) for x in SECTION_CYCLE]), (F.floor(F.col("pos") / 2) % 4 + 1).cast("int")).alias("section_name"),
        "chunk_text",
        "sentiment_label",
        F.when(F.col("sentiment_label").isNotNull(), (F.length("chunk_text") % 100) / 100.0).alias("sentiment_score"),
    )


def _listed(values: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


SQL = {
    "companies": "SELECT 'C' || c_custkey AS ticker, c_name AS name, c_mktsegment AS sector FROM customer",
    "filings": """SELECT 'F' || o_orderkey AS filing_id, 'C' || o_custkey AS ticker, CASE WHEN month(o_orderdate) % 4 = 0 THEN 'DFP' ELSE 'ITR' END AS filing_type,
        o_orderdate::DATE AS reference_date, CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'partial' ELSE 'failed' END AS extraction_status FROM orders""",
    "metric_values": f"""SELECT 'F' || l_orderkey AS filing_id, {_listed(METRICS)}[(l_linenumber - 1) % {len(METRICS)} + 1] AS metric_name,
        CASE WHEN (l_orderkey + l_linenumber) % 10 <> 0 THEN l_extendedprice END AS extracted_value,
        CASE (l_orderkey + l_linenumber) % 10 WHEN 1 THEN l_extendedprice * 1.005::DOUBLE WHEN 2 THEN l_extendedprice * 1.5::DOUBLE WHEN 3 THEN 0.0::DOUBLE ELSE l_extendedprice END AS validated_value FROM lineitem""",
    "metrics": """SELECT *, CASE WHEN extracted_value IS NULL THEN 'missing' WHEN error IS NULL THEN 'mismatch' WHEN error <= 1e-6 THEN 'exact' WHEN error <= 0.01 THEN 'close' ELSE 'mismatch' END AS match_status,
        error AS error_ratio FROM (SELECT *, CASE WHEN abs(validated_value) < 0.01 THEN CASE WHEN abs(extracted_value) < 0.01 THEN 0.0::DOUBLE END ELSE abs(extracted_value - validated_value) / abs(validated_value) END AS error FROM metric_values)""",
    "chunks": f"""SELECT printf('D%d_%04d', doc_id, pos) AS chunk_id, doc_id, 'F' || (doc_id + 1) AS filing_id, pos, {_listed(SECTION_CYCLE)}[(pos // 2) % 4 + 1] AS section_name, chunk_text, sentiment_label,
        CASE WHEN sentiment_label IS NOT NULL THEN (length(chunk_text) % 100) / 100.0::DOUBLE END AS sentiment_score
        FROM (SELECT d.doc_id, unnest(string_split(text, chr(10))) AS chunk_text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos,
              CASE WHEN quality = 0 THEN 'neutral' WHEN toxic = 1 THEN 'pessimistic' WHEN quality IS NOT NULL THEN 'optimistic' END AS sentiment_label FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
        WHERE length(chunk_text) >= {MIN_CHUNK_CHARS}""",
}
_NEEDS = {"metrics": ("metric_values",)}


def with_relations(sql: str, *names: str) -> str:
    """A query over named relations, with their definitions before it."""
    order: list[str] = []
    for n in names:
        order += [x for x in (*_NEEDS.get(n, ()), n) if x not in order]
    head = ",\n".join(f"{n} AS ({SQL[n]})" for n in order)
    body = sql.strip()
    return f"WITH {head}, {body[5:].strip()}" if body[:5].upper() == "WITH " else f"WITH {head} {body}"
