"""Queries of layout, extraction, truth, resolution, manifests and keyed changes, each with its oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import numbers as N
from quarry.operators import layout as L
from quarry.operators import resolve as Z
from quarry.operators import truth as G
from quarry.operators import upsert as U
from quarry.operators import validate as V
from quarry.sources import standin as S

from .registry import query

LABELS = ("Receita de Venda de Bens e/ou Serviços", "Custo dos Bens e/ou Serviços Vendidos", "Resultado Bruto", "Lucro/Prejuízo Consolidado do Período", "Ativo Total", "Patrimônio Líquido Consolidado", "Outras Contas")
HEADS = ("DFs Consolidadas / Balanço Patrimonial Ativo", "DFs Consolidadas / Demonstração do Resultado", "DFs Individuais / Demonstração do Resultado", "Índice")


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of orders: a banner, a heading, a unit line, and a row of blocks for each line item; code and cells are two blocks."""
    o, li = S.table(spark, sf_dir, "orders"), S.table(spark, sf_dir, "lineitem")
    doc = lambda c: F.concat(F.lit("F"), F.col(c))
    head = F.element_at(F.array(*[F.lit(h) for h in HEADS]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    top = o.select(
        doc("o_orderkey").alias("doc_id"),
        F.explode(F.array(*[F.struct(F.lit(b).cast("long").alias("block"), t.alias("text"), F.lit(y).alias("y0")) for b, t, y in ((1, F.lit("DFP - Demonstrações Financeiras Padronizadas"), 15.0), (2, head, 60.0), (3, F.lit("(Reais Mil)"), 84.0))])).alias("b"),
    ).select("doc_id", F.lit(1).alias("page"), "b.*", F.lit(40.0).alias("x0"))
    k = F.col("l_linenumber")
    label = F.element_at(F.array(*[F.lit(x) for x in LABELS]), (k - 1) % len(LABELS) + 1)
    code = F.concat(F.lit("3.0"), k.cast("string"), F.when(F.col("l_partkey") % 9 == 0, F.lit(".01.02")).otherwise(F.lit("")))
    price = F.floor("l_extendedprice").cast("string")
    one = F.when(F.col("l_suppkey") % 5 == 0, F.concat(F.lit("("), price, F.lit(")"))).otherwise(price)
    cells = F.concat_ws("\n", one, F.col("l_quantity").cast("int").cast("string"), F.when(k % 2 == 0, F.lit("7\n8")))
    y = (130 + 12 * k).cast("double")
    block = F.col("l_partkey") * 10 + k
    row = [F.struct((block * 2 + i).alias("block"), t.alias("text"), y.alias("y0"), F.lit(x).alias("x0")) for i, t, x in ((0, F.concat(code, F.lit("\n"), label), 40.0), (1, cells, 300.0))]
    body = li.select(doc("l_orderkey").alias("doc_id"), F.explode(F.array(*row)).alias("b")).select("doc_id", F.lit(1).alias("page"), "b.block", "b.text", "b.y0", "b.x0")
    return top.unionByName(body)


def _list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_BLOCKS = f"""top AS (SELECT 'F' || o_orderkey AS doc_id, {_list(HEADS)}[o_orderkey % 4 + 1] AS head FROM orders),
cells AS (SELECT 'F' || l_orderkey AS doc_id, l_linenumber AS k, l_partkey * 10 + l_linenumber AS b, '3.0' || l_linenumber || CASE WHEN l_partkey % 9 = 0 THEN '.01.02' ELSE '' END || chr(10) || {_list(LABELS)}[(l_linenumber - 1) % 7 + 1] AS t,
  CASE WHEN l_suppkey % 5 = 0 THEN '(' || floor(l_extendedprice)::BIGINT || ')' ELSE floor(l_extendedprice)::BIGINT::VARCHAR END || chr(10) || l_quantity::INT || CASE WHEN l_linenumber % 2 = 0 THEN chr(10) || '7' || chr(10) || '8' ELSE '' END AS c FROM lineitem),
parts AS (SELECT doc_id, 130 + 12 * k AS y0, 40 AS x0, b * 2 AS b, t FROM cells UNION ALL SELECT doc_id, 130 + 12 * k, 300, b * 2 + 1, c FROM cells),
joined AS (SELECT doc_id, (round_even(y0 / 3.0, 0) * 3)::INT AS y, string_split(string_agg(t, chr(10) ORDER BY x0, b, t), chr(10)) AS ps FROM parts GROUP BY 1, 2),
found AS (SELECT doc_id, y, ps, list_position(list_transform(ps[2:], lambda p: regexp_full_match(p, '[+-]?\\d+(\\.\\d{{3}})*(,\\d+)?') OR (p LIKE '(%' AND p LIKE '%)')), true) AS pos FROM joined),
tab AS (SELECT doc_id, y, ps[1] AS code, array_to_string(list_slice(ps, 2, pos), ' ') AS description, list_slice(ps, pos + 1, len(ps)) AS cells FROM found WHERE pos IS NOT NULL AND pos > 1)"""
_NAMED = f"""{_BLOCKS}, named AS (SELECT tab.*, head, CASE WHEN length(code) - length(replace(code, '.', '')) <= 2 THEN CASE WHEN regexp_matches(description, '(?i)receita\\s+de\\s+venda') THEN 'revenue' WHEN regexp_matches(description, '(?i)custo\\s+dos?\\s+bens') THEN 'cogs'
  WHEN regexp_matches(description, '(?i)resultado\\s+bruto') THEN 'gross_profit' WHEN regexp_matches(description, '(?i)lucro\\s*/\\s*preju[íi]zo\\s+(?:consolidado\\s+)?do\\s+per[íi]odo') THEN 'net_income' WHEN regexp_matches(description, '(?i)^ativo\\s+total$') THEN 'total_assets'
  WHEN regexp_matches(description, '(?i)patrim[oô]nio\\s+l[íi]quido') THEN 'total_equity' END END AS metric_name FROM tab JOIN top USING (doc_id) WHERE head LIKE 'DFs Consolidadas%'),
vals AS (SELECT *, CASE WHEN metric_name IN ('revenue', 'cogs', 'gross_profit', 'net_income') AND len(cells) >= 4 AND substr(doc_id, 2)::BIGINT % 3 = 0 THEN cells[2] ELSE cells[1] END AS raw FROM named WHERE metric_name IS NOT NULL)"""
_VALUE = "CASE WHEN raw LIKE '(%' THEN -TRY_CAST(replace(replace(raw[2:-2], '.', ''), ',', '.') AS DOUBLE) ELSE TRY_CAST(replace(replace(raw, '.', ''), ',', '.') AS DOUBLE) END"


def _quarterly() -> F.Column:
    return F.substring("doc_id", 2, 20).cast("long") % 3 == 0


@query("page_sections", f"WITH {_BLOCKS} SELECT doc_id, head AS header, CASE WHEN head LIKE '%Balanço Patrimonial%' THEN 'Balanço Patrimonial' WHEN head LIKE '%Resultado%' THEN 'DRE' ELSE 'Unknown' END AS section FROM top")
def page_sections(spark, sf_dir):
    b = blocks(spark, sf_dir)
    return L.page_sections(b).join(L.page_headers(b), ["doc_id", "page"], "left").select("doc_id", "header", "section")


@query("page_scales", "SELECT 'F' || o_orderkey AS doc_id, 1000.0::DOUBLE AS scale FROM orders")
def page_scales(spark, sf_dir):
    return L.page_scales(blocks(spark, sf_dir)).select("doc_id", "scale")


@query("table_rows", f"WITH {_BLOCKS} SELECT doc_id, y, code, description, array_to_string(cells, '|') AS cells FROM tab")
def table_rows(spark, sf_dir):
    return L.page_rows(L.clean_blocks(blocks(spark, sf_dir))).select("doc_id", "y", "code", "description", F.array_join("cells", "|").alias("cells"))


@query("extracted_metrics", f"WITH {_NAMED} SELECT doc_id, metric_name, raw, {_VALUE} AS value FROM vals WHERE {_VALUE} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id, metric_name ORDER BY y, code) = 1")
def extracted_metrics(spark, sf_dir):
    return L.extract_metrics(blocks(spark, sf_dir), _quarterly()).select("doc_id", "metric_name", "raw", "value")


@query("extraction_failures", f"WITH {_NAMED}, done AS (SELECT DISTINCT doc_id, metric_name FROM vals WHERE {_VALUE} IS NOT NULL), every AS (SELECT doc_id, unnest({_list(tuple(m for m, _ in L.METRIC_LABELS))}) AS metric_name FROM top) SELECT metric_name, 'row_not_matched' AS reason, count(*) AS n FROM every ANTI JOIN done USING (doc_id, metric_name) GROUP BY 1")
def extraction_failures(spark, sf_dir):
    return L.extraction_failures(blocks(spark, sf_dir), _quarterly()).groupBy("metric_name", "reason").agg(F.count("*").alias("n"))


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statement rows of filings from line items: codes by line number, current and former periods, two starts."""
    k = F.col("l_linenumber")
    pick = lambda vs: F.element_at(F.array(*[F.lit(v) for v in vs]), (k - 1) % len(vs) + 1)
    return S.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("F"), F.col("l_orderkey")).alias("filing_id"),
        pick(STATEMENTS).alias("statement"),
        F.when(F.col("l_suppkey") % 4 == 0, "PENÚLTIMO").when(F.col("l_suppkey") % 4 == 1, "Último").otherwise("ULTIMO").alias("ORDEM_EXERC"),
        pick(CODES).alias("CD_CONTA"),
        pick(DESCRIPTIONS).alias("DS_CONTA"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("DT_INI_EXERC"),
        F.when(F.col("l_partkey") % 13 == 0, "n/a").otherwise(F.replace(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))).alias("VL_CONTA"),
    )


STATEMENTS = ("DRE", "DRE", "DRE", "BPA", "BPP", "DFC_MI", "DRE")
CODES = ("3.01", "3.09", "3.11", "1", "2.03", "6.01", "3.11.01.02")
DESCRIPTIONS = ("Receita", "Resultado", "Resultado do Período", "Ativo Total", "Patrimônio Líquido", "Caixa", "Lucro Líquido")
_STATEMENTS = f"""st AS (SELECT 'F' || l_orderkey AS filing_id, {_list(STATEMENTS)}[(l_linenumber - 1) % 7 + 1] AS statement, l_suppkey % 4 <> 0 AS now, {_list(CODES)}[(l_linenumber - 1) % 7 + 1] AS code, {_list(DESCRIPTIONS)}[(l_linenumber - 1) % 7 + 1] AS ds,
  strftime(l_shipdate, '%Y-%m-%d') AS ini, CASE WHEN l_partkey % 13 = 0 THEN 'n/a' ELSE replace(l_extendedprice::DECIMAL(18,2)::VARCHAR, '.', ',') END AS vl FROM lineitem),
rules(metric_name, code, priority) AS (VALUES ('revenue', '3.01', 0), ('cogs', '3.02', 0), ('gross_profit', '3.03', 0), ('net_income', '3.11', 0), ('net_income', '3.10', 1), ('net_income', '3.09', 2), ('total_assets', '1', 0), ('operating_cash_flow', '6.01', 0)),
cand AS (SELECT filing_id, metric_name, priority, ini, st.code, vl FROM st JOIN rules USING (code) WHERE now
  UNION ALL SELECT filing_id, 'net_income', 100, ini, code, vl FROM st WHERE now AND statement = 'DRE' AND regexp_matches(ds, '(?i)lucro\\s+l[íi]quido') AND length(code) - length(replace(code, '.', '')) <= 2
  UNION ALL SELECT filing_id, 'total_equity', 100, ini, code, vl FROM st WHERE now AND statement = 'BPP' AND regexp_matches(ds, '(?i)patrim[oô]nio\\s+l[íi]quido')),
best AS (SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY filing_id, metric_name ORDER BY priority, ini, code, vl) = 1),
truth AS (SELECT filing_id, metric_name, TRY_CAST(replace(vl, ',', '.') AS DOUBLE) AS value FROM best WHERE TRY_CAST(replace(vl, ',', '.') AS DOUBLE) IS NOT NULL)"""


@query("ground_truth", f"WITH {_STATEMENTS} SELECT * FROM truth")
def ground_truth(spark, sf_dir):
    return G.ground_truth(statements(spark, sf_dir))


@query("extraction_against_truth", f"WITH {_NAMED}, {_STATEMENTS}, ex AS (SELECT doc_id AS filing_id, metric_name, {_VALUE} AS value FROM vals WHERE {_VALUE} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id, metric_name ORDER BY y, code) = 1), c AS (SELECT metric_name, ex.value AS e, truth.value AS t FROM truth LEFT JOIN ex USING (filing_id, metric_name)), s AS (SELECT metric_name, CASE WHEN e IS NULL THEN 'missing' WHEN abs(t) < 0.01 THEN CASE WHEN abs(e) < 0.01 THEN 'exact' ELSE 'mismatch' END WHEN abs(e - t) / abs(t) <= 1e-6 THEN 'exact' WHEN abs(e - t) / abs(t) <= 0.01 THEN 'close' ELSE 'mismatch' END AS match_status FROM c) SELECT metric_name, match_status, count(*) AS n FROM s GROUP BY ALL")
def extraction_against_truth(spark, sf_dir):
    found = extracted_metrics(spark, sf_dir).withColumnRenamed("doc_id", "filing_id")
    return V.against_truth(ground_truth(spark, sf_dir), found).groupBy("metric_name", "match_status").agg(F.count("*").alias("n"))


@query("registry_resolution", "WITH t AS (SELECT 'T' || n_nationkey AS ticker, n_nationkey::VARCHAR || '7' AS p FROM nation) SELECT ticker, c_custkey AS k, c_mktsegment AS status FROM t JOIN customer ON contains(c_name, p) OR contains(c_mktsegment, p) QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY (c_mktsegment = 'MACHINERY') DESC, c_custkey) = 1")
def registry_resolution(spark, sf_dir):
    reg = S.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("DENOM_SOCIAL"), F.col("c_mktsegment").alias("DENOM_COMERC"), F.col("c_mktsegment").alias("status"))
    t = S.table(spark, sf_dir, "nation").select(F.concat(F.lit("T"), "n_nationkey").alias("ticker"), F.concat(F.col("n_nationkey").cast("string"), F.lit("7")).alias("name_search"))
    return Z.resolve(t, reg, ["DENOM_SOCIAL", "DENOM_COMERC"], F.col("status") == "MACHINERY", ["k"]).select("ticker", "k", "status")


@query("unresolved_companies", "WITH t AS (SELECT 'T' || n_nationkey AS ticker, CASE WHEN n_nationkey % 5 = 0 THEN 'not there' ELSE n_nationkey::VARCHAR END AS p FROM nation) SELECT ticker FROM t WHERE NOT EXISTS (SELECT 1 FROM customer WHERE contains(upper(c_name), upper(p)))")
def unresolved_companies(spark, sf_dir):
    reg = S.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    t = S.table(spark, sf_dir, "nation").select(F.concat(F.lit("T"), "n_nationkey").alias("ticker"), F.when(F.col("n_nationkey") % 5 == 0, "not there").otherwise(F.col("n_nationkey").cast("string")).alias("name_search"))
    return Z.unresolved(t, Z.resolve(t, reg, ["name"], F.lit(True), ["k"])).select("ticker")


@query("manifest", "SELECT 'C' || c_custkey || '_ITR_' || strftime(o_orderdate, '%Y-%m-%d') || '_' || (o_orderkey % 3) AS filing_id, 'c' || c_custkey || '/itr_' || strftime(o_orderdate, '%Y%m%d') || '_v' || (o_orderkey % 3) || '.pdf' AS pdf_path, o_orderkey AS id_doc FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'MACHINERY'")
def manifest(spark, sf_dir):
    meta = S.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("cnpj"), F.to_date("o_orderdate").alias("reference_date"), (F.col("o_orderkey") % 3).alias("version"), F.col("o_orderkey").alias("id_doc"))
    known = S.table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "MACHINERY").select(F.col("c_custkey").alias("cnpj"), F.concat(F.lit("C"), "c_custkey").alias("ticker"))
    return Z.manifest(meta, known, F.lit("ITR")).select("filing_id", "pdf_path", "id_doc")


@query("company_upsert", "SELECT ticker, name, sector FROM (SELECT 'C' || c_custkey AS ticker, c_name AS name, c_mktsegment AS sector FROM customer) WHERE ticker NOT IN (SELECT 'C' || s_suppkey * 20 FROM supplier) UNION ALL SELECT 'C' || s_suppkey * 20, s_name, 'changed' FROM supplier")
def company_upsert(spark, sf_dir):
    new = S.table(spark, sf_dir, "supplier").select(F.concat(F.lit("C"), F.col("s_suppkey") * 20).alias("ticker"), F.col("s_name").alias("name"), F.lit("changed").alias("sector"))
    return U.upsert(S.companies(spark, sf_dir), new, ["ticker"])


@query("filing_latest_upsert", "SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def filing_latest_upsert(spark, sf_dir):
    e = S.table(spark, sf_dir, "events")
    first = e.where(F.col("ts") < "2024-01-15").select("user_id", "event_id", "event_type", "value", "ts")
    later = e.where(F.col("ts") >= "2024-01-15").select("user_id", "event_id", "event_type", "value", "ts")
    old = U.last_of(first, ["user_id"], ["ts", "event_id"])
    return U.upsert(old, U.last_of(later, ["user_id"], ["ts", "event_id"]), ["user_id"]).drop("ts")


@query("chunk_insert_ignore", S.with_relations("SELECT chunk_id, chunk_text FROM chunks UNION ALL SELECT 'N' || conv_id, text FROM (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations) WHERE rn = 1", "chunks"))
def chunk_insert_ignore(spark, sf_dir):
    c = S.chunks(spark, sf_dir).select("chunk_id", "chunk_text")
    new = S.table(spark, sf_dir, "conversations").select(F.concat(F.lit("N"), "conv_id").alias("chunk_id"), F.col("text").alias("chunk_text"), "turn")
    old = c.withColumn("turn", F.lit(None).cast("long")).select("chunk_id", "chunk_text", "turn")
    both = new.unionByName(old)  # keys that are there already are ignored
    return U.insert_ignore(old, both, ["chunk_id"], ["turn"]).select("chunk_id", "chunk_text")


@query("metric_delete", S.with_relations("SELECT filing_id, count(*) AS n FROM metrics WHERE filing_id NOT IN (SELECT filing_id FROM filings WHERE extraction_status = 'failed') GROUP BY 1", "metrics", "filings"))
def metric_delete(spark, sf_dir):
    m = V.compare(S.metric_values(spark, sf_dir))
    gone = S.filings(spark, sf_dir).where(F.col("extraction_status") == "failed").select("filing_id")
    return U.delete(m, gone, ["filing_id"]).groupBy("filing_id").agg(F.count("*").alias("n"))


@query("metric_replace", S.with_relations("SELECT filing_id, count(*) AS n, sum(CASE WHEN metric_name = 'redone' THEN 1 ELSE 0 END)::BIGINT AS redone FROM (SELECT filing_id, metric_name FROM metrics WHERE filing_id NOT IN (SELECT filing_id FROM filings WHERE extraction_status = 'partial') UNION ALL SELECT filing_id, 'redone' FROM filings WHERE extraction_status = 'partial') GROUP BY 1", "metrics", "filings"))
def metric_replace(spark, sf_dir):
    m = S.metric_values(spark, sf_dir).select("filing_id", "metric_name")
    new = S.filings(spark, sf_dir).where(F.col("extraction_status") == "partial").select("filing_id", F.lit("redone").alias("metric_name"))
    return U.replace_group(m, new, ["filing_id"]).groupBy("filing_id").agg(F.count("*").alias("n"), F.count_if(F.col("metric_name") == "redone").alias("redone"))


@query("sentiment_update", S.with_relations("SELECT sentiment_label, count(*) AS n, round(avg(sentiment_score), 9) AS score FROM (SELECT CASE WHEN sentiment_label IS NULL THEN CASE WHEN length(chunk_text) % 2 = 0 THEN 'neutral' END ELSE sentiment_label END AS sentiment_label, CASE WHEN sentiment_label IS NULL THEN 0.5::DOUBLE ELSE sentiment_score END AS sentiment_score FROM chunks) GROUP BY 1", "chunks"))
def sentiment_update(spark, sf_dir):
    c = S.chunks(spark, sf_dir)
    new = c.where(F.col("sentiment_label").isNull()).select("chunk_id", F.when(F.length("chunk_text") % 2 == 0, "neutral").alias("sentiment_label"), F.lit(0.5).alias("sentiment_score"))
    out = U.update(c, new, ["chunk_id"], ["sentiment_label", "sentiment_score"])
    return out.groupBy("sentiment_label").agg(F.count("*").alias("n"), F.round(F.avg("sentiment_score"), 9).alias("score"))


@query("manifest_merge", "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'new' END ELSE 'old' END AS pdf_path FROM orders")
def manifest_merge(spark, sf_dir):
    o = S.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.lit("old").alias("pdf_path"))
    got = o.where(F.col("id") % 3 == 0).select("id", F.when(F.col("id") % 2 == 0, "new").alias("pdf_path"))
    return U.update(o, got, ["id"], ["pdf_path"])


@query("pending_filings", S.with_relations("SELECT filing_id FROM filings WHERE extraction_status <> 'success'", "filings"))
def pending_filings(spark, sf_dir):
    from quarry.sources.files import pending

    f = S.filings(spark, sf_dir)
    return pending(f.select("filing_id"), f.where(F.col("extraction_status") == "success"), "filing_id")


@query("truth_numbers", "SELECT l_orderkey, l_partkey, l_suppkey, CASE WHEN l_partkey % 13 <> 0 THEN l_extendedprice END AS value FROM lineitem")
def truth_numbers(spark, sf_dir):
    raw = F.when(F.col("l_partkey") % 13 == 0, "n/a").otherwise(F.replace(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(",")))
    return S.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", N.truth_number(raw).alias("value"))
