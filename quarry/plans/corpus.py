"""Queries of text functions, sections, chunks, windows and samples, each with its oracle where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions import numbers as N
from quarry.functions import text as T
from quarry.operators import chunking as C
from quarry.operators import retrieval as R
from quarry.operators import sampling as M
from quarry.operators import sections as X
from quarry.sources import standin as S

from .registry import query


def _pick(values: tuple[str, ...], i: F.Column) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (i % len(values) + 1).cast("int"))


def _sql_pick(values: tuple[str, ...], i: str) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + f"][({i}) % {len(values)} + 1]"


@query("normalized_cells", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE l_linenumber % 7 WHEN 0 THEN p WHEN 1 THEN -p WHEN 2 THEN -p WHEN 3 THEN p WHEN 4 THEN 0 WHEN 6 THEN p END AS value FROM (SELECT *, l_extendedprice AS p FROM lineitem)")
def normalized_cells(spark, sf_dir):
    li = S.table(spark, sf_dir, "lineitem")
    br = F.translate(F.format_number("l_extendedprice", 2), ",.", ".,")
    k = F.col("l_linenumber") % 7
    cell = F.when(k == 0, br).when(k == 1, F.concat(F.lit("("), br, F.lit(")"))).when(k == 2, F.concat(F.lit("- "), br)).when(k == 3, F.concat(F.lit("R$ "), br)).when(k == 4, F.lit("—")).when(k == 5, F.lit("n.d.")).otherwise(F.concat(F.lit(" +"), br, F.lit(" mil")))
    return li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", N.normalize_cell(cell).alias("value"))


HEADERS = ("(Reais Mil)", "(em R$ milhões)", "R$ bilhões", "(em R$)", "Em milhares", "sem unidade")


@query("unit_scales", f"SELECT n_nationkey AS k, CASE WHEN lower(h) LIKE '%bilh%' THEN 1e9 WHEN lower(h) LIKE '%milh%' THEN 1e6 WHEN lower(h) LIKE '%mil%' THEN 1e3 ELSE 1 END::DOUBLE AS scale FROM (SELECT n_nationkey, {_sql_pick(HEADERS, 'n_nationkey')} AS h FROM nation)")
def unit_scales(spark, sf_dir):
    return S.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), N.detect_scale(_pick(HEADERS, F.col("n_nationkey"))).alias("scale"))


@query("folded_texts", r"SELECT doc_id, md5(regexp_replace(upper(strip_accents(replace(text, 'ß', 'ss'))), '[^\x00-\x7F]', '', 'g')) AS folded FROM documents")
def folded_texts(spark, sf_dir):
    return S.table(spark, sf_dir, "documents").select("doc_id", F.md5(T.fold(F.col("text"))).alias("folded"))


HEADINGS = ("DFs Consolidadas / Balanço Patrimonial Ativo", "BALANÇO PATRIMONIAL", "Demonstração do Resultado", "Demonstração do Resultado Abrangente", "Relatório da Administração", "Comentário do Desempenho", "NOTAS EXPLICATIVAS", "Nota Explicativa", "Capa", "")
_CLASS = "CASE WHEN regexp_matches(h, '(?i)balan[çc]o\\s+patrimonial') THEN 'Balanço Patrimonial' WHEN regexp_matches(h, '(?i)demonstra[çc][aã]o\\s+do\\s+resultado') AND NOT regexp_matches(h, '(?i)resultado\\s+abrangente') THEN 'DRE' WHEN regexp_matches(h, '(?i)relat[oó]rio\\s+da\\s+administra[çc][aã]o|coment[aá]rios?\\s+(?:de|do)\\s+desempenho') THEN 'Relatório da Administração' WHEN regexp_matches(h, '(?i)notas?\\s+explicativas?') THEN 'Notas Explicativas' ELSE 'Unknown' END"


@query("heading_sections", f"SELECT c_custkey AS k, {_CLASS} AS section FROM (SELECT c_custkey, {_sql_pick(HEADINGS, 'c_custkey')} AS h FROM customer)")
def heading_sections(spark, sf_dir):
    return S.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), T.classify_section(_pick(HEADINGS, F.col("c_custkey"))).alias("section"))


ARTIFACTS = ("ITR - Informações", "Versão : 1", "PÁGINA: 20 de 101", "PÚBLICA", "Texto comum", "CONFIDENCIAL", "Pág. 7", "ITRs do ano", "Publicado")


@query("artifact_blocks", f"SELECT c_custkey AS k, i IN (1, 2, 3, 4, 6, 7) AS artifact FROM (SELECT c_custkey, c_custkey % {len(ARTIFACTS)} + 1 AS i FROM customer)")
def artifact_blocks(spark, sf_dir):
    return S.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), T.is_artifact(_pick(ARTIFACTS, F.col("c_custkey"))).alias("artifact"))


@query("document_paragraphs", r"WITH p AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '' AND NOT (length(x) < 20 AND regexp_full_match(x, '\d+'))) AS ps FROM documents) SELECT doc_id, len(ps)::INT AS n, md5(array_to_string(ps, '|')) AS content FROM p")
def document_paragraphs(spark, sf_dir):
    ps = T.paragraphs(F.replace("text", F.lit("\n"), F.lit("\n\n")))
    return S.table(spark, sf_dir, "documents").select("doc_id", F.size(ps).alias("n"), F.md5(F.array_join(ps, "|")).alias("content"))


@query("token_estimates", r"SELECT doc_id, greatest(1, trunc(len(list_filter(string_split_regex(text, '\s+'), lambda x: x <> '')) * 1.33::DOUBLE))::INT AS tokens FROM documents")
def token_estimates(spark, sf_dir):
    return S.table(spark, sf_dir, "documents").select("doc_id", T.token_estimate(F.col("text")).alias("tokens"))


_ABBR = r"(^|[^\p{L}\p{N}_])(Cia|Dr|Dra|Sr|Sra|Prof|No|Art|Pag|Ref|p\.ex)\."


@query("document_sentences", f"WITH g AS (SELECT doc_id, regexp_replace(regexp_replace(text, '(?i){_ABBR}', '\\1\\2' || chr(2), 'g'), '([.!?])\\s+([A-ZÁÉÍÓÚÀÈÌÒÙÂÊÎÔÛÃÕÇ0-9])', '\\1' || chr(1) || '\\2', 'g') AS t FROM documents), s AS (SELECT doc_id, list_filter(list_transform(string_split(t, chr(1)), lambda x: regexp_replace(replace(x, chr(2), '.'), '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') AS ss FROM g) SELECT doc_id, greatest(len(ss), 1)::INT AS n, md5(array_to_string(ss, '|')) AS content FROM s")
def document_sentences(spark, sf_dir):
    ss = T.sentences(F.col("text"))
    return S.table(spark, sf_dir, "documents").select("doc_id", F.size(ss).alias("n"), F.md5(F.array_join(ss, "|")).alias("content"))


@query("term_statistics", r"SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(string_split_regex(lower(text), '\s+')) AS term FROM documents) WHERE term <> '' GROUP BY 1, 2) GROUP BY term")
def term_statistics(spark, sf_dir):
    return R.term_statistics(R.postings(S.table(spark, sf_dir, "documents"), "doc_id", "text"))


@query("composite_keys", "SELECT o_orderkey AS k, 'C' || o_custkey || '_ITR_' || strftime(o_orderdate, '%Y-%m-%d') || '_1' AS filing_key, 'C' || o_custkey || '_ITR_' || strftime(o_orderdate, '%Y-%m-%d') || '_1_' || lpad((o_orderkey % 1000)::VARCHAR, 4, '0') AS chunk_key, 'C' || o_custkey AS ticker, strftime(o_orderdate, '%Y-%m-%d') AS period, NULL::VARCHAR AS beyond FROM orders")
def composite_keys(spark, sf_dir):
    key = T.filing_key(F.concat(F.lit("C"), F.col("o_custkey")), F.lit("ITR"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("1"))
    o = S.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), key.alias("filing_key"))
    return o.select("k", "filing_key", T.chunk_key(F.col("filing_key"), F.col("k") % 1000).alias("chunk_key"), T.key_part(F.col("filing_key"), 1).alias("ticker"), T.key_part(F.col("filing_key"), 3).alias("period"), T.key_part(F.col("filing_key"), 9).alias("beyond"))


@query("shortened_texts", "SELECT doc_id, CASE WHEN length(text) > 90 THEN text[1:90] || '…' ELSE text END AS short FROM documents")
def shortened_texts(spark, sf_dir):
    return S.table(spark, sf_dir, "documents").select("doc_id", T.shorten(F.col("text"), 90).alias("short"))


RESPONSES = ("Optimistic.", "It is neutral", "rather PESSIMISTIC", "no idea", "neutral or optimistic")


@query("response_labels", f"SELECT c_custkey AS k, CASE WHEN lower(r) LIKE '%optimistic%' THEN 'optimistic' WHEN lower(r) LIKE '%neutral%' THEN 'neutral' WHEN lower(r) LIKE '%pessimistic%' THEN 'pessimistic' ELSE 'neutral' END AS label FROM (SELECT c_custkey, {_sql_pick(RESPONSES, 'c_custkey')} AS r FROM customer)")
def response_labels(spark, sf_dir):
    return S.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), T.label_of(_pick(RESPONSES, F.col("c_custkey"))).alias("label"))


MARKED = (*X.NAMES, "Outra")


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose lines follow markers, two to a section."""
    d = S.table(spark, sf_dir, "documents")
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.concat(F.lit("[SECTION:"), _pick(MARKED, F.floor(i / 2)), F.lit("]"), x))
    return d.select(F.col("doc_id"), F.array_join(lines, "\n").alias("full_text"))


@query("marked_sections", f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents),
s AS (SELECT doc_id, pos, {_sql_pick(MARKED, 'pos // 2')} AS section, regexp_replace(line, '^\\s+|\\s+$', '', 'g') AS t FROM l),
f AS (SELECT * FROM s WHERE section <> 'Outra' AND t <> ''),
i AS (SELECT *, (section IS DISTINCT FROM lag(section) OVER (PARTITION BY doc_id ORDER BY pos))::INT AS new FROM f),
g AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY pos) AS ord FROM i)
SELECT doc_id, ord::INT AS ord, section, md5(string_agg(t, chr(10) || chr(10) ORDER BY pos)) AS content FROM g GROUP BY doc_id, ord, section""")
def marked_sections(spark, sf_dir):
    return X.detect(_marked(spark, sf_dir)).select("doc_id", "ord", "section", F.md5("text").alias("content"))


@query("headed_sections", """WITH t AS (SELECT c_custkey AS doc_id, 'Nota Explicativa de ' || c_name || ' e o Balanço Patrimonial ' || c_mktsegment AS t FROM customer)
SELECT doc_id, 1 AS ord, 'Notas Explicativas' AS section, 0 AS start, (strpos(t, 'Balan') - 1)::INT AS stop, trim(t[1:strpos(t, 'Balan') - 1]) AS text FROM t
UNION ALL SELECT doc_id, 2, 'Balanço Patrimonial', (strpos(t, 'Balan') - 1)::INT, length(t)::INT, trim(t[strpos(t, 'Balan'):]) FROM t""")
def headed_sections(spark, sf_dir):
    c = S.table(spark, sf_dir, "customer")
    return X.detect(c.select(F.col("c_custkey").alias("doc_id"), F.concat(F.lit("Nota Explicativa de "), "c_name", F.lit(" e o Balanço Patrimonial "), "c_mktsegment").alias("full_text")))


_TOK = r"greatest(1, trunc(len(list_filter(string_split_regex({x}, '\s+'), lambda w: w <> '')) * 1.33::DOUBLE))::INT"
_SENTENCES = f"list_filter(list_transform(string_split(regexp_replace(regexp_replace(x, '(?i){_ABBR}', '\\1\\2' || chr(2), 'g'), '([.!?])\\s+([A-ZÁÉÍÓÚÀÈÌÒÙÂÊÎÔÛÃÕÇ0-9])', '\\1' || chr(1) || '\\2', 'g'), chr(1)), lambda y: regexp_replace(replace(y, chr(2), '.'), '^\\s+|\\s+$', '', 'g')), lambda y: y <> '')"
#: Chunks one after the other: (lead, first, stop) by list positions from 1; sums[i] are the tokens before unit i.
CHUNKS_SQL = f"""
WITH RECURSIVE para AS (SELECT doc_id, unnest(ps) AS x, generate_subscripts(ps, 1) AS i FROM (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '' AND NOT (length(x) < 20 AND regexp_full_match(x, '\\d+'))) AS ps FROM documents)),
cut AS (SELECT doc_id, i, x, {_TOK.format(x="x")} AS n, CASE WHEN len({_SENTENCES}) > 0 THEN {_SENTENCES} ELSE [x] END AS ss FROM para),
unit AS (SELECT doc_id, i, unnest(range(1, CASE WHEN n > 384 THEN len(ss) + 1 ELSE 2 END)) AS j, n > 384 AS long, x, ss FROM cut),
named AS (SELECT doc_id, i, j, CASE WHEN long THEN ss[j] ELSE x END AS t, CASE WHEN long THEN ss[j] ELSE ss[len(ss)] END AS tail, CASE WHEN long AND j = 1 THEN len(ss) ELSE 0 END AS run FROM unit),
counted AS (SELECT *, {_TOK.format(x="t")} AS n, {_TOK.format(x="tail")} AS m FROM named),
doc AS (SELECT doc_id, list(t ORDER BY i, j) AS t, list(tail ORDER BY i, j) AS tail, list(m ORDER BY i, j) AS m, list(run ORDER BY i, j) AS run, list(n ORDER BY i, j) AS n, count(*)::INT AS size FROM counted GROUP BY doc_id),
d AS (SELECT *, list_transform(range(1, size + 2), lambda k: coalesce(list_sum(list_slice(n, 1, (k - 1)::INT)), 0)::INT) AS sums, list_transform(range(1, size + 1), lambda k: coalesce(list_min(list_filter(range(k + 1, size + 1), lambda e: run[e] > 0)), size + 1)::INT) AS edge FROM doc),
step AS (
  SELECT doc_id, 0 AS turn, 0 AS lead, 1 AS first, 1 AS stop, 0 AS handed, false AS opened FROM d
  UNION ALL
  SELECT doc_id, turn + 1, lead2, stop, CASE WHEN alone THEN stop ELSE greatest(stop + 1, stop + len(list_filter(list_slice(sums, stop + 1, edge[stop]), lambda c: c <= 384 + sums[stop] - coalesce(m[lead2], 0)))) END::INT,
         greatest(handed2, lead2)::INT, alone
  FROM (SELECT *, NOT opened AND run[stop] > 0 AND lead2 > 0 AND m[lead2] + n[stop] > 384 AS alone FROM (
    SELECT step.*, d.* EXCLUDE (doc_id), CASE WHEN opened THEN lead WHEN run[stop] > 0 THEN handed WHEN turn = 0 THEN 0 ELSE stop - 1 END AS lead2,
           CASE WHEN run[stop] > 0 THEN stop + run[stop] - 1 ELSE handed END AS handed2
    FROM step JOIN d USING (doc_id) WHERE stop <= size))
),
made AS (SELECT doc_id, turn, regexp_replace(array_to_string(list_concat(CASE WHEN lead > 0 THEN [tail[lead]] ELSE []::VARCHAR[] END, list_slice(t, first, stop - 1)), ' '), '^\\s+|\\s+$', '', 'g') AS text FROM step JOIN d USING (doc_id) WHERE turn > 0),
kept AS (SELECT doc_id, text, {_TOK.format(x="text")} AS token_count, row_number() OVER (PARTITION BY doc_id ORDER BY turn) - 1 AS chunk_index FROM made WHERE {_TOK.format(x="text")} >= 50)
SELECT doc_id::VARCHAR AS filing_id, 'Notas Explicativas' AS section, md5(text) AS text, token_count, chunk_index::INT AS chunk_index, doc_id || '_' || lpad(chunk_index::VARCHAR, greatest(4, length(chunk_index::VARCHAR))::INT, '0') AS chunk_id FROM kept
"""


@query("prose_chunks", CHUNKS_SQL)
def prose_chunks(spark, sf_dir):
    d = S.table(spark, sf_dir, "documents")
    text = F.replace("text", F.lit("\n"), F.lit("\n\n"))
    c = C.chunk_sections(d.select(F.col("doc_id").cast("string").alias("filing_id"), F.lit(0).alias("ord"), F.lit(T.NOTES).alias("section"), text.alias("text")))
    return c.withColumn("text", F.md5("text"))


@query("chunk_neighbours", S.with_relations("SELECT doc_id, chunk_id, lag(chunk_id) OVER w AS before, lead(chunk_id) OVER w AS after FROM chunks WINDOW w AS (PARTITION BY doc_id ORDER BY pos)", "chunks"))
def chunk_neighbours(spark, sf_dir):
    return C.neighbours(S.chunks(spark, sf_dir), ["doc_id"], ["pos"], "chunk_id")


@query("chunk_numbers", S.with_relations("SELECT chunk_id, (row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1)::INT AS chunk_index FROM chunks", "chunks"))
def chunk_numbers(spark, sf_dir):
    return C.numbered(S.chunks(spark, sf_dir), "doc_id", ["pos"]).select("chunk_id", "chunk_index")


_DRAW = "((k + 42) % 1000003 * 48271 + 42) % 2147483647"


@query("training_pairs", S.with_relations("""
WITH c AS (SELECT doc_id, section_name, chunk_text, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY doc_id, section_name) AS n, lead(chunk_text) OVER w AS nxt, (doc_id * 31 + length(section_name)) * 1009 + row_number() OVER w - 1 AS seed FROM chunks WINDOW w AS (PARTITION BY doc_id, section_name ORDER BY pos)),
p AS (SELECT *, i + 2 + ((seed + 7) % 1000003 * 48271 + 7) % 2147483647 % (n - i - 2) AS j FROM c WHERE n >= 4 AND n - i - 2 > 0 AND ((seed + 42) % 1000003 * 48271 + 42) % 2147483647 % 1000 < 300)
SELECT doc_id, section_name, md5(chunk_text) AS first, md5(nxt) AS second, 'adjacent' AS kind FROM c WHERE nxt IS NOT NULL
UNION ALL SELECT p.doc_id, p.section_name, md5(p.chunk_text), md5(c.chunk_text), 'distant' FROM p JOIN c ON p.doc_id = c.doc_id AND p.section_name = c.section_name AND p.j = c.i
""", "chunks"))
def training_pairs(spark, sf_dir):
    p = C.training_pairs(S.chunks(spark, sf_dir), ["doc_id", "section_name"], ["pos"], "chunk_text", F.col("doc_id") * 31 + F.length("section_name"))
    return p.withColumns({"first": F.md5("first"), "second": F.md5("second")})


@query("adjacent_pairs", S.with_relations("SELECT doc_id, section_name, md5(chunk_text) AS first, md5(nxt) AS second FROM (SELECT *, lead(chunk_text) OVER (PARTITION BY doc_id, section_name ORDER BY pos) AS nxt FROM chunks) WHERE nxt IS NOT NULL", "chunks"))
def adjacent_pairs(spark, sf_dir):
    return training_pairs(spark, sf_dir).where("kind = 'adjacent'").select("doc_id", "section_name", "first", "second")


@query("sampled_documents", f"SELECT k AS doc_id FROM (SELECT doc_id AS k FROM documents) ORDER BY {_DRAW}, k LIMIT 100")
def sampled_documents(spark, sf_dir):
    return M.sample(S.table(spark, sf_dir, "documents"), F.col("doc_id"), 100).select("doc_id")


@query("stratified_documents", f"SELECT k AS doc_id, lang FROM (SELECT doc_id AS k, lang FROM documents) QUALIFY row_number() OVER (PARTITION BY lang ORDER BY {_DRAW}, k) <= 25")
def stratified_documents(spark, sf_dir):
    return M.stratified(S.table(spark, sf_dir, "documents"), "lang", F.col("doc_id"), 25).select("doc_id", "lang")


@query("scheduled_questions", f"SELECT doc_id, (rn - 1)::INT AS turn, ['factual', 'temporal', 'comparative'][(rn - 1) % 3 + 1] AS query_type FROM (SELECT k AS doc_id, row_number() OVER (ORDER BY {_DRAW}, k) AS rn FROM (SELECT doc_id AS k FROM documents)) WHERE rn <= 94")
def scheduled_questions(spark, sf_dir):
    return M.scheduled(S.table(spark, sf_dir, "documents"), ("factual", "temporal", "comparative"), F.col("doc_id"), 94).select("doc_id", "turn", "query_type")


@query("hold_out_split", f"SELECT k AS doc_id, rn <= least(500, greatest(50, (SELECT count(*) FROM documents) // 20)) AS held_out FROM (SELECT k, row_number() OVER (ORDER BY {_DRAW}, k) AS rn FROM (SELECT doc_id AS k FROM documents))")
def hold_out_split(spark, sf_dir):
    return M.hold_out(S.table(spark, sf_dir, "documents").select("doc_id"), F.col("doc_id")).select("doc_id", "held_out")


@query("stratified_split", f"SELECT k AS doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {_DRAW}, k) <= ceil(count(*) OVER (PARTITION BY quality) * 0.2::DOUBLE) AS test FROM (SELECT doc_id AS k, quality FROM labels)")
def stratified_split(spark, sf_dir):
    return M.stratified_split(S.table(spark, sf_dir, "labels"), "quality", F.col("doc_id")).select("doc_id", "quality", "test")


@query("evaluation_subsample", f"WITH d AS (SELECT doc_id AS k, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS need FROM documents) SELECT k AS doc_id, need FROM d WHERE need UNION ALL SELECT * FROM (SELECT k, need FROM d WHERE NOT need ORDER BY {_DRAW}, k LIMIT greatest(0, 200 - (SELECT count(*) FROM d WHERE need)))")
def evaluation_subsample(spark, sf_dir):
    d, need = S.table(spark, sf_dir, "documents"), S.table(spark, sf_dir, "labels").where("toxic = 1")
    out = M.required_and_fill(d.select("doc_id"), need, "doc_id", 200)
    return out.join(F.broadcast(need.select("doc_id", F.lit(True).alias("need"))), "doc_id", "left").select("doc_id", F.coalesce("need", F.lit(False)).alias("need"))


@query("prose_pool", S.with_relations("SELECT chunk_id FROM chunks WHERE length(chunk_text) >= 200 AND section_name IN ('Relatório da Administração', 'Notas Explicativas') AND len(string_split_regex(trim(chunk_text), '\\s+')) >= 20", "chunks"))
def prose_pool(spark, sf_dir):
    c = S.chunks(spark, sf_dir)
    return c.where((F.length("chunk_text") >= 200) & F.col("section_name").isin(*T.PROSE) & (F.size(T.words(F.col("chunk_text"))) >= 20)).select("chunk_id")


@query("running_sections", "SELECT conv_id, turn, last_value(s IGNORE NULLS) OVER w AS section, coalesce(last_value(s IGNORE NULLS) OVER w IS DISTINCT FROM last_value(s IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS marks FROM (SELECT conv_id, turn, CASE WHEN length(text) % 4 = 0 THEN role END AS s FROM conversations) WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)")
def running_sections(spark, sf_dir):
    c = S.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.length("text") % 4 == 0, F.col("role")).alias("s"))
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = c.withColumn("section", F.last("s", True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return c.select("conv_id", "turn", "section", (~F.col("section").eqNullSafe(F.lag("section").over(w))).alias("marks"))
