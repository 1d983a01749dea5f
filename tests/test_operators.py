import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import chunking as C
from quarry.operators import layout as L
from quarry.operators import resolve as Z
from quarry.operators import retrieval as R
from quarry.operators import sampling as M
from quarry.operators import sections as X
from quarry.operators import truth as G
from quarry.operators import upsert as U
from quarry.operators import validate as V
from quarry.sources import files


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def blocks(spark, kind):
    """A small filing: a consolidated income statement, a balance sheet and notes that go on for a page."""
    four = "\n7\n8" if kind == "ITR" else ""
    data = [
        (1, 0, f"{kind} - Demonstrações", 15.0, 40.0), (1, 1, "DFs Consolidadas / Demonstração do Resultado", 60.0, 40.0), (1, 2, "(Reais Mil)", 84.0, 40.0),
        (1, 3, f"3.01\nReceita de Venda de Bens\n1.234\n(5){four}", 140.0, 40.0), (1, 4, "3.02\nCusto dos Bens", 152.0, 40.0), (1, 5, f"-99\n1{four}", 152.4, 300.0),
        (1, 6, "3.01.01.02.03\nReceita de Venda interna\n9\n9", 170.0, 40.0), (1, 7, "3.11\nLucro/Prejuízo Consolidado do Período\n(x)\n1", 182.0, 40.0), (1, 8, "sem código\n1", 190.0, 40.0),
        (2, 0, "DFs Individuais / Balanço Patrimonial Ativo", 60.0, 40.0), (2, 1, "1\nAtivo Total\n10\n9", 140.0, 40.0),
        (3, 0, "Notas Explicativas", 42.0, 40.0), (3, 1, "Texto das notas.", 200.0, 40.0), (4, 0, "Mais texto.", 200.0, 40.0), (4, 1, "PÚBLICA", 20.0, 40.0), (4, 2, "4", 800.0, 40.0),
    ]
    return spark.createDataFrame([(kind, *d) for d in data], "doc_id string, page int, block int, text string, y0 double, x0 double")


def test_layout(spark):
    b = L.clean_blocks(blocks(spark, "DFP").unionByName(blocks(spark, "ITR")))
    assert b.where("y0 = 800").count() == 0
    got = rows(L.page_sections(b).where("doc_id = 'DFP'"), "page")
    assert got == [("DFP", 1, T.INCOME, True), ("DFP", 2, T.BALANCE, True), ("DFP", 3, T.NOTES, True), ("DFP", 4, T.NOTES, False)]
    quarterly = F.col("doc_id") == "ITR"
    found = rows(L.extract_metrics(b, quarterly).select("doc_id", "metric_name", "value"), "doc_id", "metric_name")
    assert found == [("DFP", "cogs", -99.0), ("DFP", "revenue", 1234.0), ("ITR", "cogs", 1.0), ("ITR", "revenue", -5.0)]
    lost = rows(L.extraction_failures(b, quarterly).where("doc_id = 'DFP'").select("metric_name", "reason", "raw"), "metric_name", "reason")
    assert ("net_income", "parse_error", "(x)") in lost and ("net_income", "row_not_matched", None) in lost and ("total_assets", "row_not_matched", None) in lost
    assert rows(L.page_scales(b).where("doc_id = 'DFP'"), "page") == [("DFP", 1, 1000.0)]
    (text,) = [r.full_text for r in L.full_texts(b).where("doc_id = 'DFP'").collect()]
    sections = rows(X.detect(spark.createDataFrame([("d", text)], "doc_id string, full_text string")).select("ord", "section", "text"), "ord")
    assert [s[1] for s in sections] == [T.INCOME, T.BALANCE, T.NOTES] and sections[2][2] == "Texto das notas.\n\nMais texto."


def test_statement_rows_like_joins(spark):
    """Sections carried over pages, marked pages, ties of headers and empty pages, against the parts that make them up."""
    pick = random.Random(5)
    heads = ["DFs Consolidadas / Balanço Patrimonial", "DFs Consolidadas / Demonstração do Resultado", "Notas Explicativas", "DFs Individuais / Balanço Patrimonial", "#interna", "DFs Consolidadas", "DFP - x", "  ", None]
    data = []
    for d in range(12):
        for p in range(pick.randint(1, 6)):
            data += [(f"d{d}", p, i, pick.choice(heads), 10.0, pick.choice([20.0, 20.0, 60.0, 95.0])) for i in range(pick.randint(0, 3))]
            data += [(f"d{d}", p, 10 + i, pick.choice(["1.01\nAtivo Total\n5", "3.01\nReceita", "7,5", " ", None, "(3)"]), float(pick.randint(1, 3)), 130.0 + 12 * pick.randint(0, 2)) for i in range(pick.randint(0, 6))]
    b = spark.createDataFrame(data, "doc_id string, page int, block int, text string, x0 double, y0 double")
    pages = L.page_sections(b).where(F.col("section").isin(T.BALANCE, T.INCOME)).join(L.consolidated_pages(b), ["doc_id", "page"], "left_semi")
    want = L.page_rows(b).join(pages.select("doc_id", "page"), ["doc_id", "page"], "left_semi")
    order = ("doc_id", "page", "y", "code", "description")
    assert rows(L.statement_rows(b), *order) == rows(want, *order) != []
    assert rows(L.statement_rows(b, None), *order) == rows(L.page_rows(b).join(L.consolidated_pages(b), ["doc_id", "page"], "left_semi"), *order)


def test_sections_of_plain_texts(spark):
    texts = [("a", "[SECTION:DRE]um[SECTION:DRE] dois [SECTION:Outra]x[SECTION:Notas Explicativas]\n\n[SECTION:DRE]três"), ("b", "Capa Notas Explicativas texto. Balanço Patrimonial 1 Notas Explicativas"), ("c", "nada"), ("d", None)]
    got = rows(X.detect(spark.createDataFrame(texts, "doc_id string, full_text string")), "doc_id", "ord")
    assert got[0] == ("a", 1, "DRE", 13, len(texts[0][1]), "um\n\ndois\n\ntrês")
    assert [(r[0], r[2], r[5]) for r in got[1:]] == [("b", T.NOTES, "Notas Explicativas texto."), ("b", T.BALANCE, "Balanço Patrimonial 1 Notas Explicativas")]
    for d, _, _, start, stop, body in got[1:]:
        assert dict(texts)[d][start:stop].strip() == body


def test_table_metric(spark):
    t = [["Conta", "Atual"], ["Receita Líquida", None, "n/a"], ["Receita de Venda", "", "(1.000)", "2"]]
    df = spark.createDataFrame([("d", t)], "doc_id string, rows array<array<string>>")
    assert rows(L.first_in_tables(df, "revenue", dict(L.METRIC_LABELS)["revenue"]), "doc_id") == [("d", "revenue", -1000.0, "(1.000)", "Receita de Venda")]
    assert L.first_in_tables(df, "cogs", dict(L.METRIC_LABELS)["cogs"]).count() == 0


def words(n, name):
    """A sentence of n words: int(n * 1.33) tokens."""
    return " ".join([name.capitalize(), *[name] * (n - 1)]) + "."


GOLDEN = [  # limit 13, least 3; words → tokens: 2 → 2, 3 → 3, 5 → 6, 6 → 7, 7 → 9, 10 → 13
    ("", []),
    (words(2, "a"), []),  # below the least size
    (f"{words(5, 'a')}\n\n{words(6, 'b')}", [words(5, "a") + " " + words(6, "b")]),  # 6 + 7 fit
    (f"{words(6, 'a')}\n\n{words(6, 'b')}", [words(6, "a"), words(6, "a") + " " + words(6, "b")]),  # full: the last sentence leads the next
    (f"{words(3, 'a')} {words(3, 'b')}\n\n{words(7, 'c')}", [words(3, "a") + " " + words(3, "b"), words(3, "b") + " " + words(7, "c")]),
    (f"{words(6, 'a')} {words(6, 'b')} {words(2, 'c')}", [words(6, "a"), words(6, "a") + " " + words(6, "b"), words(6, "b") + " " + words(2, "c")]),  # 14 words: by sentences; each chunk holds one new sentence at least
    (f"{words(3, 'a')}\n\n{words(20, 'b')}\n\n{words(3, 'c')}", [words(3, "a"), words(20, "b"), words(20, "b") + " " + words(3, "c")]),  # a long sentence is never cut; nothing is handed on before it
    (f"{words(6, 'a')}\n\n{words(6, 'b')}\n\n{words(3, 'x')}\n\n{words(20, 'c')}", [words(6, "a"), words(6, "a") + " " + words(6, "b"), words(6, "b") + " " + words(3, "x"), words(6, "b"), words(6, "b") + " " + words(20, "c")]),  # what was handed on last goes into the long paragraph
    (f"{words(20, 'a')}\n\n{words(20, 'b')}", [words(20, "a"), words(20, "a"), words(20, "a") + " " + words(20, "b")]),
    (f"{words(10, 'a')}\n\n{words(10, 'b')}\n\n{words(10, 'c')}", [words(10, "a"), words(10, "a") + " " + words(10, "b"), words(10, "b") + " " + words(10, "c")]),
]


def test_chunks_by_hand(spark):
    df = spark.createDataFrame([(f"f{i:02d}", 0, T.NOTES, t) for i, (t, _) in enumerate(GOLDEN)] + [("f03", 1, T.REPORT, words(4, "z")), ("f03", 2, T.BALANCE, "tabela " * 99)], "filing_id string, ord int, section string, text string")
    got = {}
    for r in C.chunk_sections(df, 13, 3).orderBy("filing_id", "chunk_index").collect():
        assert r.chunk_index == len(got.get(r.filing_id, [])) and r.chunk_id == f"{r.filing_id}_{r.chunk_index:04d}" and r.token_count >= 3
        got.setdefault(r.filing_id, []).append(r.text)
    want = {f"f{i:02d}": c for i, (_, c) in enumerate(GOLDEN) if c}
    want["f03"] = [*want["f03"], words(4, "z")]
    assert got == want


def test_truth(spark):
    s = [
        ("f", "DRE", "ÚLTIMO", "3.09", "x", "2023-01-01", "9"), ("f", "DRE", "Ultimo", "3.11", "x", "2023-04-01", "2"), ("f", "DRE", "ÚLTIMO", "3.11", "x", "2023-01-01", "1,5"), ("f", "DRE", "PENÚLTIMO", "3.01", "x", "2023-01-01", "7"),
        ("f", "BPP", "ÚLTIMO", "2.03", "Patrimônio Líquido", None, "4"), ("f", "BPP", "ÚLTIMO", "2.03.01.01", "Patrimônio Líquido dos sócios", None, "1"), ("f", "BPA", "ÚLTIMO", "1", "Ativo", None, "bad"),
    ]
    df = spark.createDataFrame(s, "filing_id string, statement string, ORDEM_EXERC string, CD_CONTA string, DS_CONTA string, DT_INI_EXERC string, VL_CONTA string")
    assert rows(G.ground_truth(df), "metric_name") == [("f", "net_income", 1.5), ("f", "total_equity", 4.0)]
    assert rows(G.ground_truth(df.drop("DT_INI_EXERC")).select("metric_name"), "metric_name") == [("net_income",), ("total_equity",)]


def test_validation(spark):
    truth = spark.createDataFrame([("f", "a", 1.0), ("f", "b", 2.0)], "filing_id string, metric_name string, value double")
    found = spark.createDataFrame([("f", "a", 1.0), ("f", "z", 5.0)], "filing_id string, metric_name string, value double")
    m = V.against_truth(truth, found)
    assert rows(m.select("metric_name", "match_status"), "metric_name") == [("a", "exact"), ("b", "missing")]
    r = V.report(m).first()
    assert (r.n, r.n_exact, r.n_missing, r.exact_pct, r.coverage_pct) == (2, 1, 1, 50.0, 50.0)
    assert V.report(m.limit(0)).first().exact_pct == 0.0


def test_keyed_changes(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    c = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "k int, v string")
    assert rows(U.upsert(t, c, ["k"]), F.asc_nulls_last("k")) == [(1, "a"), (2, "B"), (3, "C"), (None, "N")]
    assert rows(U.insert_ignore(t, c, ["k"], ["v"]), F.asc_nulls_last("k")) == [(1, "a"), (2, "b"), (3, "C"), (None, "n")]
    assert rows(U.delete(t, c, ["k"]), "k") == [(1, "a")]
    assert rows(U.update(t, spark.createDataFrame([(1, None)], "k int, v string"), ["k"], ["v"]), F.asc_nulls_last("k")) == [(1, None), (2, "b"), (None, "n")]
    assert rows(U.last_of(t.unionByName(t.withColumn("v", F.lit("z"))), ["k"], ["v"]), F.asc_nulls_last("k")) == [(1, "z"), (2, "z"), (None, "z")]


def ranked(spark, *ids):
    return spark.createDataFrame([(1, i, r, 0.0) for r, i in enumerate(ids)], "query_id long, doc_id long, rank int, score double")


def test_fusion(spark):
    got = rows(R.fuse(ranked(spark, 10, 11), ranked(spark, 12, 11), 10).select("doc_id", "rank"), "rank")
    assert got == [(11, 0), (10, 1), (12, 2)]
    assert R.fuse(ranked(spark, *range(10)), ranked(spark, *range(5, 15)), 3).count() == 3
    both = R.fuse(ranked(spark, 7), ranked(spark, 7), 5).first()
    assert both.score == pytest.approx(2 / 61)


def test_lexical_fill_and_measures(spark):
    docs = spark.createDataFrame([(1, "red fish"), (2, "blue fish fish"), (3, "green bird"), (4, "")], "doc_id long, text string")
    q = spark.createDataFrame([(1, "bird bird"), (2, "nothing here")], "query_id long, query string")
    got = rows(R.bm25(docs, q, "doc_id", "text", 3).select("query_id", "doc_id", "rank"), "query_id", "rank")
    assert got == [(1, 3, 0), (1, 1, 1), (1, 2, 2), (2, 1, 0), (2, 2, 1), (2, 3, 2)]
    rel = spark.createDataFrame([(1, 3), (1, 3), (1, 9)], "query_id long, doc_id long")
    m = {r.query_id: r for r in R.evaluate(R.bm25(docs, q, "doc_id", "text", 3), rel, q).collect()}
    assert (m[1].recall_5, m[1].mrr, m[2].recall_5, m[2].ndcg_10) == (0.5, 1.0, 0.0, 0.0)
    assert R.means(R.evaluate(ranked(spark, 3), rel, q)).first().n_queries == 2


def test_files(spark, tmp_path):
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("A.CSV", "CNPJ ;V\n1;x\n2;y\n")
        f.writestr("doc.PDF", "pdf")
    (tmp_path / "ok.zip").write_bytes(z.getvalue())
    (tmp_path / "bad.zip").write_bytes(b"no archive")
    raw = spark.read.format("binaryFile").load(str(tmp_path / "*.zip"))
    members = files.zip_members(raw, ["a.csv"])
    assert rows(files.delimited_members(members, ["CNPJ", "V", "lack"]).select("CNPJ", "V", "lack"), "CNPJ") == [("1", "x", None), ("2", "y", None)]
    assert sorted(bool(r.content) for r in files.first_document(raw).collect()) == [False, True]
    (tmp_path / "t.csv").write_text(" a ;b\n1;2\n")
    df = files.read_delimited(spark, [str(tmp_path / "t.csv"), str(tmp_path / "lack.csv")])
    assert df.columns == ["a", "b"] and rows(df, "a") == [("1", "2")]
    assert files.read_delimited(spark, str(tmp_path / "lack.csv")) is None
    files.write_delimited(df, str(tmp_path / "out"))
    assert rows(files.read_delimited(spark, str(tmp_path / "out")), "a") == [("1", "2")]
    v = spark.createDataFrame([("a", [1.0]), ("b", [2.0])], "chunk_id string, e array<double>")
    files.save_vectors(v, str(tmp_path / "v"))
    files.save_vectors(spark.createDataFrame([("b", [9.0])], v.schema), str(tmp_path / "v"))
    assert rows(files.load_vectors(spark, str(tmp_path / "v")), "chunk_id") == [("a", [1.0]), ("b", [9.0])]
    assert files.load_vectors(spark, str(tmp_path / "none")) is None
    (tmp_path / "j").mkdir()
    (tmp_path / "j/1.json").write_text('[{"k": 1}, {"k": 2}]')
    (tmp_path / "j/2.json").write_text("{broken")
    assert rows(files.read_json(spark, str(tmp_path / "j"), "k long").where("k is not null"), "k") == [(1,), (2,)]
    pages = files.document_blocks(spark.createDataFrame([("p", bytearray("um\ndois\ftrês".encode()))], "path string, content binary"))
    assert rows(pages.select("page", "text"), "page", "block") == [(1, "um"), (1, "dois"), (2, "três")]


def test_nearest_like_all_pairs(spark):
    pick = random.Random(3)
    vs = [(i, [float(pick.randint(-2, 2)) for _ in range(3)]) for i in range(60)] + [(60, None), (61, [0.0, 0.0, 0.0])]
    qs = [(i, [float(pick.randint(-2, 2)) for _ in range(3)]) for i in range(7)]
    v = spark.createDataFrame(vs, "id long, e array<double>").repartition(5)
    q = spark.createDataFrame(qs, "query_id long, vector array<double>")
    unit = lambda x: [c / (sum(c * c for c in x) ** 0.5 or 1) for c in x]
    want = []
    for i, x in qs:
        scores = sorted((-round(sum(a * b for a, b in zip(unit(x), unit(e), strict=True)), 9), d) for d, e in vs if e is not None)[:9]
        want += [(i, d, r, -s + 0.0) for r, (s, d) in enumerate(scores)]
    for size in (1, 100, 1 << 20):
        assert [(a, b, c, s + 0.0) for a, b, c, s in rows(R.dense(v, q, "id", "e", 9, block_bytes=size), "query_id", "rank")] == want
    assert R.dense(v, q.where("query_id < 0"), "id", "e", 9).count() == 0


def test_holders_like_all_pairs(spark, tmp_path):
    docs = [(1, "x one two three y"), (2, "one two  three"), (3, "One two three"), (4, "zone two threes"), (5, None), (6, ""), (7, "two three four two")]
    asked = [(1, "one two three"), (2, "two"), (3, "ne two thr"), (4, "not there at all"), (5, "two three four"), (6, None), (7, " three "), (8, "two three")]
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(asked, "query_id long, query string")
    files.save_lexical(d, f"{tmp_path}/i", "doc_id", "text")
    got = rows(R.holding(files.load_lexical(spark, f"{tmp_path}/i"), d, q, "doc_id", "text"), "query_id", "doc_id")
    assert got == [(i, n) for i, x in asked for n, t in docs if x is not None and t is not None and x in t]


def test_resolution_like_all_pairs(spark):
    reg = [(1, "Ação S.A.", None, False), (2, "ACAO Holding", "Aço", True), (3, "Banco X", "acao", True), (4, None, "BX", False), (5, "", "", True)]
    targets = [("A", "ação"), ("B", "bx"), ("C", "banco x"), ("D", "none"), ("E", "S.A."), ("F", None), ("G", "AO H")]
    df = spark.createDataFrame(reg, "k long, n string, m string, active boolean")
    t = spark.createDataFrame(targets, "ticker string, name_search string")
    found = rows(Z.resolve(t, df, ["n", "m"], F.col("active"), ["k"]).select("ticker", "k"), "ticker")
    assert found == [("A", 2), ("B", 4), ("C", 3), ("E", 1), ("G", 2)]


def test_required_and_drawn_rows(spark):
    df, need = spark.range(100), spark.range(3)
    got = [r[0] for r in rows(M.required_and_fill(df, need, "id", 10), "id")]
    assert len(got) == 10 and got[:3] == [0, 1, 2]
    assert M.required_and_fill(df, spark.range(20), "id", 10).count() == 20
