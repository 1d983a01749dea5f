import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.functions import numbers as N
from quarry.functions import text as T


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").coalesce(1)
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


NUMBERS = {"1.234.567": 1234567.0, "1.234,56": 1234.56, "-45.678": -45678.0, "+7": 7.0, "0": 0.0, "12,5": 12.5, "": None, "abc": None, "1.23": None, "1234.567": None, "1.234 mil": None, " 8 ": 8.0}
CELLS = {"(1.234,56)": -1234.56, "-": 0.0, "—": 0.0, "--": 0.0, "R$ 1.234,56": 1234.56, " ": None, "texto": None, "-12": -12.0, "+12": 12.0, "(-5)": 5.0, "US$ 3": 3.0, "1 234": 1234.0, "10 mil": 10.0, None: None}
SCALES = {"(em R$ mil)": 1e3, "Reais Mil": 1e3, "R$ milhões": 1e6, "bilhões": 1e9, "R$": 1.0}


def test_numbers(spark):
    assert column(spark, list(NUMBERS), N.parse_number) == list(NUMBERS.values())
    # A sign inside parentheses negates once more than the parentheses do.
    assert column(spark, list(CELLS), N.normalize_cell) == list(CELLS.values())
    assert column(spark, list(SCALES), N.detect_scale) == list(SCALES.values())
    assert column(spark, ["1,5", "2.5", "x", None], N.truth_number) == [1.5, 2.5, None, None]


def test_errors_and_statuses(spark):
    rows = [(100.0, 100.0, "exact", 0.0), (100.5, 100.0, "close", 0.005), (150.0, 100.0, "mismatch", 0.5), (None, 1.0, "missing", None), (0.0, 0.0, "exact", 0.0), (5.0, 0.0, "mismatch", None)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _, _) in enumerate(rows)], "i int, e double, t double").orderBy("i")
    got = df.select(N.match_status(F.col("e"), F.col("t")), N.relative_error(F.col("e"), F.col("t"))).collect()
    assert [r[0] for r in got] == [r[2] for r in rows]
    assert [r[1] for r in got] == [pytest.approx(r[3]) if r[3] is not None else None for r in rows]


def test_headings(spark):
    cases = {
        "DFs Consolidadas / Balanço Patrimonial Ativo": T.BALANCE, "BALANÇO\nPATRIMONIAL": T.BALANCE, "Demonstração do Resultado": T.INCOME, "Demonstração do Resultado Abrangente": T.UNKNOWN,
        "RELATÓRIO DA ADMINISTRAÇÃO": T.REPORT, "Comentário do Desempenho": T.REPORT, "Notas Explicativas": T.NOTES, "": T.UNKNOWN, "Capa": T.UNKNOWN,
    }
    assert column(spark, list(cases), T.classify_section) == list(cases.values())
    marks = {"ITR - Informações": True, "Versão : 1": True, "PÁGINA: 20 de 101": True, "PÚBLICA": True, "A receita cresceu.": False}
    assert column(spark, list(marks), T.is_artifact) == list(marks.values())


def test_folding_and_tokens(spark):
    assert column(spark, ["Último ação", None], T.fold) == ["ULTIMO ACAO", None]
    assert column(spark, ["", "a b c d e f g h i j", "a b"], T.token_estimate) == [1, 13, 2]
    assert column(spark, ["Uma frase. Outra aqui! Mais? sim"], T.sentences) == [["Uma frase.", "Outra aqui!", "Mais? sim"]]
    assert column(spark, ["A Empresa S.A. Divulgou 1.234 hoje. Fim"], T.sentences) == [["A Empresa S.A. Divulgou 1.234 hoje.", "Fim"]]
    assert column(spark, ["um\n\n12\n\nPÚBLICA\n\n[SECTION:DRE]dois\r\n\r\n\r\ntrês"], T.paragraphs) == [["um", "dois", "três"]]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=" .,-+()R$0123456789mil—a ", max_size=9), min_size=30, max_size=30))
def test_cells_like_a_plain_version(spark, cells):
    def number(t):
        t = t.strip()
        if not re.match(r"^[+-]?\s*(\d{1,3}(\.\d{3})*|\d+)(,\d+)?$", t):
            return None
        return float(re.sub(r"\s", "", t.replace(".", "").replace(",", ".")))

    def cell(t):
        t = t.strip()
        if not t:
            return None
        if t in N.DASHES:
            return 0.0
        minus = False
        if t.startswith("(") and t.endswith(")"):
            t, minus = t[1:-1].strip(), True
        elif t[0] == "-":
            t, minus = t[1:].strip(), True
        elif t[0] == "+":
            t = t[1:].strip()
        t = re.sub(r"R\$\s*|US\$\s*|\bR\b\s*|mil\b.*$", "", t, flags=re.I).strip().replace(" ", "")
        v = number(t)
        return v if v is None or not minus else -v

    assert column(spark, cells, N.normalize_cell) == [cell(c) for c in cells]
