import unicodedata

from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import retrieval as R
from quarry.sources import files


def test_fold_like_decomposition(spark):
    texts = ["São João", "ČŠŽ ěř ő", "ﬁm ﬂ ½ №5 …", "ªº²³ ™", "Straße Ægir Øre", "Ωμέγα ПРИВЕТ 漢字", "İı ǅ ㎏ Ⅻ", "", None, "plain"]
    want = [None if t is None else unicodedata.normalize("NFKD", t.upper()).encode("ascii", "ignore").decode() for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    assert [r.f for r in df.select("i", T.fold(F.col("t")).alias("f")).orderBy("i").collect()] == want


def test_members_with_quotes(spark):
    content = '﻿CNPJ;NAME;X\r\n1;"a;b";x\r\n2;"two\r\nlines";y\r\n\r\n3;short\r\n'
    df = spark.createDataFrame([("p", "m", content.encode("latin-1", "ignore")), ("p", "n", None), ("p", "o", b"")], "path string, member string, content binary")
    got = [tuple(r) for r in files.delimited_members(df, ["NAME", "X", "none"], encoding="latin-1").collect()]
    assert got == [("p", "m", "a;b", "x", None), ("p", "m", "two\r\nlines", "y", None), ("p", "m", "short", None, None)]


def test_filtered_resave(spark, tmp_path):
    df = spark.createDataFrame([("1", "a;b"), ("2", "c")], "k string, v string")
    files.resave_filtered(df, F.col("k") == "1", f"{tmp_path}/out")
    assert [tuple(r) for r in files.read_delimited(spark, [f"{tmp_path}/out"]).collect()] == [("1", "a;b")]


def test_a_failure_between_renames_loses_nothing(spark, tmp_path):
    path = f"{tmp_path}/t"
    files.swap_in(spark.range(3), path)
    (tmp_path / "t").rename(tmp_path / "t.old")  # as if the second rename never came
    assert files.stored(spark, path).count() == 3
    files.swap_in(files.stored(spark, path).union(spark.range(2)), path)
    assert files.stored(spark, path).count() == 5 and not (tmp_path / "t.old").exists()
    assert files.stored(spark, f"{tmp_path}/none") is None


def test_index_like_texts(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b b c"), (2, "a a d"), (3, ""), (4, "e f")], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "b d"), (2, "zz"), (3, "a e e")], "query_id long, query string")
    files.save_lexical(docs, f"{tmp_path}/i", "doc_id", "text")
    key = lambda d: sorted(tuple(r) for r in d.collect())
    assert key(R.bm25_indexed(files.load_lexical(spark, f"{tmp_path}/i"), asked, 3)) == key(R.bm25(docs, asked, "doc_id", "text", 3))


def test_tables_of_documents(spark):
    df = spark.createDataFrame([("a", b"x\ty\n1\t2\n\nalone\tz\n"), ("b", b"none"), ("c", None)], "path string, content binary")
    assert [tuple(r) for r in files.document_tables(df).collect()] == [("a", 0, [["x", "y"], ["1", "2"]])]
    assert files.document_tables(df, least_rows=1).count() == 2
