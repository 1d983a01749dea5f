"""Lexical search and holders from one pass over the documents, against the SQL, and what hit_rates shuffles."""

import os
import random

import duckdb
import pytest

from quarry.operators import retrieval as R
from quarry.plans import registry
from quarry.plans import search as P
from quarry.sources import standin as S


def folder(spark, path, documents, benchmark):
    spark.createDataFrame(documents, "doc_id long, text string, source string").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}/{t}.parquet/*.parquet'")
    return str(path), con


def odd(spark, path):
    """Copies, empty and null texts, question words in most documents, questions that are short, empty, null, of strange case."""
    draw = random.Random(3)
    words = [f"w{i}" for i in range(60)] + ["The", "Ä"] * 10
    documents = [(i, " ".join(draw.choices(words, k=draw.randint(1, 40))), draw.choice(["a", "b", None])) for i in range(180)]
    documents += [(180 + i, documents[i % 3][1], "c") for i in range(40)] + [(300, None, "a"), (301, "", "b"), (-7, "w1\n\nW2  w3 the", "a")]
    asked = [(100 + i, " ".join(documents[i * 3][1].split(" ")[1:9])) for i in range(50)]
    return folder(spark, path, documents, asked + [(1, "the"), (2, ""), (3, None), (4, "w1\n\nW2"), (5, "absent words only"), (6, "w5 w5 the w5"), (7, "w1 w2 w3")])


@pytest.mark.parametrize("blocks", [{}, {"block_chars": 300, "block_bytes": 2000}])
def test_lists_and_holders_like_the_sql(spark, tmp_path, blocks):
    path, db = odd(spark, tmp_path)
    ranks, held = R.bm25_and_holding(S.table(spark, path, "documents"), P.questions(spark, path), "doc_id", "text", 20, P._kept, **blocks)
    got = sorted((r.query_id, r["rank"], r.doc_id) for r in ranks.collect())
    assert got == sorted(db.execute(f"WITH {P._SPARSE} SELECT query_id, rank, doc_id FROM sparse").fetchall())
    assert sorted((r.query_id, r.doc_id) for r in held.collect()) == sorted(db.execute(f"WITH {P._QUESTIONS}, {P._REL} SELECT query_id, doc_id FROM rel").fetchall())


def test_hit_rates_of_odd_tables(spark, tmp_path):
    path, db = odd(spark, tmp_path)
    assert [tuple(r) for r in registry.QUERIES["hit_rates"](spark, path).collect()] == db.execute(registry.ORACLES["hit_rates"]).fetchall()


def test_unmatched_documents_come_before_matches_of_negative_score(spark, tmp_path):
    documents = [(i, "some very common words", "a") for i in range(50)] + [(i, "other", "b") for i in range(50, 60)]
    path, db = folder(spark, tmp_path, documents, [(1, "some very common words")])
    got = [tuple(r) for r in registry.QUERIES["hit_rates"](spark, path).collect()]
    assert got == db.execute(registry.ORACLES["hit_rates"]).fetchall() == [(1, 0.0, 0.0)]


@pytest.mark.parametrize("benchmark", [[], [(1, "some words here"), (2, None)]])
def test_hit_rates_without_documents(spark, tmp_path, benchmark):
    path, db = folder(spark, tmp_path, [], benchmark)
    assert [tuple(r)[0] for r in registry.QUERIES["hit_rates"](spark, path).collect()] == [len(benchmark)]


def test_hit_rates_shuffles_no_postings_and_no_pairs(spark):
    path, sc = "/root/testdata/sf0.01", spark.sparkContext._jsc.sc()

    def written():
        sc.listenerBus().waitUntilEmpty()
        return sc.statusStore().executorSummary("driver").totalShuffleWrite()

    before = written()
    registry.QUERIES["hit_rates"](spark, path).collect()
    assert written() - before < 3 * os.path.getsize(f"{path}/documents.parquet")
