import numpy as np
from pyspark.sql import functions as F

from quarry.operators import models as O
from quarry.operators import sentiment as Y
from quarry.sources import files


def test_embedding(spark):
    df = spark.createDataFrame([(1, "um dois dois"), (2, None), (3, "um dois dois"), (4, "")], "k int, t string")
    v = {r.k: np.array(r.vector) for r in O.embed(df, "k", "t").collect()}
    assert np.isclose(np.linalg.norm(v[1]), 1) and (v[1] == v[3]).all() and not v[2].any() and not v[4].any()


def test_answers_and_labels(spark):
    df = spark.createDataFrame([(1, "Bem optimistic"), (2, None)], "k int, t string")
    got = {r.k: r.label for r in O.bootstrap_labels(df, "k", "t", "[x] {text}").collect()}
    assert got == {1: "optimistic", 2: "neutral"}


def test_sentiment_head(spark, tmp_path):
    rng = np.random.default_rng(0)
    rows = [(i, "positive" if i % 3 == 0 else "negative", [float(x) + (2 if i % 3 == 0 else -2) for x in rng.normal(size=4)]) for i in range(90)]
    df = spark.createDataFrame(rows, "k int, y string, v array<double>")
    model = Y.train(df, "v", "y")
    O.save_model(model, str(tmp_path / "m"))
    out = Y.score_new(df, df.where("k < 10"), O.load_model(str(tmp_path / "m")), "v", "k").join(df, "k")
    assert out.count() == 80 and out.where("label = y").count() >= 78 and out.where("score < 0.5 or score > 1").count() == 0


def test_lexical_tables(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b a"), (2, "b")], "id long, t string")
    files.save_lexical(docs, str(tmp_path), "id", "t")
    assert spark.read.parquet(f"{tmp_path}/terms").where("term = 'a'").first()[1:] == (1, 2)
    assert spark.read.parquet(f"{tmp_path}/lengths").agg(F.sum("len")).first()[0] == 4
