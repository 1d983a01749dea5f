"""Sentiment of chunks: a balanced logistic head over vectors, trained and applied with pyspark.ml."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def train(rows: DataFrame, vector: str, label: str, c: float = 1.0) -> PipelineModel:
    """Logistic regression with weights that balance the classes; c as in loss × c + |w|² / 2."""
    sizes = rows.groupBy(label).agg(F.count("*").alias("__n"))
    total = rows.agg(F.count("*").alias("__all"), F.count_distinct(label).alias("__classes"))
    weighed = rows.join(F.broadcast(sizes), label).join(F.broadcast(total)).withColumn("__w", F.col("__all") / (F.col("__classes") * F.col("__n")))
    data = weighed.select(array_to_vector(F.col(vector).cast("array<double>")).alias("features"), F.col(label).alias("label_text"), "__w")
    n = data.count()
    index = StringIndexer(inputCol="label_text", outputCol="label", stringOrderType="alphabetAsc")
    head = LogisticRegression(weightCol="__w", regParam=1.0 / (c * max(n, 1)), standardization=False, maxIter=200, tol=1e-8)
    fitted = Pipeline(stages=[index, head]).fit(data)
    back = IndexToString(inputCol="prediction", outputCol="predicted", labels=fitted.stages[0].labels)
    return PipelineModel([fitted.stages[1], back])


def score(rows: DataFrame, model: PipelineModel, vector: str, key: str) -> DataFrame:
    """(key, label, score): the likeliest class and its probability."""
    data = rows.select(key, array_to_vector(F.col(vector).cast("array<double>")).alias("features"))
    return model.transform(data).select(key, F.col("predicted").alias("label"), F.array_max(vector_to_array("probability")).alias("score"))


def score_new(rows: DataFrame, done: DataFrame, model: PipelineModel, vector: str, key: str, overwrite: bool = False) -> DataFrame:
    """Scores of rows that aren't in done, or of all."""
    todo = rows if overwrite else rows.join(done.select(key), key, "left_anti")
    return score(todo, model, vector, key)


def similarity_gap(positives: DataFrame, randoms: DataFrame, a: str, b: str) -> DataFrame:
    """Mean cosine of positive and of random pairs of vectors, and their difference."""
    from quarry.functions import numbers as N

    def mean(pairs: DataFrame, name: str) -> DataFrame:
        return pairs.agg(F.avg(N.dot(F.col(a), F.col(b)) / (N.norm(F.col(a)) * N.norm(F.col(b)))).alias(name))

    both = mean(positives, "positive").join(mean(randoms, "random"))
    return both.withColumn("gap", F.col("positive") - F.col("random"))
