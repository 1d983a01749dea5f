"""Relational reports: series, cross sections, sentiment, distributions and rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def metric_series(metrics: DataFrame, filings: DataFrame, ticker: str | None = None, metric: str | None = None) -> DataFrame:
    """Values of metrics over time, for one company or metric if named."""
    f, m = filings, metrics
    if ticker is not None:
        f = f.where(F.col("ticker") == ticker)
    if metric is not None:
        m = m.where(F.col("metric_name") == metric)
    return m.join(f, "filing_id").select("filing_id", "ticker", "filing_type", "reference_date", "metric_name", "extracted_value", "validated_value", "match_status")


def cross_section(metrics: DataFrame, filings: DataFrame, companies: DataFrame, metric: str, period: str) -> DataFrame:
    """One metric of all companies in one period, largest first, nulls last."""
    m = metrics.where(F.col("metric_name") == metric)
    f = filings.where(F.col("reference_date") == F.lit(period).cast("date"))
    return m.join(f, "filing_id").join(companies, "ticker").select("ticker", "name", "sector", "filing_id", "extracted_value").orderBy(F.desc_nulls_last("extracted_value"), "filing_id")


def latest(series: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The latest row of each key."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return series.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def sentiment_groups(chunks: DataFrame, filings: DataFrame, section: str | None = None, ticker: str | None = None) -> DataFrame:
    """Mean score and count by company, period, section and label of scored chunks."""
    c = chunks.where(F.col("sentiment_label").isNotNull())
    if section is not None:
        c = c.where(F.col("section_name") == section)
    f = filings if ticker is None else filings.where(F.col("ticker") == ticker)
    return c.join(f, "filing_id").groupBy("ticker", "reference_date", "section_name", "sentiment_label").agg(F.avg("sentiment_score").alias("avg_score"), F.count("*").alias("n"))


def sentiment_shares(chunks: DataFrame, filings: DataFrame, labels: tuple[str, ...]) -> DataFrame:
    """Percent of each label per period, rounded half to even."""
    p = chunks.where(F.col("sentiment_label").isNotNull()).join(filings, "filing_id").groupBy("reference_date").pivot("sentiment_label", list(labels)).count().fillna(0)
    total = sum((F.col(x) for x in labels[1:]), F.col(labels[0]))
    return p.select("reference_date", *[F.col(x).alias(f"n_{x}") for x in labels], *[F.bround(F.col(x) * 100.0 / total, 1).alias(f"{x}_pct") for x in labels])


def top_chunks(chunks: DataFrame, label: str, n: int = 50) -> DataFrame:
    """The n chunks of a label with the highest scores."""
    return chunks.where(F.col("sentiment_label") == label).orderBy(F.desc("sentiment_score"), "chunk_id").limit(n).select("chunk_id", "filing_id", "section_name", "sentiment_score", "chunk_text")


def counts(df: DataFrame, by: str, n: int | None = None) -> DataFrame:
    out = df.groupBy(by).agg(F.count("*").alias("n"))
    return out.orderBy(F.desc("n"), by).limit(n) if n else out


def year_pivot(filings: DataFrame, kinds: tuple[str, ...] = ("DFP", "ITR")) -> DataFrame:
    return filings.groupBy(F.year("reference_date").alias("year")).pivot("filing_type", list(kinds)).count().fillna(0)


def length_profile(df: DataFrame, value: Column, by: str, limit: int) -> DataFrame:
    """Percentiles (linear between ranks), extremes, mean and the share up to a limit, by group."""
    return df.groupBy(by).agg(
        F.count("*").alias("n"),
        F.min(value).alias("least"),
        F.max(value).alias("most"),
        F.avg(value).alias("mean"),
        *[F.percentile(value, p / 100).alias(f"p{p}") for p in (50, 90, 95)],
        F.avg(F.when(value <= limit, 1.0).otherwise(0.0)).alias("within"),
    )


def histogram(df: DataFrame, value: Column, low: float, high: float, bins: int) -> DataFrame:
    """Counts of equal bins from low to high; values outside fall into bins 0 and bins + 1."""
    return df.groupBy(F.width_bucket(value.cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(bins).cast("long")).alias("bin")).agg(F.count("*").alias("n"))


def answer_scores(answers: DataFrame, parts: tuple[str, ...] = ("faithfulness", "relevance", "completeness")) -> DataFrame:
    """Completely scored answers with the mean of their scores."""
    full = answers.dropna(subset=list(parts))
    return full.withColumn("mean_score", sum((F.col(c) for c in parts[1:]), F.col(parts[0])) / len(parts))


def extremes(scored: DataFrame, order: list[str], key: str, n: int = 3) -> DataFrame:
    best = scored.orderBy(*[F.desc(c) for c in order], key).limit(n).withColumn("end", F.lit("best"))
    worst = scored.orderBy(*[F.asc(c) for c in order], key).limit(n).withColumn("end", F.lit("worst"))
    return best.unionByName(worst)


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.groupBy(truth, predicted).agg(F.count("*").alias("n"))


def classifier_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Per class: support, precision, recall, F1; with accuracy, macro F1 and Cohen's kappa of all."""
    c = confusion(df, truth, predicted)
    rows = c.groupBy(F.col(truth).alias("label")).agg(F.sum("n").alias("support"), F.sum(F.when(F.col(truth) == F.col(predicted), F.col("n")).otherwise(0)).alias("hits"))
    cols = c.groupBy(F.col(predicted).alias("label")).agg(F.sum("n").alias("predicted"))
    t = rows.join(cols, "label", "full").fillna(0)
    each = t.select(
        "label",
        "support",
        "predicted",
        F.when(F.col("predicted") > 0, F.col("hits") / F.col("predicted")).otherwise(0.0).alias("precision"),
        F.when(F.col("support") > 0, F.col("hits") / F.col("support")).otherwise(0.0).alias("recall"),
        F.when(F.col("predicted") + F.col("support") > 0, 2.0 * F.col("hits") / (F.col("predicted") + F.col("support"))).otherwise(0.0).alias("f1"),
    )
    total = t.agg(F.sum("support").alias("n"), F.sum("hits").alias("hits"), F.sum(F.col("support").cast("double") * F.col("predicted")).alias("chance"))
    total = total.select((F.col("hits") / F.col("n")).alias("accuracy"), (F.col("chance") / (F.col("n").cast("double") * F.col("n"))).alias("pe"))
    macro = each.agg(F.avg("f1").alias("macro_f1"))
    one = total.join(macro, F.lit(True)).select("accuracy", "macro_f1", F.when(F.col("pe") < 1, (F.col("accuracy") - F.col("pe")) / (1 - F.col("pe"))).otherwise(1.0).alias("kappa"))
    return each.join(F.broadcast(one), F.lit(True))  # one row
