"""Comparison of extracted metrics with ground truth, and reports on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import numbers as N

MATCHED = ("exact", "close", "mismatch")


def compare(values: DataFrame) -> DataFrame:
    """Adds error_ratio and match_status to rows of extracted_value and validated_value."""
    e, t = F.col("extracted_value"), F.col("validated_value")
    return values.withColumns({"error_ratio": N.relative_error(e, t), "match_status": N.match_status(e, t)})


def against_truth(truth: DataFrame, extracted: DataFrame) -> DataFrame:
    """Truth rows with what was extracted for them; what has no truth is left out."""
    keys = ["filing_id", "metric_name"]
    return compare(truth.select(*keys, F.col("value").alias("validated_value")).join(extracted.select(*keys, F.col("value").alias("extracted_value")), keys, "left"))


def share_of(condition: F.Column, total: F.Column | None = None) -> F.Column:
    return N.percent(F.count_if(condition), total if total is not None else F.count("*"))


def status_counts(metrics: DataFrame, by: str = "match_status") -> DataFrame:
    return metrics.groupBy(by).agg(F.count("*").alias("n"))


def report(metrics: DataFrame) -> DataFrame:
    """One row: counts, rates of exact, of exact or close, of found, and the mean error of what was found."""
    s = F.col("match_status")
    return metrics.agg(
        F.count("*").alias("n"),
        *[F.count_if(s == x).alias(f"n_{x}") for x in (*MATCHED, "missing")],
        share_of(s == "exact").alias("exact_pct"),
        share_of(s.isin("exact", "close")).alias("exact_or_close_pct"),
        share_of(s != "missing").alias("coverage_pct"),
        F.avg(F.when(s != "missing", F.col("error_ratio"))).alias("mean_error_ratio"),
    )


def mean_errors(metrics: DataFrame) -> DataFrame:
    """The four means that reports use: of close ones, of three statuses with errors from zero, of three statuses, of all found."""
    s, e = F.col("match_status"), F.col("error_ratio")
    return metrics.agg(
        F.avg(F.when(s == "close", e)).alias("close_only"),
        F.avg(F.when(s.isin(*MATCHED) & (e >= 0), e)).alias("not_negative"),
        F.avg(F.when(s.isin(*MATCHED), e)).alias("matched"),
        F.avg(F.when((s != "missing") & e.isNotNull(), e)).alias("found"),
    )


def by_metric(metrics: DataFrame) -> DataFrame:
    s = F.col("match_status")
    return metrics.groupBy("metric_name").agg(
        F.count("*").alias("total"),
        *[F.count_if(s == x).alias(f"n_{x}") for x in (*MATCHED, "missing")],
        share_of(s.isin("exact", "close")).alias("match_pct"),
        F.avg("error_ratio").alias("mean_error_ratio"),
    )


def by_company(metrics: DataFrame, filings: DataFrame, least: int = 5) -> DataFrame:
    """Accuracy of companies with at least so many metrics."""
    joined = metrics.join(filings.select("filing_id", "ticker"), "filing_id")
    ok = F.count_if(F.col("match_status") == "exact")
    return joined.groupBy("ticker").agg(F.count("*").alias("total"), ok.alias("n_exact"), (ok / F.count("*")).alias("ratio"), F.count_distinct("filing_id").alias("n_filings")).where(F.col("total") >= least)


def best_and_worst(companies: DataFrame, n: int = 10) -> DataFrame:
    """The n best and the n worst by ratio; a company may be in both."""
    best = companies.orderBy(F.desc("ratio"), "ticker").limit(n).withColumn("end", F.lit("top"))
    worst = companies.orderBy(F.asc("ratio"), "ticker").limit(n).withColumn("end", F.lit("bottom"))
    return best.unionByName(worst)


def status_pivot(metrics: DataFrame, filings: DataFrame) -> DataFrame:
    """Counts by filing type × status, with totals and percents."""
    p = metrics.join(filings.select("filing_id", "filing_type"), "filing_id").groupBy("filing_type").pivot("match_status", [*MATCHED, "missing"]).count().fillna(0)
    total = sum((F.col(x) for x in ("close", "mismatch", "missing")), F.col("exact"))
    return p.withColumn("total", total).withColumns({f"{x}_pct": N.percent(F.col(x), F.col("total")) for x in (*MATCHED, "missing")})


def outcome_of_filings(extracted: DataFrame, filings: DataFrame, expected: int) -> DataFrame:
    """The status of each filing by how many metrics were found and how many of the expected ones weren't."""
    found = extracted.where(F.col("extracted_value").isNotNull()).groupBy("filing_id").agg(F.count_distinct("metric_name").alias("found"))
    out = filings.select("filing_id").join(found, "filing_id", "left").fillna(0, ["found"])
    return out.withColumn("status", N.filing_status(F.col("found"), F.lit(expected) - F.col("found")))


def orphans(metrics: DataFrame, filings: DataFrame, companies: DataFrame) -> DataFrame:
    """Keys without a parent: metrics without a filing, filings without a company."""
    a = metrics.select("filing_id").join(filings, "filing_id", "left_anti").select(F.lit("metric").alias("kind"), F.col("filing_id").alias("key"))
    b = filings.select("filing_id", "ticker").join(companies, "ticker", "left_anti").select(F.lit("filing").alias("kind"), F.col("filing_id").alias("key"))
    return a.unionAll(b)
