"""Queries of validation and reporting, each with its oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import numbers as N
from quarry.operators import reports as R
from quarry.operators import validate as V
from quarry.sources import standin as S

from .registry import query


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.compare(S.metric_values(spark, sf_dir))


@query("status_breakdown", S.with_relations("SELECT match_status, count(*) AS n FROM metrics GROUP BY match_status", "metrics"))
def status_breakdown(spark, sf_dir):
    return V.status_counts(_metrics(spark, sf_dir))


@query("extraction_status_counts", S.with_relations("SELECT extraction_status, count(*) AS n FROM filings GROUP BY 1", "filings"))
def extraction_status_counts(spark, sf_dir):
    return V.status_counts(S.filings(spark, sf_dir), "extraction_status")


_RATES = """count(*) AS n, count(*) FILTER (match_status = 'exact') AS n_exact, count(*) FILTER (match_status = 'close') AS n_close, count(*) FILTER (match_status = 'mismatch') AS n_mismatch, count(*) FILTER (match_status = 'missing') AS n_missing"""


@query("validation_report", S.with_relations(f"SELECT {_RATES}, n_exact * 100.0::DOUBLE / n AS exact_pct, (n_exact + n_close) * 100.0::DOUBLE / n AS exact_or_close_pct, (n - n_missing) * 100.0::DOUBLE / n AS coverage_pct, round(avg(error_ratio) FILTER (match_status <> 'missing'), 9) AS mean_error_ratio FROM metrics", "metrics"))
def validation_report(spark, sf_dir):
    return V.report(_metrics(spark, sf_dir)).withColumn("mean_error_ratio", F.round("mean_error_ratio", 9))


@query("mean_error_variants", S.with_relations("SELECT round(avg(error_ratio) FILTER (match_status = 'close'), 9) AS close_only, round(avg(error_ratio) FILTER (match_status IN ('exact', 'close', 'mismatch') AND error_ratio >= 0), 9) AS not_negative, round(avg(error_ratio) FILTER (match_status IN ('exact', 'close', 'mismatch')), 9) AS matched, round(avg(error_ratio) FILTER (match_status <> 'missing'), 9) AS found FROM metrics", "metrics"))
def mean_error_variants(spark, sf_dir):
    out = V.mean_errors(_metrics(spark, sf_dir))
    return out.select(*[F.round(c, 9).alias(c) for c in out.columns])


@query("metric_accuracy", S.with_relations(f"SELECT metric_name, {_RATES.replace('AS n,', 'AS total,', 1)}, (n_exact + n_close) * 100.0::DOUBLE / total AS match_pct, round(avg(error_ratio), 9) AS mean_error_ratio FROM metrics GROUP BY metric_name", "metrics"))
def metric_accuracy(spark, sf_dir):
    return V.by_metric(_metrics(spark, sf_dir)).withColumn("mean_error_ratio", F.round("mean_error_ratio", 9))


_BY_COMPANY = "SELECT ticker, count(*) AS total, count(*) FILTER (match_status = 'exact') AS n_exact, count(*) FILTER (match_status = 'exact') / count(*)::DOUBLE AS ratio, count(DISTINCT m.filing_id) AS n_filings FROM metrics m JOIN filings f USING (filing_id) GROUP BY ticker HAVING count(*) >= 5"


@query("company_accuracy", S.with_relations(_BY_COMPANY, "metrics", "filings"))
def company_accuracy(spark, sf_dir):
    return V.by_company(_metrics(spark, sf_dir), S.filings(spark, sf_dir))


@query("company_best_worst", S.with_relations(f"WITH c AS ({_BY_COMPANY}) SELECT * FROM (SELECT *, 'top' AS \"end\" FROM c ORDER BY ratio DESC, ticker LIMIT 10) UNION ALL SELECT * FROM (SELECT *, 'bottom' AS \"end\" FROM c ORDER BY ratio, ticker LIMIT 10)", "metrics", "filings"))
def company_best_worst(spark, sf_dir):
    return V.best_and_worst(company_accuracy(spark, sf_dir))


@query("company_sector_accuracy", S.with_relations(f"WITH c AS ({_BY_COMPANY}) SELECT c.ticker, total, ratio, sector FROM c LEFT JOIN companies USING (ticker)", "metrics", "filings", "companies"))
def company_sector_accuracy(spark, sf_dir):
    return company_accuracy(spark, sf_dir).join(S.companies(spark, sf_dir), "ticker", "left").select("ticker", "total", "ratio", "sector")


@query("status_pivot", S.with_relations("WITH t AS (SELECT filing_type, count(*) FILTER (match_status = 'exact') AS exact, count(*) FILTER (match_status = 'close') AS close, count(*) FILTER (match_status = 'mismatch') AS mismatch, count(*) FILTER (match_status = 'missing') AS missing, count(*) AS total FROM metrics JOIN filings USING (filing_id) GROUP BY filing_type) SELECT *, exact * 100.0::DOUBLE / total AS exact_pct, close * 100.0::DOUBLE / total AS close_pct, mismatch * 100.0::DOUBLE / total AS mismatch_pct, missing * 100.0::DOUBLE / total AS missing_pct FROM t", "metrics", "filings"))
def status_pivot(spark, sf_dir):
    return V.status_pivot(_metrics(spark, sf_dir), S.filings(spark, sf_dir))


@query("filing_outcomes", S.with_relations("SELECT status, count(*) AS n FROM (SELECT f.filing_id, CASE WHEN coalesce(found, 0) = 0 THEN 'failed' WHEN 7 - found > 2 THEN 'partial' ELSE 'success' END AS status FROM filings f LEFT JOIN (SELECT filing_id, count(DISTINCT metric_name) AS found FROM metric_values WHERE extracted_value IS NOT NULL GROUP BY 1) USING (filing_id)) GROUP BY status", "metric_values", "filings"))
def filing_outcomes(spark, sf_dir):
    return V.status_counts(V.outcome_of_filings(S.metric_values(spark, sf_dir), S.filings(spark, sf_dir), len(S.METRICS)), "status")


@query("orphan_keys", S.with_relations("SELECT 'metric' AS kind, filing_id AS key FROM metrics m WHERE NOT EXISTS (SELECT 1 FROM filings f WHERE f.filing_id = m.filing_id AND reference_date >= '1996-01-01') UNION ALL SELECT 'filing', filing_id FROM filings f WHERE reference_date >= '1996-01-01' AND NOT EXISTS (SELECT 1 FROM companies c WHERE c.ticker = f.ticker AND sector <> 'BUILDING')", "metrics", "filings", "companies"))
def orphan_keys(spark, sf_dir):
    f = S.filings(spark, sf_dir).where(F.col("reference_date") >= "1996-01-01")  # so that orphans exist
    return V.orphans(_metrics(spark, sf_dir), f, S.companies(spark, sf_dir).where(F.col("sector") != "BUILDING"))


@query("metric_series", S.with_relations("SELECT filing_id, ticker, filing_type, reference_date, metric_name, extracted_value, round(validated_value, 4) AS validated_value, match_status FROM metrics JOIN filings USING (filing_id) WHERE ticker = 'C7' AND metric_name = 'revenue'", "metrics", "filings"))
def metric_series(spark, sf_dir):
    return R.metric_series(_metrics(spark, sf_dir), S.filings(spark, sf_dir), "C7", "revenue").withColumn("validated_value", F.round("validated_value", 4))


@query("cross_section", S.with_relations("SELECT ticker, name, sector, filing_id, extracted_value FROM metrics JOIN filings USING (filing_id) JOIN companies USING (ticker) WHERE metric_name = 'revenue' AND reference_date = DATE '1997-03-05'", "metrics", "filings", "companies"))
def cross_section(spark, sf_dir):
    return R.cross_section(_metrics(spark, sf_dir), S.filings(spark, sf_dir), S.companies(spark, sf_dir), "revenue", "1997-03-05")


@query("top_companies_by_value", S.with_relations("SELECT ticker, name, sector, filing_id, extracted_value FROM metrics JOIN filings USING (filing_id) JOIN companies USING (ticker) WHERE metric_name = 'revenue' AND extracted_value IS NOT NULL ORDER BY extracted_value DESC, filing_id LIMIT 30", "metrics", "filings", "companies"))
def top_companies_by_value(spark, sf_dir):
    m = _metrics(spark, sf_dir).where((F.col("metric_name") == "revenue") & F.col("extracted_value").isNotNull())
    j = m.join(S.filings(spark, sf_dir), "filing_id").join(S.companies(spark, sf_dir), "ticker")
    return j.select("ticker", "name", "sector", "filing_id", "extracted_value").orderBy(F.desc("extracted_value"), "filing_id").limit(30)


@query("latest_readings", S.with_relations("SELECT ticker, metric_name, reference_date, filing_id, extracted_value FROM metrics JOIN filings USING (filing_id) QUALIFY row_number() OVER (PARTITION BY ticker, metric_name ORDER BY reference_date DESC, filing_id DESC, extracted_value DESC NULLS LAST, validated_value DESC NULLS LAST) = 1", "metrics", "filings"))
def latest_readings(spark, sf_dir):
    s = R.metric_series(_metrics(spark, sf_dir), S.filings(spark, sf_dir))
    return R.latest(s, ["ticker", "metric_name"], ["reference_date", "filing_id", "extracted_value", "validated_value"]).select("ticker", "metric_name", "reference_date", "filing_id", "extracted_value")


@query("sentiment_groups", S.with_relations("SELECT ticker, reference_date, section_name, sentiment_label, round(avg(sentiment_score), 9) AS avg_score, count(*) AS n FROM chunks JOIN filings USING (filing_id) WHERE sentiment_label IS NOT NULL GROUP BY ALL", "chunks", "filings"))
def sentiment_groups(spark, sf_dir):
    return R.sentiment_groups(S.chunks(spark, sf_dir), S.filings(spark, sf_dir)).withColumn("avg_score", F.round("avg_score", 9))


@query("sentiment_groups_filtered", S.with_relations("SELECT ticker, reference_date, section_name, sentiment_label, round(avg(sentiment_score), 9) AS avg_score, count(*) AS n FROM chunks JOIN filings USING (filing_id) WHERE sentiment_label IS NOT NULL AND section_name = 'Notas Explicativas' GROUP BY ALL", "chunks", "filings"))
def sentiment_groups_filtered(spark, sf_dir):
    return R.sentiment_groups(S.chunks(spark, sf_dir), S.filings(spark, sf_dir), section="Notas Explicativas").withColumn("avg_score", F.round("avg_score", 9))


@query("sentiment_shares", S.with_relations("WITH t AS (SELECT reference_date, count(*) FILTER (sentiment_label = 'optimistic') AS n_optimistic, count(*) FILTER (sentiment_label = 'neutral') AS n_neutral, count(*) FILTER (sentiment_label = 'pessimistic') AS n_pessimistic, count(*) AS t FROM chunks JOIN filings USING (filing_id) WHERE sentiment_label IS NOT NULL GROUP BY 1) SELECT reference_date, n_optimistic, n_neutral, n_pessimistic, round_even(n_optimistic * 100.0::DOUBLE / t, 1) AS optimistic_pct, round_even(n_neutral * 100.0::DOUBLE / t, 1) AS neutral_pct, round_even(n_pessimistic * 100.0::DOUBLE / t, 1) AS pessimistic_pct FROM t", "chunks", "filings"))
def sentiment_shares(spark, sf_dir):
    return R.sentiment_shares(S.chunks(spark, sf_dir), S.filings(spark, sf_dir), ("optimistic", "neutral", "pessimistic"))


@query("top_sentiment_chunks", S.with_relations("SELECT chunk_id, filing_id, section_name, sentiment_score, chunk_text FROM chunks WHERE sentiment_label = 'optimistic' ORDER BY sentiment_score DESC, chunk_id LIMIT 50", "chunks"))
def top_sentiment_chunks(spark, sf_dir):
    return R.top_chunks(S.chunks(spark, sf_dir), "optimistic")


@query("scored_chunk_counts", S.with_relations("SELECT count(*) AS n, count(*) FILTER (sentiment_label IS NULL) AS unscored, count(*) FILTER (sentiment_label IS NOT NULL) AS scored FROM chunks WHERE chunk_text IS NOT NULL AND chunk_text <> ''", "chunks"))
def scored_chunk_counts(spark, sf_dir):
    c = S.chunks(spark, sf_dir).where(F.col("chunk_text").isNotNull() & (F.col("chunk_text") != ""))
    return c.agg(F.count("*").alias("n"), F.count_if(F.col("sentiment_label").isNull()).alias("unscored"), F.count("sentiment_label").alias("scored"))


@query("label_distribution", S.with_relations("SELECT sentiment_label, count(*) AS n FROM chunks WHERE sentiment_label IS NOT NULL GROUP BY 1", "chunks"))
def label_distribution(spark, sf_dir):
    return R.counts(S.chunks(spark, sf_dir).where(F.col("sentiment_label").isNotNull()), "sentiment_label")


@query("busiest_companies", S.with_relations("SELECT ticker, count(*) AS n FROM filings GROUP BY 1 ORDER BY n DESC, ticker LIMIT 15", "filings"))
def busiest_companies(spark, sf_dir):
    return R.counts(S.filings(spark, sf_dir), "ticker", 15)


@query("distinct_periods", S.with_relations("SELECT DISTINCT reference_date FROM filings", "filings"))
def distinct_periods(spark, sf_dir):
    return S.filings(spark, sf_dir).select("reference_date").distinct()


@query("filings_year_pivot", S.with_relations("SELECT year(reference_date)::INT AS year, count(*) FILTER (filing_type = 'DFP') AS DFP, count(*) FILTER (filing_type = 'ITR') AS ITR FROM filings GROUP BY 1", "filings"))
def filings_year_pivot(spark, sf_dir):
    return R.year_pivot(S.filings(spark, sf_dir))


@query("chunk_length_profile", S.with_relations("SELECT section_name, count(*) AS n, min(length(chunk_text)) AS least, max(length(chunk_text)) AS most, round(avg(length(chunk_text)), 6) AS mean, quantile_cont(length(chunk_text), 0.5)::DOUBLE AS p50, round(quantile_cont(length(chunk_text)::DOUBLE, 0.9), 6) AS p90, round(quantile_cont(length(chunk_text)::DOUBLE, 0.95), 6) AS p95, round(avg(CASE WHEN length(chunk_text) <= 384 THEN 1.0::DOUBLE ELSE 0 END), 9) AS within FROM chunks GROUP BY 1", "chunks"))
def chunk_length_profile(spark, sf_dir):
    out = R.length_profile(S.chunks(spark, sf_dir), F.length("chunk_text"), "section_name", 384)
    return out.select("section_name", "n", F.col("least").cast("long").alias("least"), F.col("most").cast("long").alias("most"), *[F.round(c, 6).alias(c) for c in ("mean", "p50", "p90", "p95")], F.round("within", 9).alias("within"))


@query("chunk_length_histogram", S.with_relations("SELECT CASE WHEN length(chunk_text) >= 2000 THEN 41 ELSE length(chunk_text) // 50 + 1 END::BIGINT AS bin, count(*) AS n FROM chunks GROUP BY 1", "chunks"))
def chunk_length_histogram(spark, sf_dir):
    return R.histogram(S.chunks(spark, sf_dir), F.length("chunk_text"), 0, 2000, 40)


_ANSWERS = "SELECT conv_id * 100 + turn AS id, CASE WHEN conv_id % 5 <> 0 THEN (length(text) % 5 + 1)::INT END AS faithfulness, (length(role) % 5 + 1)::INT AS relevance, (turn % 5 + 1)::INT AS completeness FROM conversations"


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = S.table(spark, sf_dir, "conversations")
    return c.select((F.col("conv_id") * 100 + F.col("turn")).alias("id"), F.when(F.col("conv_id") % 5 != 0, (F.length("text") % 5 + 1).cast("int")).alias("faithfulness"), (F.length("role") % 5 + 1).cast("int").alias("relevance"), (F.col("turn") % 5 + 1).cast("int").alias("completeness"))


_SCORED = f"SELECT *, (faithfulness + relevance + completeness) / 3.0::DOUBLE AS mean_score FROM ({_ANSWERS}) WHERE faithfulness IS NOT NULL"


@query("answer_scores", f"SELECT count(*) AS n, round(avg(faithfulness), 9) AS faithfulness, round(avg(relevance), 9) AS relevance, round(avg(completeness), 9) AS completeness, round(avg(mean_score), 9) AS mean_score FROM ({_SCORED})")
def answer_scores(spark, sf_dir):
    s = R.answer_scores(_answers(spark, sf_dir))
    return s.agg(F.count("*").alias("n"), *[F.round(F.avg(c), 9).alias(c) for c in ("faithfulness", "relevance", "completeness", "mean_score")])


@query("answer_extremes", f"WITH s AS ({_SCORED}) SELECT id, faithfulness, relevance, completeness, \"end\" FROM (SELECT *, 'best' AS \"end\" FROM s ORDER BY faithfulness DESC, relevance DESC, completeness DESC, id LIMIT 3) UNION ALL SELECT id, faithfulness, relevance, completeness, \"end\" FROM (SELECT *, 'worst' AS \"end\" FROM s ORDER BY faithfulness, relevance, completeness, id LIMIT 3)")
def answer_extremes(spark, sf_dir):
    parts = ["faithfulness", "relevance", "completeness"]
    return R.extremes(R.answer_scores(_answers(spark, sf_dir)), parts, "id").select("id", *parts, "end")


_PREDICTED = "SELECT sentiment_label AS truth, CASE WHEN length(chunk_text) % 7 = 0 THEN 'neutral' WHEN length(chunk_text) % 11 = 0 THEN 'pessimistic' ELSE sentiment_label END AS predicted FROM chunks WHERE sentiment_label IS NOT NULL"


def _predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.length("chunk_text")
    return S.chunks(spark, sf_dir).where(F.col("sentiment_label").isNotNull()).select(F.col("sentiment_label").alias("truth"), F.when(n % 7 == 0, "neutral").when(n % 11 == 0, "pessimistic").otherwise(F.col("sentiment_label")).alias("predicted"))


@query("confusion_matrix", S.with_relations(f"SELECT truth, predicted, count(*) AS n FROM ({_PREDICTED}) GROUP BY 1, 2", "chunks"))
def confusion_matrix(spark, sf_dir):
    return R.confusion(_predicted(spark, sf_dir), "truth", "predicted")


@query("classifier_report", S.with_relations(f"""WITH p AS ({_PREDICTED}), l AS (SELECT DISTINCT truth AS label FROM p UNION SELECT DISTINCT predicted FROM p),
e AS (SELECT label, (SELECT count(*) FROM p WHERE truth = label) AS support, (SELECT count(*) FROM p WHERE predicted = label) AS predicted, (SELECT count(*) FROM p WHERE truth = label AND predicted = label) AS hits FROM l),
f AS (SELECT label, support, predicted, hits, CASE WHEN predicted > 0 THEN hits / predicted::DOUBLE ELSE 0 END AS precision, CASE WHEN support > 0 THEN hits / support::DOUBLE ELSE 0 END AS recall, 2.0::DOUBLE * hits / (predicted + support) AS f1 FROM e),
g AS (SELECT sum(hits) / sum(support)::DOUBLE AS accuracy, avg(f1) AS macro_f1, sum(support * predicted::DOUBLE) / (sum(support)::DOUBLE * sum(support)) AS pe FROM f)
SELECT label, support, predicted, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, round(accuracy, 9) AS accuracy, round(macro_f1, 9) AS macro_f1, round((accuracy - pe) / (1 - pe), 9) AS kappa FROM f, g""", "chunks"))
def classifier_report(spark, sf_dir):
    out = R.classifier_report(_predicted(spark, sf_dir), "truth", "predicted")
    return out.select("label", "support", "predicted", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1", "accuracy", "macro_f1", "kappa")])


@query("binary_sentiment", S.with_relations("SELECT CASE WHEN sentiment_label = 'optimistic' THEN 'positive' ELSE 'negative' END AS label, count(*) AS n FROM chunks WHERE sentiment_label IS NOT NULL GROUP BY 1", "chunks"))
def binary_sentiment(spark, sf_dir):
    c = S.chunks(spark, sf_dir).where(F.col("sentiment_label").isNotNull())
    return R.counts(c.withColumn("label", F.when(F.col("sentiment_label") == "optimistic", "positive").otherwise("negative")), "label")


@query("chart_feeds", S.with_relations("SELECT 'metrics' AS feed, metric_name AS grp, count(*) AS n, round(avg(extracted_value), 4) AS value FROM metrics GROUP BY 2 UNION ALL SELECT 'sentiment', sentiment_label, count(*), round(avg(sentiment_score), 4) FROM chunks WHERE sentiment_label IS NOT NULL GROUP BY 2", "metrics", "chunks"))
def chart_feeds(spark, sf_dir):
    a = _metrics(spark, sf_dir).groupBy(F.lit("metrics").alias("feed"), F.col("metric_name").alias("grp")).agg(F.count("*").alias("n"), F.round(F.avg("extracted_value"), 4).alias("value"))
    b = S.chunks(spark, sf_dir).where(F.col("sentiment_label").isNotNull()).groupBy(F.lit("sentiment").alias("feed"), F.col("sentiment_label").alias("grp")).agg(F.count("*").alias("n"), F.round(F.avg("sentiment_score"), 4).alias("value"))
    return a.unionByName(b)


@query("number_percent_guard", "SELECT n_nationkey::BIGINT AS k, CASE WHEN n_regionkey > 0 THEN n_nationkey * 100.0::DOUBLE / n_regionkey ELSE 0 END AS pct FROM nation")
def number_percent_guard(spark, sf_dir):
    return S.table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("k"), N.percent(F.col("n_nationkey"), F.col("n_regionkey")).alias("pct"))
