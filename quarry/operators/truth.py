"""Ground truth of metrics from statement rows, for all filings at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions import numbers as N
from quarry.functions import text as T

# The statement and account codes of each metric in order of preference, and descriptions that stand in for them.
STATEMENTS = {"revenue": "DRE", "cogs": "DRE", "gross_profit": "DRE", "net_income": "DRE", "total_assets": "BPA", "total_equity": "BPP", "operating_cash_flow": "DFC_MI"}
CODES = {"revenue": ["3.01"], "cogs": ["3.02"], "gross_profit": ["3.03"], "net_income": ["3.11", "3.10", "3.09"], "total_assets": ["1"], "total_equity": [], "operating_cash_flow": ["6.01"]}
DESCRIPTIONS = {"net_income": r"lucro.{0,10}preju[íi]zo.{0,20}(per[íi]odo|exerc[íi]cio)|lucro\s+l[íi]quido", "total_equity": r"patrim[oô]nio\s+l[íi]quido"}
CURRENT, DEPTH = "ULTIMO", 2


def rules(spark: SparkSession) -> DataFrame:
    """(metric_name, statement, code, pattern, priority)."""
    rows = [(m, STATEMENTS[m], c, None, i) for m, cs in CODES.items() for i, c in enumerate(cs)]
    rows += [(m, STATEMENTS[m], None, p, 100) for m, p in DESCRIPTIONS.items()]
    return spark.createDataFrame(rows, "metric_name string, statement string, code string, pattern string, priority int")


def candidates(statements: DataFrame) -> DataFrame:
    """Rows of statements that may hold a metric, with the priority of the rule that says so.

    statements: filing_id, statement, ORDEM_EXERC, CD_CONTA, DS_CONTA, DT_INI_EXERC, VL_CONTA; columns that lack don't filter.
    """
    s = statements
    if "ORDEM_EXERC" in s.columns:
        s = s.where(T.fold(F.coalesce("ORDEM_EXERC", F.lit(""))) == CURRENT)
    by_code = s.join(F.broadcast(rules(s.sparkSession).where(F.col("code").isNotNull())), "statement").where(F.col("CD_CONTA") == F.col("code"))
    shallow = F.coalesce(F.regexp_count("CD_CONTA", F.lit(r"\.")) <= DEPTH, F.lit(False))
    parts = [by_code.select(*s.columns, "metric_name", "priority")]
    for m, p in DESCRIPTIONS.items():
        hit = F.coalesce(F.col("DS_CONTA").rlike("(?iU)" + p), F.lit(False))
        parts.append(s.where((F.col("statement") == STATEMENTS[m]) & shallow & hit).select(*s.columns, F.lit(m).alias("metric_name"), F.lit(100).alias("priority")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def ground_truth(statements: DataFrame) -> DataFrame:
    """(filing_id, metric_name, value): the first code with rows, else the description; of several rows the earliest start."""
    start = [F.col("DT_INI_EXERC").asc_nulls_last()] if "DT_INI_EXERC" in statements.columns else []
    w = Window.partitionBy("filing_id", "metric_name").orderBy("priority", *start, "CD_CONTA", "VL_CONTA")
    best = candidates(statements).withColumn("__rn", F.row_number().over(w)).where("__rn = 1")
    return best.select("filing_id", "metric_name", N.truth_number(F.col("VL_CONTA")).alias("value")).where(F.col("value").isNotNull())
