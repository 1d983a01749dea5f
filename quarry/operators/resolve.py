"""Companies found in a registry, and manifests of filings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import text as T


def resolve(targets: DataFrame, registry: DataFrame, names: list[str], active: F.Column, order: list[str], gram: int = 3) -> DataFrame:
    """The registry row of each target whose folded pattern lies in one of the names: active ones first, then by order.

    targets: (ticker, name_search). Candidates share a pattern's first characters (gram of them) with some place of a name, which
    is an equality; only shorter patterns are held against all rows. Rows are taken once, though several names may hold a pattern.
    """
    t = targets.select("ticker", T.fold(F.col("name_search")).alias("__p"))
    reg = registry.withColumn("__names", F.array_compact(F.array(*[T.fold(F.col(n)) for n in names])))
    held = F.exists("__names", lambda n: F.contains(n, F.col("__p")))
    places = lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.length(n) - gram + 1, F.lit(1))), lambda i: F.substring(n, i, F.lit(gram)))
    keyed = reg.withColumn("__key", F.explode(F.array_distinct(F.flatten(F.transform("__names", places)))))
    long = t.where(F.length("__p") >= gram).withColumn("__key", F.substring("__p", 1, gram))
    found = keyed.join(long, "__key").where(held).drop("__key").unionByName(reg.join(t.where(F.length("__p") < gram), held))
    w = Window.partitionBy("ticker").orderBy(F.desc(active.cast("int")), *order)
    return found.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn", "__p", "__names")


def unresolved(targets: DataFrame, resolved: DataFrame) -> DataFrame:
    return targets.join(resolved.select("ticker"), "ticker", "left_anti")


def manifest(metadata: DataFrame, companies: DataFrame, kind: F.Column) -> DataFrame:
    """Filings of known companies with their keys; metadata: cnpj, reference_date, version and more; companies: cnpj, ticker."""
    m = metadata.join(companies.select("cnpj", "ticker"), "cnpj").withColumn("filing_type", kind)
    key = T.filing_key(F.col("ticker"), F.col("filing_type"), F.date_format("reference_date", "yyyy-MM-dd"), F.col("version").cast("string"))
    path = F.concat(F.lower("ticker"), F.lit("/"), F.lower("filing_type"), F.lit("_"), F.replace(F.date_format("reference_date", "yyyy-MM-dd"), F.lit("-"), F.lit("")), F.lit("_v"), F.col("version").cast("string"), F.lit(".pdf"))
    return m.withColumns({"filing_id": key, "pdf_path": path})
