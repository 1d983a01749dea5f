"""Keyed changes of tables as whole-table expressions: upsert, ignore, replace, delete, update."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _same(left: str, right: str, keys: list[str]) -> F.Column:
    on = F.col(f"{left}.{keys[0]}").eqNullSafe(F.col(f"{right}.{keys[0]}"))
    for k in keys[1:]:
        on = on & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return on


def last_of(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row of each key: that which order puts last."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return rows.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def upsert(table: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of changes (one of each key) replace those of their key, or are added."""
    kept = table.alias("t").join(changes.select(*keys).alias("c"), _same("t", "c", keys), "left_anti")
    return kept.unionByName(changes)


def insert_ignore(table: DataFrame, rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows whose key is new are added; of several with one key, the first by order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    first = rows.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
    new = first.alias("n").join(table.select(*keys).alias("t"), _same("n", "t", keys), "left_anti")
    return table.unionByName(new)


def delete(table: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return table.alias("t").join(gone.select(*keys).alias("g"), _same("t", "g", keys), "left_anti")


def replace_group(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of the keys that rows has give way to rows (several of a key are kept)."""
    return delete(table, rows.select(*keys).distinct(), keys).unionByName(rows)


def update(table: DataFrame, values: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Columns take the values of matching rows, null or not; other rows stay."""
    v = values.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[F.col(c).alias(f"__v_{c}") for c in columns], F.lit(True).alias("__hit"))
    on = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"__k_{k}"))
        on = c if on is None else on & c
    joined = table.join(v, on, "left")
    return joined.select(*[F.when(F.col("__hit"), F.col(f"__v_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in table.columns])
