"""Deterministic samples, splits and schedules by arithmetic on keys or hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def draw(key: Column, seed: int = 42) -> Column:
    """A number below 2 ** 31 - 1 that looks random, from an integer key."""
    x = (key.cast("long") + seed) % 1000003
    return (x * 48271 + seed) % 2147483647


def sample(df: DataFrame, key: Column, n: int, seed: int = 42) -> DataFrame:
    """n rows in the order of draw."""
    return df.withColumn("__d", draw(key, seed)).withColumn("__k", key).orderBy("__d", "__k").limit(n).drop("__d", "__k")


def stratified(df: DataFrame, by: str, key: Column, n: int, seed: int = 42) -> DataFrame:
    """n rows of each kind."""
    w = Window.partitionBy(by).orderBy(draw(key, seed), key)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def hold_out(df: DataFrame, key: Column, seed: int = 42, least: int = 50, most: int = 500, part: int = 20) -> DataFrame:
    """Adds held_out for min(most, max(least, rows // part)) rows, chosen by draw."""
    total = df.agg(F.count("*").alias("__n"))
    n = F.least(F.lit(most), F.greatest(F.lit(least), F.floor(F.col("__n") / part)))
    limit = sample(df.select(key.alias("__key")), F.col("__key"), most, seed).withColumn("__rn", F.row_number().over(Window.orderBy(draw(F.col("__key"), seed), "__key"))).join(total).where(F.col("__rn") <= n).select("__key")
    return df.join(limit.withColumn("held_out", F.lit(True)), key.eqNullSafe(F.col("__key")), "left").drop("__key").fillna(False, ["held_out"])


def stratified_split(df: DataFrame, label: str, key: Column, share: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds test: a share of each label, rounded up."""
    w = Window.partitionBy(label)
    rn = F.row_number().over(w.orderBy(draw(key, seed), key))
    return df.withColumn("test", rn <= F.ceil(F.count("*").over(w) * share))


def scheduled(df: DataFrame, kinds: tuple[str, ...], key: Column, n: int, seed: int = 42) -> DataFrame:
    """n sampled rows, dealt the kinds in turn."""
    picked = sample(df, key, n, seed)
    rn = F.row_number().over(Window.orderBy(draw(key, seed), key)) - 1
    return picked.withColumn("turn", rn).withColumn("query_type", F.element_at(F.array(*[F.lit(k) for k in kinds]), (F.col("turn") % len(kinds) + 1).cast("int")))


def required_and_fill(df: DataFrame, required: DataFrame, key: str, size: int, seed: int = 42) -> DataFrame:
    """All rows whose key is required, and drawn others up to size."""
    need = df.join(required.select(key).distinct(), key, "left_semi")
    rest = df.join(required.select(key).distinct(), key, "left_anti")
    k = F.xxhash64(key) if dict(df.dtypes)[key] == "string" else F.col(key)
    drawn = sample(rest, k, size, seed).withColumn("__rn", F.row_number().over(Window.orderBy(draw(k, seed), k)))
    have = need.agg(F.count("*").alias("__have"))
    return need.unionByName(drawn.join(F.broadcast(have)).where(F.col("__rn") + F.col("__have") <= size).drop("__rn", "__have"))
