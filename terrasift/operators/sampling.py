"""Seeded sampling by the order of a hash: any engine and any number of executors draws the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import hash_order, hash_unit


def sample(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """n rows without replacement, all if there are no more."""
    return df.orderBy(hash_order(seed, F.col(key)), key).limit(n)


def stratified(df: DataFrame, stratum: Column, key: str, quota: dict[str, int], seed: str) -> DataFrame:
    """Up to quota rows of each stratum; strata without a quota give none."""
    allowed = F.create_map(*[x for k, v in quota.items() for x in (F.lit(k), F.lit(v))])
    w = Window.partitionBy("stratum").orderBy(hash_order(seed, F.col(key)), key)
    ranked = df.withColumn("stratum", stratum).where(F.col("stratum").isNotNull()).withColumn("_r", F.row_number().over(w))
    return ranked.where(F.col("_r") <= F.coalesce(F.try_element_at(allowed, "stratum"), F.lit(0))).drop("_r")


def round_robin(df: DataFrame, stratum: str, key: str, n: int, seed: str) -> DataFrame:
    """n rows, taking one of each stratum in turn."""
    w = Window.partitionBy(stratum).orderBy(hash_order(seed, F.col(key)), key)
    return df.withColumn("_k", F.row_number().over(w)).orderBy("_k", stratum, key).limit(n).drop("_k")


def decidable_mix(df: DataFrame, strata: list[str], decidable: Column, key: str, n: int, share: float, seed: str) -> DataFrame:
    """Up to n rows of each stratum, of which at most the floor of share * n, the decidable ones, come first."""
    w = Window.partitionBy(*strata, "_d").orderBy(hash_order(seed, F.col(key)), key)
    first = int(share * n)
    rows = df.withColumn("_d", F.coalesce(decidable, F.lit(False))).withColumn("_r", F.row_number().over(w))
    return rows.where((F.col("_d") & (F.col("_r") <= first)) | (~F.col("_d") & (F.col("_r") <= n - first))).drop("_d", "_r")


def half_capped(df: DataFrame, positive: Column, key: str, n: int, seed: str) -> DataFrame:
    """n rows with at most n / 2 positives; negatives fill the rest."""
    pos = sample(df.where(positive), key, n // 2, seed)
    k = pos.count()
    return pos.unionByName(sample(df.where(~positive), key, n - k, seed))


def jitter(key: Column, metres: float, seed: str) -> tuple[Column, Column]:
    """Uniform offsets (dx, dy) within plus or minus metres."""
    return (2 * hash_unit(seed + "x", key) - 1) * metres, (2 * hash_unit(seed + "y", key) - 1) * metres
