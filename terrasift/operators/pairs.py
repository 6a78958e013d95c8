"""Choosing the two epochs of a comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def before_after(rows: DataFrame, key: str, side: str, order: list[str], value: str) -> DataFrame:
    """(key, before_id, after_id): the last of each side. Without a ``before``: the earliest and latest of all. Keys with fewer than two
    rows, or without an ``after``, give none."""
    at = F.struct(*order)
    of = lambda s: F.max_by(F.when(F.col(side) == s, F.col(value)), F.when(F.col(side) == s, at))
    g = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), of("before").alias("b"), of("after").alias("a"), F.min_by(value, at).alias("first"), F.max_by(value, at).alias("last"))
    g = g.where("n >= 2 and a is not null")
    return g.select(key, F.coalesce("b", "first").alias("before_id"), F.when(F.col("b").isNull(), F.col("last")).otherwise(F.col("a")).alias("after_id"))
