"""Set accounting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def accounting(got: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """One row: distinct keys that leaked (got, not expected), that are missing, and that are in both."""
    a, b = got.select(key).distinct().withColumn("_a", F.lit(True)), expected.select(key).distinct().withColumn("_b", F.lit(True))
    has = lambda c: F.coalesce(c, F.lit(False))
    j = a.join(b, key, "full").select(has("_a").alias("a"), has("_b").alias("b"))
    return j.agg(F.count_if(F.expr("a and not b")).alias("leaked"), F.count_if(F.expr("b and not a")).alias("missing"), F.count_if(F.expr("a and b")).alias("both"))
