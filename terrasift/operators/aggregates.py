"""Aggregations with the rules for nulls, ties and edges spelled out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranking import running


def value_counts(df: DataFrame, name: str, nulls: bool = False) -> DataFrame:
    rows = df if nulls else df.where(F.col(name).isNotNull())
    return rows.groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def pivot_counts(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Counts with a column for each value, 0 where there are none."""
    return df.groupBy(row).agg(*[F.count_if(F.col(column) == v).alias(v) for v in values])


def crosstab(df: DataFrame, column: str, hit: Column) -> DataFrame:
    """(value, missed, found, total, miss_rate) with missing values as "NULL" and a row "All"."""
    rows = df.select(F.coalesce(F.col(column).cast("string"), F.lit("NULL")).alias("value"), hit.alias("_hit"))
    both = rows.rollup("value").agg(F.count_if(~F.col("_hit")).alias("missed"), F.count_if("_hit").alias("found"), F.count(F.lit(1)).alias("total"))
    return both.select(F.coalesce("value", F.lit("All")).alias("value"), "missed", "found", "total", (F.col("missed") / F.col("total")).alias("miss_rate"))


def fixed_bins(x: Column, edges: list[float]) -> Column:
    """The bin of x, from 0; the last one is closed; outside: null."""
    out = F.when(x == edges[-1], len(edges) - 2)
    for k in range(len(edges) - 1):
        out = out.when((x >= edges[k]) & (x < edges[k + 1]), k)
    return out.cast("long")


def quantiles(df: DataFrame, name: str, at: list[float]) -> DataFrame:
    """One row: q of each probability, exact, by linear interpolation over the values that aren't null or NaN (null if there are none).

    Distinct values are counted and their counts summed up in order over all tasks, so no task holds all rows.
    """
    value = F.col(name).cast("double")
    counts = df.where(value.isNotNull() & ~F.isnan(value)).groupBy(value.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    placed = running(counts, [F.col("_v")], {"_before": "_n"}, "_at")
    total = counts.agg(F.sum("_n").alias("_all"))
    every = placed.crossJoin(F.broadcast(total))  # one row
    place = lambda q: (F.col("_all") - 1) * q
    held = lambda k: F.max(F.when((F.col("_before") <= k) & (k < F.col("_before") + F.col("_n")), F.col("_v")))
    ends = every.agg(F.max("_all").alias("_all"), *[held(f(place(q))).alias(f"_{side}{k}") for k, q in enumerate(at) for side, f in (("l", F.floor), ("h", F.ceil))])
    share = lambda q: place(q) - F.floor(place(q))
    return ends.select(*[(F.col(f"_l{k}") + (F.col(f"_h{k}") - F.col(f"_l{k}")) * share(q)).alias(f"q{round(q * 100)}") for k, q in enumerate(at)])


def describe(df: DataFrame, name: str, at: list[float]) -> DataFrame:
    one = df.agg(F.count(name).alias("n"), F.avg(name).alias("mean"), F.stddev_samp(name).alias("std"), F.min(name).alias("min"), F.max(name).alias("max"))
    q = quantiles(df, name, at)
    return one.crossJoin(F.broadcast(q)).select("n", "mean", "std", "min", *q.columns, "max")  # one row each


def share(test: Column) -> Column:
    """The share of all rows where test holds; missing is false."""
    return F.avg(F.when(test, 1.0).otherwise(0.0))


def sweep(df: DataFrame, name: str, thresholds: list[float], positive: Column) -> DataFrame:
    """(t, recall, dropped) for keeping rows at or above each threshold."""
    kept = F.coalesce(F.col(name) >= F.col("t"), F.lit(False))
    rows = df.withColumn("_y", positive).withColumn("t", F.explode(F.array(*map(F.lit, thresholds))))
    return rows.groupBy("t").agg((F.count_if(kept & F.col("_y")) / F.greatest(F.count_if("_y"), F.lit(1))).alias("recall"), share(~kept).alias("dropped"))


def most_common(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The commonest value of each group, the least of tied ones; null values don't count."""
    n = df.where(F.col(name).isNotNull()).groupBy(*keys, name).count()
    w = Window.partitionBy(*keys).orderBy(F.desc("count"), name)
    return n.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(*keys, name)


def hull(lat: str = "lat", lon: str = "lon") -> list[Column]:
    """Bounds and centre of points, and the greater side in metres (111 000 a degree) as ``span_m``."""
    high, wide = F.max(lat) - F.min(lat), F.max(lon) - F.min(lon)
    span = F.greatest(high * 111000.0, wide * 111000.0 * F.cos(F.radians(F.avg(lat))))
    return [F.min(lat).alias("lat_min"), F.max(lat).alias("lat_max"), F.min(lon).alias("lon_min"), F.max(lon).alias("lon_max"), F.floor(span + 0.5).cast("long").alias("span_m")]


def class_weights(df: DataFrame, name: str, classes: int) -> DataFrame:
    """(class, n, weight): N / (K * max(n, 1))."""
    n = df.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    every = n.agg(F.sum("n").alias("_all"))
    return n.crossJoin(F.broadcast(every)).select(name, "n", (F.col("_all") / (classes * F.greatest("n", F.lit(1)))).alias("weight"))
