"""Ranking, dedup and sharding with an explicit order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import written


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first n rows of each group, ranked from 1."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= n)


def best(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group."""
    return top_n(df, keys, order, 1, "_r").drop("_r")


def by_priority(frames: list[DataFrame], keys: list[str], tie: list[str]) -> DataFrame:
    """Rows of the earliest frame that has their key; ties within a frame by ``tie``."""
    every = None
    for k, frame in enumerate(frames):
        part = frame.withColumn("_prio", F.lit(k))
        every = part if every is None else every.unionByName(part, allowMissingColumns=True)
    return best(every, keys, [F.col("_prio"), *map(F.col, tie)]).drop("_prio")


def running(df: DataFrame, order: list[Column], sums: dict[str, str], at: str = "at", write: Callable[[DataFrame, str], DataFrame] = written, label: str = "running") -> DataFrame:
    """df with ``at``, the number of rows before each in this order, and for each out: column of ``sums`` the column's sum over them.

    Rows are sorted over all tasks and written with the number of their task; windows run within tasks, and one row of sums
    for each task gives what lies before it. So no window holds all rows, nor all those of a common value.
    """
    rows = write(df.orderBy(*order).withColumn("_part", F.spark_partition_id()), label)
    each = {at: F.count(F.lit(1))} | {out: F.sum(c) for out, c in sums.items()}
    before, own = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    total = rows.groupBy(F.col("_part").alias("_p")).agg(*[x.alias(f"_t_{out}") for out, x in each.items()])
    shifts = total.select("_p", *[F.coalesce(F.sum(f"_t_{out}").over(before), F.lit(0)).alias(f"_s_{out}") for out in each])
    inner = rows.select("*", *[F.coalesce(x.over(own), F.lit(0)).alias(f"_o_{out}") for out, x in each.items()])
    joined = inner.join(F.broadcast(shifts), F.col("_part") == F.col("_p"))  # a row for each task
    return joined.select(*df.columns, *[(F.col(f"_s_{out}") + F.col(f"_o_{out}")).alias(out) for out in each])


def global_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Ranks from 0 over all rows; ``order`` should tell all rows apart."""
    return running(df, order, {}, name)


def fill_gaps(labels: DataFrame, key: str, year: str, label: str) -> DataFrame:
    """Years strictly between two consecutive equal labels of a key, as (key, year, label)."""
    w = Window.partitionBy(key).orderBy(year)
    pairs = labels.withColumn("_y", F.lead(year).over(w)).withColumn("_l", F.lead(label).over(w))
    pairs = pairs.where((F.col("_l") == F.col(label)) & (F.col("_y") > F.col(year) + 1))
    return pairs.select(key, F.explode(F.sequence(F.col(year) + 1, F.col("_y") - 1)).alias(year), label)
