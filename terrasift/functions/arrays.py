"""Expressions over array<double> columns: vectors and small rasters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(v: str) -> Column:
    return F.col(v).cast("array<double>")


def total(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def norm(v: Column, floor: float = 1e-12) -> Column:
    return F.greatest(F.sqrt(dot(v, v)), F.lit(floor))


def normalised(v: Column) -> Column:
    return F.transform(F.arrays_zip(v.alias("x"), F.array_repeat(norm(v), F.size(v).cast("int")).alias("n")), lambda z: z["x"] / z["n"])


def cosine_distance(a: Column, b: Column) -> Column:
    return 1.0 - dot(a, b) / (norm(a) * norm(b))


def present(v: Column) -> Column:
    """The values that aren't null or NaN."""
    return F.filter(v, lambda x: x.isNotNull() & ~F.isnan(x))


def mean(v: Column) -> Column:
    return F.try_divide(total(v), F.size(v).cast("double"))


def stdev(v: Column) -> Column:
    """Population standard deviation."""
    return F.sqrt(F.greatest(F.lit(0.0), mean(F.transform(v, lambda x: x * x)) - F.pow(mean(v), 2)))
