"""Filters with the null and NaN rules spelled out: comparisons with a missing value are false, exclusions keep it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def at_least(score: str, t: float) -> Column:
    """A score that is there and reaches t."""
    return F.col(score).isNotNull() & ~F.isnan(score) & (F.col(score) >= t)


def in_band(score: str, low: float, high: float) -> Column:
    return at_least(score, low) & (F.col(score) < high)


def not_in(name: str, values: list) -> Column:
    return F.col(name).isNull() | ~F.col(name).isin(values)


def said(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def industrial(kind: str, subtype: str, kinds: list) -> Column:
    return said(F.col(kind).isin(kinds)) | said(F.col(subtype) == "industrial")


def inside_box(x0: float, y0: float, x1: float, y1: float) -> Column:
    return (F.col("xmin") >= x0) & (F.col("xmax") <= x1) & (F.col("ymin") >= y0) & (F.col("ymax") <= y1)


def has_source(sources: str, name: str) -> Column:
    return said(F.array_contains(sources, name))


def worth_keeping(kind: str, subtype: str, area: str, drop: list, floor: float) -> Column:
    folded = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    return ~(folded(kind).isin(drop) | folded(subtype).isin(drop) | (F.coalesce(F.col(area), F.lit(0.0)) < floor))


def flags(df: DataFrame, tests: dict[str, Column], any_name: str) -> DataFrame:
    """df with a boolean for each test (missing: false) and whether any holds."""
    named = {k: said(c) for k, c in tests.items()}
    return df.withColumns(named).withColumn(any_name, reduce(lambda a, b: a | b, named.values()))


def as_manifest(df: DataFrame, **constants) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in constants.items()})


def note_verdict(note: str) -> Column:
    """Fixed values and their order: what a note's words mean for its site; null: nothing."""
    text = F.lower(F.col(note))
    some = lambda *words: reduce(lambda a, b: a | b, [text.contains(w) for w in words])
    return (
        F.when(some("demolish"), "drop").when(some("cut off", "not centered", "bottom right corner"), "drop")
        .when(~F.trim(text).startswith("important"), None).when(some("extention", "extension", "expansion"), "expansion_existing")
        .when(some("brownfield"), "brownfield").when(some("greenfield"), "greenfield")
    )


def in_named_boxes(df: DataFrame, boxes: dict[str, tuple[float, float, float, float]]) -> DataFrame:
    """A row for each of a fixed list of boxes (edges included) that holds the point."""
    inside = lambda b: (F.col("lon") >= b[0]) & (F.col("lat") >= b[1]) & (F.col("lon") <= b[2]) & (F.col("lat") <= b[3])
    return df.withColumn("box", F.explode(F.array_compact(F.array(*[F.when(inside(b), name) for name, b in boxes.items()]))))
