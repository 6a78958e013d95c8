"""Resume, upsert and planning: the state is a table or a log of events, and each operator a fold over it."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def chunk_status(rows: DataFrame, chunk: str, good: Column) -> DataFrame:
    """(chunk, status): ``empty`` marks chunks that were worked on and gave nothing, so that they aren't tried again."""
    return rows.groupBy(chunk).agg(F.when(F.count_if(good) == 0, "empty").otherwise("done").alias("status"))


def todo(every: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return every.join(done, keys, "left_anti")


def latest(log: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last event of each key."""
    others = [c for c in log.columns if c not in keys]
    return log.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_e")).select(*keys, *[F.col("_e")[c].alias(c) for c in others])


def fold(log: DataFrame, keys: list[str], order: list[str], deleted: Column) -> DataFrame:
    """The rows that stand after all upserts and deletes of the log."""
    return latest(log, keys, order).where(~F.coalesce(deleted, F.lit(False)))


def upsert(table: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """table with the rows of changes in place of those with their keys."""
    return todo(table, changes, keys).unionByName(changes, allowMissingColumns=True)


def batch_size(budget: int, base: int, each: int, least: int = 1, most: int = 64) -> int:
    """Items that fit a memory budget."""
    return max(least, min(most, (budget - base) // each if each > 0 else most))


def chunk_count(bytes_: Column, budget: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(bytes_ / float(budget))).cast("long")


def verdict(value: Column, warn: float, fail: float) -> Column:
    """PASS, WARN or FAIL as the value reaches the bounds."""
    return F.when(value >= fail, "FAIL").when(value >= warn, "WARN").otherwise("PASS")


def per_chunk(rows: DataFrame, chunk: str, work: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Rows of ``schema`` (chunk, ..., error) by work(chunk's rows); a chunk whose work fails is one row with its error. Chunks are planned to fit a task."""
    names = [f.strip().split()[0] for f in schema.split(",")]

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        try:
            done = work(part)
            return done.assign(**{chunk: key[0], "error": None})[names]
        except Exception as e:
            return pd.DataFrame([{n: None for n in names} | {chunk: key[0], "error": f"{type(e).__name__}: {e}"[:200]}])[names]

    return rows.groupBy(chunk).applyInPandas(run, schema)
