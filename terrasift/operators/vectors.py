"""Vector search and scoring on array<double> columns.

Search compares every query with every reference, by matrix products over Arrow batches. The smaller side travels, in slices of
at most SLICE bytes that the driver and each task hold one at a time; the larger side is read once for each slice and never shuffled.
Rows with null vectors meet nothing: such queries have null results.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import dot
from ..sources.scratch import written
from .ranking import running

#: Bytes of vectors in a slice; products of a query and a reference that are worked on at a time.
SLICE, PRODUCTS = 32 << 20, 1 << 21


def _matrix(column: pa.Array) -> np.ndarray:
    rows = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(rows, -1) if rows else np.zeros((0, 0))


def _slices(df: DataFrame, vector: str, rows: int) -> Iterator[pa.RecordBatch]:
    """All rows of df, some at a time, in the order of a hash."""
    width = df.select(F.max(F.size(vector)).alias("n")).first().n or 1
    each = max(1, SLICE // (8 * width))
    if rows <= each:
        yield from df.toArrow().combine_chunks().to_batches()
        return
    placed = written(running(df, [F.xxhash64(*df.columns), *[F.col(c) for c in df.columns]], {}, "_k"), "slices")
    for k in range(math.ceil(rows / each)):
        yield from placed.where((F.col("_k") >= k * each) & (F.col("_k") < (k + 1) * each)).drop("_k").toArrow().combine_chunks().to_batches()


def _search(queries: DataFrame, refs: DataFrame, state: Callable, fold: Callable, emit: Callable, schema: str) -> DataFrame:
    """Rows of ``schema`` by emit(keys, state), one or more for each query (key, v): state(q, refs) is what a block of references says of a block of
    queries, fold(a, b) joins two of them."""

    def blocks(q: np.ndarray, batch: pa.RecordBatch) -> tuple:
        found, step = None, max(1, PRODUCTS // max(1, len(q)))
        for lo in range(0, batch.num_rows, step):
            new = state(q, batch.slice(lo, step))
            found = new if found is None else fold(found, new)
        return found

    def over_queries(some: pa.RecordBatch):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            refs = sent.value
            for batch in batches:
                q, step = _matrix(batch.column(1)), max(1, PRODUCTS // max(1, min(refs.num_rows, 4096)))
                for lo in range(0, batch.num_rows, step):
                    yield emit(batch.column(0).slice(lo, step), blocks(q[lo : lo + step], refs))

        sent = spark.sparkContext.broadcast(some)
        return queries.mapInArrow(run, schema)

    def over_refs(some: pa.RecordBatch):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            asked, parts = sent.value, None
            q = _matrix(asked.column(1))
            cuts = range(0, len(q), 4096)
            for batch in batches:
                if batch.num_rows:
                    new = [blocks(q[lo : lo + 4096], batch) for lo in cuts]
                    parts = new if parts is None else [fold(a, b) for a, b in zip(parts, new)]
            for lo, part in zip(cuts, parts or []):
                yield emit(asked.column(0).slice(lo, 4096), part)

        sent = spark.sparkContext.broadcast(some)
        return refs.mapInArrow(run, schema)

    spark, n, m = queries.sparkSession, queries.count(), refs.count()
    out = None
    for some in _slices(refs, "w", m) if m <= n else _slices(queries, "v", n):
        part = over_queries(some) if m <= n else over_refs(some)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def nearest_by_group(queries: DataFrame, refs: DataFrame, key: str, group: str, groups: list[str]) -> DataFrame:
    """For each query (key, v), the least cosine distance to the references (w) of each group; null where a group has none."""

    def unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)

    def state(q: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
        out, of = np.full((len(q), len(groups)), np.inf), np.array(batch.column(1).to_pylist(), dtype=object)
        d = 1.0 - unit(q) @ unit(_matrix(batch.column(0))).T
        for k, g in enumerate(groups):
            if (of == g).any():
                out[:, k] = d[:, of == g].min(axis=1)
        return out

    def emit(keys: pa.Array, least: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([keys, *[pa.array(x, mask=np.isinf(x)) for x in least.T]], names=[key, *groups])

    kind = queries.schema[key].dataType.simpleString()
    there = queries.where("v is not null").select(key, "v")
    found = _search(there, refs.where("w is not null").select("w", group), state, np.minimum, emit, ", ".join([f"`{key}` {kind}", *[f"`{g}` double" for g in groups]]))
    return queries.select(key).join(found.groupBy(key).agg(*[F.min(g).alias(g) for g in groups]), key, "left")


def linear_scores(v: Column, weights: list[list[float]], bias: list[float]) -> list[Column]:
    """W v + b, a column for each row of W."""
    return [dot(v, F.array(*map(F.lit, w))) + b for w, b in zip(weights, bias)]


def softmax(scores: list[Column]) -> list[Column]:
    top = F.greatest(*scores)
    e = [F.exp(s - top) for s in scores]
    whole = sum(e[1:], e[0])
    return [x / whole for x in e]


def knn_vote(queries: DataFrame, refs: DataFrame, key: str, k: int) -> DataFrame:
    """(key, p): the share of label 1 among the k nearest by Euclidean distance (ties: least rid), weighed by 1/distance; an equal vector decides alone.

    refs: rid, w, y. Products narrow the references down; distances of what is left come from differences.
    """

    def state(q: np.ndarray, batch: pa.RecordBatch) -> tuple:
        rid, w, y = batch.column(0).to_numpy(), _matrix(batch.column(1)), batch.column(2).to_numpy()
        near = (q * q).sum(axis=1)[:, None] + (w * w).sum(axis=1) - 2 * (q @ w.T)
        slack = 1e-9 * (1 + (q * q).sum(axis=1) + (w * w).sum(axis=1).max())
        bound = (np.partition(near, k - 1, axis=1)[:, k - 1] if len(w) > k else np.full(len(q), np.inf)) + slack
        d, r, label = (np.full((len(q), k), x) for x in (np.inf, np.iinfo(np.int64).max, 0.0))
        for j in range(len(q)):
            some = np.flatnonzero(near[j] <= bound[j])
            far = np.sqrt(((q[j] - w[some]) ** 2).sum(axis=1))
            first = np.lexsort((rid[some], far))[:k]
            d[j, : len(first)], r[j, : len(first)], label[j, : len(first)] = far[first], rid[some][first], y[some][first]
        return d, r, label

    def fold(a: tuple, b: tuple) -> tuple:
        both = [np.concatenate(x, axis=1) for x in zip(a, b)]
        order = np.lexsort((both[1], both[0]), axis=1)[:, :k]
        return tuple(np.take_along_axis(x, order, axis=1) for x in both)

    def emit(keys: pa.Array, found: tuple) -> pa.RecordBatch:
        d, r, y = found
        there = ~np.isinf(d)
        rows = pa.StructArray.from_arrays([pa.array(x[there]) for x in (d, r, y)], names=["d", "rid", "y"])
        at = pa.array(np.concatenate(([0], np.cumsum(there.sum(axis=1)))), pa.int32())
        return pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(at, rows)], names=[key, "n"])

    kind = queries.schema[key].dataType.simpleString()
    sides = queries.where("v is not null").select(key, "v"), refs.where("w is not null").select(F.col("rid").cast("long").alias("rid"), "w", F.col("y").cast("double").alias("y"))
    found = _search(sides[0], sides[1].select("rid", "w", "y"), state, fold, emit, f"`{key}` {kind}, n array<struct<d:double,rid:bigint,y:double>>")
    best = found.groupBy(key).agg(F.slice(F.array_sort(F.flatten(F.collect_list("n"))), 1, k).alias("n"))  # k for each slice and task
    zero = F.filter("n", lambda r: r["d"] == 0)
    used = F.when(F.size(zero) > 0, F.transform(zero, lambda r: F.struct(F.lit(1.0).alias("w"), r["y"].alias("y")))).otherwise(F.transform("n", lambda r: F.struct((1.0 / r["d"]).alias("w"), r["y"].alias("y"))))
    add = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)
    return best.withColumn("u", used).select(key, F.try_divide(add(F.transform("u", lambda r: r["w"] * r["y"])), add(F.transform("u", lambda r: r["w"]))).alias("p"))
