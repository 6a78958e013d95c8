"""Probes on vectors: training, folds, evaluation. Models are pyspark.ml's; parity with other trainers is in metrics, not weights."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import normalised
from ..sources.scratch import written
from . import metrics
from .aggregates import class_weights
from .vectors import knn_vote


def weighed(df: DataFrame, classes: int = 2) -> DataFrame:
    """df (v, y) with features and the class-balanced weight."""
    w = class_weights(df, "y", classes).select("y", F.col("weight").alias("w"))
    return df.join(F.broadcast(w), "y").withColumn("features", array_to_vector("v")).withColumn("y", F.col("y").cast("double"))


def group_folds(df: DataFrame, group: str, folds: int) -> DataFrame:
    """(group, fold): groups by size, the largest first, each to the fold with the fewest rows (the least of equal ones)."""
    n = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    schema = f"{n.select(F.col(group).alias('g')).schema['g'].dataType.simpleString()}"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        load = [(0, k) for k in range(folds)]  # a heap: lightest fold first
        for batch in batches:
            dealt = []
            for size in batch.column(1).to_pylist():
                dealt.append(load[0][1])
                heapq.heapreplace(load, (load[0][0] + size, load[0][1]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(dealt, pa.int32())], names=[group, "fold"])

    ordered = n.coalesce(1).sortWithinPartitions(F.desc("n"), group)  # one row for each group, in one task
    return ordered.mapInArrow(deal, f"`{group}` {schema}, fold int")


class Scored:
    """A model given as a function of df (v) to df with ``margin`` or ``share``."""

    def __init__(self, score: Callable[[DataFrame], DataFrame]):
        self.transform = score


def _stacked(v: pd.Series) -> np.ndarray:
    return np.stack(v.to_numpy()).astype(float) if len(v) else np.zeros((0, 0))


def linear_ce(df: DataFrame, steps: int = 60, rate: float = 0.05, decay: float = 1e-4) -> Scored:
    """Two-class linear head by class-weighted cross-entropy and AdamW with a cosine rate: full-batch gradients, summed up where the rows are."""
    rows = written(df.select("v", F.col("y").cast("double").alias("y"), "w"), "probe")
    width = rows.select(F.max(F.size("v")).alias("n")).first().n or 0
    p = np.zeros(width + 1)  # the difference of the two classes' logits
    m, s = np.zeros_like(p), np.zeros_like(p)
    for t in range(1, steps + 1):
        now = p.copy()

        def gradients(batches: Iterator[pd.DataFrame], now: np.ndarray = now) -> Iterator[pd.DataFrame]:
            total, weight = np.zeros(len(now)), 0.0
            for batch in batches:
                if len(batch):
                    x = np.hstack([_stacked(batch["v"]), np.ones((len(batch), 1))])
                    off = (1 / (1 + np.exp(-x @ now)) - batch["y"].to_numpy()) * batch["w"].to_numpy()
                    total, weight = total + x.T @ off, weight + batch["w"].sum()
            yield pd.DataFrame({"k": np.arange(len(now) + 1), "g": np.append(total, weight)})

        sums = rows.mapInPandas(gradients, "k int, g double").groupBy("k").agg(F.sum("g").alias("g")).orderBy("k").toPandas()["g"].to_numpy()
        if not len(sums) or not sums[-1]:
            break
        g = sums[:-1] / sums[-1]
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        p -= rate * 0.5 * (1 + np.cos(np.pi * (t - 1) / steps)) * ((m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8) + decay * p)

    @F.pandas_udf("double")
    def share(v: pd.Series) -> pd.Series:
        x = _stacked(v)
        return pd.Series(1 / (1 + np.exp(-(x @ p[: x.shape[1]] + p[-1]))) if len(x) else [])

    return Scored(lambda df: df.withColumn("share", share("v")))


def landmarks(df: DataFrame, n: int) -> np.ndarray:
    """n vectors (or all), the first in the order of a hash."""
    rows = df.where("v is not null").select("v", F.xxhash64("v").alias("_o")).orderBy("_o").limit(n).select("v").toPandas()
    return _stacked(rows["v"])


def rbf(gamma: float) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    return lambda a, b: np.exp(-gamma * np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * a @ b.T, 0))


def poly2(gamma: float) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    return lambda a, b: (gamma * a @ b.T + 1) ** 2


def nystroem(df: DataFrame, points: np.ndarray, kernel: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """df (v) with features: kernel values to a fixed set of points, whitened by their own kernel matrix; directions without weight in it are left out."""
    values, vectors = np.linalg.eigh(kernel(points, points))
    there = values > 1e-8 * values.max(initial=0.0)
    white = vectors[:, there] / np.sqrt(values[there])

    @F.pandas_udf("array<double>")
    def lifted(v: pd.Series) -> pd.Series:
        return pd.Series(list(kernel(_stacked(v), points) @ white) if len(v) else [])

    return df.withColumn("features", array_to_vector(lifted("v")))


def lifted_svc(df: DataFrame, kernel: Callable, n: int = 200) -> Scored:
    """A linear machine on the features of nystroem()."""
    points = landmarks(df, n)
    model = LinearSVC(weightCol="w", maxIter=60, regParam=0.001, standardization=False, featuresCol="features", labelCol="y").fit(nystroem(df, points, kernel))
    return Scored(lambda x: model.transform(nystroem(x, points, kernel)))


def kernel_svc(df: DataFrame, kernel: Callable, cost: float = 1.0, most: int = 2000, passes: int = 40) -> Scored:
    """A kernel machine on at most ``most`` rows, half of them positive if there are so many, by coordinate ascent on the dual with class weights.

    Its own kernel matrix is held on the driver, so the sample is bounded; the bias is a constant feature.
    """
    rows = df.where("v is not null").select("v", F.col("y").cast("int").alias("y"), "w", F.xxhash64("v").alias("_o"))
    parts = [rows.where(F.col("y") == k).orderBy("_o").limit(n).toPandas() for k, n in ((1, most // 2), (0, most))]
    sample = pd.concat([parts[0], parts[1][: most - len(parts[0])]])
    x, y, c = _stacked(sample["v"]), np.where(sample["y"] == 1, 1.0, -1.0), cost * sample["w"].to_numpy()
    q = (kernel(x, x) + 1) * y[:, None] * y
    a, slope = np.zeros(len(y)), -np.ones(len(y))
    for _ in range(passes):
        for j in range(len(y)):
            step = min(max(a[j] - slope[j] / max(q[j, j], 1e-12), 0.0), c[j]) - a[j]
            if step:
                a[j] += step
                slope += step * q[j]
    kept = a > 0
    points, weights = x[kept], (a * y)[kept]

    @F.pandas_udf("double")
    def margin(v: pd.Series) -> pd.Series:
        return pd.Series((kernel(_stacked(v), points) + 1) @ weights if len(v) and len(points) else np.zeros(len(v)))

    return Scored(lambda df: df.withColumn("margin", margin("v")))


def neighbours(df: DataFrame, k: int = 15) -> Scored:
    """The distance-weighed vote of the k nearest by angle; rows to score need an ``id``."""
    unit = lambda rows: rows.select("id", normalised(F.col("v")).alias("v"), *[c for c in ("y",) if c in rows.columns])
    refs = unit(df).select(F.col("id").alias("rid"), F.col("v").alias("w"), "y")

    def score(rows: DataFrame) -> DataFrame:
        return rows.join(knn_vote(unit(rows).select("id", "v"), refs, "id", k).withColumnRenamed("p", "share"), "id", "left")

    return Scored(score)


def trainers(width: int) -> dict[str, Callable[[DataFrame], object]]:
    """Ten probes over weighed() rows of vectors of this width."""
    common, gamma = {"featuresCol": "features", "labelCol": "y"}, 1.0 / max(1, width)
    return {
        "linear_ce": linear_ce,
        "logreg": lambda df: LogisticRegression(weightCol="w", maxIter=40, regParam=0.01, **common).fit(df),
        "linear_svc": lambda df: LinearSVC(weightCol="w", maxIter=40, regParam=0.01, **common).fit(df),
        "mlp": lambda df: MultilayerPerceptronClassifier(layers=[width, 32, 2], maxIter=40, seed=1, **common).fit(df),
        "svc_rbf_nystroem": lambda df: lifted_svc(df, rbf(gamma)),
        "svc_poly2_nystroem": lambda df: lifted_svc(df, poly2(gamma)),
        "svc_rbf": lambda df: kernel_svc(df, rbf(gamma)),
        "knn_cosine": neighbours,
        "gbt": lambda df: GBTClassifier(weightCol="w", maxIter=10, maxDepth=3, seed=1, **common).fit(df),
        "forest": lambda df: RandomForestClassifier(weightCol="w", numTrees=30, maxDepth=6, seed=1, **common).fit(df),
    }


def positive_share(model, df: DataFrame) -> DataFrame:
    """df with p: the probability of class 1, or the logistic of the margin where a model has none."""
    out = model.transform(df)
    if "share" in out.columns:
        return out.withColumn("p", F.col("share"))
    if "probability" in out.columns:
        return out.withColumn("p", vector_to_array("probability")[1])
    margin = F.col("margin") if "margin" in out.columns else vector_to_array("rawPrediction")[1]
    return out.withColumn("p", 1.0 / (1.0 + F.exp(-margin)))


def cross_validated(df: DataFrame, group: str, folds: int, trainer: Callable[[DataFrame], object]) -> DataFrame:
    """(fold, auroc) of group folds."""
    dealt = df.join(group_folds(df, group, folds), group)
    out = None
    for k in range(folds):
        model = trainer(weighed(dealt.where(F.col("fold") != k)))
        score = metrics.auroc(positive_share(model, weighed(dealt.where(F.col("fold") == k)))).select(F.lit(k).alias("fold"), "auroc")
        out = score if out is None else out.union(score)
    return out


def three_way(train: DataFrame, clean_train: DataFrame, test: DataFrame, clean_test: DataFrame, trainer: Callable[[DataFrame], object]) -> DataFrame:
    """(setup, auroc): trained and tested on all, trained on all and tested on clean, both clean."""
    every, clean = trainer(weighed(train)), trainer(weighed(clean_train))
    runs = {"original": (every, test), "original_on_clean": (every, clean_test), "clean": (clean, clean_test)}
    out = None
    for name, (model, part) in runs.items():
        score = metrics.auroc(positive_share(model, weighed(part))).select(F.lit(name).alias("setup"), "auroc")
        out = score if out is None else out.union(score)
    return out


def encoded(df: DataFrame, load: Callable[[], Callable[[np.ndarray], np.ndarray]], pixels: str, schema: str = "id long, v array<double>") -> DataFrame:
    """(id, v) by an injected encoder, loaded once in each task and called a batch at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = load()
        for batch in batches:
            v = encoder(np.stack(batch[pixels].to_numpy())) if len(batch) else np.zeros((0, 1))
            yield pd.DataFrame({"id": batch["id"], "v": list(np.asarray(v, dtype=float))})

    return df.select("id", pixels).mapInPandas(run, schema)
