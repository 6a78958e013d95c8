"""Regularised quadratic discriminant over document statistics.

Each text becomes about twenty statistics (lengths, shares of byte classes, lines, repetition), transformed by
logarithms and logits so that they are nearer to normal. Class means and covariances come from exact sums over
all labelled training rows, added up where the rows are; each covariance is shrunk towards the pooled one and
towards a multiple of its diagonal. Scores are posteriors from the difference of Mahalanobis log densities, by
Cholesky factors computed once.

Cases: null, empty and blank texts have the statistics of no words and get a score too. Labels other than 0 and 1
and null ones are left out; a document labelled more than once counts once for each label row. With no label of a
class, the score is the share of the other class. Repeated rows give repeated rows; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_limits, crc_mod, cut, small
from .words import SPACED, buffers, hashes, mix

TO_POOLED, TO_DIAGONAL = 0.1, 0.05
_B = np.arange(256)
_UPPER = (_B >= 65) & (_B <= 90)
_LOWER = ((_B >= 97) & (_B <= 122)) | (_B >= 0x80)
_DIGIT = (_B >= 48) & (_B <= 57)
_SYMBOL = np.isin(_B, list(b"#*$%&|<>"))
_LOUD = np.isin(_B, list(b"!?"))
_STOP = np.isin(_B, list(b".,;:"))
_OTHER = ~(_UPPER | _LOWER | _DIGIT | _SYMBOL | _LOUD | _STOP | ~SPACED)
_NEWLINE = _B == 10
_CLASSES = [_UPPER, _LOWER, _DIGIT, _SYMBOL, _LOUD, _STOP, _OTHER, ~SPACED, _NEWLINE, (_B & 0xC0) == 0x80]
NAMES = ["words", "word_length", "line_words", "upper", "digit", "symbol", "loud", "stop", "other", "space", "distinct", "repeated", "common", "deviation"]


def statistics(texts: pa.Array) -> np.ndarray:
    """(texts, features): transformed statistics of whole texts."""
    data, where = buffers(texts)
    rows = len(where) - 1
    counts = np.zeros((rows, len(_CLASSES)))
    step = 1 << 20
    code = np.zeros(256, dtype=np.uint8)
    for j, c in enumerate(_CLASSES[:8]):
        code[c] = j  # the first eight are disjoint
    for lo in range(int(where[0]), int(where[-1]), step):
        hi = min(lo + step, int(where[-1]))
        part = data[lo:hi]
        a, b = np.searchsorted(where, lo, "right") - 1, np.searchsorted(where, hi, "left")
        own = np.repeat(np.arange(b - a), np.minimum(where[a + 1 : b + 1], hi) - np.maximum(where[a:b], lo)).astype(np.int32)
        counts[a:b, :8] += np.bincount(own * 8 + code[part], minlength=8 * (b - a)).reshape(-1, 8)
        counts[a:b, 8] += np.bincount(own[part == 10], minlength=b - a)
        counts[a:b, 9] += np.bincount(own[(part & 0xC0) == 0x80], minlength=b - a)
    h, at = hashes(texts)
    n = np.diff(at).astype(float)
    pair = mix(h[:-1] * np.uint64(3) + h[1:]) if len(h) else h
    distinct, repeated, top = np.zeros(rows), np.zeros(rows), np.zeros(rows)
    for d in range(rows):
        if at[d + 1] - at[d] > 1:
            own = np.sort(h[at[d] : at[d + 1]])
            runs = np.diff(np.concatenate(([0], np.flatnonzero(own[1:] != own[:-1]) + 1, [len(own)])))
            distinct[d], top[d] = len(runs), runs.max()
            own = np.sort(pair[at[d] : at[d + 1] - 1])
            repeated[d] = (own[1:] == own[:-1]).sum()
        elif at[d + 1] > at[d]:
            distinct[d] = top[d] = 1
    chars = np.maximum(1, counts[:, :8].sum(axis=1) - counts[:, 9])
    share = lambda x, of=chars: np.log((x + 0.5) / (np.maximum(of - x, 0) + 5.0))  # noqa: E731  a logit, drawn in for short texts
    lines = counts[:, 8] + 1
    solid = np.maximum(1, chars - counts[:, 7])
    return np.stack([
        np.log1p(n), np.log((solid + 1) / (n + 1)), np.log((n + 1) / lines), share(counts[:, 0]), share(counts[:, 2]), share(counts[:, 3]), share(counts[:, 4]),
        share(counts[:, 5]), share(counts[:, 6]), share(counts[:, 7]), share(n - distinct, n), share(repeated, n), share(top, n), np.log1p(np.abs(solid / np.maximum(1, n) - 5)),
    ], axis=1)


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x) for each row."""
    arrow_limits(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = statistics(batch.column(1))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], type=pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), lists], names=["doc_id", "x"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col).mapInArrow(run, "doc_id long, x array<double>")


class Discriminant:
    """Means, Cholesky factors and priors of two classes."""

    def __init__(self, n: np.ndarray, total: np.ndarray, squares: np.ndarray):
        self.prior = (n + 0.5) / (n.sum() + 1) if n.sum() else np.array([0.5, 0.5])
        self.whole = bool((n > 1).all())
        if not self.whole:
            return
        self.mean = total / n[:, None]
        cov = squares / n[:, None, None] - self.mean[:, :, None] * self.mean[:, None, :]
        pooled = (cov * n[:, None, None]).sum(axis=0) / n.sum()
        self.factor, self.log_det = [], []
        for k in range(2):
            s = (1 - TO_POOLED) * cov[k] + TO_POOLED * pooled
            s = (1 - TO_DIAGONAL) * s + TO_DIAGONAL * np.diag(np.maximum(np.diag(s), 1e-3)) + 1e-4 * np.eye(len(s))
            low = np.linalg.cholesky(s)
            self.factor.append(np.linalg.inv(low))
            self.log_det.append(np.log(np.diag(low)).sum())

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.whole:
            return np.full(len(x), self.prior[1])
        logs = [-0.5 * (((x - self.mean[k]) @ self.factor[k].T) ** 2).sum(axis=1) - self.log_det[k] + np.log(self.prior[k]) for k in range(2)]
        return 0.5 * (1 + np.tanh(np.clip(0.5 * (logs[1] - logs[0]), -20, 20)))


def fit(found: DataFrame, labels: DataFrame, label: str = "quality") -> Discriminant:
    """From (doc_id, x) and (doc_id, label): sums over all rows that have both."""
    size = len(NAMES)
    rows, cols = np.tril_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 + size + len(rows)))
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            for k in range(2):
                own = x[y == k]
                square = own.T @ own
                sums[k] += np.concatenate(([len(own)], own.sum(axis=0), square[rows, cols]))
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat([0, 1], sums.shape[1])), pa.array(np.tile(np.arange(sums.shape[1]), 2)), pa.array(sums.ravel())], names=["y", "i", "s"])

    known = labels.where(F.col(label).isin(0, 1)).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    sums = found.join(known, "doc_id").select("y", "x").mapInArrow(run, "y long, i long, s double").groupBy("y", "i").agg(F.sum("s").alias("s"))
    table = np.zeros((2, 1 + size + len(rows)))
    for r in sums.toLocalIterator():  # two classes, a fixed number of sums
        table[r.y, r.i] = r.s
    squares = np.zeros((2, size, size))
    squares[:, rows, cols] = squares[:, cols, rows] = table[:, 1 + size :]
    return Discriminant(table[:, 0], table[:, 1 : 1 + size], squares)


def held_out_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, fold: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted; learns from labels of rows whose crc32(doc_id as text) mod ``fold`` is not 0."""
    found = cut(features(docs), "statistics")
    model = found.sparkSession.sparkContext.broadcast(fit(found.where(crc_mod("doc_id", fold) != 0), labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.round(model.value.score(x), 9))], names=["doc_id", "score"])

    out = found.mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", F.coalesce(crc_mod("doc_id", fold) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of docs that the classifier doesn't reject."""
    marked = held_out_scores(docs, labels, threshold)
    gone = cut(marked.where("predicted = 0").select("doc_id").distinct(), "rejected")
    return docs.join(small(gone), "doc_id", "left_anti").select(docs.columns)
