"""Ranking and threshold metrics over (y, p), exact and by counts of distinct scores.

Running counts are two-level: sums of BUCKETS ranges of the score, then a window within each range, so that no window holds
all rows. Scores must lie in [0, 1]; rows with a null or NaN score are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1024


def score_counts(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """For each distinct score: pos, neg, and the cumulative counts tp, fp of scores at or above it."""
    rows = df.where(F.col(p).isNotNull() & ~F.isnan(p) & F.col(y).isNotNull())
    each = rows.groupBy(F.col(p).alias("p")).agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg"))
    each = each.withColumn("_b", F.floor(F.col("p") * BUCKETS).cast("int"))
    sums = each.groupBy("_b").agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    above = Window.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("_b").alias("_k"), F.coalesce(F.sum("_p").over(above), F.lit(0)).alias("_tp"), F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_fp"))
    own = Window.partitionBy("_b").orderBy(F.desc("p"))
    return each.join(F.broadcast(sums), F.col("_b") == F.col("_k")).select("p", "pos", "neg", (F.col("_tp") + F.sum("pos").over(own)).alias("tp"), (F.col("_fp") + F.sum("neg").over(own)).alias("fp"))


def auroc(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """One row: auroc, null if a class is missing. Ties count half."""
    c = score_counts(df, y, p)
    wins = F.sum(F.col("neg") * (2 * (F.col("tp") - F.col("pos")) + F.col("pos")))
    return c.agg(F.try_divide(wins.cast("double"), (2 * F.sum("pos") * F.sum("neg")).cast("double")).alias("auroc"))


def average_precision(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """One row: ap, by steps over distinct scores."""
    c = score_counts(df, y, p)
    part = F.col("pos").cast("double") * F.col("tp") / (F.col("tp") + F.col("fp"))
    return c.agg(F.try_divide(F.sum(part), F.sum("pos").cast("double")).alias("ap"))


def pr_curve(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """(threshold, precision, recall) of each distinct score, and (null, 1, 0)."""
    c = score_counts(df, y, p)
    total = c.agg(F.sum("pos").alias("_all"))
    points = c.crossJoin(F.broadcast(total)).select(F.col("p").alias("threshold"), (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), F.try_divide(F.col("tp"), F.col("_all")).alias("recall"))
    return points.union(df.sparkSession.createDataFrame([(None, 1.0, 0.0)], points.schema))


def recall_at_precision(df: DataFrame, target: float, y: str = "y", p: str = "p") -> DataFrame:
    return pr_curve(df, y, p).where(F.col("precision") >= target).agg(F.coalesce(F.max("recall"), F.lit(0.0)).alias("recall"))


def precision_at_recall(df: DataFrame, target: float, y: str = "y", p: str = "p") -> DataFrame:
    """The best precision at recall of target or more and its threshold (the least on ties)."""
    ok = pr_curve(df, y, p).where((F.col("recall") >= target) & F.col("threshold").isNotNull())
    return ok.agg(F.max("precision").alias("precision"), F.min_by("threshold", F.struct(-F.col("precision"), "threshold")).alias("threshold"))


def confusion(df: DataFrame, thresholds: list[float], y: str = "y", p: str = "p", strict: bool = False) -> DataFrame:
    """(t, tp, fp, fn, tn) for each threshold; predictions are p >= t, or p > t if strict."""
    said = F.col(p) > F.col("t") if strict else F.col(p) >= F.col("t")
    said = said & ~F.isnan(p)
    rows = df.withColumn("t", F.explode(F.array(*map(F.lit, thresholds))))
    kinds = {"tp": said & (F.col(y) == 1), "fp": said & (F.col(y) == 0), "fn": ~said & (F.col(y) == 1), "tn": ~said & (F.col(y) == 0)}
    return rows.groupBy("t").agg(*[F.count_if(c).alias(k) for k, c in kinds.items()])


def rates(counts: DataFrame) -> DataFrame:
    """(t, accuracy, precision, recall, f1) of confusion(), denominators 1 at least."""
    one = lambda x: F.greatest(x, F.lit(1))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select("t", ((tp + tn) / one(tp + fp + fn + tn)).alias("accuracy"), (tp / one(tp + fp)).alias("precision"), (tp / one(tp + fn)).alias("recall"), (2 * tp / one(2 * tp + fp + fn)).alias("f1"))
