"""Graph operators and metrics against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from terrasift.operators import graph, learning, metrics
from tests.test_spatial import dist


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def test_components_of_paths_and_cycles(spark):
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + i, 100 + (i + 1) % 7) for i in range(7)] + [(r.randrange(200, 260), r.randrange(200, 260)) for _ in range(40)] + [(5, 5)]
    parent = {}
    for a, b in edges:
        if a != b:
            for x in (a, b):
                parent.setdefault(x, x)
            p, q = sorted((find(parent, a), find(parent, b)))
            parent[q] = p
    got = {x.node: x.comp for x in graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(parent, x) for x in parent}


def test_group_folds_take_the_lightest(spark):
    sizes = [90, 30, 25, 20, 20, 15, 15, 10, 10, 10, 5, 5, 5, 5, 5]
    rows = [(k,) for k, n in enumerate(sizes) for _ in range(n)]
    load, want = [0] * 5, {}
    for k, n in enumerate(sizes):
        want[k] = load.index(min(load))
        load[want[k]] += n
    assert {x.site: x.fold for x in learning.group_folds(spark.createDataFrame(rows, "site long"), "site", 5).collect()} == want and max(load) == 90


def cloud(n, seed):
    r = random.Random(seed)
    return [(i, 40 + r.gauss(0, 0.02) + 0.2 * (i % 3), -90 + r.gauss(0, 0.02)) for i in range(n)]


@pytest.mark.parametrize("least", [1, 2, 5])
def test_dbscan(spark, least):
    pts, eps = cloud(150, 4), 700
    near = {a[0]: [b[0] for b in pts if dist(a, b) <= eps] for a in pts}
    core = {i for i in near if len(near[i]) >= least}
    parent = {i: i for i in core}
    for i in core:
        for j in near[i]:
            if j in core:
                p, q = sorted((find(parent, i), find(parent, j)))
                parent[q] = p
    want = {i: find(parent, i) if i in core else min((find(parent, j) for j in near[i] if j in core), default=-1) for i in near}
    got = {r.id: r.cluster for r in graph.dbscan(spark.createDataFrame(pts, "id long, lat double, lon double"), eps, least).collect()}
    assert got == want


def test_greedy_dedup_is_the_sequential_pass(spark):
    pts = cloud(200, 5)
    kept = []
    for p in pts:
        if all(dist(p, q) > 500 for q in kept):
            kept.append(p)
    got = {r.id for r in graph.greedy_dedup(spark.createDataFrame(pts, "id long, lat double, lon double"), 500).collect()}
    assert got == {p[0] for p in kept}


def scores(spark, seed=1, tie=20):
    r = random.Random(seed)
    rows = [(int(r.random() < 0.3), r.randrange(tie) / tie) for _ in range(500)] + [(1, None), (0, float("nan"))]
    return [x for x in rows[:500]], spark.createDataFrame(rows, "y int, p double")


def test_auroc_and_its_mirror(spark):
    rows, df = scores(spark)
    pos, neg = [p for y, p in rows if y], [p for y, p in rows if not y]
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg)
    assert abs(metrics.auroc(df).first().auroc - want) < 1e-12
    assert abs(metrics.auroc(df.withColumn("p", 1 - F.col("p"))).first().auroc - (1 - want)) < 1e-12
    assert metrics.auroc(df.where("y = 1")).first().auroc is None


def test_average_precision_and_curve(spark):
    rows, df = scores(spark, 2)
    total, ap = sum(y for y, _ in rows), 0.0
    for t in sorted({p for _, p in rows}, reverse=True):
        tp, n = sum(y for y, p in rows if p >= t), sum(1 for _, p in rows if p >= t)
        ap += sum(y for y, p in rows if p == t) / total * tp / n
    assert abs(metrics.average_precision(df).first().ap - ap) < 1e-12
    curve = metrics.pr_curve(df).collect()
    assert (None, 1.0, 0.0) in [tuple(r) for r in curve] and len(curve) == len({p for _, p in rows}) + 1
    assert metrics.recall_at_precision(df, 1.01).first().recall == 0.0


def test_confusion_guards_denominators(spark):
    df = spark.createDataFrame([(1, 0.2), (0, 0.5), (1, 0.5)], "y int, p double")
    got = {r.t: r for r in metrics.rates(metrics.confusion(df, [0.5, 0.99])).collect()}
    assert got[0.99].precision == 0.0 and got[0.5].precision == 0.5
    strict = metrics.confusion(df, [0.5], strict=True).first()
    assert (strict.tp, strict.fp, strict.fn, strict.tn) == (0, 0, 2, 1)
