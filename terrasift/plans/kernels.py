"""Queries over kernels, learning and streams; those without SQL are held against brute force in the tests."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ..functions import kernels as K
from ..functions.geometry import albers
from ..functions.scalar import tidy
from ..operators import areas, learning, metrics, rasters
from ..operators.graph import greedy_dedup
from ..sources import readers, scratch, sinks
from ..streaming import live
from .base import query, sql
from .joins import roads
from .scalars import rings

RING = [(-99.5, 30.5), (-98.5, 30.5), (-98.5, 31.5), (-99.0, 31.5)]


def ring_column():
    return F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in RING])


@query("g02_shape_features", sql("b", "SELECT id, CASE WHEN id % 4 = 3 THEN 0.0e0 ELSE 0.75e0 END AS rectangularity, CASE WHEN id % 4 = 3 THEN 0.0e0 ELSE id % 4 + 1.0e0 END AS aspect_ratio, CASE WHEN id % 4 = 3 THEN 0.0e0 ELSE id % 4 + 1.0e0 END AS elongation FROM b"))
def _(t):
    """Trapezia of three quarters of their box, one to three times as high as wide (their least box is upright); every fourth ring crosses itself."""
    b = t.raw("part").select(F.col("p_partkey").alias("id"), F.col("p_size").cast("double").alias("p_size"), (F.col("p_partkey") % 4 + 1).cast("double").alias("k"))
    at = lambda x, y: F.struct((F.col("p_size") * x).alias("x"), (F.col("p_size") * F.col("k") * y).alias("y"))
    bow = F.array(at(0.0, 0.0), at(1.0, 1.0), at(1.0, 0.0), at(0.0, 1.0))
    ring = F.when(F.col("id") % 4 == 3, bow).otherwise(F.array(at(0.0, 0.0), at(1.0, 0.0), at(1.0, 1.0), at(0.5, 1.0)))
    s = b.select("id", K.shape_features_udf(ring).alias("s"))
    return s.select("id", *[tidy(F.col("s")[c]).alias(c) for c in ("rectangularity", "aspect_ratio", "elongation")])


@query("g08_land_grid")
def _(t):
    return areas.land_grid(t.spark, ring_column(), (30.5, -99.5, 31.5, -98.5))


@query("g09_random_points")
def _(t):
    return areas.random_points(t.spark, 200, "g9", ring_column(), (30.5, -99.5, 31.5, -98.5))


@query("g10_road_distance")
def _(t):
    r = roads(t)
    lines = r.select(F.col("x").alias("xa"), F.lit(29.0).alias("ya"), F.col("x").alias("xb"), F.lit(33.0).alias("yb"))
    return areas.road_distance(t.anchors().select("id", "lat", "lon"), lines, 10_000.0).select("id", tidy(F.col("dist"), 3).alias("dist"))


@query("f12_mgrs")
def _(t):
    return t.buildings().select("id", K.mgrs_udf("lat", "lon").alias("mgrs_tile"))


@query("f13_projections")
def _(t):
    x, y = albers(F.col("lat"), F.col("lon"))
    b = t.buildings().select("id", tidy(x, 3).alias("x_5070"), tidy(y, 3).alias("y_5070"), K.utm_udf("lat", "lon").alias("u"))
    return b.select("id", "x_5070", "y_5070", tidy(F.col("u.x"), 3).alias("x_utm"), tidy(F.col("u.y"), 3).alias("y_utm"))


@query("c02_sub_clusters")
def _(t):
    b = t.buildings().select("id", "lat", "lon", (F.col("id") % 3).alias("parent"))
    return areas.sub_clusters(b, "parent", 9000, 5).select("id", "parent", "cluster")


@query("c05_greedy_dedup")
def _(t):
    return greedy_dedup(t.buildings().select("id", "lat", "lon"), 4000)


@query("c06_facilities")
def _(t):
    """Candidates are half-degree cells, or a tenth as wide for every third supplier; singletons are the suppliers of nation 0."""
    s = t.candidates()
    half = F.when(F.col("id") % 3 == 0, 0.005).otherwise(0.25)
    c = s.where("state != 0").select(F.col("id").alias("candidate_id"), "lat", "lon", *[(F.col(k) + f * half).alias(f"{k}_{m}") for k in ("lat", "lon") for m, f in (("min", -1), ("max", 1))])
    b = t.buildings().select("id", "lat", "lon", F.col("area").alias("approx_area_m2"), F.when(F.col("class") == "large", "warehouse").otherwise(F.col("class")).alias("class"), "subtype", "name", F.when(F.col("id") % 3 == 0, F.col("id") % 30 / 2.0).alias("height"), (F.col("id") % 9).cast("int").alias("num_floors"))
    alone = s.where("state = 0").select(F.col("id").alias("candidate_id"), "lat", "lon")
    f = areas.facilities(c, b, alone, eps=9000.0, min_samples=4)
    return f.select(*[tidy(F.col(k)).alias(k) if k in ("lat", "lon") else k for k in f.columns])


def labelled(t):
    return t.vectors().select("id", (F.col("id") % 40).alias("site"), "v", (F.col("label") < 3).cast("int").alias("y"))


@query("m05_probe_training")
def _(t):
    rows = labelled(t)
    model = learning.trainers(64)["logreg"](learning.weighed(rows.where("id % 4 != 0")))
    return learning.positive_share(model, learning.weighed(rows.where("id % 4 = 0"))).select("id", F.col("y").cast("int").alias("y"), F.round("p", 4).alias("p"))


@query("m09_probe_family")
def _(t):
    rows = labelled(t)
    train, test = learning.weighed(rows.where("id % 4 != 0")), learning.weighed(rows.where("id % 4 = 0"))
    out = None
    for name, trainer in learning.trainers(64).items():
        score = metrics.auroc(learning.positive_share(trainer(train), test)).select(F.lit(name).alias("probe"), F.round("auroc", 3).alias("auroc"))
        out = score if out is None else out.union(score)
    return out


@query("m06_cross_validated")
def _(t):
    folds = learning.cross_validated(labelled(t), "site", 3, learning.trainers(64)["logreg"])
    return folds.select("fold", F.round("auroc", 3).alias("auroc"))


def per_raster(t, f, schema):
    """f of each 8 x 8 raster, in batches."""

    def run(batches):
        for batch in batches:
            yield pd.DataFrame([(i, *f(np.asarray(v).reshape(8, 8))) for i, v in zip(batch["id"], batch["v"])], columns=[c.split()[0] for c in schema.split(", ")])

    return t.vectors().select("id", "v").mapInPandas(run, schema)


@query("g03_polygon_mask")
def _(t):
    def f(a):
        side = 2 + 4 * abs(float(a[0, 0]))
        return (int(K.polygon_mask(np.array([(1, 1), (1 + side, 1), (1, 1 + side)], dtype=float), 8, 8).sum()),)

    return per_raster(t, f, "id long, pixels long")


@query("g05_mask_to_polygon")
def _(t):
    def f(a):
        ring = K.largest_polygon(a > 0)
        p = np.array(ring, dtype=float).reshape(-1, 2)
        return len(ring), float(abs((p[:, 0] * np.roll(p[:, 1], -1) - np.roll(p[:, 0], -1) * p[:, 1]).sum()) / 2) if len(p) else 0.0

    return per_raster(t, f, "id long, corners long, area double")


@query("r07_gradient_footprint")
def _(t):
    def f(a):
        mask = K.gradient_footprint(a)
        return (None if mask is None else float(mask.sum()),)

    return per_raster(t, f, "id long, pixels double")


@query("s12_raster_window", sql("a", """SELECT id, CASE WHEN c1 > c0 AND r1 > r0 THEN c0 END AS col, CASE WHEN c1 > c0 AND r1 > r0 THEN r0 END AS row, CASE WHEN c1 > c0 AND r1 > r0 THEN c1 - c0 END AS cols, CASE WHEN c1 > c0 AND r1 > r0 THEN r1 - r0 END AS rows FROM (
SELECT id, CAST(greatest(0, round_even(l, 0)) AS INTEGER) AS c0, CAST(greatest(0, round_even(u, 0)) AS INTEGER) AS r0, CAST(least(150, round_even(l + w, 0)) AS INTEGER) AS c1, CAST(least(150, round_even(u + w2, 0)) AS INTEGER) AS r1 FROM (
SELECT id, ((lon - 0.02e0) - (-100.0e0)) / 0.0125e0 AS l, (32.0e0 - (lat + 0.02e0)) / 0.0125e0 AS u, ((lon + 0.02e0) - (lon - 0.02e0)) / 0.0125e0 AS w, ((lat + 0.02e0) - (lat - 0.02e0)) / 0.0125e0 AS w2 FROM a))"""))
def _(t):
    boxed = t.anchors().select("id", (F.col("lon") - 0.02).alias("x0"), (F.col("lat") - 0.02).alias("y0"), (F.col("lon") + 0.02).alias("x1"), (F.col("lat") + 0.02).alias("y1"))
    w = rasters.raster_window(("x0", "y0", "x1", "y1"), -100.0, 32.0, 0.0125, 150, 150)
    return boxed.select("id", w.alias("w")).select("id", "w.col", "w.row", "w.cols", "w.rows")


@query("s12_resampled", sql("v", "SELECT id, list_transform(range(0, 25), lambda i: v[CAST(floor((i // 5 + 0.5e0) * 8 / 5) * 8 + floor((i % 5 + 0.5e0) * 8 / 5) AS INTEGER) + 1]) AS pixels FROM v"))
def _(t):
    return t.vectors().select("id", rasters.resampled(F.col("v"), 8, 8, 5, 5).alias("pixels"))


@query("r11_square_resize")
def _(t):
    return per_raster(t, lambda a: (round(float(K.lanczos_square(a[None, :, :6], 5).sum()), 6),), "id long, total double")


@query("s06_csv_with_text_copy", "SELECT c_custkey, CAST(c_acctbal AS VARCHAR) AS lat_raw, c_acctbal AS lat FROM customer")
def _(t):
    path = f"{scratch.folder(t.spark)}/terrasift/csv-{uuid.uuid4().hex}"
    t.raw("customer").select("c_custkey", K.number_text_udf("c_acctbal").alias("lat_raw")).write.csv(path, header=True)
    return readers.csv(t.spark, path, "c_custkey long, lat_raw string")


@query("k08_json_append", "SELECT n_nationkey, n_name FROM nation UNION ALL SELECT n_nationkey, n_name FROM nation")
def _(t):
    path = f"{scratch.folder(t.spark)}/terrasift/json-{uuid.uuid4().hex}"
    for _k in range(2):
        sinks.json_append(t.raw("nation").select("n_nationkey", "n_name"), path)
    return readers.json_lines(t.spark, path, t.raw("nation").select("n_nationkey", "n_name").schema)


@query("k04_chunk_overwrite", "SELECT s_suppkey, s_suppkey % 5 AS chunk, CASE WHEN s_suppkey % 5 = 2 THEN -1.0e0 ELSE s_acctbal END AS v FROM supplier")
def _(t):
    path = f"{scratch.folder(t.spark)}/terrasift/chunks-{uuid.uuid4().hex}"
    rows = t.raw("supplier").select("s_suppkey", (F.col("s_suppkey") % 5).alias("chunk"), F.col("s_acctbal").alias("v"))
    sinks.chunked(rows, path, "chunk")
    sinks.chunked(rows.where("chunk = 2").withColumn("v", F.lit(-1.0)), path, "chunk")
    return t.spark.read.schema("s_suppkey long, v double, chunk long").parquet(path).select("s_suppkey", "chunk", "v")


@query("i07_heartbeat", "SELECT date_trunc('hour', ts) AS start, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS n_err FROM events GROUP BY 1")
def _(t):
    beat = live.heartbeat(t.raw("events"), "ts", F.col("event_type") == "error")
    return beat.select("start", "n", "n_err")


@query("m07_group_folds")
def _(t):
    return learning.group_folds(labelled(t), "site", 5)


@query("m20_injected_encoder")
def _(t):
    def load():
        projection = np.linspace(-1, 1, 64 * 4).reshape(64, 4)
        return lambda batch: batch @ projection

    e = learning.encoded(t.vectors(), load, "v")
    return e.select("id", F.transform("v", lambda x: tidy(x)).alias("v"))


@query("m21_three_way")
def _(t):
    rows = labelled(t)
    clean = rows.where("id % 7 != 0")
    split = lambda df: (df.where("id % 4 != 0"), df.where("id % 4 = 0"))
    (train, test), (clean_train, clean_test) = split(rows), split(clean)
    s = learning.three_way(train, clean_train, test, clean_test, learning.trainers(64)["logreg"])
    return s.select("setup", F.round("auroc", 4).alias("auroc"))
