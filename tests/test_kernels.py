"""Numpy kernels and nested clusters."""

import math

import numpy as np

from terrasift.functions import kernels as K
from terrasift.operators import areas
from tests.test_graph_and_metrics import cloud
from tests.test_spatial import dist


def test_shape_features_by_upright_and_rotated_boxes():
    turn = math.radians(33)
    c, s = math.cos(turn), math.sin(turn)
    box = [(x * c - y * s, x * s + y * c) for x, y in ((0, 0), (4, 0), (4, 1), (0, 1))]
    wide, high = 4 * c + s, 4 * s + c
    rectangularity, aspect, elongation = K.shape_features(box)
    assert abs(rectangularity - 4 / (wide * high)) < 1e-9 and abs(aspect - wide / high) < 1e-9 and abs(elongation - 4) < 1e-9
    assert K.shape_features([(0, 0), (1, 1)]) == K.shape_features([]) == K.shape_features([(0, 0), (1, 1), (1, 0), (0, 1)]) == (0.0, 0.0, 0.0)


def test_polygon_mask_touches_and_back():
    mask = K.polygon_mask(np.array([(1.2, 1.2), (4.8, 1.2), (4.8, 3.8), (1.2, 3.8)]), 6, 7)
    want = np.zeros((6, 7), dtype=bool)
    want[1:4, 1:5] = True
    assert (mask == want).all()
    mask[5, 6] = True
    assert sorted(K.largest_polygon(mask)) == [(1, 1), (1, 4), (5, 1), (5, 4)]
    assert K.largest_polygon(np.zeros((3, 3), dtype=bool)) == []


def test_components_and_holes():
    m = np.array([[1, 1, 0, 1], [0, 0, 0, 1], [1, 0, 0, 0]], dtype=bool)
    label = K.label_components(m)
    assert label.max() == 3 and label[0, 0] == label[0, 1] != label[0, 3] and (label > 0).tolist() == m.tolist()
    ring = np.ones((5, 5), dtype=bool)
    ring[2, 2] = False
    assert K.fill_holes(ring).all()


def test_gradient_footprint_holds_the_centre():
    img = np.zeros((21, 21))
    img[7:14, 7:14] = 9
    got = K.gradient_footprint(img)
    assert got[10, 10] and 25 <= got.sum() <= 140 and not got[0, 0]


def test_gradient_footprint_of_missing_and_flat_pixels():
    assert K.gradient_footprint(np.full((9, 9), np.nan)) is None and K.gradient_footprint(np.ones((9, 9))) is None
    img = np.zeros((30, 30))
    img[4:12, 16:26] = 50.0
    whole = K.gradient_footprint(img, (0.7, 0.27))
    holed = img.copy()
    holed[28, 2] = np.nan  # counts as the mean, which is near the ground
    assert whole[8, 21] and K.gradient_footprint(holed, (0.7, 0.27))[8, 21]
    assert not whole[:2].any() and not whole[:, -2:].any()  # closing eats what touches the edge


def test_lanczos_keeps_a_flat_image_and_its_shape():
    out = K.lanczos_square(np.full((2, 30, 30), 5.0), 8)
    assert out.shape == (2, 8, 8) and np.allclose(out, 5.0)
    assert K.lanczos_square(np.ones((1, 10, 20)), 16).shape == (1, 16, 16)


def test_utm_and_squares_of_known_places():
    x, y, zone = K.utm(np.array([0.0, 45.0]), np.array([3.0, 9.0]))
    assert abs(x[0] - 500000) < 1e-6 and abs(y[0]) < 1e-6 and zone[0] == 31
    assert abs(x[1] - 500000) < 1e-6 and abs(y[1] - 4982950.40) < 0.1
    assert K.mgrs_square(np.array([30.0]), np.array([-100.0])) == ["14RMU"]


def test_clusters_do_not_cross_parents(spark):
    pts = [(i, la, lo, i % 2) for i, la, lo in cloud(120, 8)]
    got = {r.id: r.cluster for r in areas.sub_clusters(spark.createDataFrame(pts, "id long, lat double, lon double, parent long"), "parent", 900, 4).collect()}
    for parent in (0, 1):
        own = [p for p in pts if p[3] == parent]
        near = {a[0]: [b[0] for b in own if dist(a, b) <= 900] for a in own}
        core = {i for i in near if len(near[i]) >= 4}
        assert {i for i in near if got[i] == -1} == {i for i in near if not any(j in core for j in near[i])}
        for i in core:
            assert all(got[i] == got[j] for j in near[i] if j in core)


def test_road_distance_and_cap(spark):
    points = spark.createDataFrame([(1, 40.0, -90.0), (2, 41.0, -90.0)], "id long, lat double, lon double")
    roads = spark.createDataFrame([(-90.01, 39.0, -90.01, 40.5)], "xa double, ya double, xb double, yb double")
    got = {r.id: r.dist for r in areas.road_distance(points, roads, 5000.0).collect()}
    assert abs(got[1] - math.radians(0.01) * 6371000 * math.cos(math.radians(40))) < 1 and got[2] == 5000.0


def test_composite_drops_clouds_fills_holes_and_rejects_flat(spark):
    from terrasift.operators import rasters

    ramp = [float(k) for k in range(20)]
    rows = [(1, [None, *ramp[1:]]), (1, [None, *[x + 2 for x in ramp[1:]]]), (1, [500.0] * 3 + [None] * 17)]  # the last is nearly all cloud
    rows += [(2, ramp), (3, [5.0] * 20), (3, [5.5] * 20)]
    out = rasters.composite(spark.createDataFrame(rows, "k long, b array<double>"), "k", ["b"], least_pixels=10, least_scenes=2).collect()
    assert [x.k for x in out] == [1] and list(out[0].b) == [11.0, *[x + 1 for x in ramp[1:]]]


def test_facilities_by_hand(spark):
    """A big candidate with two clusters and noise, a big one with noise only, a big one without buildings, a small one and a singleton."""
    m = 1 / 111000.0
    near = lambda i, la, lo, n, **kw: [{"id": i + k, "lat": la + k * 100 * m, "lon": lo, "approx_area_m2": 10.0, "class": "warehouse", "subtype": None, "name": None, "height": None, "num_floors": None} | kw for k in range(n)]
    rows = near(1, 0.0, 0.0, 6, name="b", height=5.0) + near(20, 0.05, 0.05, 5, name="a", num_floors=3) + near(40, 0.02, 0.08, 2) + near(60, 1.0, 1.0, 4)
    rows += near(80, 0.0, 0.0, 3, **{"class": "house", "subtype": "residential"}) + near(90, 0.001, 0.0, 1, **{"class": None, "approx_area_m2": 3000.0}) + near(95, 0.001, 0.0, 1, **{"class": None, "approx_area_m2": 2999.0})
    rows[0]["class"], rows[1]["name"] = "hangar", ""
    schema = "id long, lat double, lon double, approx_area_m2 double, class string, subtype string, name string, height double, num_floors int"
    buildings = spark.createDataFrame([tuple(r[c.split()[0]] for c in schema.split(", ")) for r in rows], schema)
    box = lambda i, la, lo, h: (i, lo, la, lo - h, la - h, lo + h, la + h)
    candidates = spark.createDataFrame([box(7, 0.04, 0.04, 0.1), box(8, 1.0, 1.0, 0.1), box(9, 5.0, 5.0, 0.1), box(10, 0.0, 0.0, 0.001)], "candidate_id long, lon double, lat double, lon_min double, lat_min double, lon_max double, lat_max double")
    alone = spark.createDataFrame([(3, 2.0, 3.0)], "candidate_id long, lon double, lat double")
    got = areas.facilities(candidates, buildings, alone).orderBy("facility_id").collect()
    assert [(x.facility_id, x.parent_candidate_id, x.source, x.n_buildings) for x in got] == [
        ("f_0000000", 7, "sub_cluster", 7), ("f_0000001", 7, "sub_cluster", 5), ("f_0000002", 8, "cluster_centroid", 0), ("f_0000003", 9, "cluster_centroid", 0), ("f_0000004", 10, "cluster_centroid", 0), ("f_0000005", 3, "singleton", 0),
    ]
    first, second = got[:2]
    assert (first.names, first.n_distinct_names, first.max_height_m, first.max_num_floors, first.top_class) == (["b"], 1, 5.0, None, "warehouse")
    assert (second.names, second.max_height_m, second.max_num_floors) == (["a"], None, 3) and abs(second.lat - 0.05 - 200 * m) < 1e-9
    assert (got[2].lat, got[2].lon, got[2].names) == (1.0, 1.0, []) and (got[5].lat, got[5].lon) == (3.0, 2.0)


def test_land_grid_reaches_the_curved_edge(spark):
    from pyspark.sql import functions as F

    ring = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((-125.0, 49.0), (-67.0, 49.0), (-67.0, 49.6), (-125.0, 49.6))])
    grid = areas.land_grid(spark, ring, (49.0, -125.0, 49.6, -67.0), 20_000.0).collect()
    assert all(49.0 <= g.lat <= 49.6 for g in grid) and len({g.tile_id for g in grid}) == len(grid)
    for lon in range(-124, -67, 6):  # every stretch of the arc has tiles
        assert any(abs(g.lon - lon) < 1 for g in grid)


def test_random_points_are_as_many_as_asked(spark):
    from pyspark.sql import functions as F

    sliver = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0.0, 0.0), (1.0, 0.0), (1.0, 0.02), (0.0, 0.02))])
    rows = areas.random_points(spark, 50, "s", sliver, (0.0, 0.0, 1.0, 1.0)).collect()
    assert len(rows) == 50 and all(0 <= r.lat <= 0.02 for r in rows) and rows == areas.random_points(spark, 50, "s", sliver, (0.0, 0.0, 1.0, 1.0)).collect()


def test_cover_and_colour_rules(spark):
    from pyspark.sql import functions as F

    from terrasift.operators import cover

    nan = float("nan")
    cases = [
        ((0.1, 0.1, None, 0.1), "missing", 0), ((0.1, nan, 0.1, 0.1), "missing", 0), ((0.06, 0.05, 0.04, 0.03), "water", 1), ((0.05, 0.1, 0.1, 0.21), "vegetation", 2), ((0.3, 0.3, 0.34, 0.35), "concrete", 3),
        ((0.4, 0.4, 0.4, 0.4), "metal_roof", 3), ((0.2, 0.4, 0.36, 0.36), "rust_brick", 5), ((0.28, 0.3, 0.34, 0.36), "sand", 6), ((0.3, 0.3, 0.34, 0.38), "ambiguous", 9), ((0.1, 0.1, 0.1, 0.1), "asphalt", 4), ((0.12, 0.15, 0.19, 0.19), "rust_brick", 5), ((0.15, 0.2, 0.2, 0.22), "sand", 6),
        ((0.2, 0.2, 0.2, 0.25), "sparse_veg", 7), ((0.16, 0.2, 0.18, 0.17), "bare_soil", 8), ((0.0, 0.2, 0.19, 0.19), "rust_brick", 5), ((0.2, 0.2, 0.19, 0.22), "ambiguous", 9),
    ]
    df = spark.createDataFrame([(k, *c[0]) for k, c in enumerate(cases)], "k int, blue double, green double, red double, nir double")
    got = {r.k: (r.c.cover, r.c.tier) for r in df.select("k", cover.cover_tier().alias("c")).collect()}
    assert got == {k: c[1:] for k, c in enumerate(cases)}
    colours = [((0.31, 0.2, 1.0), "natural"), ((0.11, 0.5, 1.0), "natural"), ((0.10, 0.5, 1.11), "natural"), ((0.10, 0.31, 1.1), "built"), ((0.0, 0.14, 1.0), "built"), ((0.0, 0.15, 1.0), "ambiguous"), ((0.0, 0.30, 1.0), "ambiguous"), ((nan, 0.2, 1.0), "missing"), ((0.2, None, 1.0), "missing")]
    df = spark.createDataFrame([(k, *c[0]) for k, c in enumerate(colours)], "k int, a double, b double, c double")
    assert {r.k: r.x for r in df.select("k", cover.colour_class(F.col("a"), F.col("b"), F.col("c")).alias("x")).collect()} == {k: c[1] for k, c in enumerate(colours)}
    assert cover.COVER_DROPPED == ("water", "concrete", "metal_roof", "asphalt", "rust_brick")


def test_boxes_file_names_and_paths(spark):
    from pyspark.sql import functions as F

    from terrasift.functions import scalar as X

    one = spark.createDataFrame([(0.0, 59.9, 0.2, 60.1)], "x0 double, y0 double, x1 double, y1 double")
    got = one.select(*[c.alias(n) for n, c in zip("abcd", X.expand_bbox("x0", "y0", "x1", "y1", 111.0))]).first()
    assert abs(got.b - 59.899) < 1e-9 and abs(got.d - 60.101) < 1e-9 and abs(got.a + 0.002) < 1e-9
    names = ["m_12345678_ne_9_060_20220415_20221210.tif", "m_1234567_sw_14_100_20200101.tif", "m_123456_ne_14_060_20220415.tif", "m_1234567_sw_14_100_20200101.xml", None]
    f = spark.createDataFrame([(n,) for n in names], "f string")
    parts = X.tile_parts(F.col("f"))
    rows = f.select("f", *[v.alias(k) for k, v in parts.items()]).withColumn("back", X.tile_name(*map(F.col, parts))).collect()
    assert (rows[0].quad_id, rows[0].quadrant, rows[0].utm_zone, rows[0].processed, rows[0].back) == ("12345678", "ne", "9", "20221210", names[0])
    assert (rows[1].processed, rows[1].back) == (None, names[1]) and all(r.quad_id is None for r in rows[2:])
    href = F.lit("s3://x/level-1/y/LE07_L1GT_1_B8.TIF")
    assert spark.range(1).select(X.surface_href(href, "swir22").alias("h")).first().h == "s3://x/level-2/y/LE07_L2SP_1_SR_B7.TIF"


def test_probes_learn_and_vote(spark):
    from terrasift.operators import learning, metrics

    rng = np.random.default_rng(4)
    rows = []
    for k in range(240):
        inner = k % 2
        angle, radius = rng.random() * 6.28, (0.6 if inner else 2.0) + rng.normal() * 0.1
        rows.append((k, [float(radius * math.cos(angle)), float(radius * math.sin(angle)), 1.0], inner))
    df = spark.createDataFrame(rows, "id long, v array<double>, y int")
    train, test = learning.weighed(df.where("id % 4 < 2")), learning.weighed(df.where("id % 4 >= 2"))
    known = learning.trainers(3)
    assert len(known) == 10
    score = {name: metrics.auroc(learning.positive_share(known[name](train), test)).first().auroc for name in ("svc_rbf_nystroem", "svc_poly2_nystroem", "svc_rbf", "knn_cosine", "linear_ce", "logreg")}
    assert min(score[x] for x in ("svc_rbf_nystroem", "svc_poly2_nystroem", "svc_rbf")) > 0.97  # rings, which no plane divides
    assert score["linear_ce"] < 0.8 and score["logreg"] < 0.8
    line = spark.createDataFrame([(k, [float(k % 2) + rng.normal() * 0.2, 1.0], k % 2) for k in range(200)], "id long, v array<double>, y int")
    train, test = learning.weighed(line.where("id < 100")), learning.weighed(line.where("id >= 100"))
    assert all(metrics.auroc(learning.positive_share(learning.trainers(2)[x](train), test)).first().auroc > 0.95 for x in ("linear_ce", "logreg"))
    assert learning.cross_validated(line.withColumn("site", line.id % 20), "site", 4, learning.linear_ce).count() == 4
    assert {r.setup for r in learning.three_way(line, line, line, line, learning.trainers(2)["logreg"]).collect()} == {"original", "original_on_clean", "clean"}


def test_encoder_runs_in_batches(spark):
    from terrasift.operators import learning

    df = spark.createDataFrame([(k, [float(k), 1.0]) for k in range(5)], "id long, px array<double>")
    got = {r.id: list(r.v) for r in learning.encoded(df, lambda: lambda x: x * 2, "px").collect()}
    assert got == {k: [2.0 * k, 2.0] for k in range(5)}


def test_vector_search_equals_brute_force(spark, monkeypatch):
    from terrasift.operators import vectors

    rng = np.random.default_rng(5)
    q, w = rng.normal(size=(60, 6)), rng.normal(size=(45, 6))
    w[3], w[4], q[7] = w[0], w[0], w[0]
    queries = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(q)] + [(99, None)], "id long, v array<double>")
    refs = spark.createDataFrame([(k, [float(x) for x in v], ("a", "b")[k % 2], float(k % 3 == 0)) for k, v in enumerate(w)], "rid long, w array<double>, kind string, y double")
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    want = 1 - unit(q) @ unit(w).T
    for size, left, right in ((1 << 20, queries, refs), (6 * 8 * 10, queries, refs), (6 * 8 * 10, queries.where("id < 20"), refs)):
        monkeypatch.setattr(vectors, "SLICE", size)
        near = {r.id: r for r in vectors.nearest_by_group(left, right.select("w", "kind"), "id", "kind", ["a", "b", "c"]).collect()}
        vote = {r.id: r.p for r in vectors.knn_vote(left, right, "id", 5).collect()}
        for k in near:
            if k == 99:
                assert near[k].a is None and k not in vote
                continue
            assert abs(near[k].a - want[k, ::2].min()) < 1e-12 and abs(near[k].b - want[k, 1::2].min()) < 1e-12 and near[k].c is None
            d = np.linalg.norm(q[k] - w, axis=1)
            first = np.lexsort((np.arange(45), d))[:5]
            zero = first[d[first] == 0]
            p = np.mean(zero % 3 == 0) if len(zero) else (1 / d[first] * (first % 3 == 0)).sum() / (1 / d[first]).sum()
            assert abs(vote[k] - p) < 1e-9


def test_modes_and_distances_in_windows(spark):
    from pyspark.sql import functions as F

    from terrasift.operators import rasters

    rng = np.random.default_rng(6)
    images = [rng.integers(0, 4, (5, 7)).tolist() for _ in range(4)]
    images[3] = [[None] * 7] * 5
    df = spark.createDataFrame([(k, [x for row in im for x in row]) for k, im in enumerate(images)], "k int, p array<int>")
    rows = {r.k: r for r in df.select("k", *[rasters.window_mode(F.col("p"), 5, 7, r).alias(f"m{r}") for r in (1, 3)], rasters.distance_to(F.transform("p", lambda x: x == 3), 5, 7, 10.0).alias("d")).collect()}
    for k, im in enumerate(images[:3]):
        a = np.array(im)
        for y in range(5):
            for x in range(7):
                for reach in (1, 3):
                    near = a[max(0, y - reach) : y + reach + 1, max(0, x - reach) : x + reach + 1].ravel()
                    assert rows[k][f"m{reach}"][y * 7 + x] == np.bincount(near).argmax()
                yy, xx = np.nonzero(a == 3)
                assert abs(rows[k].d[y * 7 + x] - 10 * np.sqrt(((yy - y) ** 2 + (xx - x) ** 2).min())) < 1e-9
    assert set(rows[3].m1) == {None} and set(rows[3].d) == {None}


def test_exact_quantiles(spark):
    from terrasift.operators import aggregates

    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(size=501), np.zeros(400)])
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),)], "x double").repartition(7)
    at = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    got = aggregates.quantiles(df, "x", at).first()
    assert np.allclose(list(got), np.quantile(x, at))
    assert list(aggregates.quantiles(df.where("x is null"), "x", at).first()) == [None] * 6
