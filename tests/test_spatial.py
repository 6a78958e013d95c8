"""Cell joins against brute force, at several latitudes."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrasift.functions.geometry import albers, inverse_albers, valid_outline
from terrasift.operators.spatial import box_join, nearest, radius_join, within

R = 6371000.0


def dist(a, b):
    p, q = math.radians(a[1]), math.radians(b[1])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
    return 2 * R * math.asin(min(1, math.sqrt(h)))


def points(n, seed, lat):
    r = random.Random(seed)
    return [(i, lat + r.uniform(-0.2, 0.2), -90 + r.uniform(-0.3, 0.3)) for i in range(n)] + [(n, None, -90.0), (n + 1, lat, None)]


def frames(spark, lat):
    a, b = points(150, 1, lat), points(200, 2, lat)
    left = spark.createDataFrame(a, "id long, lat double, lon double")
    return a[:150], b[:200], left, spark.createDataFrame(b, "rid long, rlat double, rlon double")


@pytest.mark.parametrize("lat", [0.0, 45.0, -70.0, 84.0])
def test_radius_join_is_brute_force(spark, lat):
    a, b, left, right = frames(spark, lat)
    got = sorted((r.id, r.rid) for r in radius_join(left, right, 3000).collect())
    assert got == sorted((x[0], y[0]) for x in a for y in b if dist(x, y) <= 3000)
    semi = {r.id for r in radius_join(left, right, 3000, how="left_semi").collect()}
    assert semi == {i for i, _ in got}
    anti = {r.id for r in radius_join(left, right, 3000, how="left_anti").collect()}
    assert anti == {r.id for r in left.collect()} - semi


def test_no_cartesian_product(spark):
    _, _, left, right = frames(spark, 40.0)
    for df in (radius_join(left, right, 2000), within(left, right, "id", 2000, 3)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_nearest_finds_far_points(spark):
    a, b, left, right = frames(spark, 40.0)
    far = left.union(spark.createDataFrame([(900, -60.0, 150.0)], left.schema))
    got = {r.id: r.rid for r in nearest(far, right, "id", 500).collect()}
    for x in [*a, (900, -60.0, 150.0)]:
        assert got[x[0]] == min(b, key=lambda y: (dist(x, y), y[0]))[0]
    assert got[150] is None
    near = {r.id: r.rid for r in nearest(left, right, "id", 500, most=500).collect()}
    assert all((v is None) == (min(dist(x, y) for y in b) > 500) for x in a for v in [near[x[0]]])


def test_box_join_once_and_edges(spark):
    left = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 1.0), (2, 2.0, 2.0, 2.0, 2.0), (3, -3.0, -3.0, 5.0, 5.0)], "id long, xmin double, ymin double, xmax double, ymax double")
    right = spark.createDataFrame([(1, 1.0, 1.0, 2.0, 2.0), (2, 9.0, 9.0, 9.5, 9.5)], "rid long, rxmin double, rymin double, rxmax double, rymax double")
    assert sorted((r.id, r.rid) for r in box_join(left, right, 0.3).collect()) == [(1, 1), (2, 1), (3, 1)]


def test_albers_goes_both_ways(spark):
    df = spark.createDataFrame([(30.0, -100.0), (48.0, -70.0), (23.0, -96.0)], "lat double, lon double")
    x, y = albers(F.col("lat"), F.col("lon"))
    back = inverse_albers(F.col("x"), F.col("y"))
    for r in df.select("lat", "lon", x.alias("x"), y.alias("y")).select("*", back[0].alias("a"), back[1].alias("o")).collect():
        assert abs(r.a - r.lat) < 1e-6 and abs(r.o - r.lon) < 1e-6
        if r.lat == 23.0:
            assert abs(r.x) < 1e-6 and abs(r.y) < 1e-6


def test_outline_rules(spark):
    rows = [([[0.0, 0.0], [1.0, 0.0], [0.5, 1.0]], True), ([[0.0, 0.0], [1.0, 0.0]], False), ([[0.0, 0.0], [1.1, 0.0], [0.5, 1.0]], False), (None, False)]
    df = spark.createDataFrame(rows, "p array<array<double>>, ok boolean")
    assert all(r.got == r.ok for r in df.withColumn("got", valid_outline(F.col("p"))).collect())


def test_pairs_across_the_antimeridian_and_near_a_pole(spark):
    a = [(1, 0.0, 179.9990), (2, 10.0, -179.9995), (3, 85.0, 179.99), (4, 0.0, 0.0), (5, -40.0, 180.0)]
    b = [(1, 0.0, -179.9990), (2, 10.0, 179.9990), (3, 85.0, -179.99), (4, 0.0, 0.001), (5, -40.0, -180.0), (6, 0.0, 90.0)]
    left, right = spark.createDataFrame(a, "id long, lat double, lon double"), spark.createDataFrame(b, "rid long, rlat double, rlon double")
    got = {(r.id, r.rid) for r in radius_join(left, right, 500).collect()}
    assert got == {(x[0], y[0]) for x in a for y in b if dist(x, y) <= 500} and len(got) == 5
    assert {r.id for r in radius_join(left, right, 500, how="left_anti").collect()} == set()


def test_semi_and_anti_joins_keep_equal_rows(spark):
    left = spark.createDataFrame([(1, 0.0, 0.0), (1, 0.0, 0.0), (2, 9.0, 9.0), (2, 9.0, 9.0), (3, None, 1.0)], "id long, lat double, lon double")
    right = spark.createDataFrame([(7, 0.0, 0.0), (8, 0.0, 0.0001)], "rid long, rlat double, rlon double")
    assert sorted(r.id for r in radius_join(left, right, 100, how="left_semi").collect()) == [1, 1]
    assert sorted(r.id for r in radius_join(left, right, 100, how="left_anti").collect()) == [2, 2, 3]


def test_roads_cut_lines(spark):
    from terrasift.operators.spatial import crosses, uncrossed

    r = random.Random(3)
    lines = [(k, k + 1000, *[r.uniform(0, 10) for _ in range(4)]) for k in range(200)]
    roads = [tuple(r.uniform(0, 10) for _ in range(4)) for _ in range(6)] + [(5.0, -1.0, 5.0, 11.0)]
    lines.append((500, 1500, 5.0, 2.0, 7.0, 2.0))  # begins on a road

    def side(p, q, t):
        return (q[0] - p[0]) * (t[1] - p[1]) - (q[1] - p[1]) * (t[0] - p[0])

    def hit(x, y):
        a, b, c, d = x[2:4], x[4:6], y[:2], y[2:]
        return side(a, b, c) * side(a, b, d) <= 0 and side(c, d, a) * side(c, d, b) <= 0

    got = uncrossed(spark.createDataFrame(lines, "a long, b long, xa double, ya double, xb double, yb double"), spark.createDataFrame(roads, "xa double, ya double, xb double, yb double"), 0.7)
    assert "NestedLoop" not in got._jdf.queryExecution().toString() and "Cartesian" not in got._jdf.queryExecution().toString()
    assert {x.a for x in got.collect()} == {x[0] for x in lines if not any(hit(x, y) for y in roads)}


def test_plans_have_no_nested_loops(spark):
    import __spark_entry__ as entry

    for name in ("j29_road_cut", "j34_cosine_nearest", "m02_drop_rule", "m09_knn_vote", "j17_multi_radius", "w06_global_rank"):
        plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan, name


def test_edges_of_polygons(spark):
    """A point on an outer edge or corner is outside, one on a hole's edge or corner inside, whichever side it is on."""
    from terrasift.operators.spatial import in_region

    box = lambda x0, y0, x1, y1: [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    polygons = spark.createDataFrame([([box(0.0, 0.0, 4.0, 4.0), box(1.0, 1.0, 3.0, 3.0)],), ([[(10.0, 0.0), (12.0, 2.0), (10.0, 4.0)]],)], "rings array<array<struct<x: double, y: double>>>")
    grid = [(k, k % 29 / 2.0 - 0.5, k // 29 / 2.0 - 0.5) for k in range(29 * 11)]
    inside = lambda x, y: (0 < x < 4 and 0 < y < 4 and not (1 < x < 3 and 1 < y < 3)) or (x > 10 and abs(y - 2) < 12 - x)
    got = in_region(spark.createDataFrame(grid, "id long, lon double, lat double"), polygons)
    assert {r.id for r in got.collect()} == {k for k, x, y in grid if inside(x, y)}


def counting(monkeypatch, module, name="written"):
    """The rows of the tables that a module writes, by label."""
    made, real = {}, getattr(module, name)

    def count(df, label):
        out = real(df, label)
        made[label] = max(made.get(label, 0), out.count())
        return out

    monkeypatch.setattr(module, name, count)
    return made


def copies(spark, n, spots=((40.0, -90.0), (40.001, -90.0), (40.5, -90.0)), name=""):
    """n points at each spot; two spots are near each other."""
    rows = [(k * 10 + s, *spots[s]) for k in range(n) for s in range(len(spots))]
    return spark.createDataFrame(rows, f"{name}id long, {name}lat double, {name}lon double")


def test_exploded_sides_are_not_broadcast(spark):
    left, right = copies(spark, 2), copies(spark, 2, name="r")
    one = box_join(left.selectExpr("lon xmin", "lat ymin", "lon + 5 xmax", "lat + 5 ymax"), right.selectExpr("rlon rxmin", "rlat rymin", "rlon rxmax", "rlat rymax"), 0.05)
    for df in (radius_join(left, right, 500), one):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_clusters_pair_places(spark, monkeypatch):
    """c01, c03: sixty points at each of three places are one pair of places, not thousands."""
    from terrasift.operators import graph

    made = counting(monkeypatch, graph)
    points = copies(spark, 60).union(spark.createDataFrame([(7, None, -90.0), (8, None, -90.0), (9, 41.0, -90.0)], "id long, lat double, lon double"))
    got = {r.id: (r.cluster, r.core) for r in graph.dbscan(points, 500, 61).collect()}
    assert made["pairs"] == 1
    assert got == {r.id: ((0, True) if r.id % 10 < 2 and r.id > 1 or r.id < 2 else (-1, False)) for r in points.collect()}
    assert {r.cluster for r in graph.dbscan(points, 500, 60).collect()} == {0, 2, -1}
    assert {r.id: r.cluster for r in graph.dbscan(points, 500, 1).collect()}[8] == 8


def test_sub_clusters_pair_places_of_a_parent(spark, monkeypatch):
    """c02: places of different parents are never paired."""
    from terrasift.operators import areas, graph

    made = counting(monkeypatch, graph)
    points = copies(spark, 40).withColumn("parent", F.col("id") % 4)
    got = {r.id: (r.cluster, r.parent) for r in areas.sub_clusters(points, "parent", 500, 30).collect()}
    assert made["pairs"] <= 4
    for k, (cluster, parent) in got.items():
        near = [j for j in got if j % 4 == k % 4 and (j % 10 == k % 10 or {j % 10, k % 10} == {0, 1})]
        assert cluster == (min(near) if len(near) >= 30 else -1) and parent == k % 4


def test_greedy_dedup_pairs_places(spark, monkeypatch):
    """c05"""
    from terrasift.operators import graph

    made = counting(monkeypatch, graph)
    points = copies(spark, 60).union(spark.createDataFrame([(7, None, -90.0), (8, None, -90.0)], "id long, lat double, lon double"))
    assert {r.id for r in graph.greedy_dedup(points, 500).collect()} == {0, 2, 7, 8} and made["pairs"] == 1


def test_nearest_and_within_compare_places(spark, monkeypatch):
    """j20, j22: what is joined follows the places, results are those of all rows."""
    from terrasift.operators import spatial

    sizes, real = [], spatial.radius_join

    def joined(*args, **kw):
        out = real(*args, **kw)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(spatial, "radius_join", joined)
    left, right = copies(spark, 50), copies(spark, 50, name="r")
    assert {(r.id, r.rid) for r in spatial.nearest(left, right, "id", 500).collect()} == {(r.id, r.id % 10) for r in left.collect()}
    assert sizes == [5]
    got = {(r.id, r["rank"], r.rid) for r in spatial.within(left, right, "id", 500, 4).collect()}
    assert got == {(r.id, k + 1, k * 10 + r.id % 10) for r in left.collect() for k in range(4)} and sizes[1] == 20


def test_road_cut_compares_places(spark, tmp_path, monkeypatch):
    """j29: three buildings at each place give the pairs of the SQL, by one line for each pair of places."""
    import duckdb

    import __spark_entry__ as entry
    from terrasift.plans import joins

    made = counting(monkeypatch, joins)
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    more = part.crossJoin(spark.range(3).withColumnRenamed("id", "_k")).withColumn("p_partkey", F.col("p_partkey") + 20000 * F.col("_k")).drop("_k")
    more.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    spark.read.parquet("/root/testdata/sf0.001/nation.parquet").coalesce(1).write.parquet(str(tmp_path / "nation.parquet"))
    con = duckdb.connect()
    for name in ("part", "nation"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = con.sql(entry.oracle_sql()["j29_road_cut"]).fetchall()
    got = [tuple(r) for r in entry.queries()["j29_road_cut"](spark, str(tmp_path)).select("a", "b").collect()]
    assert sorted(got) == sorted(want) and made["place-pairs"] <= len(want) / 9 * 4


def test_facilities_pair_places_of_a_box(spark, monkeypatch):
    """c06: candidates of one box share their clusters, buildings at one place are one node."""
    from terrasift.operators import areas, graph

    made = counting(monkeypatch, graph)
    b = copies(spark, 30).selectExpr("id", "lat", "lon", "10.0D approx_area_m2", "if(id % 20 < 10, 'warehouse', 'hangar') class", "'' subtype", "concat('n', id % 3) name", "id / 1.0D height", "1 num_floors")
    box = lambda i: (i, -90.0, 40.0, -90.2, 39.8, -89.8, 40.2)
    c = spark.createDataFrame([box(5), box(4)], "candidate_id long, lon double, lat double, lon_min double, lat_min double, lon_max double, lat_max double")
    got = areas.facilities(c, b, c.limit(0)).orderBy("facility_id").collect()
    assert made["pairs"] == 1 and made["nodes"] == 2
    assert [(r.facility_id, r.parent_candidate_id, r.n_buildings, r.names, r.max_height_m, r.top_class) for r in got] == [(f"f_000000{k}", 4 + k, 60, ["n0", "n1", "n2"], 291.0, "hangar") for k in range(2)]
    assert all(abs(r.lat - 40.0005) < 1e-9 and r.lon == -90.0 for r in got)


def test_facilities_make_no_pairs_of_different_places(spark, monkeypatch):
    """c06: 300 different places within a radius are one row, not 44 850 pairs."""
    from terrasift.operators import areas, graph

    made = counting(monkeypatch, graph)
    b = spark.range(300).selectExpr("id", "40.0D + id * 1e-6D lat", "-90.0D lon", "10.0D approx_area_m2", "'warehouse' class", "'' subtype", "'n' name", "1.0D height", "1 num_floors")
    c = spark.createDataFrame([(5, -90.0, 40.0, -90.2, 39.8, -89.8, 40.2)], "candidate_id long, lon double, lat double, lon_min double, lat_min double, lon_max double, lat_max double")
    assert [r.n_buildings for r in areas.facilities(c, b, c.limit(0)).collect()] == [300]
    assert made["pairs"] == 1 and made["nodes"] == 300


@pytest.mark.parametrize("tile", [1, 3, 16])
def test_boxed_clusters_equal_brute_force(spark, monkeypatch, tile):
    """c06: boxes cut into tiles give the clusters of all pairs, border nodes among them."""
    from terrasift.operators import graph

    monkeypatch.setattr(graph, "TILE", tile)
    rng, eps, least = np.random.default_rng(tile), 1000.0, 6
    rows = [(k % 3, k // 3 * 7 % 1000, 40.0 + float(la), -90.0 + float(lo), int(n)) for k, (la, lo, n) in enumerate(zip(rng.random(900) * 0.12, rng.random(900) * 0.12, rng.integers(1, 4, 900)))]
    got = {(r.box, r.id): r.cluster for r in graph.boxed_clusters(spark.createDataFrame(rows, "box long, id long, lat double, lon double, n long"), eps, least).collect()}
    want = {}
    for box in range(3):
        _, ids, lat, lon, n = (np.array(v) for v in zip(*[r for r in rows if r[0] == box]))
        x, y = lon * 111000.0 * np.cos(np.radians((lat * n).sum() / n.sum())), lat * 111000.0
        near = np.hypot(x[:, None] - x, y[:, None] - y) <= eps
        core = near @ n >= least
        label = np.where(core, ids, 1 << 40)
        for _ in range(len(ids)):
            label = np.where(core, np.where(near & core, label, 1 << 40).min(axis=1), 1 << 40)
        label = np.where(core, label, np.where(near & core, label, 1 << 40).min(axis=1))
        want |= {(box, int(i)): int(v) for i, v in zip(ids, label) if v < 1 << 40}
    assert got == want and len(set(want.items())) < 900 and len({(k[0], v) for k, v in want.items()}) > 5
