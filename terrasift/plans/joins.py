"""Relational and spatial joins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.scalar import EARTH_KM, change_status, grid_cell, tidy
from ..operators import spatial as S
from ..operators.graph import near_pairs, places
from ..operators.incremental import todo
from ..operators.ranking import best
from ..sources.scratch import written
from .base import haversine_sql as hav
from .base import query, sql, tidy_sql

BA = hav("a.lat", "a.lon", "b.lat", "b.lon")


def targets(df, *payload):
    """The right side of a spatial join: rid, rlat, rlon and payload."""
    return df.select(F.col("id").alias("rid"), F.col("lat").alias("rlat"), F.col("lon").alias("rlon"), *[F.col(p).alias(f"r{p}") for p in payload])


def boxes(df, *payload):
    return df.select(F.col("id").alias("rid"), *[F.col(c).alias(f"r{c}") for c in ("xmin", "ymin", "xmax", "ymax", *payload)])


def wide(df, by: float):
    """Candidates and anchors as boxes of half-size ``by`` degrees."""
    return df.select("*", (F.col("lon") - by).alias("xmin"), (F.col("lat") - by).alias("ymin"), (F.col("lon") + by).alias("xmax"), (F.col("lat") + by).alias("ymax"))


MEET = "{l}.xmin <= {r}.xmax AND {r}.xmin <= {l}.xmax AND {l}.ymin <= {r}.ymax AND {r}.ymin <= {l}.ymax"
AW = "w AS (SELECT *, lon - 0.01e0 AS xmin, lat - 0.01e0 AS ymin, lon + 0.01e0 AS xmax, lat + 0.01e0 AS ymax FROM a)"


@query("j01_inner", sql("bh", "SELECT b.id, area, change FROM b JOIN h ON b.id = h.id"))
def _(t):
    return t.buildings().join(t.changes(), "id").select("id", "area", "change")


@query("j02_left", sql("bh", "SELECT b.id, h.footprint, h.id IS NOT NULL AS covered FROM b LEFT JOIN h ON b.id = h.id AND h.footprint > 25"))
def _(t):
    some = t.changes().where("footprint > 25").withColumn("covered", F.lit(True))
    return t.buildings().select("id").join(some, "id", "left").select("id", "footprint", F.coalesce("covered", F.lit(False)).alias("covered"))


_KEPT = "k AS (SELECT site, year, arg_max(label, (ts, event_id)) AS label FROM l GROUP BY 1, 2)"


def panel(t):
    """The latest label of each site and year."""
    return t.labels().groupBy("site", "year").agg(F.max_by("label", F.struct("ts", "event_id")).alias("label"))


@query("j03_left_composite", sql("l", "SELECT g.site, g.year, k.label FROM (SELECT DISTINCT site, year + 1 AS year FROM l) g LEFT JOIN k ON g.site = k.site AND g.year = k.year", _KEPT))
def _(t):
    grid = t.labels().select("site", (F.col("year") + 1).alias("year")).distinct()
    return grid.join(panel(t), ["site", "year"], "left").select("site", "year", "label")


@query("j04_left_drop_orphans", sql("l", "SELECT g.site, g.year, k.label FROM (SELECT DISTINCT site, year + 1 AS year FROM l) g JOIN k ON g.site = k.site AND g.year = k.year", _KEPT))
def _(t):
    grid = t.labels().select("site", (F.col("year") + 1).alias("year")).distinct()
    return grid.join(panel(t), ["site", "year"]).select("site", "year", "label")


@query("j05_left_filter_default", sql("b", "SELECT b.id, n.n_tiles FROM b LEFT JOIN (SELECT l_partkey AS id, count(*) AS n_tiles FROM lineitem WHERE l_quantity > 45 GROUP BY 1) n ON b.id = n.id WHERE coalesce(n.n_tiles, 0) > 2"))
def _(t):
    n = t.raw("lineitem").where("l_quantity > 45").groupBy(F.col("l_partkey").alias("id")).agg(F.count(F.lit(1)).alias("n_tiles"))
    return t.buildings().select("id").join(n, "id", "left").where(F.coalesce("n_tiles", F.lit(0)) > 2)


@query("j06_left_default_fill", sql("bh", "SELECT b.id, coalesce(h.footprint > 10, true) AS clean FROM b LEFT JOIN h ON b.id = h.id AND h.error IS NULL"))
def _(t):
    return t.buildings().select("id").join(t.changes().where("error is null"), "id", "left").select("id", F.coalesce(F.col("footprint") > 10, F.lit(True)).alias("clean"))


@query("j07_map_lookup", "SELECT c_custkey, n_name AS state FROM customer LEFT JOIN (SELECT n_nationkey, n_name FROM nation WHERE n_nationkey < 20) ON c_nationkey = n_nationkey")
def _(t):
    dim = t.raw("nation").where("n_nationkey < 20").select("n_nationkey", F.col("n_name").alias("state"))
    return t.raw("customer").join(dim, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", "state")


@query("j08_override_lookup", sql("a", "SELECT a.id, coalesce(o.kind, a.site_type) AS site_type FROM a LEFT JOIN (SELECT s_suppkey AS id, 'expansion' AS kind FROM supplier WHERE s_suppkey % 3 = 0) o ON a.id = o.id"))
def _(t):
    o = t.raw("supplier").where("s_suppkey % 3 = 0").select(F.col("s_suppkey").alias("id"), F.lit("expansion").alias("kind"))
    return t.anchors().join(o, "id", "left").select("id", F.coalesce("kind", "site_type").alias("site_type"))


@query("j09_semi_composite", sql("l", "SELECT DISTINCT site, year FROM l WHERE (site, year) IN (SELECT (site, year) FROM k WHERE label = 'complete')", _KEPT))
def _(t):
    return t.labels().select("site", "year").distinct().join(panel(t).where("label = 'complete'"), ["site", "year"], "left_semi")


@query("j10_semi_in_select", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)")
def _(t):
    keys = t.raw("customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    return t.raw("orders").join(keys, "o_custkey", "left_semi").select("o_orderkey")


@query("j11_anti", sql("b", "SELECT id FROM b WHERE id NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A' AND l_quantity > 30)"))
def _(t):
    added = t.raw("lineitem").where("l_returnflag = 'A' and l_quantity > 30").select(F.col("l_partkey").alias("id"))
    return todo(t.buildings().select("id"), added, ["id"])


@query("j12_anti_composite", sql("l", "SELECT site, year, label FROM k WHERE (site, year) NOT IN (SELECT (site, year) FROM l WHERE label = 'not_a_site')", _KEPT))
def _(t):
    return todo(panel(t), t.labels().where("label = 'not_a_site'"), ["site", "year"]).select("site", "year", "label")


@query("j13_cross_minus_done", sql("l", "SELECT site, year FROM (SELECT DISTINCT site FROM l), (SELECT unnest(range(1, 31)) AS year) EXCEPT SELECT site, year FROM l"))
def _(t):
    every = t.labels().select("site").distinct().withColumn("year", F.explode(F.sequence(F.lit(1), F.lit(30)).cast("array<long>")))
    return todo(every, t.labels(), ["site", "year"]).select("site", "year")


@query("j14_radius_exists", sql("ab", f"SELECT DISTINCT a.id FROM a JOIN b ON b.area >= 3000 AND {BA} <= 1200"))
def _(t):
    return S.radius_join(t.anchors().select("id", "lat", "lon"), targets(t.buildings().where("area >= 3000")), 1200, how="left_semi").select("id")


@query("j15_radius_count", sql("ab", f"SELECT a.id, count(b.id) AS n FROM a LEFT JOIN b ON coalesce(b.subtype = 'industrial', false) AND {BA} <= 500 GROUP BY a.id"))
def _(t):
    left = t.anchors().select("id", "lat", "lon")
    n = S.radius_join(left, targets(t.buildings().where("subtype = 'industrial'")), 500).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return left.select("id").join(n, "id", "left").select("id", F.coalesce("n", F.lit(0)).alias("n"))


@query("j16_radius_pairs", sql("ab", f"SELECT a.id, b.id AS building, a.site_type, {tidy_sql(BA, 3)} AS dist FROM a JOIN b ON {BA} <= 400"))
def _(t):
    found = S.radius_join(t.anchors().select("id", "lat", "lon", "site_type"), targets(t.buildings()), 400)
    return found.select("id", F.col("rid").alias("building"), "site_type", tidy(F.col("dist"), 3).alias("dist"))


@query("j17_multi_radius", sql("ab", f"""SELECT id, n_100m, n_500m, n_2km, CASE WHEN n_100m BETWEEN 1 AND 3 THEN 'strong' WHEN n_100m > 3 THEN 'multi' WHEN n_500m > 0 THEN 'far' ELSE 'none' END AS quality, ids FROM (
SELECT a.id, CAST(coalesce(count_if(d <= 100), 0) AS BIGINT) AS n_100m, CAST(coalesce(count_if(d <= 500), 0) AS BIGINT) AS n_500m, count(d) AS n_2km, coalesce(list_sort(CASE WHEN count_if(d <= 100) > 0 THEN list(bid) FILTER (WHERE d <= 100) ELSE list(bid) FILTER (WHERE d <= 500) END), []) AS ids FROM a LEFT JOIN (SELECT a.id AS aid, b.id AS bid, {BA} AS d FROM a JOIN b ON {BA} <= 2000) p ON a.id = p.aid GROUP BY a.id)"""))
def _(t):
    left = t.anchors().select("id", "lat", "lon")
    pairs = S.radius_join(left, targets(t.buildings()), 2000).select("id", "rid", "dist")
    counts = pairs.groupBy("id").agg(F.count_if(F.col("dist") <= 100).alias("n_100m"), F.count_if(F.col("dist") <= 500).alias("n_500m"), F.count(F.lit(1)).alias("n_2km"), *[F.sort_array(F.collect_list(F.when(F.col("dist") <= r, F.col("rid")))).alias(f"ids{r}") for r in (100, 500)])
    n = left.select("id").join(counts, "id", "left").na.fill(0, ["n_100m", "n_500m", "n_2km"])
    quality = F.when(F.col("n_100m").between(1, 3), "strong").when(F.col("n_100m") > 3, "multi").when(F.col("n_500m") > 0, "far").otherwise("none")
    return n.select("id", "n_100m", "n_500m", "n_2km", quality.alias("quality"), F.coalesce(F.when(F.col("n_100m") > 0, F.col("ids100")).otherwise(F.col("ids500")), F.array().cast("array<long>")).alias("ids"))


_STATUS = "CASE WHEN coalesce(change, -1) >= 0.15 THEN 'changed' WHEN error IS NOT NULL THEN 'error' WHEN coalesce(footprint, 0) < 10 OR change IS NULL THEN 'ambiguous' ELSE 'stable' END"
_RESCUE = f"z AS (SELECT b.id, b.lat, b.lon, {_STATUS} AS status FROM b LEFT JOIN h ON b.id = h.id)"


def statuses(t, threshold: float = 0.15):
    scored = t.buildings().select("id", "lat", "lon").join(t.changes(), "id", "left")
    return scored.select("id", "lat", "lon", change_status(F.col("change"), F.col("footprint"), F.col("error"), threshold).alias("status"))


@query("j18_proximity_rescue", sql("bh", f"SELECT DISTINCT s.id FROM z s JOIN z c ON s.status = 'stable' AND c.status = 'changed' AND {hav('s.lat', 's.lon', 'c.lat', 'c.lon', 6371.0088)} <= 6.0", _RESCUE))
def _(t):
    z = statuses(t)
    return S.radius_join(z.where("status = 'stable'"), targets(z.where("status = 'changed'")), 6000, earth=EARTH_KM * 1000, how="left_semi").select("id")


_OWN = "span / 2 + 1500"


@query("j19_variable_radius_owner", sql("cb", f"""SELECT b.id, arg_min(c.id, (-prob, c.id)) AS owner FROM c JOIN b ON {hav('c.lat', 'c.lon', 'b.lat', 'b.lon')} <= {_OWN}
AND abs(b.lat - c.lat) * 110540.0e0 <= span / 2 + 1000 AND abs(b.lon - c.lon) * 111320.0e0 * cos(radians(c.lat)) <= span / 2 + 1000 GROUP BY b.id"""))
def _(t):
    c = t.candidates()
    pairs = S.radius_join(t.buildings().select("id", "lat", "lon"), targets(c, "span", "prob"), 39 * 100 / 2 + 1500)
    reach = F.col("rspan") / 2
    inside = (F.abs(F.col("lat") - F.col("rlat")) * 110540.0 <= reach + 1000) & (F.abs(F.col("lon") - F.col("rlon")) * 111320.0 * F.cos(F.radians("rlat")) <= reach + 1000)
    return pairs.where((F.col("dist") <= reach + 1500) & inside).groupBy("id").agg(F.min_by("rid", F.struct(-F.col("rprob"), "rid")).alias("owner"))


_NEAR = f"(SELECT a.id, b.id AS bid, b.name, {BA} AS d, row_number() OVER (PARTITION BY a.id ORDER BY {BA}, b.id) AS r FROM a, b)"


@query("j20_nearest", sql("ab", f"SELECT id, bid AS building, name, {tidy_sql('d', 3)} AS dist FROM {_NEAR} WHERE r = 1"))
def _(t):
    found = S.nearest(t.anchors().select("id", "lat", "lon"), targets(t.buildings(), "name"), "id", 1500)
    return found.select("id", F.col("rid").alias("building"), F.col("rname").alias("name"), tidy(F.col("dist"), 3).alias("dist"))


@query("j21_nearest_within", sql("ab", f"SELECT id, CASE WHEN d <= 900 THEN bid END AS building, CASE WHEN d <= 900 THEN {tidy_sql('d', 3)} END AS dist FROM {_NEAR} WHERE r = 1"))
def _(t):
    found = S.nearest(t.anchors().select("id", "lat", "lon"), targets(t.buildings()), "id", 900, most=900)
    return found.select("id", F.col("rid").alias("building"), tidy(F.col("dist"), 3).alias("dist"))


@query("j22_k_nearest", sql("ab", f"SELECT id, list(bid ORDER BY r) AS near FROM {_NEAR} WHERE r <= 15 AND d <= 3000 GROUP BY id"))
def _(t):
    ranked = S.within(t.anchors().select("id", "lat", "lon"), targets(t.buildings()), "id", 3000, 15)
    return ranked.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("rank", "rid"))).alias("z")).select("id", F.transform("z", lambda z: z["rid"]).alias("near"))


@query("j23_exclude_near", sql("ab", f"SELECT a.id FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE {BA} <= 500)"))
def _(t):
    return S.radius_join(t.anchors().select("id", "lat", "lon"), targets(t.buildings()), 500, how="left_anti").select("id")


@query("j24_box_intersects", sql("ab", f"SELECT w.id, count(*) AS n_tiles, list_sort(list(b.id)) AS tiles FROM w JOIN b ON {MEET.format(l='w', r='b')} GROUP BY w.id", AW))
def _(t):
    pairs = S.box_join(wide(t.anchors(), 0.01), boxes(t.buildings()), 0.03)
    return pairs.groupBy("id").agg(F.count(F.lit(1)).alias("n_tiles"), F.sort_array(F.collect_list("rid")).alias("tiles"))


@query("j25_majority_attribute", sql("ab", f"SELECT id, class FROM (SELECT w.id, b.class, row_number() OVER (PARTITION BY w.id ORDER BY count(*) DESC, b.class) AS r FROM w JOIN b ON b.class IS NOT NULL AND {MEET.format(l='w', r='b')} GROUP BY w.id, b.class) WHERE r = 1", AW))
def _(t):
    pairs = S.box_join(wide(t.anchors(), 0.01), boxes(t.buildings().where("class is not null"), "class"), 0.03)
    return best(pairs.groupBy("id", "rclass").count(), ["id"], [F.desc("count"), F.col("rclass")]).select("id", F.col("rclass").alias("class"))


_DEG = "(w.lat - b.lat) * (w.lat - b.lat) + (w.lon - b.lon) * (w.lon - b.lon)"


@query("j26_nearest_tile", sql("ab", f"SELECT w.id, arg_min(b.id, ({_DEG}, b.id)) AS tile FROM w JOIN b ON {MEET.format(l='w', r='b')} GROUP BY w.id", AW))
def _(t):
    pairs = S.box_join(wide(t.anchors(), 0.01), boxes(t.buildings(), "lat", "lon"), 0.03)
    d2 = (F.col("lat") - F.col("rlat")) * (F.col("lat") - F.col("rlat")) + (F.col("lon") - F.col("rlon")) * (F.col("lon") - F.col("rlon"))
    return pairs.groupBy("id").agg(F.min_by("rid", F.struct(d2, "rid")).alias("tile"))


@query("j27_preferred_tile", sql("ab", f"SELECT id, tile FROM (SELECT w.id, b.id AS tile, row_number() OVER (PARTITION BY w.id ORDER BY b.id % 5 DESC, b.name DESC, {_DEG}, b.id) AS r FROM w JOIN b ON {MEET.format(l='w', r='b')}) WHERE r = 1", AW))
def _(t):
    pairs = S.box_join(wide(t.anchors(), 0.01), boxes(t.buildings(), "lat", "lon", "name"), 0.03)
    d2 = (F.col("lat") - F.col("rlat")) * (F.col("lat") - F.col("rlat")) + (F.col("lon") - F.col("rlon")) * (F.col("lon") - F.col("rlon"))
    return best(pairs.withColumn("d2", d2), ["id"], [F.desc(F.col("rid") % 5), F.desc("rname"), F.col("d2"), F.col("rid")]).select("id", F.col("rid").alias("tile"))


@query("j28_point_in_polygon", sql("b", "SELECT id FROM b WHERE lat > 30.5e0 AND lat < 31.5e0 AND lon > -99.5e0 + (lat - 30.5e0) * 0.5e0 AND lon < -98.5e0"))
def _(t):
    ring = [(-99.5, 30.5), (-98.5, 30.5), (-98.5, 31.5), (-99.0, 31.5)]
    column = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ring])
    return t.buildings().where(S.in_ring(F.col("lon"), F.col("lat"), column)).select("id")


ROADS = "r AS (SELECT n_nationkey AS road, -100.0e0 + n_nationkey * 0.08e0 AS x, 30.0e0 + n_nationkey * 0.08e0 AS y FROM nation)"


def roads(t):
    """A vertical and a horizontal line for each nation: x and y constant."""
    return t.raw("nation").select(F.col("n_nationkey").alias("road"), (F.col("n_nationkey") * 0.08 - 100.0).alias("x"), (F.col("n_nationkey") * 0.08 + 30.0).alias("y"))


def road_segments(t):
    """The lines of roads() as segments far beyond all points."""
    r = roads(t)
    up = r.select(F.col("x").alias("xa"), F.lit(29.0).alias("ya"), F.col("x").alias("xb"), F.lit(33.0).alias("yb"))
    return up.union(r.select(F.lit(-101.0), F.col("y"), F.lit(-97.0), F.col("y")))


def cut_edges(t, radius: float):
    """Pairs of buildings within radius whose joining line no road crosses: (a, b). Places are compared, then their buildings paired."""
    b = t.buildings().select("id", "lat", "lon")
    members, each = places(b)
    members = written(members, "place-members")
    ends = lambda d: each.select(F.col("id").alias(d), F.col("lat").alias(f"y{d}"), F.col("lon").alias(f"x{d}"))
    both = written(near_pairs(each, radius), "place-pairs")
    both = both.union(both.select("b", "a")).union(each.select("id", "id"))  # either way round, and a place with itself
    open_ = written(S.uncrossed(both.join(ends("a"), "a").join(ends("b"), "b"), road_segments(t), 0.05).select(F.col("a").alias("pa"), F.col("b").alias("pb")), "open-lines")
    side = lambda d: members.select(F.col("id").alias(d), F.col("place").alias(f"p{d}"))
    return open_.hint("merge").join(side("a"), "pa").hint("merge").join(side("b"), "pb").where("a < b").select("a", "b")


PAIRS = "e AS (SELECT p.id AS a, q.id AS b, p.lon AS xa, p.lat AS ya, q.lon AS xb, q.lat AS yb FROM b p JOIN b q ON p.id < q.id AND abs(p.lat - q.lat) < 0.03 AND " + hav("p.lat", "p.lon", "q.lat", "q.lon") + " <= {r})"
UNCUT = "u AS (SELECT a, b FROM e WHERE NOT EXISTS (SELECT 1 FROM r WHERE (least(xa, xb) <= x AND x <= greatest(xa, xb)) OR (least(ya, yb) <= y AND y <= greatest(ya, yb))))"


@query("j29_road_cut", sql("b", "SELECT a, b FROM u", ",\n".join([ROADS, PAIRS.format(r=2500), UNCUT])))
def _(t):
    return cut_edges(t, 2500)


@query("j30_point_in_box", sql("cb", "SELECT c.id, count(*) AS n FROM c JOIN b ON b.lon BETWEEN c.lon - 0.02e0 AND c.lon + 0.02e0 AND b.lat BETWEEN c.lat - 0.02e0 AND c.lat + 0.02e0 GROUP BY c.id"))
def _(t):
    points = t.buildings().select(F.col("id").alias("rid"), F.col("lon").alias("rxmin"), F.col("lat").alias("rymin"), F.col("lon").alias("rxmax"), F.col("lat").alias("rymax"))
    return S.box_join(wide(t.candidates(), 0.02), points, 0.05).groupBy("id").agg(F.count(F.lit(1)).alias("n"))


_GAPX = "greatest(0.0e0, greatest(p.xmin - q.xmax, q.xmin - p.xmax))"
_GAPY = "greatest(0.0e0, greatest(p.ymin - q.ymax, q.ymin - p.ymax))"


@query("j31_gap_pairs", sql("b", f"SELECT p.id AS a, q.id AS b FROM b p JOIN b q ON p.id < q.id AND sqrt({_GAPX} * {_GAPX} + {_GAPY} * {_GAPY}) <= 0.03e0"))
def _(t):
    b = t.buildings().select("id", "xmin", "ymin", "xmax", "ymax")
    wider = boxes(b).withColumns({"rx0": F.col("rxmin"), "ry0": F.col("rymin"), "rx1": F.col("rxmax"), "ry1": F.col("rymax")})
    wider = wider.withColumns({"rxmin": F.col("rx0") - 0.0301, "rymin": F.col("ry0") - 0.0301, "rxmax": F.col("rx1") + 0.0301, "rymax": F.col("ry1") + 0.0301})
    pairs = S.box_join(b, wider, 0.02).where("id < rid")
    gap = lambda lo, hi, rlo, rhi: F.greatest(F.lit(0.0), F.greatest(F.col(lo) - F.col(rhi), F.col(rlo) - F.col(hi)))
    gx, gy = gap("xmin", "xmax", "rx0", "rx1"), gap("ymin", "ymax", "ry0", "ry1")
    return pairs.where(F.sqrt(gx * gx + gy * gy) <= 0.03).select(F.col("id").alias("a"), F.col("rid").alias("b"))


_SHARED = "greatest(0.0e0, least(w.xmax, b.xmax) - greatest(w.xmin, b.xmin)) * greatest(0.0e0, least(w.ymax, b.ymax) - greatest(w.ymin, b.ymin)) / ((b.xmax - b.xmin) * (b.ymax - b.ymin))"


@query("j32_max_overlap", sql("ab", f"SELECT id, {tidy_sql('m')} AS overlap FROM (SELECT b.id, coalesce(max(CASE WHEN {MEET.format(l='w', r='b')} THEN {_SHARED} END), 0.0e0) AS m FROM b LEFT JOIN w ON {MEET.format(l='w', r='b')} GROUP BY b.id) WHERE m < 0.3e0", AW.replace("0.01e0", "0.001e0")))
def _(t):
    from ..functions.geometry import box_overlap

    b = t.buildings()
    pairs = S.box_join(wide(t.anchors(), 0.001).drop("lat", "lon"), boxes(b), 0.01)
    share = pairs.groupBy("rid").agg(F.max(box_overlap()).alias("m"))
    out = b.select("id").join(share.select(F.col("rid").alias("id"), "m"), "id", "left").withColumn("m", F.coalesce("m", F.lit(0.0)))
    return out.where("m < 0.3").select("id", tidy(F.col("m")).alias("overlap"))


@query("j33_grid_lookup", sql("ba", "SELECT b.id, min(a.id) AS scene FROM b JOIN a ON CAST(floor(b.lat / 0.1e0) AS BIGINT) = CAST(floor(a.lat / 0.1e0) AS BIGINT) AND CAST(floor(b.lon / 0.1e0) AS BIGINT) = CAST(floor(a.lon / 0.1e0) AS BIGINT) GROUP BY b.id"))
def _(t):
    cells = lambda df: df.select("id", grid_cell(F.col("lat"), 0.1).alias("y"), grid_cell(F.col("lon"), 0.1).alias("x"))
    scene = cells(t.anchors()).groupBy("y", "x").agg(F.min("id").alias("scene"))
    return cells(t.buildings()).join(scene, ["y", "x"]).select("id", "scene")


_COS = "1.0e0 - list_sum(list_transform(range(1, 65), lambda i: q.v[i] * p.v[i])) / (greatest(sqrt(list_sum(list_transform(q.v, lambda x: x * x))), 1e-12) * greatest(sqrt(list_sum(list_transform(p.v, lambda x: x * x))), 1e-12))"


@query("j34_cosine_nearest", sql("v", f"SELECT q.id, {tidy_sql('min(CASE WHEN p.label = 0 THEN ' + _COS + ' END)', 5)} AS d_pos, {tidy_sql('min(CASE WHEN p.label BETWEEN 1 AND 4 THEN ' + _COS + ' END)', 5)} AS d_man FROM v q JOIN v p ON p.label < 5 WHERE q.label >= 5 GROUP BY q.id"))
def _(t):
    from ..operators.vectors import nearest_by_group

    v = t.vectors()
    refs = v.where("label < 5").select(F.when(F.col("label") == 0, "pos").otherwise("man").alias("kind"), F.col("v").alias("w"))
    d = nearest_by_group(v.where("label >= 5"), refs, "id", "kind", ["pos", "man"])
    return d.select("id", tidy(F.col("pos"), 5).alias("d_pos"), tidy(F.col("man"), 5).alias("d_man"))


@query("j35_before_after_pair", """WITH m AS (SELECT o_custkey AS project, o_orderdate AS d, o_orderkey AS id, CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'before' ELSE 'after' END AS side FROM orders),
g AS (SELECT project, count(*) AS n, arg_max(id, (d, id)) FILTER (WHERE side = 'before') AS last_before, arg_max(id, (d, id)) FILTER (WHERE side = 'after') AS last_after, arg_min(id, (d, id)) AS earliest, arg_max(id, (d, id)) AS latest FROM m GROUP BY 1)
SELECT project, CASE WHEN last_before IS NULL THEN earliest ELSE last_before END AS before_id, CASE WHEN last_before IS NULL THEN latest ELSE last_after END AS after_id FROM g WHERE n >= 2 AND last_after IS NOT NULL""")
def _(t):
    from ..operators.pairs import before_after

    m = t.raw("orders").select(F.col("o_custkey").alias("project"), F.col("o_orderdate").alias("d"), F.col("o_orderkey").alias("id"), F.when(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp"), "before").otherwise("after").alias("side"))
    return before_after(m, "project", "side", ["d", "id"], "id")


@query("j36_index_join", "SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 300000")
def _(t):
    names = t.raw("customer").select("c_custkey", "c_name")
    return t.raw("orders").where("o_totalprice > 300000").join(names, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "c_name")


@query("j37_left_suffixes", sql("ba", "SELECT b.id, b.lat, a.lat AS lat_a FROM b LEFT JOIN a ON b.id = a.id"))
def _(t):
    other = t.anchors().select("id", F.col("lat").alias("lat_a"))
    return t.buildings().join(other, "id", "left").select("id", "lat", "lat_a")


@query("j38_ordered_enrich", sql("l", """SELECT k.rank, k.id, n.n_years FROM (SELECT row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS rank, c_custkey AS id FROM customer ORDER BY 1 LIMIT 40) k
JOIN (SELECT site, count(DISTINCT year) AS n_years FROM l GROUP BY 1) n ON k.id % 200 = n.site"""))
def _(t):
    w = Window.orderBy(F.desc("c_acctbal"), "c_custkey")
    top = t.raw("customer").orderBy(F.desc("c_acctbal"), "c_custkey").limit(40).select(F.row_number().over(w).cast("long").alias("rank"), F.col("c_custkey").alias("id"))
    years = t.labels().groupBy("site").agg(F.countDistinct("year").alias("n_years"))
    return top.join(years, F.col("id") % 200 == F.col("site")).select("rank", "id", "n_years")
