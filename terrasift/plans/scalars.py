"""Scalar functions and geometry."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import scalar as X
from ..functions.scalar import tidy
from .base import haversine_sql as hav
from .base import query, sql, tidy_sql
from .joins import AW, wide


@query("f01_haversine", sql("ab", f"SELECT a.id, {tidy_sql(hav('a.lat', 'a.lon', 'b.lat', 'b.lon'), 3)} AS m, {tidy_sql(hav('a.lat', 'a.lon', 'b.lat', 'b.lon', 6371.0088), 5)} AS km FROM a JOIN b ON a.id = b.id"))
def _(t):
    b = t.buildings().select("id", F.col("lat").alias("y"), F.col("lon").alias("x"))
    j = t.anchors().join(b, "id")
    d = lambda r: X.haversine(F.col("lat"), F.col("lon"), F.col("y"), F.col("x"), r)
    return j.select("id", tidy(d(X.EARTH_M), 3).alias("m"), tidy(d(X.EARTH_KM), 5).alias("km"))


@query("f02_equirect_111000", sql("b", f"SELECT id, {tidy_sql('(xmax - xmin) * 111000.0e0 * cos(radians((ymin + ymax) / 2))')} AS w_m FROM b"))
def _(t):
    return t.buildings().select("id", tidy((F.col("xmax") - F.col("xmin")) * X.DEG_PLAIN * F.cos(F.radians((F.col("ymin") + F.col("ymax")) / 2))).alias("w_m"))


@query("f03_metres_cos_floor", sql("b", f"SELECT id, {tidy_sql('(ymax - ymin) * 110540.0e0')} AS h_m, {tidy_sql('(xmax - xmin) * 111320.0e0 * greatest(cos(radians(lat + 55)), 0.1e0)')} AS w_m FROM b"))
def _(t):
    return t.buildings().select("id", tidy((F.col("ymax") - F.col("ymin")) * X.DEG_LAT).alias("h_m"), tidy((F.col("xmax") - F.col("xmin")) * X.lon_scale(F.col("lat") + 55)).alias("w_m"))


@query("f04_bbox_area", sql("b", f"SELECT id, {tidy_sql('abs((xmax - xmin) * 111320.0e0 * cos(radians((ymin + ymax) / 2)) * (ymax - ymin) * 111320.0e0)', 3)} AS m2 FROM b"))
def _(t):
    return t.buildings().select("id", tidy(X.bbox_area_m2("xmin", "ymin", "xmax", "ymax"), 3).alias("m2"))


@query("f05_bbox_km2", sql("b", f"SELECT id, {tidy_sql('greatest(0.0e0, (xmax - xmin) * 111.0e0 * cos(radians((ymin + ymax) / 2))) * greatest(0.0e0, (ymax - ymin) * 111.0e0)', 9)} AS km2 FROM b"))
def _(t):
    return t.buildings().select("id", tidy(X.bbox_area_km2("xmin", "ymin", "xmax", "ymax"), 9).alias("km2"))


@query("f06_expand_bbox", sql("b", f"SELECT id, {tidy_sql('xmin - 100.0e0 / (111000.0e0 * cos(radians((ymin + ymax) / 2)))', 9)} AS x0, {tidy_sql('ymax + 100.0e0 / 111000.0e0', 9)} AS y1 FROM b"))
def _(t):
    box = X.expand_bbox("xmin", "ymin", "xmax", "ymax", 100.0)
    return t.buildings().select("id", tidy(box[0], 9).alias("x0"), tidy(box[3], 9).alias("y1"))


_RAW = "CASE id % 4 WHEN 0 THEN '30' WHEN 1 THEN '30.500' WHEN 2 THEN '30.' || id ELSE '30.12345' END"


def raw_text():
    k = F.col("id") % 4
    return F.when(k == 0, "30").when(k == 1, "30.500").when(k == 2, F.concat(F.lit("30."), F.col("id").cast("string"))).otherwise("30.12345")


@query("f07_decimal_places", sql("b", f"SELECT id, CAST(coalesce(len(string_split(raw, '.')[2]), 0) AS INTEGER) AS places, CAST(coalesce(len(rtrim(string_split(raw, '.')[2], '0')), 0) AS INTEGER) AS stripped FROM (SELECT id, {_RAW} AS raw FROM b)"))
def _(t):
    return t.buildings().select("id", raw_text().alias("raw")).select("id", X.decimal_places(F.col("raw")).alias("places"), X.stripped_places(F.col("raw")).alias("stripped"))


@query("f08_precision_label", sql("b", f"SELECT id, CASE WHEN p >= 5 THEN 'parcel' WHEN p >= 3 THEN 'city' ELSE 'approximate' END AS label FROM (SELECT id, coalesce(len(string_split({_RAW}, '.')[2]), 0) AS p FROM b)"))
def _(t):
    p = X.decimal_places(raw_text())
    return t.buildings().select("id", X.precision_label(p, p).alias("label"))


@query("f09_grid_cell", sql("b", "SELECT id, CAST(floor(lat / 0.25e0) AS BIGINT) AS y, CAST(floor(lon / 0.25e0) AS BIGINT) AS x FROM b"))
def _(t):
    return t.buildings().select("id", X.grid_cell(F.col("lat"), 0.25).alias("y"), X.grid_cell(F.col("lon"), 0.25).alias("x"))


@query("f10_utm_epsg", sql("b", "SELECT id, CAST(CASE WHEN lat - 31 >= 0 THEN 32600 ELSE 32700 END + floor((lon + 180) / 6) + 1 AS BIGINT) AS epsg, 32600 + CAST(substr('14RNV', 1, 2) AS BIGINT) AS of_tile FROM b"))
def _(t):
    tile = F.lit("14RNV")
    return t.buildings().select("id", X.utm_epsg(F.col("lat") - 31, F.col("lon")).alias("epsg"), (F.lit(32600) + tile.substr(F.lit(1), F.length(tile) - 3).cast("long")).alias("of_tile"))


@query("f11_mgrs_split", "SELECT n_nationkey, regexp_extract(lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || 'SKA', '^(\\d+)', 1) AS zone, substr(lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || 'SKA', 3, 1) AS band, 'KA' AS square FROM nation")
def _(t):
    tile = F.concat(F.lpad(F.col("n_nationkey").cast("string"), 2, "0"), F.lit("SKA"))
    part = lambda k: F.regexp_extract(tile, "^([0-9]+)([A-Z])([A-Z]{2})$", k)
    return t.raw("nation").select("n_nationkey", part(1).alias("zone"), part(2).alias("band"), part(3).alias("square"))


@query("f14_uri_parse", r"SELECT page_id, regexp_extract(url, '^[a-z]+://([^/]+)/', 1) AS host, regexp_extract(url, '^[a-z]+://[^/]+/(.*)$', 1) AS key, regexp_replace(url, '^https?://', 's3://') AS s3 FROM pages")
def _(t):
    part = lambda p: F.regexp_extract("url", p, 1)
    return t.raw("pages").select("page_id", part("^[a-z]+://([^/]+)/").alias("host"), part("^[a-z]+://[^/]+/(.*)$").alias("key"), F.regexp_replace("url", "^https?://", "s3://").alias("s3"))


_HREF = "'s3://bucket/collection02/level-1/standard/etm/2008/LE07_' || CASE page_id % 3 WHEN 0 THEN 'L1TP' WHEN 1 THEN 'L1GT' ELSE 'L1GS' END || '_' || page_id || '_20080704_02_T1_B8.TIF'"


@query("f15_href_rewrite", "SELECT page_id, replace(replace(replace(replace(h, '/level-1/', '/level-2/'), '_L1TP_', '_L2SP_'), '_L1GT_', '_L2SP_'), '_B8.TIF', '_SR_B4.TIF') AS nir08, "
       f"replace(replace(replace(replace(h, '/level-1/', '/level-2/'), '_L1TP_', '_L2SP_'), '_L1GT_', '_L2SP_'), '_B8.TIF', '_SR_B7.TIF') AS swir22 FROM (SELECT page_id, {_HREF} AS h FROM pages)")
def _(t):
    kind = F.when(F.col("page_id") % 3 == 0, "L1TP").when(F.col("page_id") % 3 == 1, "L1GT").otherwise("L1GS")
    href = F.concat(F.lit("s3://bucket/collection02/level-1/standard/etm/2008/LE07_"), kind, F.lit("_"), F.col("page_id").cast("string"), F.lit("_20080704_02_T1_B8.TIF"))
    return t.raw("pages").select("page_id", X.surface_href(href, "nir08").alias("nir08"), X.surface_href(href, "swir22").alias("swir22"))


_FILE = ("'m_' || lpad(CAST(id % 90000 AS VARCHAR), CASE WHEN id % 3 = 0 THEN 8 ELSE 7 END, '0') || '_nw_' || CASE WHEN id % 5 = 0 THEN '9' ELSE '14' END || '_060_2022' || lpad(CAST(id % 12 + 1 AS VARCHAR), 2, '0') || '15'"
         " || CASE WHEN id % 2 = 0 THEN '_20221210' ELSE '' END || CASE WHEN id % 7 = 0 THEN '.xml' ELSE '.tif' END")
_PATTERN = r"^m_(\d{7,8})_(ne|nw|se|sw)_(\d+)_(\d+)_(\d{8})(?:_(\d{8}))?\.tif$"


def file_name():
    key = F.col("id")
    zone, size = F.when(key % 5 == 0, "9").otherwise("14"), F.when(key % 3 == 0, 8).otherwise(7)
    date = F.concat(F.lit("_060_2022"), F.lpad((key % 12 + 1).cast("string"), 2, "0"), F.lit("15"))
    return F.concat(F.lit("m_"), F.lpad((key % 90000).cast("string"), size, F.lit("0")), F.lit("_nw_"), zone, date, F.when(key % 2 == 0, "_20221210").otherwise(""), F.when(key % 7 == 0, ".xml").otherwise(".tif"))


@query("f16_filename_decode", sql("b", f"""SELECT id, CASE WHEN ok THEN regexp_extract(f, '{_PATTERN}', 1) END AS quad_id, CASE WHEN ok THEN regexp_extract(f, '{_PATTERN}', 2) END AS quadrant, CASE WHEN ok THEN regexp_extract(f, '{_PATTERN}', 3) END AS utm_zone,
CASE WHEN ok THEN regexp_extract(f, '{_PATTERN}', 5) END AS acquired, CASE WHEN ok THEN nullif(regexp_extract(f, '{_PATTERN}', 6), '') END AS processed, CASE WHEN ok THEN f END AS rebuilt FROM (SELECT id, f, regexp_matches(f, '{_PATTERN}') AS ok FROM (SELECT id, {_FILE} AS f FROM b))"""))
def _(t):
    parts = X.tile_parts(F.col("f"))
    f = t.buildings().select("id", file_name().alias("f")).select("id", *[v.alias(k) for k, v in parts.items()])
    return f.select("id", "quad_id", "quadrant", "utm_zone", "acquired", "processed", F.when(F.col("quad_id").isNotNull(), X.tile_name(*map(F.col, ("quad_id", "quadrant", "utm_zone", "res_code", "acquired", "processed")))).alias("rebuilt"))


@query("f17_naming_tokens", sql("b", f"SELECT id, CASE len(string_split({_FILE}, '_')) WHEN 6 THEN 'short' WHEN 7 THEN 'long' ELSE 'unknown' END AS convention FROM b"))
def _(t):
    n = F.size(F.split(file_name(), "_"))
    return t.buildings().select("id", F.when(n == 6, "short").when(n == 7, "long").otherwise("unknown").alias("convention"))


@query("f18_short_ids", sql("b", "SELECT id, 'b_' || substr(md5(name || '|' || id), 1, 10) AS short, substr(sha1(name || '|' || id), 1, 12) AS project FROM b"))
def _(t):
    return t.buildings().select("id", X.short_id("b", F.col("name"), F.col("id").cast("string")).alias("short"), F.substring(F.sha1(F.concat_ws("|", "name", F.col("id").cast("string")).cast("binary")), 1, 12).alias("project"))


@query("f19_map_url", sql("b", "SELECT id, 'https://www.google.com/maps?q=' || printf('%.6f', lat) || ',' || printf('%.6f', lon) AS url FROM b"))
def _(t):
    return t.buildings().select("id", F.format_string("https://www.google.com/maps?q=%.6f,%.6f", "lat", "lon").alias("url"))


@query("f20_date_relation", """SELECT o_orderkey, CASE WHEN d IS NULL THEN 'unknown' WHEN year(o_orderdate) < year(d) THEN 'before' ELSE 'after' END AS relation, year(d) AS announced FROM
(SELECT o_orderkey, o_orderdate, TRY_CAST(CASE WHEN o_orderkey % 5 = 0 THEN 'mid 1998' ELSE '199' || (o_orderkey % 10) || '-06-01' END AS TIMESTAMP) AS d FROM orders)""")
def _(t):
    text = F.when(F.col("o_orderkey") % 5 == 0, "mid 1998").otherwise(F.concat(F.lit("199"), (F.col("o_orderkey") % 10).cast("string"), F.lit("-06-01")))
    o = t.raw("orders").withColumn("d", F.try_to_timestamp(text, F.lit("yyyy-MM-dd")))
    relation = F.when(F.col("d").isNull(), "unknown").when(F.year("o_orderdate") < F.year("d"), "before").otherwise("after")
    return o.select("o_orderkey", relation.alias("relation"), F.year("d").cast("long").alias("announced"))


_SPREAD = "SELECT id, abs(v[1]) * 1.2e0 + 0.02e0 AS blue, abs(v[2]) + 0.05e0 AS green, abs(v[3]) * 2 + 0.02e0 AS red, CASE WHEN id % 17 = 0 THEN NULL WHEN id % 19 = 0 THEN 'NaN'::DOUBLE ELSE abs(v[4]) * 2 + 0.02e0 END AS nir FROM v"


def spread(t):
    """Band means from vectors, some missing."""
    at = lambda k, times, plus: F.abs(F.get("v", F.lit(k))) * times + plus
    nir = F.when(F.col("id") % 17 == 0, None).when(F.col("id") % 19 == 0, float("nan")).otherwise(at(3, 2, 0.02))
    return t.vectors().select("id", at(0, 1.2, 0.02).alias("blue"), at(1, 1, 0.05).alias("green"), at(2, 2, 0.02).alias("red"), nir.alias("nir"))


_BANDS = "SELECT id, v[1] + 0.2e0 AS blue, v[2] + 0.2e0 AS green, v[3] + 0.2e0 AS red, v[4] + 0.3e0 AS nir, v[5] + 0.2e0 AS swir FROM v"


def bands(t):
    at = lambda k, plus: F.get("v", F.lit(k)) + plus
    return t.vectors().select("id", at(0, 0.2).alias("blue"), at(1, 0.2).alias("green"), at(2, 0.2).alias("red"), at(3, 0.3).alias("nir"), at(4, 0.2).alias("swir"))


_NDVI = "(nir - red) / nullif(nir + red, 0)"
_NDWI = "(green - nir) / nullif(green + nir, 0)"
_NDBI = "(swir - nir) / nullif(swir + nir, 0)"


_YELLOW = "CASE WHEN blue > 0 THEN red / blue ELSE 99 END"


@query("f22_cover_cascade", sql("v", f"""SELECT id, CASE tier WHEN 0 THEN 'missing' WHEN 1 THEN 'water' WHEN 2 THEN 'vegetation' WHEN 3 THEN CASE WHEN red > 0.35e0 AND blue > 0.25e0 THEN 'metal_roof' ELSE 'concrete' END WHEN 4 THEN 'asphalt'
WHEN 5 THEN 'rust_brick' WHEN 6 THEN 'sand' WHEN 7 THEN 'sparse_veg' WHEN 8 THEN 'bare_soil' ELSE 'ambiguous' END AS cover, tier, tier IN (1, 3, 4, 5) AS dropped FROM (SELECT *, CASE
WHEN blue IS NULL OR green IS NULL OR red IS NULL OR nir IS NULL OR isnan(blue + green + red + nir) THEN 0
WHEN nir < 0.05e0 AND blue > red THEN 1
WHEN nir > 2.0e0 * red THEN 2
WHEN red > 0.2e0 AND {_YELLOW} < 1.2e0 AND nir <= 1.1e0 * red THEN 3
WHEN red < 0.12e0 AND green < 0.12e0 AND blue < 0.12e0 AND nir < 0.15e0 THEN 4
WHEN {_YELLOW} > 1.4e0 AND red > 0.18e0 AND nir <= 1.05e0 * red THEN 5
WHEN {_YELLOW} > 1.2e0 AND nir > 1.05e0 * red THEN 6
WHEN nir > 1.2e0 * red THEN 7
WHEN red > 0.1e0 AND red < 0.3e0 AND {_YELLOW} > 1.1e0 AND nir > 0.9e0 * red THEN 8 ELSE 9 END AS tier FROM ({_SPREAD}))"""))
def _(t):
    from ..operators.cover import COVER_DROPPED, cover_tier

    c = spread(t).select("id", cover_tier().alias("c"))
    return c.select("id", "c.cover", "c.tier", F.col("c.cover").isin(*COVER_DROPPED).alias("dropped"))


_SNDVI, _SBRIGHT, _SRATIO = "(nir - red) / (nir + red)", "(blue + green + red) / 3", "nir / red"


@query("f23_colour_rule", sql("v", f"""SELECT id, CASE WHEN nir IS NULL OR isnan(nir) THEN 'missing' WHEN {_SNDVI} > 0.30e0 THEN 'natural' WHEN {_SNDVI} > 0.10e0 THEN 'natural' WHEN {_SRATIO} > 1.1e0 THEN 'natural'
WHEN {_SBRIGHT} > 0.30e0 THEN 'built' WHEN {_SBRIGHT} < 0.15e0 THEN 'built' ELSE 'ambiguous' END AS colour FROM ({_SPREAD})"""))
def _(t):
    from ..operators.cover import colour_class

    nir, red = F.col("nir"), F.col("red")
    return spread(t).select("id", colour_class((nir - red) / (nir + red), (F.col("blue") + F.col("green") + red) / 3, nir / red).alias("colour"))


@query("f24_ndvi", sql("v", f"SELECT id, {tidy_sql(_NDVI)} AS plain, {tidy_sql('(nir - red) / (nir + red + 1e-9)')} AS guarded FROM ({_BANDS})"))
def _(t):
    nir, red = F.col("nir"), F.col("red")
    return bands(t).select("id", tidy(X.ndvi(nir, red)).alias("plain"), tidy(X.ndvi(nir, red, 1e-9)).alias("guarded"))


@query("f25_reflectance", f"SELECT p_partkey, CASE WHEN dn <> 0 AND dn * 2.75e-5 - 0.2e0 BETWEEN 0 AND 1 THEN {tidy_sql('dn * 2.75e-5 - 0.2e0', 9)} END AS r FROM (SELECT p_partkey, CAST(p_partkey * 31 % 50000 AS DOUBLE) AS dn FROM part)")
def _(t):
    return t.raw("part").select("p_partkey", tidy(X.reflectance((F.col("p_partkey") * 31 % 50000).cast("double")), 9).alias("r"))


@query("f26_chip_quality", sql("v", """SELECT id, CASE WHEN id % 23 = 0 THEN 'missing' WHEN dark > 0.3e0 THEN 'empty' WHEN sd < 8.0e0 THEN 'cloudy' ELSE 'ok' END AS quality FROM (SELECT id,
len(list_filter(range(1, 65), lambda i: r[i] + g[i] + b[i] < 10)) / 64.0e0 AS dark, floor(list_stddev_pop(list_concat(list_concat(r, g), b)) * 1e6 + 0.5) / 1e6 AS sd FROM (SELECT id,
list_transform(v, lambda x: greatest(0.0e0, x * (id % 5) * 100 + 20)) AS r, list_transform(v, lambda x: greatest(0.0e0, x * (id % 5) * 90 + 10)) AS g, list_transform(v, lambda x: greatest(0.0e0, x * (id % 5) * 80)) AS b FROM v))"""))
def _(t):
    from ..operators.cover import chip_quality

    band = lambda times, plus: F.transform("v", lambda x: F.greatest(F.lit(0.0), x * (F.col("id") % 5) * times + plus))
    return t.vectors().select("id", chip_quality(F.when(F.col("id") % 23 != 0, band(100, 20)), band(90, 10), band(80, 0)).alias("quality"))


_CLASSES = ("warehouse", "retail", "house", "barn", "school", "stadium", "mosque", "shed", "large")


@query("f27_group_mapping", sql("b", f"""SELECT id, CASE WHEN c = 'warehouse' THEN 'industrial' WHEN c = 'retail' THEN 'retail' WHEN c = 'house' THEN 'residential' WHEN c = 'barn' THEN 'agricultural' WHEN c = 'school' THEN 'education'
WHEN c = 'stadium' THEN 'institutional' WHEN c = 'mosque' THEN 'religious' ELSE 'other' END AS grp FROM (SELECT id, CASE WHEN id % 10 < 9 THEN ({list(_CLASSES)!r})[id % 10 + 1] END AS c FROM b)"""))
def _(t):
    from ..operators.cover import CLASS_GROUPS, group_of

    kind = F.get(F.array(*map(F.lit, _CLASSES)), (F.col("id") % 10).cast("int"))
    return t.buildings().select("id", kind.alias("c")).select("id", group_of("c", CLASS_GROUPS).alias("grp"))


@query("f28_code_names", "SELECT n_nationkey, r_name AS name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey AND r_regionkey < 4")
def _(t):
    dim = t.raw("region").where("r_regionkey < 4").select("r_regionkey", F.col("r_name").alias("name"))
    return t.raw("nation").join(F.broadcast(dim), F.col("n_regionkey") == F.col("r_regionkey"), "left").select("n_nationkey", "name")


@query("f29_log_score", sql("t", f"SELECT shard, {tidy_sql('max(prob) * ln(1 + count(*))')} AS score FROM t WHERE prob IS NOT NULL AND NOT isnan(prob) GROUP BY shard"))
def _(t):
    return t.tiles().where("prob is not null and not isnan(prob)").groupBy("shard").agg(tidy(F.max("prob") * F.log1p(F.count(F.lit(1)))).alias("score"))


@query("f30_sigmoid_softmax", sql("v", f"SELECT id, {tidy_sql('1.0e0 / (1.0e0 + exp(-v[1]))')} AS s, {tidy_sql('exp(v[2] - greatest(v[1], v[2])) / (exp(v[1] - greatest(v[1], v[2])) + exp(v[2] - greatest(v[1], v[2])))')} AS p FROM v"))
def _(t):
    from ..operators.vectors import softmax

    a, b = F.get("v", F.lit(0)), F.get("v", F.lit(1))
    return t.vectors().select("id", tidy(X.sigmoid(a)).alias("s"), tidy(softmax([a, b])[1]).alias("p"))


@query("f31_clip_default", sql("h", "SELECT id, least(greatest(coalesce(change, 0), 0.02e0), 0.1e0) AS c FROM h"))
def _(t):
    return t.changes().select("id", X.clip(F.coalesce("change", F.lit(0.0)), 0.02, 0.1).alias("c"))


@query("f32_truncate_or_null", "SELECT doc_id, nullif(substr(CASE WHEN doc_id % 6 = 0 THEN '' ELSE text END, 1, 120), '') AS note FROM documents")
def _(t):
    return t.raw("documents").select("doc_id", F.nullif(F.substring(F.when(F.col("doc_id") % 6 == 0, "").otherwise(F.col("text")), 1, 120), F.lit("")).alias("note"))


@query("f33_status_mapping", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'RUNNING' ELSE 'UNKNOWN' END AS status FROM orders")
def _(t):
    s = F.col("o_orderstatus")
    return t.raw("orders").select("o_orderkey", F.when(s == "F", "COMPLETED").when(s == "O", "RUNNING").otherwise("UNKNOWN").alias("status"))


def rings():
    p = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    mid = (F.col("xmin") + F.col("xmax")) / 2
    return F.array(p(F.col("xmin"), F.col("ymin")), p(F.col("xmax"), F.col("ymin")), p(mid, F.col("ymax")))


@query("g01_polygon_measures", sql("b", f"SELECT id, {tidy_sql('(xmax - xmin) * (ymax - ymin) / 2 * 1e8', 3)} AS area, {tidy_sql('(xmin + xmax + (xmin + xmax) / 2) / 3', 5)} AS cx, {tidy_sql('(ymin + ymin + ymax) / 3', 5)} AS cy, xmin AS x0, ymax AS y1 FROM b"))
def _(t):
    b = t.buildings().withColumn("ring", rings())
    r = F.col("ring")
    # moved to the origin, or the products lose the digits that differ
    near = F.transform(r, lambda p: F.struct((p["x"] - F.col("xmin")).alias("x"), (p["y"] - F.col("ymin")).alias("y")))
    return b.select("id", tidy(G.ring_area(near) * 1e8, 3).alias("area"), tidy(G.ring_centroid(near, "x") + F.col("xmin"), 5).alias("cx"), tidy(G.ring_centroid(near, "y") + F.col("ymin"), 5).alias("cy"), G.ring_bound(r, "x", True).alias("x0"), G.ring_bound(r, "y", False).alias("y1"))


@query("g04_bbox_mask", sql("v", "SELECT id, CAST(list_sum(list_transform(range(0, 64), lambda i: CASE WHEN i // 8 >= 2 AND i // 8 < 6 AND i % 8 >= 1 AND i % 8 < 5 THEN 1 ELSE 0 END)) AS BIGINT) AS pixels FROM v"))
def _(t):
    from ..operators.rasters import box_mask

    return t.vectors().select("id", F.size(F.filter(box_mask(8, 8, (0.125, 0.25, 0.625, 0.75), (0.0, 0.0, 1.0, 1.0)), lambda x: x)).cast("long").alias("pixels"))


@query("g06_affine", sql("b", "SELECT id, CAST(floor((lon + 100) * 1000) AS BIGINT) AS col, CAST(floor((32 - lat) * 1000) AS BIGINT) AS row FROM b"))
def _(t):
    return t.buildings().select("id", F.floor((F.col("lon") + 100) * 1000).cast("long").alias("col"), F.floor((32 - F.col("lat")) * 1000).cast("long").alias("row"))


@query("g07_overlap_ratio", sql("ab", f"SELECT w.id AS a, b.id AS b, {tidy_sql('greatest(0.0e0, least(w.xmax, b.xmax) - greatest(w.xmin, b.xmin)) * greatest(0.0e0, least(w.ymax, b.ymax) - greatest(w.ymin, b.ymin)) / ((b.xmax - b.xmin) * (b.ymax - b.ymin))')} AS ratio FROM w JOIN b ON w.xmin <= b.xmax AND b.xmin <= w.xmax AND w.ymin <= b.ymax AND b.ymin <= w.ymax", AW))
def _(t):
    from ..operators.spatial import box_join
    from .joins import boxes

    pairs = box_join(wide(t.anchors(), 0.01), boxes(t.buildings()), 0.03)
    return pairs.select(F.col("id").alias("a"), F.col("rid").alias("b"), tidy(G.box_overlap()).alias("ratio"))


@query("g11_geojson_crs", "SELECT n_nationkey, CASE WHEN n_nationkey % 3 <> 0 THEN 'EPSG:' || (32600 + n_nationkey) END AS crs FROM nation")
def _(t):
    key = F.col("n_nationkey").cast("string")
    doc = F.when(F.col("n_nationkey") % 3 != 0, F.concat(F.lit('{"crs":{"properties":{"name":"EPSG:'), (F.col("n_nationkey") + 32600).cast("string"), F.lit('"}}}'))).otherwise(F.concat(F.lit('{"crs":null,"n":'), key, F.lit("}")))
    return t.raw("nation").select("n_nationkey", F.get_json_object(doc, "$.crs.properties.name").alias("crs"))


@query("g12_outline_validation", "SELECT p_partkey, (p_size % 4 >= 3 AND p_size <= 40) AS ok FROM part")
def _(t):
    n = (F.col("p_size") % 4).cast("int")
    text = F.concat(F.lit("["), F.array_join(F.array_repeat(F.concat(F.lit("["), (F.col("p_size") / 40.0).cast("string"), F.lit(",0.5]")), n), ","), F.lit("]"))
    points = F.coalesce(F.from_json(text, "array<array<double>>"), F.array().cast("array<array<double>>"))
    return t.raw("part").select("p_partkey", G.valid_outline(points).alias("ok"))


@query("s08_bad_json", "SELECT p_partkey, CAST(CASE WHEN p_size % 5 = 0 THEN 0 ELSE 2 END AS INTEGER) AS n FROM part")
def _(t):
    text = F.when(F.col("p_size") % 5 == 0, "[[0,1").otherwise("[[0.1,0.2],[0.3,0.4]]")
    return t.raw("part").select("p_partkey", F.size(F.coalesce(F.from_json(text, "array<array<double>>"), F.array().cast("array<array<double>>"))).alias("n"))
