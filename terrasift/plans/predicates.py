"""Scans, projections, filters and predicates."""

from __future__ import annotations

import json
import time
import uuid

import pandas as pd
from pyspark.sql import functions as F

from ..functions.scalar import change_status, tidy
from ..operators import predicates as P
from ..operators.incremental import per_chunk
from ..operators.spatial import in_region
from ..sources import readers, scratch, sinks
from .base import query, sql, tidy_sql

KINDS, DROP = ["large", "economy"], ["promo", "medium"]


@query("s01_scan", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def _(t):
    return t.raw("nation").select("n_nationkey", "n_name", "n_regionkey")


@query("s02_pruned_scan", "SELECT p_partkey, p_size FROM part")
def _(t):
    return t.raw("part").select("p_partkey", "p_size")


@query("s03_pushed_bbox", sql("", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 1000 AND 200000 AND o_orderkey BETWEEN 100 AND 9000"))
def _(t):
    return t.raw("orders").where(F.col("o_totalprice").between(1000, 200000) & F.col("o_orderkey").between(100, 9000)).select("o_orderkey", "o_totalprice")


def folder(t, name: str) -> str:
    return f"{scratch.folder(t.spark)}/terrasift/{name}-{uuid.uuid4().hex}"


@query("s04_multi_file_scan", "SELECT s_nationkey AS state, count(*) AS n, min(s_suppkey) AS least FROM supplier WHERE s_suppkey % 4 < 3 GROUP BY 1")
def _(t):
    """Three of four files of a folder, by a pattern, with one SQL statement."""
    path = folder(t, "multi")
    sinks.chunked(t.raw("supplier").select("s_suppkey", "s_nationkey", (F.col("s_suppkey") % 4).alias("part")), path, "part")
    return t.spark.sql(f"SELECT s_nationkey AS state, count(*) AS n, min(s_suppkey) AS least FROM parquet.`{path}/part=[0-2]` GROUP BY s_nationkey")


@query("s05_scan_with_file_stem", "SELECT CASE s_suppkey % 3 WHEN 0 THEN '14RNV' ELSE '15RTP' END AS mgrs_tile, s_suppkey FROM supplier WHERE s_suppkey % 3 < 2")
def _(t):
    """Chunks of a folder, without the embeddings beside them."""
    path = folder(t, "chunks")
    for k, name in enumerate(("14RNV", "15RTP", "15RTP_emb")):
        sinks.one_file(t.raw("supplier").where(F.col("s_suppkey") % 3 == k).select("s_suppkey"), f"{path}/{name}.parquet")
    return readers.chunks(t.spark, f"{path}/*.parquet").select("mgrs_tile", "s_suppkey")


@query("s07_json_document", "SELECT n_nationkey AS id, n_name AS name, n_regionkey % 2 = 0 AS kept FROM nation")
def _(t):
    path = folder(t, "queue") + ".json"
    item = F.to_json(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), (F.col("n_regionkey") % 2 == 0).alias("kept")))
    rows = t.raw("nation").select(item.alias("j")).collect()  # 25 rows
    sinks.put(t.spark, path, "[\n" + ",\n".join(r.j for r in rows) + "\n]")
    return readers.json_document(t.spark, path, "id long, name string, kept boolean").select("id", "name", "kept")


@query("s09_region_union", sql("b", "SELECT id FROM b WHERE (lat > 30.1e0 AND lat < 30.9e0 AND lon > -99.9e0 AND lon < -99.1e0 AND NOT (lat > 30.4e0 AND lat < 30.6e0 AND lon > -99.6e0 AND lon < -99.4e0)) OR (lat > 30.5e0 AND lat < 31.5e0 AND lon > -99.3e0 AND lon < -98.3e0) OR (lat > 31.6e0 AND lat < 31.8e0 AND lon > -98.6e0 AND lon < -98.2e0)"))
def _(t):
    """The union of a polygon with a hole and a multipolygon that overlaps it; a third feature is left out by name."""
    box = lambda x0, y0, x1, y1: [[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]
    shapes = [("A", "Polygon", [box(-99.9, 30.1, -99.1, 30.9), box(-99.6, 30.4, -99.4, 30.6)]), ("B", "MultiPolygon", [[box(-99.3, 30.5, -98.3, 31.5)], [box(-98.6, 31.6, -98.2, 31.8)]]), ("Alaska", "Polygon", [box(-100.0, 30.0, -98.0, 32.0)])]
    path = folder(t, "states") + ".geojson"
    sinks.put(t.spark, path, json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"name": n}, "geometry": {"type": k, "coordinates": c}} for n, k, c in shapes]}))
    return in_region(t.buildings().select("id", "lat", "lon"), readers.region(t.spark, path, ["Alaska", "Hawaii"])).select("id")


@query("s10_road_files", "SELECT CASE n_nationkey % 3 WHEN 0 THEN 'motorway' ELSE 'primary' END AS fclass, n_nationkey + 0.0e0 AS xa, j + 0.0e0 AS ya, n_nationkey + 1.0e0 AS xb, j + 0.5e0 AS yb FROM nation, (SELECT unnest([0, 1]) AS j) WHERE n_nationkey % 3 < 2")
def _(t):
    def read(uri):
        k = int(uri.rsplit("-", 1)[1])
        return [(("motorway", "primary", "track")[k % 3], float(k), float(j), k + 1.0, j + 0.5) for j in range(2)]

    files = t.raw("nation").select(F.concat(F.lit("zip://roads-"), F.col("n_nationkey").cast("string")).alias("uri"))
    return readers.lines(files, read, ["motorway", "primary"])


@query("s13_scene_search", "SELECT key, scene, cloud, error FROM (SELECT key, CAST(scene AS VARCHAR) AS scene, cloud, CAST(NULL AS VARCHAR) AS error, row_number() OVER (PARTITION BY key ORDER BY coalesce(cloud, 100), j) AS r FROM (SELECT s_suppkey AS key, j, s_suppkey * 10 + j AS scene, CASE WHEN (s_suppkey + j) % 9 <> 0 THEN CAST((s_suppkey * 7 + j * 13) % 100 AS DOUBLE) END AS cloud FROM supplier, (SELECT unnest(range(0, 5)) AS j)) WHERE key % 11 <> 0 AND key % 13 <> 0) WHERE r <= 2 UNION ALL SELECT s_suppkey, NULL, NULL, 'OSError: busy' FROM supplier WHERE s_suppkey % 11 = 0 AND s_suppkey % 13 <> 0")
def _(t):
    """Two clearest scenes of each key; some keys have none, some searches fail to the end."""

    def search(key):
        if key % 13 == 0:
            return []
        if key % 11 == 0:
            raise OSError("busy")
        return [(str(key * 10 + j), None if (key + j) % 9 == 0 else float((key * 7 + j * 13) % 100)) for j in range(5)]

    return readers.searched(t.raw("supplier").select(F.col("s_suppkey").alias("key")), search, 2, attempts=2, first_wait=0.0)


@query("s14_discovery", """SELECT state, year, res FROM (SELECT state, year, res, row_number() OVER (PARTITION BY state ORDER BY year DESC, CASE res WHEN '60cm' THEN 1 WHEN '100cm' THEN 2 ELSE 3 END, res) AS r FROM (
SELECT state, year, res FROM (SELECT 's' || s_nationkey AS state, 2015 + s_suppkey % 8 AS year, (['60cm', '100cm', '30cm'])[s_suppkey % 3 + 1] AS res, s_suppkey % 5 AS kind FROM supplier) GROUP BY 1, 2, 3 HAVING bool_or(kind IN (0, 1, 2)) AND bool_or(kind IN (0, 3)))) WHERE r = 1""")
def _(t):
    """A listing of images and index files of states, years and resolutions; some have only one of both."""
    s = t.raw("supplier")
    top = F.concat_ws("/", F.concat(F.lit("s"), F.col("s_nationkey")), F.lit(2015) + F.col("s_suppkey") % 8, F.get(F.array(*map(F.lit, ("60cm", "100cm", "30cm"))), (F.col("s_suppkey") % 3).cast("int")))
    kind = F.col("s_suppkey") % 5
    keys = F.when(kind == 0, F.array(F.lit("rgbir_cog/a.tif"), F.lit("index/b.shp"))).when(kind < 3, F.array(F.lit("rgbir_cog/c.tif"))).when(kind == 3, F.array(F.lit("index/d.shp"))).otherwise(F.array(F.lit("index/e.dbf")))
    listing = s.select(top.alias("top"), F.explode(keys).alias("k")).select(F.concat_ws("/", "top", "k").alias("key"))
    return readers.discovered(listing, ["60cm", "100cm"]).select("state", F.col("year").alias("year"), "res")


@query("s15_sampled", sql("ba", "SELECT b.id, r.value FROM b LEFT JOIN r ON CAST(floor(b.lat / 0.05e0) AS BIGINT) = r.y AND CAST(floor(b.lon / 0.05e0) AS BIGINT) = r.x", "r AS (SELECT CAST(floor(lat / 0.05e0) AS BIGINT) AS y, CAST(floor(lon / 0.05e0) AS BIGINT) AS x, min(state) AS value FROM a GROUP BY 1, 2)"))
def _(t):
    a = t.anchors()
    raster = a.groupBy(F.floor(F.col("lat") / 0.05).cast("long").alias("y"), F.floor(F.col("lon") / 0.05).cast("long").alias("x")).agg(F.min("state").alias("value"))
    return readers.sampled(t.buildings().select("id", "lat", "lon"), raster, 0.05).select("id", "value")


@query("s16_missing_file", "SELECT n_nationkey, n_name FROM nation")
def _(t):
    none = readers.or_empty(t.spark, folder(t, "nowhere"), "n_nationkey long, n_name string")
    return t.raw("nation").select("n_nationkey", "n_name").unionByName(none)


@query("s17_blobs", "SELECT 'blob-' || n_nationkey AS name, '{\"id\":' || n_nationkey || '}' AS text FROM nation WHERE n_nationkey < 5")
def _(t):
    path = folder(t, "blobs")
    for k in range(5):
        sinks.put(t.spark, f"{path}/blob-{k}.json", "old")
        sinks.put(t.spark, f"{path}/blob-{k}.json", f'{{"id":{k}}}')
    return readers.blobs(t.spark, f"{path}/*.json").select(F.regexp_extract("uri", r"([^/]+)\.json", 1).alias("name"), "text")


@query("k01_overwrite", "SELECT s_suppkey, s_acctbal FROM supplier WHERE s_suppkey % 2 = 0")
def _(t):
    path, s = folder(t, "table"), t.raw("supplier").select("s_suppkey", "s_acctbal")
    sinks.parquet(s, path)
    sinks.parquet(s.where("s_suppkey % 2 = 0"), path)
    return t.spark.read.parquet(path)


@query("k02_copy_sql", "SELECT o_orderkey, o_totalprice / 2 AS half FROM orders WHERE o_orderstatus = 'F'")
def _(t):
    path = folder(t, "copy")
    sinks.copied(t.spark, f"SELECT o_orderkey, o_totalprice / 2 AS half FROM parquet.`{t.sf_dir}/orders.parquet` WHERE o_orderstatus = 'F'", path)
    return t.spark.read.parquet(path)


@query("k03_replaced", "SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 1")
def _(t):
    path, n = folder(t, "replaced"), t.raw("nation")
    sinks.replaced(n.select("n_nationkey", "n_name"), path)
    sinks.replaced(n.where("n_regionkey = 1").select("n_nationkey", "n_name"), path)
    return t.spark.read.parquet(path)


@query("k06_csv_sink", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name FROM customer WHERE c_acctbal > 5000")
def _(t):
    path = folder(t, "csv")
    sinks.csv(t.raw("customer").where("c_acctbal > 5000"), path, ["c_custkey", "c_name"], [F.desc("c_acctbal"), "c_custkey"])
    return t.spark.read.csv(path, header=True)


@query("k07_leaderboard", "SELECT c_nationkey, c_custkey, c_acctbal FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS r FROM customer) WHERE r = 1")
def _(t):
    path = folder(t, "board")
    sinks.leaderboard(t.raw("customer"), path, "c_nationkey", [F.desc("c_acctbal"), F.col("c_custkey")], ["c_custkey", "c_acctbal"])
    return t.spark.read.json(path, schema="c_nationkey long, c_custkey long, c_acctbal double")


@query("k11_keyed_blobs", "SELECT n_regionkey AS region, count(*) AS n, n_regionkey < 5 AS there FROM nation GROUP BY n_regionkey UNION ALL SELECT 9, 0, false")
def _(t):
    path = folder(t, "keyed")
    sinks.keyed(t.raw("nation").select("n_nationkey", F.col("n_regionkey").alias("region")), path, "region")
    there = t.spark.createDataFrame([(k, sinks.has_key(t.spark, path, "region", k)) for k in (0, 1, 2, 3, 4, 9)], "region long, there boolean")
    n = t.spark.read.schema("n_nationkey long, region long").parquet(path).groupBy("region").agg(F.count(F.lit(1)).alias("n"))
    return there.join(n, "region", "left").select("region", F.coalesce("n", F.lit(0)).alias("n"), "there")


@query("i08_error_rows", "SELECT s_suppkey AS id, CASE WHEN s_suppkey % 7 <> 0 AND s_suppkey % 29 <> 0 THEN [s_suppkey + 0.0e0] END AS pixels, CASE WHEN s_suppkey % 29 = 0 THEN 'TimeoutError: no answer in 0.2 s' WHEN s_suppkey % 7 = 0 THEN 'ValueError: no such window' END AS error FROM supplier")
def _(t):
    """Reads that fail or take too long are rows with an error."""

    def read(uri, box):
        if int(box[0]) % 29 == 0:
            time.sleep(0.6)
        if int(box[0]) % 7 == 0:
            raise ValueError("no such window")
        return [box[0]]

    k = F.col("s_suppkey")
    boxes = t.raw("supplier").select(k.alias("id"), F.concat(F.lit("u"), k % 4).alias("uri"), *[k.cast("double").alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])
    return readers.windows(boxes, read, timeout=0.2).select("id", "pixels", "error")


@query("i12_chunk_function", "SELECT n_regionkey AS chunk, CASE WHEN n_regionkey <> 3 THEN count(*) END AS n, CASE WHEN n_regionkey <> 3 THEN min(n_name) END AS first, CASE WHEN n_regionkey = 3 THEN 'RuntimeError: bad chunk' END AS error FROM nation GROUP BY n_regionkey")
def _(t):
    def work(part):
        if (part["chunk"] == 3).any():
            raise RuntimeError("bad chunk")
        return pd.DataFrame({"n": [len(part)], "first": [part["n_name"].min()]})

    return per_chunk(t.raw("nation").select(F.col("n_regionkey").alias("chunk"), "n_name"), "chunk", work, "chunk long, n long, first string, error string")


@query("s08_json_column", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def _(t):
    parsed = F.from_json("props", "k long")
    return t.raw("events").select("event_id", parsed["k"].alias("k"))


@query("s11_vector_matrix", sql("v", f"SELECT id, CAST(len(v) AS BIGINT) AS n, {tidy_sql('list_sum(v)')} AS total FROM v"))
def _(t):
    from ..functions.arrays import total

    return t.vectors().select("id", F.size("v").cast("long").alias("n"), tidy(total(F.col("v"))).alias("total"))


@query("s14_first_viable", sql("s", "SELECT key, year, scene FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY year DESC, coalesce(cloud, 100), scene) AS r FROM s WHERE scene % 3 <> 0) WHERE r = 1"))
def _(t):
    from ..operators.ranking import best

    return best(t.scenes().where("scene % 3 != 0"), ["key"], [F.desc("year"), F.coalesce("cloud", F.lit(100.0)), F.col("scene")]).select("key", "year", "scene")


@query("k05_empty_marker", sql("t", "SELECT shard, CASE WHEN count_if(prob >= 0.999 AND NOT isnan(prob)) = 0 THEN 'empty' ELSE 'done' END AS status FROM t GROUP BY shard"))
def _(t):
    from ..operators.incremental import chunk_status

    return chunk_status(t.tiles(), "shard", P.at_least("prob", 0.999))


@query("p01_conjunction", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
def _(t):
    return t.raw("orders").where("o_orderstatus = 'F' and o_totalprice > 100000").select("o_orderkey")


@query("p02_in_set", sql("b", "SELECT id FROM b WHERE class IN ('large', 'economy')"))
def _(t):
    return t.buildings().where(F.col("class").isin(KINDS)).select("id")


@query("p03_not_in_keeping_nulls", sql("b", "SELECT id, class FROM b WHERE class IS NULL OR class NOT IN ('large', 'economy')"))
def _(t):
    return t.buildings().where(P.not_in("class", KINDS)).select("id", "class")


@query("p04_set_or_equal", sql("b", "SELECT id FROM b WHERE coalesce(class IN ('large', 'economy'), false) OR coalesce(subtype = 'industrial', false)"))
def _(t):
    return t.buildings().where(P.industrial("class", "subtype", KINDS)).select("id")


@query("p05_three_way_or", sql("b", "SELECT id, area FROM b WHERE coalesce(class IN ('large', 'economy'), false) OR coalesce(subtype = 'industrial', false) OR (class IS NULL AND area >= 3000)"))
def _(t):
    return t.buildings().where(P.industrial("class", "subtype", KINDS) | (F.col("class").isNull() & (F.col("area") >= 3000))).select("id", "area")


@query("p06_score_threshold", sql("t", "SELECT id, prob FROM t WHERE prob IS NOT NULL AND NOT isnan(prob) AND prob >= 0.3"))
def _(t):
    return t.tiles().where(P.at_least("prob", 0.3)).select("id", "prob")


@query("p07_half_open_band", sql("t", "SELECT id FROM t WHERE prob IS NOT NULL AND NOT isnan(prob) AND prob >= 0.5 AND prob < 0.7"))
def _(t):
    return t.tiles().where(P.in_band("prob", 0.5, 0.7)).select("id")


@query("p08_constant_bbox", sql("b", "SELECT id FROM b WHERE xmin >= -99.5e0 AND xmax <= -98.5e0 AND ymin >= 30.25e0 AND ymax <= 31.5e0"))
def _(t):
    return t.buildings().where(P.inside_box(-99.5, 30.25, -98.5, 31.5)).select("id")


@query("p09_array_contains", sql("b", "SELECT id FROM b WHERE coalesce(list_contains(sources, 'OpenStreetMap'), false)"))
def _(t):
    return t.buildings().where(P.has_source("sources", "OpenStreetMap")).select("id")


@query("p10_prefix", "SELECT c_custkey FROM customer WHERE starts_with(c_name, 'Customer#00000001')")
def _(t):
    return t.raw("customer").where(F.col("c_name").startswith("Customer#00000001")).select("c_custkey")


@query("p11_prune", sql("b", "SELECT id FROM b WHERE NOT (lower(coalesce(class, '')) IN ('promo', 'medium') OR lower(coalesce(subtype, '')) IN ('promo', 'medium') OR coalesce(area, 0) < 1500)"))
def _(t):
    return t.buildings().where(P.worth_keeping("class", "subtype", "area", DROP, 1500.0)).select("id")


@query("p12_exclusion_mask", "SELECT p_partkey, coalesce(p_size > 15, false) AS steep, coalesce(nullif(p_partkey % 13, 5) = 12, false) AS water, coalesce(p_retailprice > 1000, false) AS remote, (coalesce(p_size > 15, false) OR coalesce(nullif(p_partkey % 13, 5) = 12, false) OR coalesce(p_retailprice > 1000, false)) AS excluded FROM part")
def _(t):
    cover = F.nullif(F.col("p_partkey") % 13, F.lit(5))
    return P.flags(t.raw("part"), {"steep": F.col("p_size") > 15, "water": cover == 12, "remote": F.col("p_retailprice") > 1000}, "excluded").select("p_partkey", "steep", "water", "remote", "excluded")


@query("p13_keep_or_drop", sql("b", "SELECT id, CASE WHEN coalesce(class IN ('promo', 'medium'), false) THEN 'drop' ELSE 'keep' END AS decision FROM b"))
def _(t):
    return t.buildings().select("id", F.when(F.col("class").isin(DROP), "drop").otherwise("keep").alias("decision"))


@query("p14_drop_nulls", sql("b", "SELECT id FROM b WHERE class IS NOT NULL AND subtype IS NOT NULL"))
def _(t):
    return t.buildings().na.drop(subset=["class", "subtype"]).select("id")


@query("p15_coercing_cast", "SELECT doc_id, TRY_CAST(source[4:] AS DOUBLE) AS n FROM documents WHERE TRY_CAST(source[4:] AS DOUBLE) IS NOT NULL")
def _(t):
    return t.raw("documents").select("doc_id", F.col("source").substr(F.lit(4), F.lit(99)).try_cast("double").alias("n")).na.drop(subset=["n"])


@query("p16_literal_columns", sql("b", "SELECT id, CAST(0 AS INTEGER) AS class_id, 'scan' AS source, 1.0e0 AS weight, 'scan' AS split FROM b WHERE area >= 5000"))
def _(t):
    return P.as_manifest(t.buildings().where("area >= 5000"), class_id=0, source="scan", weight=1.0, split="scan").select("id", "class_id", "source", "weight", "split")


@query("p17_computed_columns", sql("b", f"SELECT id, {tidy_sql('(xmin + xmax) / 2')} AS mid, {tidy_sql('(xmax - xmin) * 111000.0e0 * cos(radians(lat))')} AS w_m, {tidy_sql('(ymax - ymin) * 111000.0e0')} AS h_m FROM b"))
def _(t):
    wide = (F.col("xmax") - F.col("xmin")) * 111000.0 * F.cos(F.radians("lat"))
    return t.buildings().select("id", tidy((F.col("xmin") + F.col("xmax")) / 2).alias("mid"), tidy(wide).alias("w_m"), tidy((F.col("ymax") - F.col("ymin")) * 111000.0).alias("h_m"))


_NOTE = "CASE event_type WHEN 'view' THEN 'IMPORTANT extention' WHEN 'click' THEN 'important: brownfield' WHEN 'error' THEN 'IMPORTANT demolish' WHEN 'signup' THEN 'greenfield, not centered' ELSE 'greenfield' END"


@query("p18_note_overrides", f"""WITH n AS (SELECT user_id AS site, arg_max({_NOTE}, (ts, event_id)) AS note FROM events GROUP BY 1)
SELECT site, CASE WHEN contains(lower(note), 'demolish') THEN 'drop' WHEN contains(lower(note), 'cut off') OR contains(lower(note), 'not centered') OR contains(lower(note), 'bottom right corner') THEN 'drop'
  WHEN NOT starts_with(lower(trim(note)), 'important') THEN NULL WHEN contains(lower(note), 'extention') OR contains(lower(note), 'extension') OR contains(lower(note), 'expansion') THEN 'expansion_existing'
  WHEN contains(lower(note), 'brownfield') THEN 'brownfield' WHEN contains(lower(note), 'greenfield') THEN 'greenfield' END AS verdict FROM n""")
def _(t):
    kinds = {"view": "IMPORTANT extention", "click": "important: brownfield", "error": "IMPORTANT demolish", "signup": "greenfield, not centered"}
    note = F.lit("greenfield")
    for k, v in kinds.items():
        note = F.when(F.col("event_type") == k, v).otherwise(note)
    latest = t.raw("events").groupBy(F.col("user_id").alias("site")).agg(F.max_by(note, F.struct("ts", "event_id")).alias("note"))
    return latest.select("site", P.note_verdict("note").alias("verdict"))


_BOXES = "(VALUES ('west', -100.0e0, 30.0e0, -99.2e0, 31.0e0), ('east', -98.9e0, 30.5e0, -98.0e0, 32.0e0), ('south', -99.6e0, 30.0e0, -98.4e0, 30.3e0)) AS x(box, x0, y0, x1, y1)"


@query("p19_box_restriction", sql("b", f"SELECT box, id FROM b JOIN {_BOXES} ON lon >= x0 AND lon <= x1 AND lat >= y0 AND lat <= y1"))
def _(t):
    boxes = {"west": (-100.0, 30.0, -99.2, 31.0), "east": (-98.9, 30.5, -98.0, 32.0), "south": (-99.6, 30.0, -98.4, 30.3)}
    return P.in_named_boxes(t.buildings(), boxes).select("box", "id")


@query("p20_strict_positives", sql("b", "SELECT id FROM b WHERE id % 2 = 0 AND starts_with(name, 'small') AND subtype = 'industrial' AND NOT (area < 1000)"))
def _(t):
    return t.buildings().where((F.col("id") % 2 == 0) & F.col("name").startswith("small") & (F.col("subtype") == "industrial") & ~(F.col("area") < 1000)).select("id")


@query("f21_change_status", sql("h", "SELECT id, CASE WHEN coalesce(change, -1) >= 0.1 THEN 'changed' WHEN error IS NOT NULL THEN 'error' WHEN coalesce(footprint, 0) < 10 OR change IS NULL THEN 'ambiguous' ELSE 'stable' END AS status FROM h"))
def _(t):
    return t.changes().select("id", change_status(F.col("change"), F.col("footprint"), F.col("error"), 0.1).alias("status"))
