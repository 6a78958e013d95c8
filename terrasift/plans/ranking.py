"""Ordering, dedup, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.scalar import tidy
from ..operators import ranking as R
from ..operators.incremental import todo
from ..operators.predicates import at_least
from .base import query, sql, tidy_sql
from .joins import _KEPT, panel

GOOD = "prob IS NOT NULL AND NOT isnan(prob)"


@query("w01_keep_best", sql("t", f"SELECT o_custkey, id, prob FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY prob DESC, id) AS r FROM t WHERE {GOOD}) WHERE r = 1"))
def _(t):
    return R.best(t.tiles().where(at_least("prob", 0.0)), ["o_custkey"], [F.desc("prob"), F.col("id")]).select("o_custkey", "id", "prob")


@query("w02_top_n_by_cloud", sql("s", "SELECT key, year, scene FROM (SELECT DISTINCT key, year, scene, cloud, row_number() OVER (PARTITION BY key, year ORDER BY coalesce(cloud, 100), scene, cloud) AS r FROM (SELECT DISTINCT * FROM s)) WHERE r <= 4"))
def _(t):
    return R.top_n(t.scenes().distinct(), ["key", "year"], [F.coalesce("cloud", F.lit(100.0)), F.col("scene"), F.asc_nulls_last("cloud")], 4).select("key", "year", "scene")


@query("w03_first_per_group", sql("s", "SELECT key, scene FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY coalesce(cloud, 100), scene) AS r FROM s) WHERE r = 1"))
def _(t):
    return R.best(t.scenes(), ["key"], [F.coalesce("cloud", F.lit(100.0)), F.col("scene")]).select("key", "scene")


@query("w04_latest_label", sql("l", "SELECT site, arg_max(label, year) AS label FROM k WHERE label IN ('complete', 'not_a_site') GROUP BY site", _KEPT))
def _(t):
    return panel(t).where(F.col("label").isin("complete", "not_a_site")).groupBy("site").agg(F.max_by("label", "year").alias("label"))


@query("w05_gap_fill", sql("l", """SELECT site, year, label FROM (SELECT site, label, unnest(range(year + 1, nxt)) AS year FROM (SELECT site, year, label, lead(year) OVER w AS nxt, lead(label) OVER w AS lab FROM k WHERE label <> 'unsure' WINDOW w AS (PARTITION BY site ORDER BY year)) WHERE lab = label AND label <> 'partial' AND nxt > year + 1)
WHERE (site, year) NOT IN (SELECT (site, year) FROM k WHERE label <> 'unsure')""", _KEPT))
def _(t):
    seen = panel(t).where("label != 'unsure'")
    filled = R.fill_gaps(seen, "site", "year", "label").where("label != 'partial'")
    return todo(filled, seen, ["site", "year"]).select("site", "year", "label")


@query("w06_global_rank", sql("t", f"SELECT id, 'c_' || lpad(CAST(row_number() OVER (ORDER BY prob DESC, id) - 1 AS VARCHAR), 7, '0') AS candidate_id FROM t WHERE {GOOD}"))
def _(t):
    ranked = R.global_rank(t.tiles().where(at_least("prob", 0.0)), [F.desc("prob"), F.col("id")])
    return ranked.select("id", F.concat(F.lit("c_"), F.lpad(F.col("rank").cast("string"), 7, "0")).alias("candidate_id"))


@query("w07_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def _(t):
    return t.raw("orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25).select("o_orderkey", "o_totalprice")


@query("w08_dedup_rounded", sql("b", f"SELECT max(id) AS id, {tidy_sql('lat', 1)} AS la, {tidy_sql('lon', 1)} AS lo FROM b GROUP BY 2, 3"))
def _(t):
    b = t.buildings().select("id", tidy(F.col("lat"), 1).alias("la"), tidy(F.col("lon"), 1).alias("lo"))
    return R.best(b, ["la", "lo"], [F.desc("id")])


@query("w09_priority_dedup", "SELECT c_custkey AS id, CASE WHEN s_suppkey IS NOT NULL THEN 'supplier' ELSE 'customer' END AS source FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey")
def _(t):
    a = t.raw("supplier").select(F.col("s_suppkey").alias("id"), F.lit("supplier").alias("source"))
    b = t.raw("customer").select(F.col("c_custkey").alias("id"), F.lit("customer").alias("source"))
    return R.by_priority([a, b], ["id"], ["source"])


@query("w10_locality_chunks", sql("b", "SELECT id, (row_number() OVER (ORDER BY CAST(floor(lat * 10) AS BIGINT), lon, id) - 1) // 256 AS chunk FROM b"))
def _(t):
    b = t.buildings().withColumn("_y", F.floor(F.col("lat") * 10).cast("long"))
    ranked = R.global_rank(b, [F.col("_y"), F.col("lon"), F.col("id")])
    return ranked.select("id", F.floor(F.col("rank") / 256).cast("long").alias("chunk"))


@query("w11_resequence", sql("t", "SELECT id, row_number() OVER (ORDER BY shard, id) - 1 AS row_idx FROM t"))
def _(t):
    return R.global_rank(t.tiles(), [F.col("shard"), F.col("id")], "row_idx").select("id", F.col("row_idx").cast("long").alias("row_idx"))


@query("w12_modulo_shard", sql("b", "SELECT id FROM (SELECT id, row_number() OVER (ORDER BY lat, id) - 1 AS r FROM b) WHERE r % 5 = 2"))
def _(t):
    return R.global_rank(t.buildings(), [F.col("lat"), F.col("id")]).where("rank % 5 = 2").select("id")


@query("w13_even_picks", sql("t", f"SELECT id FROM (SELECT id, row_number() OVER (ORDER BY prob DESC, id) - 1 AS r, count(*) OVER () AS n FROM t WHERE {GOOD}) WHERE r IN (SELECT CAST(floor(k * (n - 1) / 9.0e0) AS BIGINT) FROM (SELECT unnest(range(0, 10)) AS k), (SELECT count(*) AS n FROM t WHERE {GOOD}))"))
def _(t):
    rows = t.tiles().where(at_least("prob", 0.0))
    ranked = R.global_rank(rows, [F.desc("prob"), F.col("id")])
    picks = rows.agg(F.count(F.lit(1)).alias("n")).select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda k: F.floor(k * (F.col("n") - 1) / 9.0).cast("long"))).alias("rank"))
    return ranked.join(F.broadcast(picks.distinct()), "rank", "left_semi").select("id")


@query("w14_leaderboard", "SELECT c_nationkey, c_custkey FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS r FROM customer) WHERE r = 1")
def _(t):
    return R.best(t.raw("customer"), ["c_nationkey"], [F.desc("c_acctbal"), F.col("c_custkey")]).select("c_nationkey", "c_custkey")


@query("w15_round_robin", sql("a", "SELECT id, site_type FROM (SELECT *, row_number() OVER (PARTITION BY site_type ORDER BY md5('rr:' || id), id) AS k FROM a) ORDER BY k, site_type, id LIMIT 33"))
def _(t):
    from ..operators.sampling import round_robin

    return round_robin(t.anchors(), "site_type", "id", 33, "rr").select("id", "site_type")


@query("w16_rolling", "SELECT event_id, CAST(sum(CAST(floor(value * 100 + 0.5) AS BIGINT)) OVER w AS BIGINT) AS cents, count(*) OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)")
def _(t):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-49, 0)
    return t.raw("events").select("event_id", F.sum(F.floor(F.col("value") * 100 + 0.5).cast("long")).over(w).alias("cents"), F.count(F.lit(1)).over(w).alias("n"))


@query("w17_mixed_sort", "SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderpriority DESC, o_orderkey LIMIT 50")
def _(t):
    return t.raw("orders").orderBy(F.desc("o_orderdate"), F.desc("o_orderpriority"), "o_orderkey").limit(50).select("o_orderkey")


@query("w18_limit_after_filter", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderkey LIMIT 20")
def _(t):
    return t.raw("orders").where("o_orderstatus = 'P'").orderBy("o_orderkey").limit(20).select("o_orderkey")


@query("w19_first_acceptable", sql("s", """SELECT key, scene FROM (SELECT s.*, row_number() OVER (PARTITION BY s.key ORDER BY coalesce(cloud, 100), scene) AS r FROM s JOIN (SELECT key, arg_min(scene, (coalesce(cloud, 100), scene)) AS cur FROM s GROUP BY 1) c ON s.key = c.key WHERE scene <> cur AND coalesce(cloud, 0) >= 5) WHERE r = 1"""))
def _(t):
    s = t.scenes()
    cloud = F.coalesce("cloud", F.lit(100.0))
    cur = s.groupBy("key").agg(F.min_by("scene", F.struct(cloud, "scene")).alias("cur"))
    ok = s.join(cur, "key").where((F.col("scene") != F.col("cur")) & (F.coalesce("cloud", F.lit(0.0)) >= 5))
    return R.best(ok, ["key"], [cloud, F.col("scene")]).select("key", "scene")


@query("u01_union_all", "SELECT n_name AS name FROM nation UNION ALL SELECT r_name FROM region")
def _(t):
    return t.raw("nation").select(F.col("n_name").alias("name")).unionByName(t.raw("region").select(F.col("r_name").alias("name")))


@query("u02_union_by_name", "SELECT n_nationkey AS k, n_name AS name, CAST(NULL AS VARCHAR) AS note FROM nation UNION ALL SELECT r_regionkey, NULL, r_name FROM region")
def _(t):
    a = t.raw("nation").select(F.col("n_nationkey").cast("int").alias("k"), F.col("n_name").alias("name"))
    b = t.raw("region").select(F.col("r_regionkey").cast("int").alias("k"), F.col("r_name").alias("note"))
    return a.unionByName(b, allowMissingColumns=True)


@query("u03_distinct_union", "SELECT l_partkey AS id FROM lineitem WHERE l_linenumber = 1 UNION SELECT l_partkey FROM lineitem WHERE l_linenumber = 2")
def _(t):
    part = lambda k: t.raw("lineitem").where(F.col("l_linenumber") == k).select(F.col("l_partkey").alias("id"))
    return part(1).union(part(2)).distinct()


@query("u04_difference", "SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A' EXCEPT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'")
def _(t):
    of = lambda k: t.raw("lineitem").where(F.col("l_returnflag") == k).select("l_partkey", "l_suppkey")
    return of("A").subtract(of("R"))


@query("u05_intersection", "SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A' INTERSECT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'")
def _(t):
    of = lambda k: t.raw("lineitem").where(F.col("l_returnflag") == k).select("l_partkey", "l_suppkey")
    return of("A").intersect(of("R"))


@query("u06_set_accounting", "SELECT count(*) FILTER (WHERE a AND NOT b) AS leaked, count(*) FILTER (WHERE b AND NOT a) AS missing, count(*) FILTER (WHERE a AND b) AS both FROM (SELECT x.k IS NOT NULL AS a, y.k IS NOT NULL AS b FROM (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_quantity > 48) x FULL JOIN (SELECT p_partkey AS k FROM part WHERE p_size < 40) y ON x.k = y.k)")
def _(t):
    from ..operators.sets import accounting

    return accounting(t.raw("lineitem").where("l_quantity > 48").select(F.col("l_partkey").alias("k")), t.raw("part").where("p_size < 40").select(F.col("p_partkey").alias("k")), "k")


@query("u07_snapshot", sql("b", "SELECT id FROM b WHERE id NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A' AND l_shipdate > TIMESTAMP '2000-01-01')"))
def _(t):
    added = t.raw("lineitem").where((F.col("l_returnflag") == "A") & (F.col("l_shipdate") > F.lit("2000-01-01").cast("timestamp"))).select(F.col("l_partkey").alias("id")).distinct()
    return todo(t.buildings().select("id"), added, ["id"])
