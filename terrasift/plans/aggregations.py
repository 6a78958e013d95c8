"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import tidy
from ..operators import aggregates as A
from .base import query, sql, tidy_sql
from .joins import statuses

Q = [0.05, 0.25, 0.5, 0.75, 0.95]


def qsql(x: str, at=Q) -> str:
    return ", ".join(f"{tidy_sql(f'quantile_cont({x}, {q})')} AS q{round(q * 100)}" for q in at)


@query("a01_count_by_key", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL")
def _(t):
    return t.raw("orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("a02_count_sum_median", f"SELECT l_returnflag, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS total, {tidy_sql('median(l_quantity)')} AS mid FROM lineitem GROUP BY 1")
def _(t):
    return t.raw("lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("total"), tidy(F.median("l_quantity")).alias("mid"))


@query("a03_cluster_summary", sql("t", f"SELECT shard, count(*) AS n_tiles, max(prob) AS max_prob, {tidy_sql('avg(prob)')} AS mean_prob, min(prob) AS min_prob FROM t WHERE prob IS NOT NULL AND NOT isnan(prob) GROUP BY shard"))
def _(t):
    rows = t.tiles().where("prob is not null and not isnan(prob)")
    return rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n_tiles"), F.max("prob").alias("max_prob"), tidy(F.avg("prob")).alias("mean_prob"), F.min("prob").alias("min_prob"))


@query("a04_hull_summary", sql("b", f"SELECT class, count(*) AS n, max(subtype) AS subtype, min(lat) AS lat_min, max(lat) AS lat_max, min(lon) AS lon_min, max(lon) AS lon_max, CAST(floor(greatest((max(lat) - min(lat)) * 111000.0e0, (max(lon) - min(lon)) * 111000.0e0 * cos(radians(avg(lat)))) + 0.5) AS BIGINT) AS span_m FROM b WHERE class IS NOT NULL GROUP BY class"))
def _(t):
    return t.buildings().where("class is not null").groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.max("subtype").alias("subtype"), *A.hull())


@query("a05_value_counts", sql("b", "SELECT class, count(*) AS n FROM b WHERE class IS NOT NULL GROUP BY class"))
def _(t):
    return A.value_counts(t.buildings(), "class")


@query("a05_value_counts_with_null", sql("b", "SELECT class, count(*) AS n FROM b GROUP BY class"))
def _(t):
    return A.value_counts(t.buildings(), "class", nulls=True)


@query("a06_count_distinct", "SELECT l_suppkey, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1")
def _(t):
    return t.raw("lineitem").groupBy("l_suppkey").agg(F.countDistinct("l_partkey").alias("parts"))


@query("a07_pivot", "SELECT l_suppkey, count(*) FILTER (WHERE l_returnflag = 'A') AS A, count(*) FILTER (WHERE l_returnflag = 'N') AS N, count(*) FILTER (WHERE l_returnflag = 'R') AS R FROM lineitem GROUP BY 1")
def _(t):
    return A.pivot_counts(t.raw("lineitem"), "l_suppkey", "l_returnflag", ["A", "N", "R"])


@query("a08_crosstab", sql("b", f"SELECT coalesce(class, 'NULL') AS value, count(*) FILTER (WHERE area < 2000) AS missed, count(*) FILTER (WHERE area >= 2000) AS found, count(*) AS total, {tidy_sql('count(*) FILTER (WHERE area < 2000) / count(*)')} AS miss_rate FROM b GROUP BY 1 UNION ALL SELECT 'All', count(*) FILTER (WHERE area < 2000), count(*) FILTER (WHERE area >= 2000), count(*), {tidy_sql('count(*) FILTER (WHERE area < 2000) / count(*)')} FROM b"))
def _(t):
    return A.crosstab(t.buildings(), "class", F.col("area") >= 2000).withColumn("miss_rate", tidy(F.col("miss_rate")))


@query("a09_histogram", sql("t", "SELECT CAST(least(floor(prob * 5), 4) AS BIGINT) AS bin, count(*) AS n FROM t WHERE prob IS NOT NULL AND NOT isnan(prob) GROUP BY 1"))
def _(t):
    edges = [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]
    return t.tiles().where("prob is not null and not isnan(prob)").groupBy(F.least(F.floor(F.col("prob") * 5), F.lit(len(edges) - 2)).cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query("a09_fixed_edges", sql("b", "SELECT CASE WHEN area >= 100 AND area < 500 THEN 0::BIGINT WHEN area >= 500 AND area < 2500 THEN 1::BIGINT WHEN area >= 2500 AND area <= 5000 THEN 2::BIGINT END AS bin, count(*) AS n FROM b GROUP BY 1"))
def _(t):
    return t.buildings().groupBy(A.fixed_bins(F.col("area"), [100.0, 500.0, 2500.0, 5000.0]).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query("a10_histogram_2d", sql("t", "SELECT bin, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent, count(*) FILTER (WHERE o_orderpriority <> '1-URGENT') AS other FROM (SELECT CAST(floor(prob * 4) AS BIGINT) AS bin, o_orderpriority FROM t WHERE prob IS NOT NULL AND NOT isnan(prob)) GROUP BY 1"))
def _(t):
    rows = t.tiles().where("prob is not null and not isnan(prob)").select(F.floor(F.col("prob") * 4).cast("long").alias("bin"), F.when(F.col("o_orderpriority") == "1-URGENT", "urgent").otherwise("other").alias("kind"))
    return A.pivot_counts(rows, "bin", "kind", ["urgent", "other"])


@query("a11_quantiles", f"SELECT {qsql('o_totalprice')} FROM orders")
def _(t):
    q = A.quantiles(t.raw("orders"), "o_totalprice", Q)
    return q.select(*[tidy(F.col(c)).alias(c) for c in q.columns])


@query("a12_describe", f"SELECT count(p_size) AS n, {tidy_sql('avg(p_retailprice)')} AS mean, {tidy_sql('stddev_samp(p_retailprice)')} AS std, min(p_retailprice) AS min, {qsql('p_retailprice')}, max(p_retailprice) AS max FROM part")
def _(t):
    d = A.describe(t.raw("part"), "p_retailprice", Q)
    return d.select("n", *[tidy(F.col(c)).alias(c) for c in d.columns if c not in ("n", "min", "max")], "min", "max")


@query("a13_fraction", sql("b", f"SELECT {tidy_sql('avg(CASE WHEN subtype = ' + chr(39) + 'industrial' + chr(39) + ' THEN 1.0e0 ELSE 0.0e0 END)')} AS share FROM b"))
def _(t):
    return t.buildings().agg(tidy(A.share(F.col("subtype") == "industrial")).alias("share"))


@query("a14_threshold_sweep", sql("h", f"SELECT t, {tidy_sql('count(*) FILTER (WHERE coalesce(change >= t, false) AND footprint > 25) / greatest(count(*) FILTER (WHERE footprint > 25), 1)')} AS recall, {tidy_sql('avg(CASE WHEN coalesce(change >= t, false) THEN 0.0e0 ELSE 1.0e0 END)')} AS dropped FROM h, (SELECT unnest([0.05e0, 0.1e0, 0.15e0]) AS t) GROUP BY t"))
def _(t):
    s = A.sweep(t.changes(), "change", [0.05, 0.1, 0.15], F.col("footprint") > 25)
    return s.select("t", tidy(F.col("recall")).alias("recall"), tidy(F.col("dropped")).alias("dropped"))


@query("a15_distinct_names", sql("b", "SELECT class, list_sort(list(DISTINCT subtype) FILTER (WHERE subtype <> '')) AS names, count(DISTINCT subtype) AS n FROM b GROUP BY class"))
def _(t):
    names = F.sort_array(F.collect_set(F.when(F.col("subtype") != "", F.col("subtype"))))
    return t.buildings().groupBy("class").agg(names.alias("names"), F.countDistinct("subtype").alias("n"))


@query("a16_max_null_safe", sql("h", "SELECT footprint, max(change) AS top FROM h WHERE error IS NOT NULL GROUP BY footprint"))
def _(t):
    return t.changes().where("error is not null").groupBy("footprint").agg(F.max("change").alias("top"))


@query("a17_mode", sql("b", "SELECT subtype, class FROM (SELECT subtype, class, row_number() OVER (PARTITION BY subtype ORDER BY count(*) DESC, class) AS r FROM b WHERE class IS NOT NULL GROUP BY subtype, class) WHERE r = 1"))
def _(t):
    return A.most_common(t.buildings(), ["subtype"], "class")


@query("a18_having_or", sql("t", "SELECT id, shard FROM t WHERE o_custkey IN (SELECT o_custkey FROM t GROUP BY o_custkey HAVING max(CASE WHEN NOT isnan(prob) THEN prob END) >= 0.99 OR bool_or(o_orderpriority = '1-URGENT'))"))
def _(t):
    rows = t.tiles()
    good = rows.groupBy("o_custkey").agg(F.max(F.when(~F.isnan("prob"), F.col("prob"))).alias("m"), F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("u")).where("m >= 0.99 or u")
    return rows.join(good, "o_custkey", "left_semi").select("id", "shard")


@query("a19_having_sum", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING sum(o_totalprice) >= 2500000)")
def _(t):
    rows = t.raw("orders")
    good = rows.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("s")).where("s >= 2500000")
    return rows.join(good, "o_custkey", "left_semi").select("o_orderkey")


@query("a20_list_with_nulls", sql("h", "SELECT footprint, max(change) AS top, list(change ORDER BY id) AS vals FROM h GROUP BY footprint"))
def _(t):
    pairs = F.sort_array(F.collect_list(F.struct("id", "change")))
    return t.changes().groupBy("footprint").agg(F.max("change").alias("top"), F.transform(pairs, lambda x: x["change"]).alias("vals"))


_RANK = "CASE class WHEN 'small' THEN 0 WHEN 'medium' THEN 1 WHEN 'large' THEN 2 ELSE 3 END"


@query("a21_best_by_class_order", sql("b", f"SELECT subtype, arg_min(id, ({_RANK}, id)) AS id FROM b GROUP BY subtype"))
def _(t):
    rank = F.when(F.col("class") == "small", 0).when(F.col("class") == "medium", 1).when(F.col("class") == "large", 2).otherwise(3)
    return t.buildings().groupBy("subtype").agg(F.min_by("id", F.struct(rank, "id")).alias("id"))


@query("a22_any_keep", "SELECT c_custkey, CASE WHEN k IS NULL THEN 'missing' WHEN k THEN 'keep' ELSE 'drop' END AS decision FROM customer LEFT JOIN (SELECT o_custkey, bool_or(o_totalprice > 400000) AS k FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON c_custkey = o_custkey")
def _(t):
    k = t.raw("orders").where("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.bool_or(F.col("o_totalprice") > 400000).alias("k"))
    j = t.raw("customer").join(k, F.col("c_custkey") == F.col("o_custkey"), "left")
    return j.select("c_custkey", F.when(F.col("k").isNull(), "missing").when(F.col("k"), "keep").otherwise("drop").alias("decision"))


@query("a23_rate_by_group", sql("b", f"SELECT subtype, {tidy_sql('avg(CASE WHEN area < 2500 THEN 1.0e0 ELSE 0.0e0 END)')} AS specificity FROM b GROUP BY 1"))
def _(t):
    return t.buildings().groupBy("subtype").agg(tidy(A.share(F.col("area") < 2500)).alias("specificity"))


@query("a24_mean_then_filter", sql("t", f"SELECT o_custkey, {tidy_sql('avg(prob)')} AS mean FROM t WHERE prob IS NOT NULL AND NOT isnan(prob) GROUP BY 1 HAVING floor(avg(prob) * 1e6 + 0.5) / 1e6 < 0.4e0"))
def _(t):
    return t.tiles().where("prob is not null and not isnan(prob)").groupBy("o_custkey").agg(tidy(F.avg("prob")).alias("mean")).where("mean < 0.4")


@query("a25_class_weights", f"SELECT o_orderstatus, n, {tidy_sql('(SELECT count(*) FROM orders) / (3.0e0 * n)')} AS weight FROM (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1)")
def _(t):
    w = A.class_weights(t.raw("orders"), "o_orderstatus", 3)
    return w.withColumn("weight", tidy(F.col("weight")))


@query("a26_sampling_weights", f"SELECT o_orderkey, {tidy_sql('1.0e0 / count(*) OVER (PARTITION BY o_orderstatus)', 9)} AS weight FROM orders")
def _(t):
    rows = t.raw("orders")
    n = rows.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return rows.join(F.broadcast(n), "o_orderstatus").select("o_orderkey", tidy(1.0 / F.col("n"), 9).alias("weight"))


@query("a27_fold_mean_std", f"SELECT {tidy_sql('avg(m)', 3)} AS mean, {tidy_sql('stddev_pop(m)', 3)} AS std FROM (SELECT o_orderkey % 5, avg(o_totalprice) AS m FROM orders GROUP BY 1)")
def _(t):
    m = t.raw("orders").groupBy(F.col("o_orderkey") % 5).agg(F.avg("o_totalprice").alias("m"))
    return m.agg(tidy(F.avg("m"), 3).alias("mean"), tidy(F.stddev_pop("m"), 3).alias("std"))


@query("a28_median_by_key", sql("s", f"SELECT key, {tidy_sql('median(cloud)')} AS cloud FROM s GROUP BY key"))
def _(t):
    return t.scenes().groupBy("key").agg(tidy(F.median("cloud")).alias("cloud"))


_P = ", ".join(f"{tidy_sql(f'quantile_cont(value, {q})')} AS p{round(q * 100)}" for q in (0.5, 0.9, 0.95, 0.99))


@query("a29_chunk_telemetry", f"SELECT user_id % 16 AS chunk, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS n_err, {_P}, {tidy_sql('avg(value)')} AS mean, max(value) AS max FROM events GROUP BY 1")
def _(t):
    p = F.percentile("value", [0.5, 0.9, 0.95, 0.99])
    g = t.raw("events").groupBy((F.col("user_id") % 16).alias("chunk")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "error").alias("n_err"), p.alias("p"), tidy(F.avg("value")).alias("mean"), F.max("value").alias("max"))
    return g.select("chunk", "n", "n_err", *[tidy(F.col("p")[k]).alias(f"p{q}") for k, q in enumerate((50, 90, 95, 99))], "mean", "max")


@query("a30_coverage", sql("l", "SELECT count(DISTINCT (site, year)) AS got, count(DISTINCT site) * 30 AS expected FROM l"))
def _(t):
    return t.labels().agg(F.countDistinct(F.struct("site", "year")).alias("got"), (F.countDistinct("site") * 30).alias("expected"))


@query("a31_first_of_sorted", sql("s", "SELECT key, arg_min(scene, (year, scene)) AS scene FROM s GROUP BY key"))
def _(t):
    return t.scenes().groupBy("key").agg(F.min_by("scene", F.struct("year", "scene")).alias("scene"))


_Z = "z AS (SELECT CASE WHEN coalesce(change, -1) >= 0.15 THEN 'changed' WHEN error IS NOT NULL THEN 'error' WHEN coalesce(footprint, 0) < 10 OR change IS NULL THEN 'ambiguous' ELSE 'stable' END AS status FROM b LEFT JOIN h ON b.id = h.id)"


@query("a32_status_buckets", sql("bh", f"SELECT status, count(*) AS n, {tidy_sql('100.0e0 * count(*) / (SELECT count(*) FROM z)')} AS percent FROM z GROUP BY status", _Z))
def _(t):
    z = statuses(t).groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    return z.crossJoin(F.broadcast(z.agg(F.sum("n").alias("every")))).select("status", "n", tidy(100.0 * F.col("n") / F.col("every")).alias("percent"))


@query("a33_summary_row", sql("l", "SELECT count(*) AS rows, count(*) FILTER (WHERE label = 'complete') AS complete, count(*) FILTER (WHERE label = 'not_a_site') AS not_a_site, count(DISTINCT site) AS sites FROM l"))
def _(t):
    is_ = lambda k: F.count_if(F.col("label") == k).alias(k)
    return t.labels().agg(F.count(F.lit(1)).alias("rows"), is_("complete"), is_("not_a_site"), F.countDistinct("site").alias("sites"))
