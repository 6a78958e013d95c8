"""How queries are registered, and the stand-ins that they run on: the driver's tables seen as buildings, anchors, candidates,
tiles, scenes, labels and change scores. Coordinates come from keys by integer arithmetic, so every engine derives the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """Stand-ins over the tables of a folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @staticmethod
    def _place(df: DataFrame, a: int, b: int) -> DataFrame:
        return df.withColumns({"lat": 30.0 + (F.col("id") * a % 20000) / 10000.0, "lon": -100.0 + (F.col("id") * b % 20000) / 10000.0})

    def buildings(self) -> DataFrame:
        part = self.raw("part").select(F.col("p_partkey").alias("id"), "p_type", "p_brand", F.col("p_name").alias("name"), "p_size")
        half = F.col("p_size") / 100000.0
        kinds = F.when(F.col("id") % 4 == 1, F.array(F.lit("OpenStreetMap"))).when(F.col("id") % 4 == 2, F.array(F.lit("Microsoft"))).when(F.col("id") % 4 == 3, F.array(F.lit("Microsoft"), F.lit("OpenStreetMap")))
        return self._place(part, 7919, 104729).select(
            "id", "lat", "lon", (F.col("lon") - half).alias("xmin"), (F.col("lat") - half).alias("ymin"), (F.col("lon") + half).alias("xmax"), (F.col("lat") + half).alias("ymax"),
            (F.col("p_size") * 100.0).alias("area"), F.when(F.col("id") % 7 != 0, F.lower("p_type")).alias("class"),
            F.when(F.col("id") % 5 == 1, "industrial").when(F.col("id") % 5 != 0, F.col("p_brand")).alias("subtype"), "name", kinds.alias("sources"),
        )

    def anchors(self) -> DataFrame:
        c = self.raw("customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("site_type"), F.col("c_nationkey").alias("state"), F.col("c_acctbal").alias("bal"), F.col("c_name").alias("project"))
        return self._place(c, 6101, 15485863)

    def candidates(self) -> DataFrame:
        s = self.raw("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("state"))
        return self._place(s, 3571, 27644437).withColumns({"prob": (F.col("id") * 37 % 1000) / 1000.0, "span": (F.col("id") % 40 * 100).cast("long")})

    def tiles(self) -> DataFrame:
        o = self.raw("orders").select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 10).alias("shard"), "o_custkey", "o_orderpriority")
        score = F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 13 == 0, float("nan")).otherwise((F.col("id") * 37 % 1000) / 1000.0)
        return o.withColumn("prob", score)

    def scenes(self) -> DataFrame:
        return self.raw("lineitem").select(F.col("l_suppkey").alias("key"), F.col("l_linenumber").cast("long").alias("year"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("scene"), F.when(F.col("l_partkey") % 9 != 0, F.col("l_quantity")).alias("cloud"))

    def labels(self) -> DataFrame:
        kind = F.when(F.col("event_type") == "view", "unsure").when(F.col("event_type") == "click", "partial").when(F.col("event_type") == "error", "not_a_site").otherwise("complete")
        return self.raw("events").select(F.col("user_id").alias("site"), F.dayofmonth("ts").cast("long").alias("year"), kind.alias("label"), "ts", "event_id")

    def changes(self) -> DataFrame:
        """A change score for each building that has a line item: that of its least order."""
        line = self.raw("lineitem").select(F.col("l_partkey").alias("id"), F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_discount", "l_returnflag").alias("r"))
        one = line.groupBy("id").agg(F.min("r").alias("r"))
        return one.select("id", F.when(F.col("r.l_linenumber") != 7, F.col("r.l_discount") * 2).alias("change"), F.col("r.l_quantity").cast("long").alias("footprint"), F.when((F.col("r.l_returnflag") == "R") & (F.col("r.l_linenumber") < 3), "timeout").alias("error"))

    def vectors(self) -> DataFrame:
        return self.raw("embeddings").select(F.col("vec_id").alias("id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("v"))


#: The same stand-ins as common table expressions.
PLACE = "30.0e0 + (({k} * {a}) % 20000) / 10000.0e0 AS lat, -100.0e0 + (({k} * {b}) % 20000) / 10000.0e0 AS lon"
CTE = {
    "b": "b0 AS (SELECT p_partkey AS id, " + PLACE.format(k="p_partkey", a=7919, b=104729) + """, p_size / 100000.0e0 AS h, p_size * 100.0e0 AS area,
  CASE WHEN p_partkey % 7 <> 0 THEN lower(p_type) END AS class, CASE WHEN p_partkey % 5 = 1 THEN 'industrial' WHEN p_partkey % 5 <> 0 THEN p_brand END AS subtype, p_name AS name,
  CASE p_partkey % 4 WHEN 1 THEN ['OpenStreetMap'] WHEN 2 THEN ['Microsoft'] WHEN 3 THEN ['Microsoft', 'OpenStreetMap'] END AS sources FROM part),
b AS (SELECT *, lon - h AS xmin, lat - h AS ymin, lon + h AS xmax, lat + h AS ymax FROM b0)""",
    "a": "a AS (SELECT c_custkey AS id, " + PLACE.format(k="c_custkey", a=6101, b=15485863) + ", c_mktsegment AS site_type, c_nationkey AS state, c_acctbal AS bal, c_name AS project FROM customer)",
    "c": "c AS (SELECT s_suppkey AS id, " + PLACE.format(k="s_suppkey", a=3571, b=27644437) + ", (s_suppkey * 37 % 1000) / 1000.0e0 AS prob, s_suppkey % 40 * 100 AS span, s_nationkey AS state FROM supplier)",
    "t": "t AS (SELECT o_orderkey AS id, o_custkey % 10 AS shard, o_custkey, o_orderpriority, CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 'NaN'::DOUBLE ELSE (o_orderkey * 37 % 1000) / 1000.0e0 END AS prob FROM orders)",
    "s": "s AS (SELECT l_suppkey AS key, CAST(l_linenumber AS BIGINT) AS year, l_orderkey * 10 + l_linenumber AS scene, CASE WHEN l_partkey % 9 <> 0 THEN l_quantity END AS cloud FROM lineitem)",
    "l": "l AS (SELECT user_id AS site, CAST(day(ts) AS BIGINT) AS year, CASE event_type WHEN 'view' THEN 'unsure' WHEN 'click' THEN 'partial' WHEN 'error' THEN 'not_a_site' ELSE 'complete' END AS label, ts, event_id FROM events)",
    "h": """h AS (SELECT l_partkey AS id, CASE WHEN l_linenumber <> 7 THEN l_discount * 2 END AS change, CAST(l_quantity AS BIGINT) AS footprint, CASE WHEN l_returnflag = 'R' AND l_linenumber < 3 THEN 'timeout' END AS error
  FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey, l_quantity, l_discount, l_returnflag) AS rn FROM lineitem) WHERE rn = 1)""",
    "v": "v AS (SELECT vec_id AS id, CAST(label AS BIGINT) AS label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings)",
}


def sql(ctes: str, body: str, more: str = "") -> str:
    """body over the stand-ins named by the letters of ``ctes``, and further common table expressions."""
    parts = [CTE[c] for c in ctes] + ([more] if more else [])
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def tidy_sql(x: str, digits: int = 6) -> str:
    return f"floor(({x}) * 1e{digits} + 0.5) / 1e{digits}"


def haversine_sql(a: str, b: str, c: str, d: str, radius: float = 6371000.0) -> str:
    return f"2 * {radius!r}e0 * asin(sqrt(least(1.0e0, pow(sin((radians({c}) - radians({a})) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin((radians({d}) - radians({b})) / 2), 2))))"


def query(name: str, text: str | None = None):
    """Register f(tables) as a query, with its SQL if there is one."""

    def add(f: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if text is not None:
            SQL[name] = text
        return f

    return add
