"""Readers. Whatever needs a network or a native library comes in as a callable; what it returns is a DataFrame."""

from __future__ import annotations

import random
import threading
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.ranking import best

#: The announcements file: coordinates as numbers, and as they are written (for counting decimals).
ANNOUNCEMENTS = "canonical_project_name string, state string, lat_raw string, lng_raw string, site_type string, announcement_date string"


def chunks(spark: SparkSession, pattern: str, leave_out: str = "_emb", stem: str = "mgrs_tile") -> DataFrame:
    """All parquet chunks of a glob but those whose name ends in ``leave_out``, with the file's stem as a column."""
    name = F.regexp_extract("_metadata.file_path", r"([^/]+)\.parquet", 1)
    return spark.read.parquet(pattern).withColumn(stem, name).where(~F.col(stem).endswith(leave_out))


def csv(spark: SparkSession, path: str, schema: str = ANNOUNCEMENTS) -> DataFrame:
    """A CSV file with a header; lat and lng are tried from their text."""
    df = spark.read.csv(path, header=True, schema=schema, multiLine=True)
    for raw, name in (("lat_raw", "lat"), ("lng_raw", "lng")):
        if raw in df.columns:
            df = df.withColumn(name, F.col(raw).try_cast("double"))
    return df


def json_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.json(path, schema=schema, multiLine=True)


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.json(path, schema=schema)


def feature_collection(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    """(name, type, coordinates as JSON text) of a GeoJSON file's features, those of ``names`` only if given."""
    schema = "features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>"
    each = spark.read.json(path, schema=schema, multiLine=True).select(F.explode("features").alias("f"))
    out = each.select(F.try_element_at("f.properties", F.lit("name")).alias("name"), "f.geometry.type", "f.geometry.coordinates")
    return out.where(F.col("name").isin(names)) if names else out


def region(spark: SparkSession, path: str, leave_out: list[str]) -> DataFrame:
    """(name, rings): the polygons of a GeoJSON file but those of the names to leave out, each a list of rings of (x, y); a multipolygon gives one row
    for each part. Their union is asked with spatial.in_region()."""
    flat, deep = "array<array<array<double>>>", "array<array<array<array<double>>>>"
    each = feature_collection(spark, path).where(~F.coalesce(F.col("name").isin(leave_out), F.lit(False)))
    parts = F.when(F.col("type") == "MultiPolygon", F.from_json("coordinates", deep)).when(F.col("type") == "Polygon", F.array(F.from_json("coordinates", flat)))
    ring = lambda r: F.transform(r, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))
    return each.select("name", F.explode(parts).alias("p")).select("name", F.transform("p", ring).alias("rings"))


def blobs(spark: SparkSession, pattern: str) -> DataFrame:
    """(uri, text) of whole files."""
    return spark.read.format("binaryFile").load(pattern).select(F.col("path").alias("uri"), F.decode("content", "UTF-8").alias("text"))


def or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at path, or an empty one of the schema if there is none."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def retried(call: Callable, attempts: int = 4, first_wait: float = 1.0, most_wait: float = 30.0, jitter: float = 1.0, sleep: Callable[[float], None] = time.sleep):
    """call(), tried again after waits that double up to most_wait, each with a random part of ``jitter`` seconds; the last error is raised."""
    for k in range(attempts):
        try:
            return call()
        except Exception:
            if k == attempts - 1:
                raise
            sleep(min(first_wait * 2**k, most_wait) + random.random() * jitter)


def timed(call: Callable, seconds: float):
    """call() in a thread of its own; TimeoutError if it takes longer (the thread is left to itself)."""
    box: list = []
    thread = threading.Thread(target=lambda: box.append(_tried(call)), daemon=True)
    thread.start()
    thread.join(seconds)
    if not box:
        raise TimeoutError(f"no answer in {seconds} s")
    value, error = box[0]
    if error is not None:
        raise error
    return value


def _tried(call: Callable) -> tuple:
    try:
        return call(), None
    except Exception as e:
        return None, e


def windows(boxes: DataFrame, read: Callable[[str, tuple], list | None], schema: str = "id long, uri string, pixels array<double>, error string", timeout: float = 120.0, attempts: int = 2, first_wait: float = 0.0) -> DataFrame:
    """Pixels of each (id, uri, xmin, ymin, xmax, ymax) by an injected reader; what fails, or takes over ``timeout`` seconds, is a row with its error.

    Rows are sorted by uri within each partition, so that a reader may keep one file open.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                try:
                    one = lambda r=r: timed(lambda: read(r.uri, (r.xmin, r.ymin, r.xmax, r.ymax)), timeout)
                    out.append((r.id, r.uri, retried(one, attempts, first_wait, jitter=first_wait), None))
                except Exception as e:
                    out.append((r.id, r.uri, None, f"{type(e).__name__}: {e}"[:200]))
            yield pd.DataFrame(out, columns=["id", "uri", "pixels", "error"])

    return boxes.select("id", "uri", "xmin", "ymin", "xmax", "ymax").repartition("uri").sortWithinPartitions("uri").mapInPandas(run, schema)


def searched(keys: DataFrame, search: Callable[..., list[tuple]], top: int, attempts: int = 5, first_wait: float = 1.0) -> DataFrame:
    """keys with scene, cloud and error: for each row the ``top`` scenes with the least cloud (none counts as 100; ties in the order of the answer) of
    search(*row), which gives (scene, cloud); a row whose search fails to the end has its error, one without scenes nothing."""
    schema = T.StructType([*keys.schema.fields, T.StructField("scene", T.StringType()), T.StructField("cloud", T.DoubleType()), T.StructField("error", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key in batch.itertuples(index=False, name=None):
                try:
                    found = retried(lambda key=key: list(search(*key)), attempts, first_wait, 16.0, first_wait)
                    out += [(*key, scene, cloud, None) for scene, cloud in sorted(found, key=lambda x: 100.0 if x[1] is None else x[1])[:top]]
                except Exception as e:
                    out.append((*key, None, None, f"{type(e).__name__}: {e}"[:200]))
            yield pd.DataFrame(out, columns=schema.names)

    return keys.mapInPandas(run, schema)


def discovered(listing: DataFrame, preference: list[str], images: str = "rgbir_cog", index: str = ".shp") -> DataFrame:
    """(state, year, res) of a listing (key: state/year/res/kind/...): for each state the latest year, and in it the first resolution by preference (then by
    name), that has both images and an index file."""
    part = lambda k: F.get(F.split("key", "/"), F.lit(k))
    rows = listing.select(part(0).alias("state"), part(1).alias("_y"), part(2).alias("res"), (part(3) == images).alias("_i"), ((part(3) == "index") & F.col("key").endswith(index)).alias("_x"))
    whole = rows.where(F.col("_y").rlike("^[0-9]{4}$")).groupBy("state", F.col("_y").cast("int").alias("year"), "res").agg(F.bool_or("_i").alias("_i"), F.bool_or("_x").alias("_x")).where("_i and _x")
    place = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, preference)), F.col("res")), F.lit(0)), F.lit(len(preference) + 1))
    return best(whole.withColumn("_p", place), ["state"], [F.desc("year"), F.col("_p"), F.col("res")]).select("state", "year", "res")


def search_source(name: str, search: Callable[[str], list[tuple]], schema: str) -> type[DataSource]:
    """A data source over a catalogue that is asked once for each key: option ``keys`` is a comma-separated list."""

    class Reader(DataSourceReader):
        def __init__(self, keys: list[str]):
            self.keys = keys

        def partitions(self):
            return [InputPartition(k) for k in self.keys]

        def read(self, partition):
            yield from retried(lambda: search(partition.value), 4, 0.2, jitter=0.1)

    class Source(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return schema

        def reader(self, schema: T.StructType):
            return Reader([k for k in self.options.get("keys", "").split(",") if k])

    return Source


def sampled(points: DataFrame, raster: DataFrame, deg: float) -> DataFrame:
    """points (lat, lon) with the value of the raster cell (y, x, value) that holds each."""
    cell = lambda c: F.floor(F.col(c) / deg).cast("long")
    return points.withColumns({"y": cell("lat"), "x": cell("lon")}).join(raster, ["y", "x"], "left").drop("y", "x")


def lines(files: DataFrame, read: Callable[[str], list[tuple]], classes: list[str]) -> DataFrame:
    """(fclass, xa, ya, xb, yb) segments of the chosen classes from road files (uri), read where the rows are by an injected reader."""
    names = ["fclass", "xa", "ya", "xb", "yb"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri in batch["uri"]:
                rows = pd.DataFrame(read(uri), columns=names)
                yield rows[rows["fclass"].isin(classes)]

    return files.select("uri").mapInPandas(run, "fclass string, xa double, ya double, xb double, yb double")
