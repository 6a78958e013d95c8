"""Label logs and telemetry as streams: upserts by micro-batch, and rates with late data bounded by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.incremental import latest


def event_stream(spark: SparkSession, folder: str, schema: str, files: int = 1, pattern: str = "*.parquet") -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("pathGlobFilter", pattern).parquet(folder)


def upserts(stream: DataFrame, path: str, checkpoint: str, keys: list[str], order: list[str], buckets: int = 64) -> StreamingQuery:
    """Keeps the latest event of each key in a table of buckets by a hash of the keys. A micro-batch writes a version of the buckets that it touches only;
    a batch that is run again writes its own version anew. Versions that two later ones replace are deleted.

    The table is the latest version of each bucket: see current().
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark, rows = batch.sparkSession, batch.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
        touched = [r._bucket for r in rows.select("_bucket").distinct().collect()]  # at most ``buckets``
        known = _versions(spark, path, number)
        before = [f"{path}/version={known[b][-1]}/_bucket={b}" for b in touched if b in known]
        every = rows.drop("_bucket") if not before else rows.drop("_bucket").unionByName(spark.read.schema(batch.schema).parquet(*before))
        kept = latest(every, keys, order).select(batch.columns).withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
        kept.write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/version={number}")
        files, at = _folder(spark, path)
        for b in touched:
            for old in known.get(b, [])[:-1]:
                files.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/version={old}/_bucket={b}"), True)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _folder(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _versions(spark: SparkSession, path: str, below: int | None = None) -> dict[int, list[int]]:
    """The versions of each bucket, ascending."""
    files, at = _folder(spark, f"{path}/version=*/_bucket=*")
    found: dict[int, list[int]] = {}
    for s in files.globStatus(at) or []:
        version, bucket = (int(x.split("=")[1]) for x in (s.getPath().getParent().getName(), s.getPath().getName()))
        if below is None or version < below:
            found.setdefault(bucket, []).append(version)
    return {b: sorted(v) for b, v in found.items()}


def current(spark: SparkSession, path: str, below: int | None = None) -> DataFrame | None:
    """The table of upserts(), or as it was before a version."""
    parts = [f"{path}/version={v[-1]}/_bucket={b}" for b, v in _versions(spark, path, below).items()]
    return spark.read.parquet(*parts) if parts else None


def heartbeat(stream: DataFrame, time: str, failed: str, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Rows, errors and rows a second of each window."""
    seconds = F.unix_timestamp(F.col("window.end")) - F.unix_timestamp(F.col("window.start"))
    g = stream.withWatermark(time, late).groupBy(F.window(time, window)).agg(F.count(F.lit(1)).alias("n"), F.count_if(failed).alias("n_err"))
    return g.select(F.col("window.start").alias("start"), "n", "n_err", (F.col("n") / seconds).alias("rate"))


def eta_seconds(done: int, total: int, elapsed: float) -> float | None:
    """Seconds that the rest takes at the rate so far."""
    return None if done <= 0 else (total - done) * elapsed / done
