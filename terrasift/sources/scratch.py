"""Tables that cut an iterative plan's lineage: written to the shared folder of spark.checkpoint.dir and read again."""

from __future__ import annotations

import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession


class _Made(threading.local):
    """Paths of the tables that this thread has written."""

    def __init__(self):
        self.paths: list[str] = []


_made = _Made()


def folder(spark: SparkSession) -> str:
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="terrasift-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, label: str) -> DataFrame:
    path = f"{folder(df.sparkSession)}/terrasift/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _made.paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete the tables that this thread's operators have written; only once their results are written or no longer wanted."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _made.paths:
        path = jvm.org.apache.hadoop.fs.Path(_made.paths.pop())
        path.getFileSystem(conf).delete(path, True)
