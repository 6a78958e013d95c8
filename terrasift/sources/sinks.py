"""Sinks. Spark's commit protocol makes each write all or nothing; chunks and status rows make jobs resumable."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import best


def parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def copied(spark: SparkSession, select: str, path: str) -> None:
    """The result of a SELECT as zstandard parquet files at path, in place of what is there, by SQL."""
    spark.sql(f"INSERT OVERWRITE DIRECTORY '{path}' USING parquet OPTIONS (compression 'zstd') {select}")


def _at(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _at(spark, path)
    return files.exists(at)


def replaced(df: DataFrame, path: str) -> None:
    """Parquet written beside path and then renamed into its place: a write that fails leaves what was there."""
    spark, beside = df.sparkSession, f"{path.rstrip('/')}.tmp-{uuid.uuid4().hex}"
    files, at = _at(spark, path)
    try:
        df.write.option("compression", "zstd").parquet(beside)
        files.delete(at, True)
        files.rename(_at(spark, beside)[1], at)
    finally:
        files.delete(_at(spark, beside)[1], True)


def one_file(df: DataFrame, path: str) -> None:
    """df, which must fit a task, as one parquet file of this name."""
    spark, beside = df.sparkSession, f"{path}.tmp-{uuid.uuid4().hex}"
    df.coalesce(1).write.option("compression", "zstd").parquet(beside)
    files, at = _at(spark, path)
    part = files.globStatus(_at(spark, f"{beside}/part-*")[1])[0].getPath()
    files.delete(at, True)
    files.rename(part, at)
    files.delete(_at(spark, beside)[1], True)


def put(spark: SparkSession, uri: str, text: str) -> None:
    """One text under a URI, in place of what is there."""
    files, at = _at(spark, uri)
    out = files.create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def leaderboard(df: DataFrame, path: str, group: str, order: list, columns: list[str]) -> None:
    """A JSON line for each group: its best row."""
    json(best(df, [group], order).select(group, *columns).orderBy(group).coalesce(1), path)  # a row for each group


def chunked(df: DataFrame, path: str, chunk: str) -> None:
    """Each chunk in a folder of its own; chunks that df doesn't hold stay as they are."""
    df.repartition(chunk).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(chunk).parquet(path)


def csv(df: DataFrame, path: str, columns: list[str], order: list) -> None:
    df.orderBy(*order).select(*columns).write.mode("overwrite").csv(path, header=True)


def json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def json_append(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def warehouse(df: DataFrame, table: str) -> None:
    """Appends, creating the table if there is none."""
    df.write.mode("append").saveAsTable(table)


def keyed(df: DataFrame, path: str, key: str) -> None:
    """Blobs by key: a folder for each."""
    chunked(df, path, key)


def has_key(spark: SparkSession, path: str, key: str, value) -> bool:
    """Whether keyed() has written the blob of a key."""
    return exists(spark, f"{path.rstrip('/')}/{key}={value}")


def report(checks: DataFrame, title: str) -> str:
    """Markdown of (name, value, verdict), one line for each check of an audit."""
    rows = checks.select("name", F.col("value").cast("string").alias("value"), "verdict").orderBy("name").collect()  # an audit has a handful
    worst = next((v for v in ("FAIL", "WARN") if any(r.verdict == v for r in rows)), "PASS")
    return "\n".join([f"# {title}: {worst}", "", "| check | value | verdict |", "| --- | --- | --- |", *[f"| {r.name} | {r.value} | {r.verdict} |" for r in rows], ""])
