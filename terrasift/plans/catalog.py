"""All queries and their DuckDB SQL; importing the modules registers them."""

from __future__ import annotations

import importlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.spatial import radius_join
from .base import QUERIES, SQL, Tables
from .joins import statuses, targets

MODULES = ("predicates", "joins", "aggregations", "ranking", "scalars", "models", "kernels")
for _name in MODULES:
    importlib.import_module(f".{_name}", __package__)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate finalisation: scores joined to candidates, statuses, stable ones rescued near changed ones, and what is kept counted."""
    t = Tables(spark, sf_dir)
    z = statuses(t)
    near = radius_join(z.where("status = 'stable'"), targets(z.where("status = 'changed'")), 6000, how="left_semi").select("id", F.lit(True).alias("rescued"))
    marked = z.join(near, "id", "left").withColumn("status", F.when(F.col("rescued"), "rescued").otherwise(F.col("status")))
    return marked.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.bool_or(F.col("status") != "stable").alias("kept"))


def queries():
    return QUERIES


def oracle_sql():
    return SQL
