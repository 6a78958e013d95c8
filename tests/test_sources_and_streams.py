"""Readers, sinks, incremental folds, sampling and streams."""

import json
import os

import pytest
from pyspark.sql import functions as F

from terrasift.operators import incremental, sampling
from terrasift.sources import readers, sinks
from terrasift.streaming import live


def test_csv_keeps_the_text_of_coordinates(spark, tmp_path):
    (tmp_path / "a.csv").write_text("canonical_project_name,state,lat_raw,lng_raw,site_type,announcement_date\nA,TX,30.500,-99.1,greenfield,2020\nB,TX,,x,,\n")
    a, b = readers.csv(spark, str(tmp_path / "a.csv")).orderBy("canonical_project_name").collect()
    assert (a.lat_raw, a.lat, a.lng) == ("30.500", 30.5, -99.1) and (b.lat, b.lng) == (None, None)


def test_chunks_skip_sidecars_and_name_their_file(spark, tmp_path):
    for name in ("14RNV", "14RNV_emb", "15RTP"):
        spark.range(2).coalesce(1).write.parquet(str(tmp_path / "w"), mode="overwrite")
        part = next(p for p in os.listdir(tmp_path / "w") if p.endswith(".parquet"))
        os.makedirs(tmp_path / "in", exist_ok=True)
        os.rename(tmp_path / "w" / part, tmp_path / "in" / f"{name}.parquet")
    got = readers.chunks(spark, str(tmp_path / "in" / "*.parquet"))
    assert sorted((r.mgrs_tile, r.id) for r in got.collect()) == [("14RNV", 0), ("14RNV", 1), ("15RTP", 0), ("15RTP", 1)]


def test_geojson_blobs_and_missing_tables(spark, tmp_path):
    doc = {"type": "FeatureCollection", "features": [{"properties": {"name": n}, "geometry": {"type": "Point", "coordinates": [1, 2]}} for n in ("x", "y")]}
    path = tmp_path / "f.geojson"
    path.write_text(json.dumps(doc, indent=1))
    assert [r.name for r in readers.feature_collection(spark, str(path), ["y"]).collect()] == ["y"]
    assert json.loads(readers.blobs(spark, str(path)).first().text) == doc
    assert readers.or_empty(spark, str(tmp_path / "none"), "a long").columns == ["a"]


def test_windows_turn_errors_into_rows(spark):
    boxes = spark.createDataFrame([(1, "u", 0.0, 0.0, 1.0, 1.0), (2, "bad", 0.0, 0.0, 1.0, 1.0)], "id long, uri string, xmin double, ymin double, xmax double, ymax double")

    def read(uri, box):
        if uri == "bad":
            raise ValueError("no such window")
        return [box[2], box[3]]

    got = {r.id: r for r in readers.windows(boxes, read).collect()}
    assert got[1].pixels == [1.0, 1.0] and got[1].error is None and "no such window" in got[2].error


def test_search_source_asks_each_key(spark):
    spark.dataSource.register(readers.search_source("catalogue", lambda key: [(key, k) for k in range(2)], "key string, n int"))
    rows = spark.read.format("catalogue").option("keys", "a,b").load().collect()
    assert sorted(map(tuple, rows)) == [("a", 0), ("a", 1), ("b", 0), ("b", 1)]


def test_retry_waits_longer_each_time():
    waits, calls = [], []

    def call():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return "ok"

    assert readers.retried(call, 4, 0.5, jitter=0.0, sleep=waits.append) == "ok" and waits == [0.5, 1.0]
    calls.clear()
    waits.clear()
    with pytest.raises(OSError):
        readers.retried(lambda: calls.append(1) or (_ for _ in ()).throw(OSError()), 6, 8.0, 16.0, 1.0, waits.append)
    assert len(waits) == 5 and all(8 <= w <= 9 for w in waits[:1]) and all(16 <= w <= 17 for w in waits[1:])


def test_slow_calls_time_out():
    import time

    with pytest.raises(TimeoutError):
        readers.timed(lambda: time.sleep(2), 0.1)
    assert readers.timed(lambda: 5, 2) == 5


def test_a_failed_write_leaves_what_was_there(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replaced(spark.range(5), path)
    bad = spark.range(10).select(F.when(F.col("id") < 9, F.col("id")).otherwise(F.raise_error(F.lit("broken"))).alias("id"))
    with pytest.raises(Exception, match="broken"):
        sinks.replaced(bad, path)
    assert spark.read.parquet(path).count() == 5 and [f for f in os.listdir(tmp_path) if not f.startswith(".")] == ["t"]


def test_warehouse_creates_and_appends(spark):
    spark.sql("DROP TABLE IF EXISTS deltas")
    for _ in range(2):
        sinks.warehouse(spark.range(3), "deltas")
    assert spark.table("deltas").count() == 6
    spark.sql("DROP TABLE deltas")


def test_only_touched_buckets_are_written_and_old_versions_go(spark, tmp_path):
    src, table = tmp_path / "in", tmp_path / "t"
    schema = "k long, v long"
    run = lambda: live.upserts(live.event_stream(spark, str(src), schema), str(table), str(tmp_path / "cp"), ["k"], ["v"], 4).awaitTermination()
    for n, rows in enumerate([[(k, 1) for k in range(40)], [(1, 2)], [(1, 3)], [(1, 4)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(src), mode="append")
        run()
        if n:
            assert len([x for x in os.listdir(table / f"version={n}") if x.startswith("_bucket")]) == 1
    got = {r.k: r.v for r in live.current(spark, str(table)).collect()}
    assert got == {k: 4 if k == 1 else 1 for k in range(40)}
    left = [len([x for x in os.listdir(table / f"version={n}") if x.startswith("_bucket")]) for n in range(4)]
    assert left[0] == 3 and left[1] == 0 and left[2] == left[3] == 1


def test_the_entry_imports_without_the_optional_parts(tmp_path):
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(f"{root}/{name}"):
            shutil.copy(f"{root}/{name}", tmp_path)
    shutil.copytree(f"{root}/terrasift", tmp_path / "terrasift", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 200 and set(e.oracle_sql()) <= set(q) and not [k for k in q if k.startswith(('op', 'pipeline'))]"
    for gone in (False, True):
        if gone and (tmp_path / "corpus_pipeline.py").exists():
            os.remove(tmp_path / "corpus_pipeline.py")
        done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120)
        assert done.returncode == 0, done.stderr


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    sinks.chunked(df, str(tmp_path / "c"), "k")
    sinks.chunked(df.where("k = 2").withColumn("v", F.lit("new")), str(tmp_path / "c"), "k")
    assert {r.k: r.v for r in spark.read.parquet(str(tmp_path / "c")).collect()} == {1: "a", 2: "new"}
    for _ in range(2):
        sinks.json_append(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 4
    sinks.csv(df, str(tmp_path / "s"), ["v"], [F.desc("k")])
    assert [r.v for r in spark.read.csv(str(tmp_path / "s"), header=True).collect()] == ["b", "a"]
    text = sinks.report(spark.createDataFrame([("a", 1.0, "PASS"), ("b", 2.0, "WARN")], "name string, value double, verdict string"), "Audit")
    assert text.startswith("# Audit: WARN") and "| b | 2.0 | WARN |" in text


def test_upsert_and_log_fold(spark):
    log = spark.createDataFrame([("a", 1, "x", False), ("a", 2, "y", False), ("b", 1, "x", False), ("b", 2, "x", True), ("b", 3, "z", False), ("c", 1, "q", True)], "k string, t long, v string, gone boolean")
    assert sorted((r.k, r.v) for r in incremental.fold(log, ["k"], ["t"], F.col("gone")).collect()) == [("a", "y"), ("b", "z")]
    out = incremental.upsert(log.select("k", "v"), spark.createDataFrame([("a", "new")], "k string, v string"), ["k"])
    assert {(r.k, r.v) for r in out.collect()} == {("a", "new"), ("b", "x"), ("b", "z"), ("c", "q")}
    assert incremental.batch_size(24, 4, 5) == 4 and incremental.batch_size(1, 4, 5) == 1 and incremental.batch_size(9, 4, 0) == 64


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(500)
    a = [r.id for r in sampling.sample(df.repartition(7), "id", 20, "s").collect()]
    assert a == [r.id for r in sampling.sample(df.coalesce(1), "id", 20, "s").collect()] and len(set(a)) == 20
    assert sampling.sample(spark.range(3), "id", 20, "s").count() == 3
    capped = sampling.half_capped(df.withColumn("y", F.col("id") < 400), F.col("y"), "id", 50, "s")
    assert capped.where("y").count() == 25 and capped.count() == 50


def test_stream_upserts_and_heartbeat(spark, tmp_path):
    day = lambda rows: spark.createDataFrame(rows, "k string, ts timestamp, v long, bad boolean")
    src = tmp_path / "in"
    stamp = lambda s: __import__("datetime").datetime.fromisoformat(s)
    day([("a", stamp("2024-01-01T00:10"), 1, False), ("b", stamp("2024-01-01T00:20"), 1, True)]).coalesce(1).write.parquet(str(src), mode="append")
    schema = "k string, ts timestamp, v long, bad boolean"
    run = lambda: live.upserts(live.event_stream(spark, str(src), schema), str(tmp_path / "t"), str(tmp_path / "cp"), ["k"], ["ts", "v"]).awaitTermination()
    run()
    day([("a", stamp("2024-01-01T05:10"), 7, False)]).coalesce(1).write.parquet(str(src), mode="append")
    run()
    assert {r.k: r.v for r in live.current(spark, str(tmp_path / "t")).collect()} == {"a": 7, "b": 1}
    beat = live.heartbeat(live.event_stream(spark, str(src), schema, 9), "ts", F.col("bad"))
    q = beat.writeStream.format("memory").queryName("beat").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.start.hour, r.n, r.n_err) for r in spark.table("beat").collect()) == [(0, 2, 1), (5, 1, 0)]
    assert live.eta_seconds(10, 30, 5.0) == 10.0 and live.eta_seconds(0, 30, 5.0) is None


def test_scratch_tables_are_released(spark):
    from terrasift.sources import scratch

    scratch.release(spark)
    path = scratch.written(spark.range(3), "some").inputFiles()[0].rsplit("/", 1)[0]
    assert sinks.exists(spark, path)
    scratch.release(spark)
    assert not sinks.exists(spark, path)


def test_numbers_keep_their_text(spark, tmp_path):
    """Signs of zero, more than two decimals and great numbers go through a CSV file as DuckDB writes them."""
    import duckdb

    import __spark_entry__ as entry

    values = [-0.0, 0.0, 711.56, 0.125, -1e-5, 12345678.9, 1e7, 1e16, 2.0**-44, 123456789012345680.0, float("nan"), float("inf"), None]
    spark.createDataFrame(list(enumerate(values)), "c_custkey long, c_acctbal double").coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet/*.parquet'")
    want = con.sql(entry.oracle_sql()["s06_csv_with_text_copy"]).fetchall()
    got = entry.queries()["s06_csv_with_text_copy"](spark, str(tmp_path)).select("c_custkey", "lat_raw", "lat").collect()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got)
