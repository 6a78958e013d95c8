"""What the operators of this subpackage share: table reading, lineage cuts, class ids, components."""

from __future__ import annotations

import gc
import tempfile
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ranking

#: Rows up to which a two- or three-column side may be broadcast (about 24 bytes a row); beyond it the join shuffles.
BROADCAST_ROWS = 400_000
#: Arrow batches: bytes and records that one Python worker holds at a time.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 4096


class _Made(threading.local):
    """Paths of the tables that this thread's runs have cut: runs in other threads don't release them."""

    def __init__(self):
        self.paths: list[str] = []


_made = _Made()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_limits(spark: SparkSession) -> None:
    """Bound what an Arrow batch of this session holds, so that a Python worker's memory doesn't follow the length of texts; less stays as it is."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        now = spark.conf.get(key).lower().removesuffix("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one only where it is unset and the master is this machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="terrasift-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write df under the shared folder and read it back: later plans start from these files, which outlive executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/terrasift/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _made.paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_mark() -> int:
    return len(_made.paths)


def cut_release(spark: SparkSession, since: int = 0, until: int | None = None) -> None:
    """Delete the cut tables made from mark ``since`` up to mark ``until``; only for results that are already written."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    end = len(_made.paths) if until is None else until
    for k in range(since, end):
        if _made.paths[k]:
            path = jvm.org.apache.hadoop.fs.Path(_made.paths[k])
            path.getFileSystem(conf).delete(path, True)
            _made.paths[k] = ""


def freed(spark: SparkSession) -> None:
    """Have the driver collect its garbage: the shuffle files of finished writes are deleted only then, and large ones would stay beside each other."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def running(df: DataFrame, order: list[Column], sums: dict[str, str], label: str = "running") -> DataFrame:
    """df with ``at``, the number of rows before each, and sums over them: operators.ranking.running() on cut tables."""
    return ranking.running(df, order, sums, write=cut, label=label)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most ``rows`` rows (counted), else df as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def likely(rows: DataFrame, keys: DataFrame, col: str, most: int = 1 << 30) -> DataFrame:
    """The rows whose ``col``, a long that is a hash, stands in ``keys``, and few others: a join with them then deals little else.

    A bitmap of 16 to 32 bits a key, of ``most`` bits at most, is broadcast in blocks of 512 longs.
    """
    bits = min(most, 1 << max(15, (16 * max(1, keys.count()) - 1).bit_length()))
    place = F.col(col).bitwiseAND(F.lit(bits - 1).cast("long"))
    part = lambda x, by, mask: F.shiftright(x, by).bitwiseAND(F.lit(mask).cast("long"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(F.lit(63).cast("long")).cast("int"))
    marks = keys.select(place.alias("p")).select(F.shiftright("p", 6).alias("w"), one.alias("v"))
    blank = keys.sparkSession.range(bits >> 6).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("v"))
    longs = marks.union(blank).groupBy("w").agg(F.bit_or("v").alias("v"))
    blocks = longs.groupBy(F.shiftright("w", 9).alias("_block")).agg(F.sort_array(F.collect_list(F.struct("w", "v"))).getField("v").alias("_map"))
    found = F.getbit(F.get("_map", part(place, 6, 511).cast("int")), place.bitwiseAND(F.lit(63).cast("long")).cast("int")) == 1
    return rows.join(F.broadcast(blocks), F.shiftright(place, 15) == F.col("_block")).where(found).select(rows.columns)


def crc_mod(col: str, n: int):
    """crc32 of the id as text, mod n (crc32 is not negative)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % n


def class_min(df: DataFrame, keys: list[str], value: str, out: str, salts: int = 32) -> DataFrame:
    """df with ``out``: the least ``value`` of the rows with equal ``keys`` (null keys count as equal).

    Rows of one key are dealt over ``salts`` groups, so a key with a third of all rows isn't one task's work.
    """
    df = df.withColumn("_salt", F.pmod(F.xxhash64(value), F.lit(salts)).cast("int"))
    mine, all_ = [f"_m_{k}" for k in keys], [f"_w_{k}" for k in keys]
    part = df.groupBy(*[F.col(k).alias(m) for k, m in zip(keys, mine)], F.col("_salt").alias("_s")).agg(F.min(value).alias("_part"))
    whole = part.groupBy(*[F.col(m).alias(w) for m, w in zip(mine, all_)]).agg(F.min("_part").alias(out))
    part = part.join(whole, [F.col(m).eqNullSafe(F.col(w)) for m, w in zip(mine, all_)]).select(*mine, "_s", out)
    return df.join(part, [F.col(k).eqNullSafe(F.col(m)) for k, m in zip(keys, mine)] + [F.col("_salt") == F.col("_s")]).drop("_salt", "_s", *mine)


def components(edges: DataFrame, label: str = "cc") -> DataFrame:
    """(node, comp) for all nodes of undirected ``edges`` (a, b); comp is the component's least node.

    Each round, every node adopts its least neighbour, pointers are halved until they end in roots,
    and edges are contracted to roots; rounds go on until no edge joins two roots. Each step is a
    written table, so a lost executor costs one step.
    """
    spark = edges.sparkSession
    edges = cut(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{label}-edges")
    labels = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("comp")), f"{label}-parent")
        while True:
            up = parent.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
            jumped = cut(parent.join(up, "comp").select("node", F.col("up").alias("comp"), (F.col("up") != F.col("comp")).alias("moved")), f"{label}-jump")
            parent = jumped.select("node", "comp")
            if jumped.where("moved").isEmpty():
                break
        if labels is None:
            labels = parent
        else:
            up = parent.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
            labels = cut(labels.join(up, "comp", "left").select("node", F.coalesce("up", "comp").alias("comp")), f"{label}-labels")
        pa, pb = parent.select(F.col("node").alias("a"), F.col("comp").alias("ra")), parent.select(F.col("node").alias("b"), F.col("comp").alias("rb"))
        edges = cut(edges.join(pa, "a").join(pb, "b").where("ra != rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), f"{label}-edges")
        if edges.isEmpty():
            return labels


def shared_members(buckets: DataFrame, label: str, counted: bool = False) -> DataFrame:
    """(bucket, node, lo): the distinct nodes of buckets (bucket, node) that hold unlike ones, and the least of them; counted: with n, the bucket's rows."""
    more = [F.count(F.lit(1)).alias("n")] if counted else []
    sized = buckets.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), *more).where("lo != hi").drop("hi")
    sized = cut(sized, f"{label}-sized")
    freed(buckets.sparkSession)
    members = cut(buckets.join(sized, "bucket").distinct(), f"{label}-members")
    freed(buckets.sparkSession)
    return members


def stars(members: DataFrame, verify: Callable[[DataFrame], DataFrame], label: str) -> tuple[DataFrame, DataFrame]:
    """Links of nodes to the least nodes of their buckets (shared_members): edges (a, b) and their components (node, comp).

    ``verify`` takes (a, b), a < b, and gives the linked ones of them. Each node is first compared to the least of all its buckets'
    least nodes, then to those of them that it isn't joined with yet: n alike nodes cost about n comparisons.
    """
    least = cut(members.groupBy(F.col("node").alias("b")).agg(F.min("lo").alias("a")).where("a != b").select("a", "b"), f"{label}-least")
    edges = cut(verify(least).select("a", "b"), f"{label}-edges")
    comps = components(edges, f"{label}-c")
    untried = members.select(F.col("lo").alias("a"), F.col("node").alias("b")).where("a != b").distinct().join(least, ["a", "b"], "left_anti")
    open_ = with_components(untried, comps).where("ca != cb").select("a", "b")
    more = cut(verify(open_).select("a", "b"), f"{label}-more")
    if more.isEmpty():
        return edges, comps
    edges = cut(edges.union(more), f"{label}-edges")
    return edges, components(edges, f"{label}-c")


def with_components(pairs: DataFrame, comps: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """pairs with their nodes' components ca and cb; a node that is in none is its own."""
    named = lambda node, comp: comps.select(F.col("node").alias(node), F.col("comp").alias(comp))
    both = pairs.join(named(a, "ca"), a, "left").join(named(b, "cb"), b, "left")
    return both.withColumns({"ca": F.coalesce("ca", a), "cb": F.coalesce("cb", b)})
