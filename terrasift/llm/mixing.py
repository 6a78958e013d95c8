"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Each source's documents are laid end to end in the order of a hash and cut into blocks of BLOCK words. Slot k of the schedule
has the point frac((k + 1) * golden ratio), which falls into one source's share of the cumulative targets; a source's slots, ranked,
take its blocks in turn, going round again when they are used up, until its target is reached (the last slot takes
a part of a block). So any stretch of the schedule has each source near its weight. The schedule has as many slots as all
targets need together; what a source then still needs follows at the end, source by source, so the number of slots
follows the blocks, however small a source is beside others.

Ranks and running sums are worked out over all tasks (common.running): no source's rows meet in one task, and sources may be many.
A point finds its source by equal cells of [0, 1), then by the shares' exact bounds.

Cases: null, empty and blank texts have size 0 and are taken 0 words. A null source is a source of its own, the last in order.
Equal rows are rows of their own. If all sizes are 0, all targets are. An empty table gives no rows. Other columns are left out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, running, small

BLOCK, CELLS, WEIGHTS, SHARE, MOST = 4096, 4096, (3, 1, 2), 1.5, 2
GOLDEN = (math.sqrt(5) - 1) / 2


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target, place) of (source, source_size): shares by weight of SHARE of all, at most MOST times a source's size;
    place is the source's number in the order of code points.

    A source reaches its bound where bound / weight is under the level that fills the total, so running sums over the sources,
    in that order, find the level.
    """
    cycle = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    placed = running(sizes, [F.col("source").isNull(), F.col("source")], {}, "mix-sources").withColumnRenamed("at", "place")
    weighed = placed.withColumn("weight", F.get(cycle, (F.col("place") % len(WEIGHTS)).cast("int"))).withColumn("bound", F.col("source_size") * float(MOST))
    filled = cut(running(weighed, [F.col("bound") / F.col("weight"), F.col("place")], {"before": "bound", "used": "weight"}, "mix-levels").drop("at"), "mix-filled")
    all_ = filled.agg(F.sum("source_size").alias("n"), F.sum("weight").alias("w")).first()
    if all_.n is None:
        return filled.select("source", "source_size", F.lit(0.0).alias("target"), "place")
    level = (all_.n * SHARE - F.col("before")) / (all_.w - F.col("used"))
    levels = filled.withColumn("level", level).withColumn("full", F.col("level") * F.col("weight") >= F.col("bound"))
    free = levels.where("not full").agg(F.max("level").alias("m")).first().m or 0.0  # the level is greatest where the first source is not full
    return levels.select("source", "source_size", F.when(F.col("full"), F.col("bound")).otherwise(F.col("weight") * free).alias("target"), "place")


def laid_out(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """Rows of (doc_id, source, size) with their source's ``place`` and ``start``: where each begins in its source's line of words, in the order of md5 of the id."""
    first = running(goals.select("place", "source", "source_size"), [F.col("place")], {"base": "source_size"}, "mix-bases")
    first = first.select("place", F.col("source").alias("_s"), "base")
    named = sized.join(small(first, 10_000), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    h = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    lines = running(named.withColumn("_h", h), [F.col(c) for c in ("place", "_h", "doc_id", "size")], {"_words": "size"}, "mix-lines")
    return lines.select("doc_id", "source", "size", "place", (F.col("_words") - F.col("base")).alias("start"))


def schedule(goals: DataFrame, block: int = BLOCK) -> DataFrame:
    """(slot, place, source, rank, part, words): the blocks that each slot takes, for (source, source_size, target, place)."""
    spark = goals.sparkSession
    goals = goals.where("target > 0").withColumn("goal", F.floor("target").cast("long")).withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long"))
    # every round of a source's line ends in a short block, so its slots are counted by rounds
    rounds = F.floor(F.col("goal") / F.col("source_size"))
    rest = F.col("goal") - rounds * F.col("source_size")
    goals = goals.withColumn("need", (rounds * F.col("blocks") + F.ceil(rest / block)).cast("long"))
    goals = cut(running(goals, [F.col("place")], {"lo": "target"}, "mix-shares").drop("at"), "mix-goals")
    all_ = goals.agg(F.sum("need").alias("slots"), F.max(F.col("lo") + F.col("target")).alias("whole")).first()
    slots, whole = int(all_.slots or 0), float(all_.whole or 1.0)
    cell = lambda x: F.least(F.floor(x / whole * CELLS), F.lit(CELLS - 1)).cast("long")
    shares = goals.select("place", "lo", (F.col("lo") + F.col("target")).alias("hi"))
    shares = shares.withColumn("_c", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi")))))
    points = spark.range(slots).withColumn("u", F.expr(f"((id + 1) * {GOLDEN!r}D - floor((id + 1) * {GOLDEN!r}D)) * {whole!r}D")).withColumn("_c", cell(F.col("u")))
    drawn = points.join(small(shares, 50_000), "_c").where("u >= lo and u < hi").select("place", F.col("id").alias("slot"))
    ranked = running(drawn, [F.col("place"), F.col("slot")], {}, "mix-slots")
    counts = cut(ranked.groupBy("place").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first")), "mix-counts")
    ranked = ranked.join(small(counts, 10_000), "place").select("place", "slot", (F.col("at") - F.col("first")).alias("rank"))
    lacking = goals.join(counts, "place", "left").select("place", (F.col("need") - F.coalesce("n", F.lit(0))).alias("more"), F.coalesce("n", F.lit(0)).alias("n")).where("more > 0")
    lacking = running(lacking, [F.col("place")], {"shift": "more"}, "mix-closing").withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("more") - 1)))
    closing = lacking.select("place", (F.lit(slots) + F.col("shift") + F.col("k")).alias("slot"), (F.col("n") + F.col("k")).alias("rank"))
    taken = ranked.union(closing).join(small(goals, 10_000), "place").where("rank < need")
    part, begin = F.col("rank") % F.col("blocks"), (F.col("rank") % F.col("blocks")) * block
    left = F.col("goal") - F.floor(F.col("rank") / F.col("blocks")) * F.col("source_size") - begin
    return taken.select("slot", "place", "source", "rank", part.alias("part"), F.least(F.lit(block), F.col("source_size") - begin, left).cast("long").alias("words"))


def mix(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, first_slot (null: not taken), a row for each of docs."""
    sized = cut(docs.select("doc_id", "source", word_count().alias("size")), "mix-sizes")
    goals = cut(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), "mix-targets")
    lines = cut(laid_out(sized, goals).withColumn("row", F.monotonically_increasing_id()), "mix-laid")
    blocks = schedule(goals, block).groupBy("place", "part", "words").agg(F.count(F.lit(1)).alias("times"), F.min("slot").alias("slot"))
    pieces = lines.where("size > 0").withColumn("part", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))))
    met = pieces.join(blocks, ["place", "part"])
    begin = F.greatest("start", F.col("part") * block)
    end = F.least(F.col("start") + F.col("size"), F.col("part") * block + F.col("words"))
    taken = met.withColumn("got", F.greatest(F.lit(0), end - begin) * F.col("times")).where("got > 0").groupBy("row").agg(F.sum("got").alias("taken"), F.min("slot").alias("first_slot"))
    out = lines.join(taken, "row", "left").join(small(goals.select("place", "source_size", "target"), 10_000), "place")
    return out.select("doc_id", "source", "size", "source_size", (F.floor(F.col("target") * 1e6 + 0.5) / 1e6).alias("target"), F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot")
