"""Graph operators: connected components, density clustering, greedy distance dedup."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.kernels import tile_clusters
from ..functions.scalar import DEG_PLAIN
from ..sources.scratch import written
from .spatial import located, radius_join


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, comp) of undirected edges (a, b); comp is the least node that can be reached.

    Every node adopts its least neighbour, pointers are halved to roots, edges contracted to roots, until none is left:
    a number of rounds that follows the logarithm of the longest path.
    """
    edges = written(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while True:
        both = edges.union(edges.select("b", "a"))
        parent = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("comp")), "parents")
        while True:
            up = parent.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
            step = written(parent.join(up, "comp").select("node", F.col("up").alias("comp"), (F.col("up") != F.col("comp")).alias("moved")), "jumps")
            parent = step.select("node", "comp")
            if step.where("moved").isEmpty():
                break
        up = parent.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        labels = parent if labels is None else written(labels.join(up, "comp", "left").select("node", F.coalesce("up", "comp").alias("comp")), "labels")
        ra, rb = parent.select(F.col("node").alias("a"), F.col("comp").alias("ra")), parent.select(F.col("node").alias("b"), F.col("comp").alias("rb"))
        edges = written(edges.join(ra, "a").join(rb, "b").where("ra != rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            return labels


def _other(points: DataFrame) -> DataFrame:
    return points.select(F.col("id").alias("rid"), F.col("lat").alias("rlat"), F.col("lon").alias("rlon"))


def near_pairs(points: DataFrame, eps: float) -> DataFrame:
    """(a, b), a < b, of points (id, lat, lon) within eps metres."""
    return radius_join(points.select("id", "lat", "lon"), _other(points), eps).where("id < rid").select(F.col("id").alias("a"), F.col("rid").alias("b"))


def places(points: DataFrame, parent: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(id, place) of points (id, lat, lon), and (id, lat, lon, n) of their places: the least id at a place stands for it, n are there.

    Points of different parents are at different places. Those without coordinates or parent are at none.
    """
    keys = ["lat", "lon", *([parent] if parent else [])]
    whole = located(points)
    whole = whole.where(F.col(parent).isNotNull()) if parent else whole
    each = written(whole.groupBy(*keys).agg(F.min("id").alias("place"), F.count(F.lit(1)).alias("n")), "places")
    members = whole.select("id", *keys).join(each.drop("n"), keys).select("id", "place")
    return members, each.select(F.col("place").alias("id"), *keys, "n")


def dbscan(points: DataFrame, eps: float, min_samples: int, parent: str | None = None) -> DataFrame:
    """(id, cluster, core): a point counts itself; a border point joins the least of its core neighbours' clusters; noise is -1.

    Points at one place have the same neighbours: places are clustered, weighed by their points. Points of different parents, if
    there are any, are never neighbours.
    """
    members, each = places(points, parent)
    other = _other(each) if parent is None else each.select(F.col("id").alias("rid"), F.col("lat").alias("rlat"), F.col("lon").alias("rlon"), F.col(parent).alias("rparent"))
    pairs = radius_join(each.drop("n"), other, eps, same=None if parent is None else (parent, "rparent")).where("id < rid").select(F.col("id").alias("a"), F.col("rid").alias("b"))
    found = clustered(each.select("id", "n"), pairs, min_samples)
    placed = members.join(found.select(F.col("id").alias("place"), "cluster", "core"), "place").select("id", "cluster", "core")
    alone = F.lit(min_samples <= 1)  # points at no place have no neighbours
    out = points.select("id").join(placed, "id", "left")
    return out.select("id", F.coalesce("cluster", F.when(alone, F.col("id")), F.lit(-1)).cast("long").alias("cluster"), F.coalesce("core", alone).alias("core"))


def clustered(nodes: DataFrame, pairs: DataFrame, min_samples: int) -> DataFrame:
    """(id, cluster, core) of nodes (id, n), each of which stands for n points, joined by pairs (a, b), each once."""
    pairs, nodes = written(pairs, "pairs"), written(nodes, "nodes")
    weighed = pairs.join(nodes.select(F.col("id").alias("b"), "n"), "b").select(F.col("a").alias("id"), "n").union(pairs.join(nodes.select(F.col("id").alias("a"), "n"), "a").select(F.col("b").alias("id"), "n"))
    cores = written(nodes.union(weighed).groupBy("id").agg(F.sum("n").alias("n")).where(F.col("n") >= min_samples).select("id"), "cores")
    a, b = cores.select(F.col("id").alias("a")), cores.select(F.col("id").alias("b"))
    comps = connected_components(pairs.join(a, "a").join(b, "b"))
    core = written(cores.join(comps.select(F.col("node").alias("id"), "comp"), "id", "left").select("id", F.coalesce("comp", "id").alias("cluster")), "clusters")
    both = pairs.union(pairs.select("b", "a"))
    loose = nodes.select(F.col("id").alias("a")).join(a, "a", "left_anti")  # only these can be at a border
    border = both.join(loose, "a").join(core.select(F.col("id").alias("b"), "cluster"), "b").groupBy("a").agg(F.min("cluster").alias("near")).select(F.col("a").alias("id"), "near")
    out = nodes.select("id").join(core, "id", "left").join(border, "id", "left")
    return out.select("id", F.coalesce("cluster", "near", F.lit(-1)).cast("long").alias("cluster"), F.col("cluster").isNotNull().alias("core"))


#: Radii that a tile of boxed_clusters() is wide, and nodes in a row of its labels.
TILE, ROW = 16, 4096
#: What a tile knows of a node: it lies in this tile only, in others' margins too, within a radius of this tile, or is only a neighbour of such.
HOME, SHARED, NEAR, OUTER = range(4)


def boxed_clusters(nodes: DataFrame, eps: float, min_samples: int) -> DataFrame:
    """(box, id, cluster): density clusters within each box of nodes (box, id, lat, lon, n), each of which stands for n points; cluster is the box's
    least core id, a border node joins the least of its core neighbours' clusters, noise is left out. Metres are those at the box's mean latitude.

    A box is cut into tiles, from its least coordinates; a tile gets the nodes within two radii, so it knows the core nodes within one, and
    clusters them without making pairs. Components of tiles are one where a core node is in both: only such nodes are edges.
    """
    nodes = written(nodes, "nodes")
    middle = nodes.groupBy("box").agg((F.sum(F.col("lat") * F.col("n")) / F.sum("n")).alias("_mid"), *[f(c).alias(f"_{c}{k}") for c in ("lat", "lon") for k, f in ((0, F.min), (1, F.max))])
    across = DEG_PLAIN * F.cos(F.radians("_mid"))
    middle = middle.select("box", "_mid", *[(F.col(f"_{c}{k}") * by).alias(f"_{v}{k}") for c, v, by in (("lat", "y", DEG_PLAIN), ("lon", "x", across)) for k in (0, 1)])
    placed = nodes.join(middle, "box").select("*", (F.col("lon") * across).alias("x"), (F.col("lat") * DEG_PLAIN).alias("y"))
    wide, reach, margin = TILE * eps, 1.001 * eps, 2.01 * eps
    tile = lambda v, by=0.0: F.floor((F.col(v) - F.col(f"_{v}0") + by) / wide).cast("long")
    spans = lambda v: F.sequence(F.greatest(tile(v, -margin), F.lit(0)), F.least(tile(v, margin), F.floor((F.col(f"_{v}1") - F.col(f"_{v}0")) / wide).cast("long")))
    dealt = placed.withColumns({"_xs": spans("x"), "_ys": spans("y")}).withColumn("_alone", F.size("_xs") * F.size("_ys") == 1)
    dealt = dealt.withColumn("tx", F.explode("_xs")).withColumn("ty", F.explode("_ys"))
    own = (F.col("tx") == tile("x")) & (F.col("ty") == tile("y"))
    within = lambda v: F.col(f"t{v}").between(tile(v, -reach), tile(v, reach))
    part = F.when(own & F.col("_alone"), HOME).when(own, SHARED).when(within("x") & within("y"), NEAR).otherwise(OUTER)
    dealt = dealt.select("box", "tx", "ty", "id", "x", "y", "n", part.alias("part"))

    def run(table: pa.Table) -> pa.Table:
        box, (ids, x, y, n, part) = table["box"][0], (table[c].to_numpy() for c in ("id", "x", "y", "n", "part"))
        label, at, near = tile_clusters(ids, x, y, n, part < OUTER, eps, min_samples)
        core, home = label >= 0, part <= SHARED
        out = []
        for kind, of, members in (("core", label[core & home], ids[core & home]), ("border", near[home[at]], ids[at[home[at]]]), ("shared", label[core & (part != HOME)], ids[core & (part != HOME)])):
            order = np.lexsort((members, of))
            of, members = of[order], members[order]
            starts = np.flatnonzero(np.diff(of, prepend=of[:1] - 1))
            for lo, hi in zip(starts, [*starts[1:], len(of)]):
                out += [(kind, of[lo], members[k : min(k + ROW, hi)]) for k in range(lo, hi, ROW)]
        lists = pa.LargeListArray.from_arrays(np.cumsum([0, *[len(m) for *_, m in out]]), np.concatenate([np.empty(0, np.int64), *[m for *_, m in out]])).cast(pa.list_(pa.int64()))
        return pa.table({"box": pa.array([box.as_py()] * len(out), table.schema.field("box").type), "kind": pa.array([k for k, *_ in out], pa.string()), "label": pa.array([int(v) for _, v, _ in out], pa.int64()), "ids": lists})

    box_type = nodes.schema["box"].dataType.simpleString()
    pairs = written(dealt.groupBy("box", "tx", "ty").applyInArrow(run, f"box {box_type}, kind string, label long, ids array<long>"), "pairs")
    each = lambda kind: pairs.where(F.col("kind") == kind).select("box", "label", F.explode("ids").alias("id"))
    links = written(each("shared").where("label != id").select(F.struct("box", F.col("label").alias("id")).alias("a"), F.struct("box", "id").alias("b")), "links")
    cores, border = each("core"), each("border")
    if not links.isEmpty():
        comps = connected_components(links).select("node.box", F.col("node.id").alias("label"), F.col("comp.id").alias("least"))
        cores, border = (df.join(comps, ["box", "label"], "left").select("box", F.coalesce("least", "label").alias("label"), "id") for df in (cores, border))
    return cores.select("box", "id", F.col("label").alias("cluster")).union(border.groupBy("box", "id").agg(F.min("label").alias("cluster")))



def greedy_dedup(points: DataFrame, radius: float) -> DataFrame:
    """The points that a pass in the order of id keeps, each kept one dropping all later ones within radius.

    Of the points at one place only the first can be kept, so the pass is over places. Rounds: an undecided place without a smaller
    undecided neighbour is kept, its neighbours are dropped.
    """
    _, each = places(points)
    pairs = written(near_pairs(each, radius), "pairs")
    undecided = each.select("id")
    kept = points.select("id", "lat", "lon").where(F.col("lat").isNull() | F.col("lon").isNull() | F.isnan("lat") | F.isnan("lon")).select("id")
    while True:
        blocked = pairs.select(F.col("b").alias("id")).distinct()
        now = written(undecided.join(blocked, "id", "left_anti"), "kept")
        kept = kept.union(now)
        gone = pairs.join(now.select(F.col("id").alias("a")), "a", "left_semi").select(F.col("b").alias("id")).distinct()
        decided = written(now.union(gone), "decided")
        undecided = written(undecided.join(decided, "id", "left_anti"), "undecided")
        if undecided.isEmpty():
            return kept
        out = lambda c: decided.select(F.col("id").alias(c))
        pairs = written(pairs.join(out("a"), "a", "left_anti").join(out("b"), "b", "left_anti"), "pairs")
