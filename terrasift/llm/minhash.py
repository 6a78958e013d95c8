"""HyperMinHash near-duplicate detection.

A text's set is its distinct word shingles. One sorted pass over the set's 64-bit hashes fills REGISTERS
buckets: the leading bits name the bucket, and of the least remainder a register keeps the count of leading
zeros and MANTISSA bits of what follows, 16 bits in all. Empty registers of short texts borrow from full
ones in a fixed pseudo-random order. BAND registers make a band; texts that share a band are candidates.
Candidates pass if the Jaccard estimate from equal registers, less the expected accidental matches, is
near the threshold, and are then verified on the full sets by 100 * intersection >= 80 * union in integers.

Equal sets are collapsed to one class first (per salted group, so a hot class is many tasks' work). The members of a
shared band are compared to its least one, so that n alike texts cost about n comparisons; pairs that this leaves
unlinked are sought by how they differ from it (see _far_pairs), not by listing them.

Recall: at similarity 0.8 the chance that none of the 42 bands agrees is (1 - 0.8**6)**42, about 3e-6.

Cases: null, empty or blank texts have an empty set, link with nothing and are kept. Texts with fewer words
than a shingle are one shingle, the whole sequence. Repeated rows (same doc_id) share their class; if their texts
differ, the least text by code point stands for all of them. A row without doc_id is linked with nothing: its component_id is
null and it is kept. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_limits, class_min, components, cut, cut_mark, cut_release, shared_members, small, stars, with_components
from .words import hashes, mix

REGISTERS, BAND, MANTISSA, SALTS = 256, 6, 10, 16
EMPTY = 0xFFFF
_SHIFT = np.uint64(64 - int(math.log2(REGISTERS)))
_ODD = [np.uint64(x | 1) for x in (0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x9C6E6877736C46E3)]
_LENDERS = np.random.default_rng(7).permuted(np.tile(np.arange(REGISTERS, dtype=np.int16), (600, 1)), axis=1)


def sets(h: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and where each text's begin and the last ends."""
    n = np.diff(at)
    many = max(0, len(h) - k + 1)  # a batch may have fewer words than a shingle
    rolled = np.zeros(many, dtype=np.uint64)
    for j in range(k):
        rolled += h[j : many + j] * (_ODD[j % 5] + np.uint64(2 * (j // 5)))
    rolled = mix(rolled)
    out, size = [], np.zeros(len(n), dtype=np.int64)
    for d in range(len(n)):
        if n[d] >= k:
            own = np.sort(rolled[at[d] : at[d + 1] - k + 1])
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif n[d]:
            own = h[at[d] : at[d + 1]]
            own = mix(np.array([sum(int(x) * int(_ODD[j % 5]) for j, x in enumerate(own)) + int(n[d]) & 0xFFFFFFFFFFFFFFFF], dtype=np.uint64))
        else:
            continue
        size[d] = len(own)
        out.append(own)
    return (np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)), np.concatenate(([0], np.cumsum(size)))


def registers(s: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(texts, REGISTERS) of 16-bit registers; rows of empty sets are EMPTY."""
    docs = len(at) - 1
    own = np.repeat(np.arange(docs), np.diff(at))
    key = own * REGISTERS + (s >> _SHIFT).astype(np.int64)
    first = np.flatnonzero(np.diff(key, prepend=-1))
    rest = (s[first] & ((np.uint64(1) << _SHIFT) - np.uint64(1))).astype(np.float64) + 1.0
    code = (rest.view(np.uint64) >> np.uint64(52 - MANTISSA)) - np.uint64(1023 << MANTISSA)  # exponent: 57 - zeros
    regs = np.full(docs * REGISTERS, EMPTY, dtype=np.uint16)
    regs[key[first]] = code.astype(np.uint16)
    regs = regs.reshape(docs, REGISTERS)
    todo = np.flatnonzero((regs == EMPTY).any(axis=1) & (np.diff(at) > 0))
    full = regs.copy()
    for lend in [*_LENDERS, *((np.arange(REGISTERS) + j) % REGISTERS for j in range(1, REGISTERS))]:
        if not len(todo):
            break
        got = regs[todo][:, lend]
        want = full[todo]
        full[todo] = np.where(want == EMPTY, got, want)
        todo = todo[(full[todo] == EMPTY).any(axis=1)]
    return full


def sketch(docs: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, f1, f2, regs): f1 and f2 are sums that identify the set, regs has four registers a long."""
    arrow_limits(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s, at = sets(*hashes(batch.column(1)), k)
            total = np.concatenate(([np.uint64(0)], np.cumsum(s, dtype=np.uint64)))
            other = np.concatenate(([np.uint64(0)], np.cumsum(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)))
            f1, f2 = (mix(x[at[1:]] - x[at[:-1]]).view(np.int64) for x in (total, other))
            regs = registers(s, at)
            longs = np.ascontiguousarray(regs).view(np.int64)
            filled = np.diff(at) > 0
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(filled * longs.shape[1]))), type=pa.int32()), pa.array(longs[filled].reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(np.diff(at)), pa.array(f1), pa.array(f2), lists], names=["doc_id", "n_shingles", "f1", "f2", "regs"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col).mapInArrow(run, "doc_id long, n_shingles long, f1 long, f2 long, regs array<long>")


def bands(reps: DataFrame) -> DataFrame:
    """(bucket, node): the hash of each band's number and registers."""
    count = REGISTERS // BAND

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            regs = batch.column(1).flatten().to_numpy(zero_copy_only=False).view(np.uint16).reshape(-1, REGISTERS)
            key = np.zeros((len(regs), count), dtype=np.uint64)
            for j in range(BAND):
                key = mix(key ^ regs[:, j : count * BAND : BAND].astype(np.uint64) + np.uint64(j << 32))
            key = mix(key + np.arange(count, dtype=np.uint64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(regs) + 1) * count, type=pa.int32()), pa.array(key.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["node", "keys"])

    keyed = reps.select("doc_id", "regs").mapInArrow(run, "node long, keys array<long>")
    return keyed.select(F.explode("keys").alias("bucket"), "node")


def _estimate(pairs: DataFrame, percent: int) -> DataFrame:
    """(a, b) whose collision-corrected estimate is within six standard errors of the threshold, or above it."""
    need = percent / 100

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (batch.column(j).flatten().to_numpy(zero_copy_only=False).view(np.uint16).reshape(-1, REGISTERS) for j in (2, 3))
            na, nb = (batch.column(j).to_numpy(zero_copy_only=False) for j in (4, 5))
            equal = (a == b).sum(axis=1)
            by_chance = REGISTERS * 2.0**-MANTISSA * 0.17  # of two unlike least values: equal zeros (1/3) times equal mantissa, about half of the time full
            estimate = (equal - by_chance) / (REGISTERS - by_chance)
            least, most = np.minimum(na, nb), np.maximum(na, nb)
            slack = 6 * np.sqrt(need * (1 - need) / np.minimum(REGISTERS, least))
            yield batch.filter(pa.array((estimate >= need - slack) & (100 * least >= percent * most))).select([0, 1])

    return pairs.mapInArrow(run, "a long, b long")


def _verify(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    left, right = (texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"t{x}")) for x in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, ata = sets(*hashes(batch.column(2)), k)
            b, atb = sets(*hashes(batch.column(3)), k)
            keep = np.zeros(batch.num_rows, dtype=bool)
            for j in range(batch.num_rows):
                x, y = a[ata[j] : ata[j + 1]], b[atb[j] : atb[j + 1]]
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep[j] = 100 * both >= percent * (len(x) + len(y) - both) and both > 0
            yield batch.filter(pa.array(keep)).select([0, 1])

    return pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


DIFFERENCES = "p long, u long, cp long, cu long, n long, a long, d long, added array<long>, lost array<long>"


def _differences(k: int):
    """A function of batches (p, u, cp, cu, text of p, text of u) to DIFFERENCES."""

    def packed(parts: list[np.ndarray]) -> pa.ListArray:
        at = np.concatenate(([0], np.cumsum([len(x) for x in parts])))
        return pa.ListArray.from_arrays(pa.array(at, type=pa.int32()), pa.array(np.concatenate([*parts, np.zeros(0, dtype=np.uint64)]).view(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, atx = sets(*hashes(batch.column(4)), k)
            y, aty = sets(*hashes(batch.column(5)), k)
            both = [(x[atx[j] : atx[j + 1]], y[aty[j] : aty[j + 1]]) for j in range(batch.num_rows)]
            more = [np.setdiff1d(v, u, assume_unique=True) for u, v in both]
            less = [np.setdiff1d(u, v, assume_unique=True) for u, v in both]
            a, d = (pa.array([len(z) for z in part], type=pa.int64()) for part in (more, less))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(np.diff(aty)), a, d, packed(more), packed(less)], names=["p", "u", "cp", "cu", "n", "a", "d", "added", "lost"])

    return run


def _centres(families: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """(p, q): for each family (p, u), its member q that is nearest to what most of the members hold.

    Against p, a member adds and loses shingles; those that over half of the members add or lose are what most hold.
    The nearest member has the least of a + d - 2 * (how many of these it adds or loses); p itself has 0.
    """
    tp, tu = (texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"t{x}")) for x in "pu")
    none = F.lit(None).cast("long")
    rows = families.join(tp, "p").join(tu, "u").select("p", "u", none.alias("cp"), none.alias("cu"), "tp", "tu")
    rows = cut(rows.mapInArrow(_differences(k), DIFFERENCES), "centre-differences")
    size = rows.groupBy("p").agg(F.count(F.lit(1)).alias("members"))
    sides = rows.select("p", "u", F.explode("added").alias("e")).unionAll(rows.select("p", "u", F.explode("lost").alias("e")))
    usual = sides.groupBy("p", "e").agg(F.count(F.lit(1)).alias("m")).join(size, "p").where("2 * m > members").select("p", "e")
    with_usual = sides.join(usual, ["p", "e"]).groupBy("p", "u").agg(F.count(F.lit(1)).alias("s"))
    score = rows.select("p", "u", "a", "d").join(with_usual, ["p", "u"], "left").select("p", "u", (F.col("a") + F.col("d") - 2 * F.coalesce("s", F.lit(0))).alias("far"))
    least = score.groupBy("p").agg(F.min(F.struct("far", "u")).alias("b"))
    return least.select("p", F.when(F.col("b.far") < 0, F.col("b.u")).otherwise(F.col("p")).alias("q"))


def _far_pairs(families: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b): the u of one p, from different components, that can be linked, by how they differ from p.

    With A = u - p (a elements), D = p - u (d) and n = |u|: u and v are linked if 2|Au & Av| + 2|Du & Dv| is at least
    au + du + av + dv - c(nu + nv), c = (1 - t) / (1 + t) for the threshold t. Either they share an element of A: then one of
    the floor(n(1 - t) / t) + 1 rarest of each (prefix filtering), found by a join on the element. Or 2 min(du, dv) reaches
    that bound alone: for du <= dv, x(u) + y(v) <= 0 with x = a - d - cn and y = a + d - cn, and running minima over d leave
    the few u and v that can meet it. Both ways are complete; nodes far from p and from each other are never paired.
    """
    c, most = (100 - percent) / (100 + percent), (100 - percent) / percent
    tp, tu = (texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"t{x}")) for x in "pu")

    run = _differences(k)
    rows = families.join(tp, "p").join(tu, "u").select("p", "u", "cp", "cu", "tp", "tu")
    rows = cut(rows.mapInArrow(run, DIFFERENCES), "differences")

    added = rows.select("p", "u", "cp", "cu", "n", "a", F.explode("added").alias("e"))
    # elements that the same nodes added are one: edits make runs of shingles
    shared = added.groupBy("p", "e").agg(F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("u")).alias("who")).where("m > 1")
    runs = shared.groupBy("p", "m", "who").agg(F.min("e").alias("e"), F.count(F.lit(1)).alias("weight")).select("p", "e", "m", "weight")
    own = Window.partitionBy("p", "u")
    before = F.coalesce(F.sum("weight").over(own.orderBy("m", "e").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = added.join(runs, ["p", "e"]).withColumn("rank", F.col("a") - F.sum("weight").over(own) + before + 1)
    first = cut(ranked.where(F.col("rank") <= F.floor(F.col("n") * most + 1e-9) + 1).select("p", "e", "u", "cp", "cu"), "rarest")
    other = first.select("p", "e", F.col("u").alias("v"), F.col("cu").alias("cv"))
    pairs = first.where("cu != cp").join(other, ["p", "e"]).where("cu != cv and (cv = cp or u < v)").select("u", "v")

    bounds = rows.select("p", "u", "cp", "cu", "d", (F.col("a") - F.col("d") - c * F.col("n")).alias("x"), (F.col("a") + F.col("d") - c * F.col("n")).alias("y"))
    by_d = bounds.groupBy("p", "d").agg(F.min("x").alias("x"), F.min("y").alias("y"))
    up, down = Window.partitionBy("p").orderBy("d"), Window.partitionBy("p").orderBy(F.desc("d"))
    by_d = by_d.select("p", "d", F.min("x").over(up).alias("least_x"), F.min("y").over(down).alias("least_y"))
    bounds = cut(bounds.join(by_d, ["p", "d"]), "bounds")
    # a family is dealt over SALTS tasks: its u by a salt, all its v that can meet one of them to every salt
    left = bounds.where("x + least_y <= 1e-9").select("p", "u", "cu", "cp", "d", "x", F.pmod(F.xxhash64("u"), F.lit(SALTS)).alias("salt"))
    right = bounds.where("y + least_x <= 1e-9").select("p", F.col("u").alias("v"), F.col("cu").alias("cv"), F.col("d").alias("dv"), "y")
    right = right.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>")))
    can = "u != v and cu != cv and d <= dv and x + y <= 1e-9 and (cu != cp or cv != cp)"
    pairs = pairs.union(left.join(right, ["p", "salt"]).where(can).select("u", "v"))
    return pairs.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()


def _linked(reps: DataFrame, verify, far, centres) -> DataFrame:
    """(node, comp) of all linked nodes.

    Buckets whose least nodes are in one component become one family, of (p, u), p being that component's node with most links, or
    the node that ``centres`` names in its place. Members are compared to p; ``far`` takes families (p, u, cp, cu) with
    components and gives the (a, b) among the u of one p, from different components, that may be linked.
    """
    members = shared_members(bands(reps), "near", counted=True)
    edges, comps = stars(members, verify, "near")
    large = members.where("n > 2").select("lo", "node").distinct()
    if large.isEmpty():
        return comps
    ends = edges.select(F.col("a").alias("node")).union(edges.select("b")).groupBy("node").count()
    centre = comps.join(ends, "node").groupBy("comp").agg(F.max_by("node", F.struct("count", -F.col("node"))).alias("centre"))
    of_lo = comps.select(F.col("node").alias("lo"), F.col("comp").alias("cp"))
    each = large.join(of_lo, "lo", "left").join(centre.withColumnRenamed("comp", "cp"), "cp", "left").withColumn("p", F.coalesce("centre", "lo"))
    each = cut(each.select("p", F.col("node").alias("u")).union(each.select("p", "lo")).where("p != u").distinct(), "near-families")
    moved = each.join(cut(centres(each), "near-centres"), "p")
    each = cut(moved.select(F.col("q").alias("p"), "u").union(moved.select("q", "p")).where("p != u").distinct(), "near-families")

    tried = with_components(each, comps, "p", "u").where("ca != cb").select(F.least("p", "u").alias("a"), F.greatest("p", "u").alias("b")).distinct()
    edges = cut(edges.union(verify(tried).select("a", "b")), "near-centred")
    comps = components(edges, "near-c")
    families = cut(with_components(each, comps, "p", "u").withColumnsRenamed({"ca": "cp", "cb": "cu"}), "near-known")
    mixed = families.groupBy("p").agg(F.bool_or(F.col("cu") != F.col("cp")).alias("m"), F.count(F.lit(1)).alias("n")).where("m and n > 1").select("p")
    found = cut(verify(far(families.join(mixed, "p"))).select("a", "b"), "near-last")
    return comps if found.isEmpty() else components(edges.union(found), "near-final")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row for each row of docs."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    words = rows.where("doc_id is not null")
    repeated = cut(words.groupBy("doc_id").agg(F.count(F.lit(1)).alias("times")).where("times > 1"), "repeated-ids")
    if not repeated.isEmpty():
        ids = small(repeated.select("doc_id"))
        words = words.join(ids, "doc_id", "left_anti").unionByName(words.join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text")))
    mark = cut_mark()
    sketches = cut(sketch(words, k), "sketch")
    full = sketches.where("n_shingles > 0").select("doc_id", "n_shingles", "f1", "f2")
    classed = class_min(full, ["n_shingles", "f1", "f2"], "doc_id", "rep").select("doc_id", "n_shingles", "rep")
    classes = cut(classed.union(sketches.where("n_shingles = 0").select("doc_id", "n_shingles", F.lit(None).cast("long"))), "classes")
    reps = cut(sketches.join(small(classes.where("doc_id = rep").select("doc_id"), 100_000), "doc_id").select("doc_id", "n_shingles", "regs"), "reps")
    cut_release(docs.sparkSession, mark, mark + 1)

    ra, rb = (reps.select(F.col("doc_id").alias(x), F.col("regs").alias(f"r{x}"), F.col("n_shingles").alias(f"n{x}")) for x in "ab")
    near_size = f"100 * least(na, nb) >= {percent} * greatest(na, nb)"

    def texts_of(ids: DataFrame) -> DataFrame:
        return cut(words.join(small(ids), "doc_id"), "texts")

    def verify(pairs: DataFrame) -> DataFrame:
        sided = pairs.join(ra, "a").join(rb, "b").where(near_size)
        near = cut(_estimate(sided.select("a", "b", "ra", "rb", "na", "nb"), percent), "near")
        return _verify(near, texts_of(near.select(F.col("a").alias("doc_id")).union(near.select("b")).distinct()), k, percent)

    def both(families: DataFrame) -> DataFrame:
        return texts_of(families.select(F.col("p").alias("doc_id")).union(families.select("u")).distinct())

    groups = _linked(reps, verify, lambda x: _far_pairs(x, both(x), k, percent), lambda x: _centres(x, both(x), k))
    out = classes.join(groups.select(F.col("node").alias("rep"), "comp"), "rep", "left").select("doc_id", "n_shingles", F.coalesce("comp", "rep", "doc_id").alias("component_id"))
    if not repeated.isEmpty():
        out = out.join(small(repeated), "doc_id", "left").withColumn("_", F.explode(F.sequence(F.lit(1), F.coalesce("times", F.lit(1)).cast("int")))).select("doc_id", "n_shingles", "component_id")
    nameless = sketch(rows.where("doc_id is null"), k).select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"))
    return out.union(nameless).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """docs without near duplicates: of each group, the document of the least doc_id stays (of its repeated rows, one)."""
    gone = near_duplicates(docs, k, percent).where("not kept").select("doc_id").distinct()
    rest = docs.join(small(cut(gone, "gone")), "doc_id", "left_anti").select(docs.columns)
    repeated = cut(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    if repeated.isEmpty():
        return rest
    repeated = small(repeated)
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_last()))
    one = rest.join(repeated, "doc_id", "left_semi").withColumn("__first", first).where("__first = 1").select(docs.columns)
    return rest.join(repeated, "doc_id", "left_anti").select(docs.columns).unionByName(one)
