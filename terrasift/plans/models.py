"""Rasters, vectors, metrics, clustering, sampling and incremental queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import arrays as V
from ..functions import scalar as X
from ..functions.scalar import tidy
from ..operators import areas
from ..operators import graph as C
from ..operators import incremental as I
from ..operators import metrics as M
from ..operators import rasters as R
from ..operators import sampling as S
from ..operators import vectors as E
from ..operators.predicates import at_least
from ..operators.ranking import best
from .base import haversine_sql as hav
from .base import query, sql, tidy_sql
from .joins import targets
from .joins import _COS as COS

MASK = "i // 8 BETWEEN 2 AND 5 AND i % 8 BETWEEN 2 AND 5"


def square():
    return R.box_mask(8, 8, (0.25, 0.25, 0.75, 0.75), (0.0, 0.0, 1.0, 1.0))


PX = "px AS (SELECT id, label, unnest(v) AS x, unnest(range(0, 64)) AS i FROM v)"


@query("r01_pixel_median", sql("v", f"SELECT label, list(m ORDER BY i) AS pixels FROM (SELECT label, i, {tidy_sql('median(x)')} AS m FROM px GROUP BY label, i) GROUP BY label", PX))
def _(t):
    m = R.pixel_median(t.vectors(), "label", "v")
    return m.select("label", F.transform("v", lambda x: tidy(x)).alias("pixels"))


#: Three bands of a scene: clear pixels only; the blue of label 9 is flat, scenes with id % 10 = 0 are nearly all cloud.
_SCENE = "CASE WHEN (id + i) % 3 <> 0 AND (id % 10 <> 0 OR i < 12) THEN {x} END"
_COMP = f"""sc AS (SELECT label, id, i, band, CASE band WHEN 'red' THEN {_SCENE.format(x='x * 100')} WHEN 'green' THEN {_SCENE.format(x='x * 50 + 10')} ELSE {_SCENE.format(x='CASE WHEN label = 9 THEN 5.0e0 ELSE x * x * 100 END')} END AS p FROM px, (SELECT unnest(['red', 'green', 'blue']) AS band)),
ok AS (SELECT label, id FROM sc WHERE band = 'red' GROUP BY label, id HAVING count(p) >= 20),
md AS (SELECT sc.label, band, i, median(p) AS m FROM sc JOIN ok ON sc.id = ok.id AND sc.label IN (SELECT label FROM ok GROUP BY label HAVING count(*) >= 2) GROUP BY sc.label, band, i),
fl AS (SELECT label, band, i, coalesce(m, median(m) OVER (PARTITION BY label, band), 0) AS m FROM md),
gd AS (SELECT label FROM (SELECT label, band, quantile_cont(m, 0.99) - quantile_cont(m, 0.01) AS span FROM fl GROUP BY 1, 2) GROUP BY 1 HAVING min(span) >= 1)"""


_THREE = ", ".join(f"list({tidy_sql('m')} ORDER BY i) FILTER (WHERE band = '{b}') AS {b}" for b in ("red", "green", "blue"))


@query("r02_masked_composite", sql("v", f"SELECT label, {_THREE} FROM fl WHERE label IN (SELECT label FROM gd) GROUP BY label", PX + ",\n" + _COMP))
def _(t):
    at = lambda x: (F.col("id") + x) % 3 != 0
    band = lambda f: F.transform("v", lambda x, i: F.when(at(i) & ((F.col("id") % 10 != 0) | (i < 12)), f(x)))
    blue = lambda x: F.when(F.col("label") == 9, 5.0).otherwise(x * x * 100)
    scenes = t.vectors().select("label", band(lambda x: x * 100).alias("red"), band(lambda x: x * 50 + 10).alias("green"), band(blue).alias("blue"))
    made = R.composite(scenes, "label", ["red", "green", "blue"], least_pixels=20, least_scenes=2)
    return made.select("label", *[F.transform(b, lambda x: tidy(x)).alias(b) for b in ("red", "green", "blue")])


@query("r03_stretch", sql("v", f"SELECT id, list_transform(v, lambda x: {tidy_sql('least(greatest((x - lo) / (hi - lo), 0.0e0), 1.0e0)', 5)}) AS pixels FROM (SELECT v.id, v.v, q.lo, q.hi FROM v JOIN (SELECT id, quantile_cont(x, 0.01) AS lo, quantile_cont(x, 0.99) AS hi FROM px GROUP BY id) q ON v.id = q.id)", PX))
def _(t):
    v = t.vectors().withColumns({"lo": R.percentile_of(F.col("v"), 0.01), "hi": R.percentile_of(F.col("v"), 0.99)})
    return v.select("id", F.transform(R.stretch(F.col("v"), F.col("lo"), F.col("hi")), lambda x: tidy(x, 5)).alias("pixels"))


_KIND = "q AS (SELECT id, CAST(i AS INTEGER) AS i, CASE WHEN x < -0.05e0 THEN 0 WHEN x < 0.2e0 THEN 1 ELSE 2 END AS c FROM px)"
_MODE = "m{k} AS (SELECT id, i, mode FROM (SELECT a.id, a.i, b.c AS mode, row_number() OVER (PARTITION BY a.id, a.i ORDER BY count(*) DESC, b.c) AS r FROM q a JOIN q b ON a.id = b.id AND abs(a.i // 8 - b.i // 8) <= {k} AND abs(a.i % 8 - b.i % 8) <= {k} GROUP BY a.id, a.i, b.c) WHERE r = 1)"
_FAR = "d AS (SELECT a.id, a.i, sqrt(min((a.i // 8 - b.i // 8) * (a.i // 8 - b.i // 8) + (a.i % 8 - b.i % 8) * (a.i % 8 - b.i % 8))) * 30 AS m FROM q a JOIN q b ON a.id = b.id AND b.c = 2 GROUP BY a.id, a.i)"


@query("r04_window_mode", sql("v", f"SELECT m1.id, m1.i, m1.mode AS mode_3x3, m2.mode AS mode_5x5, m3.mode AS mode_7x7, {tidy_sql('d.m')} AS dist_m FROM m1 JOIN m2 ON m1.id = m2.id AND m1.i = m2.i JOIN m3 ON m1.id = m3.id AND m1.i = m3.i LEFT JOIN d ON m1.id = d.id AND m1.i = d.i",
    ",\n".join([PX, _KIND, *[_MODE.format(k=k) for k in (1, 2, 3)], _FAR])))
def _(t):
    kinds = t.vectors().select("id", F.transform("v", lambda x: F.when(x < -0.05, 0).when(x < 0.2, 1).otherwise(2)).alias("c"))
    modes = [R.window_mode(F.col("c"), 8, 8, reach).alias(f"mode_{2 * reach + 1}x{2 * reach + 1}") for reach in (1, 2, 3)]
    made = kinds.select("id", *modes, R.distance_to(F.transform("c", lambda x: x == 2), 8, 8).alias("dist_m"))
    each = made.select("id", F.posexplode(F.arrays_zip("mode_3x3", "mode_5x5", "mode_7x7", "dist_m")).alias("i", "z"))
    return each.select("id", "i", "z.mode_3x3", "z.mode_5x5", "z.mode_7x7", tidy(F.col("z.dist_m")).alias("dist_m"))


_IN = f"avg(x + 1) FILTER (WHERE {MASK})"
_OUT = f"avg(x + 1) FILTER (WHERE NOT ({MASK}))"


@query("r05_inside_ratio", sql("v", f"SELECT id, CASE WHEN {_OUT} > 0 THEN {tidy_sql(_IN + ' / ' + _OUT)} END AS ratio FROM px GROUP BY id", PX))
def _(t):
    up = F.transform("v", lambda x: x + 1)
    return t.vectors().select("id", tidy(R.inside_ratio(up, square())).alias("ratio"))


@query("r06_change", sql("v", f"SELECT id, {tidy_sql('abs(' + _IN + ' / ' + _OUT + ' - avg(x + 2) FILTER (WHERE ' + MASK + ') / avg(x + 2) FILTER (WHERE NOT (' + MASK + ')))')} AS change, CAST(16 AS BIGINT) AS footprint FROM px GROUP BY id", PX))
def _(t):
    early, late = R.inside_ratio(F.transform("v", lambda x: x + 1), square()), R.inside_ratio(F.transform("v", lambda x: x + 2), square())
    return t.vectors().select("id", tidy(F.abs(late - early)).alias("change"), F.size(F.filter(square(), lambda m: m)).cast("long").alias("footprint"))


#: Four bands of two epochs of a vector's raster, as functions and as SQL.
EPOCHS = {
    "baseline": {"red": (lambda x: x + 1, "x + 1"), "green": (lambda x: x * x + 1, "x * x + 1"), "blue": (lambda x: 1.5 - x, "1.5e0 - x"), "nir": (lambda x: x * 0.5 + 2, "x * 0.5e0 + 2")},
    "recent": {"red": (lambda x: 1.2 - x, "1.2e0 - x"), "green": (lambda x: x + 2, "x + 2"), "blue": (lambda x: x * 0.5 + 1, "x * 0.5e0 + 1"), "nir": (lambda x: x * 3, "x * 3")},
}


def _near(dy, dx):
    return f"p[CAST(least(greatest(i // 8 + {dy}, 0), 7) * 8 + least(greatest(i % 8 + {dx}, 0), 7) + 1 AS INTEGER)]"


_GX = f"({_near(-1, 1)} + 2 * {_near(0, 1)} + {_near(1, 1)} - {_near(-1, -1)} - 2 * {_near(0, -1)} - {_near(1, -1)})"
_GY = f"({_near(1, -1)} + 2 * {_near(1, 0)} + {_near(1, 1)} - {_near(-1, -1)} - 2 * {_near(-1, 0)} - {_near(-1, 1)})"
_BB = "bb AS (" + " UNION ALL ".join(f"SELECT id, '{e}' AS e, '{b}' AS b, list_transform(v, lambda x: {x}) AS p FROM v" for e, bands in EPOCHS.items() for b, (_f, x) in bands.items()) + ")"
_BP = f"bp AS (SELECT id, e, b, i, p[CAST(i + 1 AS INTEGER)] AS x, sqrt({_GX} * {_GX} + {_GY} * {_GY}) AS edge FROM bb, (SELECT unnest(range(0, 64)) AS i) WHERE {MASK})"
_BS = "bs AS (SELECT id, e, b, avg(x) AS mean, stddev_pop(x) AS std, avg(edge) AS edge FROM bp GROUP BY 1, 2, 3)"
_NV = "nv AS (SELECT r.id, r.e, avg((n.x - r.x) / (n.x + r.x)) FILTER (WHERE n.x + r.x > 1e-6) AS ndvi FROM bp r JOIN bp n ON r.id = n.id AND r.e = n.e AND r.i = n.i AND r.b = 'red' AND n.b = 'nir' GROUP BY 1, 2)"


@query("r08_masked_statistics", sql("v", "SELECT bs.id, " + ", ".join(f"{tidy_sql(f'max({s}) FILTER (WHERE bs.e = {chr(39)}{e}{chr(39)} AND b = {chr(39)}{b}{chr(39)})', 5)} AS {s}_{b}_{e}" for e in EPOCHS for b in EPOCHS[e] for s in ("mean", "std", "edge"))
    + ", " + ", ".join(f"{tidy_sql(f'max(ndvi) FILTER (WHERE bs.e = {chr(39)}{e}{chr(39)})', 5)} AS ndvi_{e}, CAST(16 AS BIGINT) AS footprint_pixels_{e}" for e in EPOCHS) + " FROM bs JOIN nv ON bs.id = nv.id AND bs.e = nv.e GROUP BY bs.id", ",\n".join([_BB, _BP, _BS, _NV])))
def _(t):
    columns = {}
    for epoch, bands in EPOCHS.items():
        made = {b: F.transform("v", f) for b, (f, _) in bands.items()}
        columns |= R.band_statistics(made, square(), 8, 8, "red", "nir", f"_{epoch}")
    return t.vectors().select("id", *[(c if k.startswith("footprint") else tidy(c, 5)).alias(k) for k, c in columns.items()])


@query("r09_nodata_statistics", sql("v", f"SELECT id, count(*) AS n, {tidy_sql('avg(x)')} AS mean, {tidy_sql('median(x)')} AS med, {tidy_sql('max(x)')} AS top, {tidy_sql('quantile_cont(x, 0.25)')} AS p25, {tidy_sql('quantile_cont(x, 0.75)')} AS p75 FROM px WHERE (id + i) % 5 <> 0 GROUP BY id", PX))
def _(t):
    seen = F.transform("v", lambda x, i: F.when((F.col("id") + i) % 5 != 0, x))
    s = R.statistics(seen)
    return t.vectors().select("id", s[0].alias("n"), tidy(s[1]).alias("mean"), tidy(s[3]).alias("med"), tidy(s[4]).alias("top"), tidy(s[5]).alias("p25"), tidy(s[6]).alias("p75"))


SIX = {
    "blue": (lambda x: x, "x"), "green": (lambda x: x * 2, "x * 2"), "red": (lambda x: x + 1, "x + 1"), "nir08": (lambda x: 1 - x, "1 - x"), "swir16": (lambda x: x * x, "x * x"), "swir22": (lambda x: x / 2, "x / 2"),
}
_MEANS = ", ".join(f"{tidy_sql(f'avg({x})')} AS {b}" for b, (_f, x) in SIX.items())
_HAS = {b: f"(id + i + {k}) % 11 <> 0" for k, b in enumerate(SIX)}


@query("r10_joint_validity", sql("v", f"SELECT id, count(*) AS footprint_pixels, {_MEANS} FROM px WHERE {MASK} AND {' AND '.join(_HAS.values())} GROUP BY id", PX))
def _(t):
    holed = lambda f, k: F.transform("v", lambda x, i: F.when((F.col("id") + i + k) % 11 != 0, f(x)))
    bands = {b: holed(f, k) for k, (b, (f, _)) in enumerate(SIX.items())}
    made = t.vectors().select("id", *[c.alias(k) for k, c in R.joint_means(bands, square()).items()]).where("footprint_pixels > 0")
    return made.select("id", "footprint_pixels", *[tidy(F.col(b)).alias(b) for b in SIX])


@query("r12_mosaic", sql("v", f"SELECT label, list(m ORDER BY i) AS pixels FROM (SELECT label, i, arg_min({tidy_sql('x')}, id) FILTER (WHERE (id + i) % 4 <> 0) AS m FROM px GROUP BY label, i) GROUP BY label", PX))
def _(t):
    holes = F.transform("v", lambda x, i: F.when((F.col("id") + i) % 4 != 0, tidy(x)))
    return R.mosaic(t.vectors().withColumn("pixels", holes), "label", "pixels", "id")


@query("r13_dilation", sql("v", "SELECT a.id, count(*) AS pixels FROM (SELECT DISTINCT p.id, p.i FROM px p JOIN px q ON p.id = q.id AND q.x > 0.2e0 AND abs(p.i // 8 - q.i // 8) + abs(p.i % 8 - q.i % 8) <= 1) a GROUP BY a.id", PX))
def _(t):
    grown = R.dilated(F.transform("v", lambda x: x > 0.2), 8, 8)
    return t.vectors().select("id", F.size(F.filter(grown, lambda m: m)).cast("long").alias("pixels")).where("pixels > 0")


@query("r15_side_guard", sql("b", "SELECT id, CASE WHEN greatest((xmax - xmin), (ymax - ymin)) > 0.0008e0 THEN 'too large' END AS error FROM b"))
def _(t):
    side = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"))
    return t.buildings().select("id", F.when(side > 0.0008, "too large").alias("error"))


@query("r16_two_epoch_ratio", sql("v", f"SELECT id, {tidy_sql(_IN + ' / ' + _OUT)} AS before, {tidy_sql('avg(x + 2) FILTER (WHERE ' + MASK + ') / avg(x + 2) FILTER (WHERE NOT (' + MASK + '))')} AS after FROM px GROUP BY id", PX))
def _(t):
    at = lambda k: tidy(R.inside_ratio(F.transform("v", lambda x: x + k), square()))
    return t.vectors().select("id", at(1).alias("before"), at(2).alias("after"))


_NORM = "greatest(sqrt(list_sum(list_transform(v, lambda x: x * x))), 1e-12)"


@query("m01_l2_normalise", sql("v", f"SELECT id, list_transform(v, lambda x: {tidy_sql('x / n')}) AS v FROM (SELECT id, v, {_NORM} AS n FROM v)"))
def _(t):
    return t.vectors().select("id", F.transform(V.normalised(F.col("v")), lambda x: tidy(x)).alias("v"))


_D = f"d AS (SELECT q.id, floor(min(CASE WHEN p.label = 0 THEN {COS} END) * 1e5 + 0.5) / 1e5 AS pos, floor(min(CASE WHEN p.label BETWEEN 1 AND 4 THEN {COS} END) * 1e5 + 0.5) / 1e5 AS man FROM v q JOIN v p ON p.label < 5 WHERE q.label >= 5 GROUP BY q.id)"


def distances(t):
    v = t.vectors()
    refs = v.where("label < 5").select(F.when(F.col("label") == 0, "pos").otherwise("man").alias("kind"), F.col("v").alias("w"))
    d = E.nearest_by_group(v.where("label >= 5"), refs, "id", "kind", ["pos", "man"])
    return d.select("id", tidy(F.col("pos"), 5).alias("pos"), tidy(F.col("man"), 5).alias("man"))


@query("m02_drop_rule", sql("v", "SELECT id, pos < man AS dropped FROM d", _D))
def _(t):
    return distances(t).select("id", (F.col("pos") < F.col("man")).alias("dropped"))


@query("m03_shortlist", sql("v", "SELECT id, pos, pos < man AS was_dropped FROM d ORDER BY pos, id LIMIT 20", _D))
def _(t):
    return distances(t).orderBy("pos", "id").limit(20).select("id", "pos", (F.col("pos") < F.col("man")).alias("was_dropped"))


W = [[((k * 7 + r * 3) % 11 - 5) / 4.0 for k in range(64)] for r in range(2)]
_LOGIT = [f"(list_sum(list_transform(range(1, 65), lambda i: v[i] * (((i - 1) * 7 + {3 * r}) % 11 - 5) / 4.0e0)) + {0.1 * r}e0)" for r in range(2)]


@query("m04_linear_probe", sql("v", f"SELECT id, {tidy_sql('exp(b - greatest(a, b)) / (exp(a - greatest(a, b)) + exp(b - greatest(a, b)))')} AS p FROM (SELECT id, {_LOGIT[0]} AS a, {_LOGIT[1]} AS b FROM v)"))
def _(t):
    return t.vectors().select("id", tidy(E.softmax(E.linear_scores(F.col("v"), W, [0.0, 0.1]))[1]).alias("p"))


@query("m08_split_by_source", sql("a", "SELECT id, CASE WHEN starts_with(site_type, 'B') THEN 'test' WHEN starts_with(site_type, 'M') THEN 'scan' ELSE 'train' END AS split FROM a"))
def _(t):
    s = F.col("site_type")
    return t.anchors().select("id", F.when(s.startswith("B"), "test").when(s.startswith("M"), "scan").otherwise("train").alias("split"))


@query("m09_knn_vote", sql("v", """SELECT id, floor((CASE WHEN min(d) = 0 THEN avg(y) FILTER (WHERE d = 0) ELSE sum(y / nullif(d, 0)) / sum(1.0e0 / nullif(d, 0)) END) * 1e5 + 0.5) / 1e5 AS p FROM (
SELECT q.id, CASE WHEN p.label < 3 THEN 1.0e0 ELSE 0.0e0 END AS y, sqrt(list_sum(list_transform(range(1, 65), lambda i: (q.v[i] - p.v[i]) * (q.v[i] - p.v[i])))) AS d,
 row_number() OVER (PARTITION BY q.id ORDER BY sqrt(list_sum(list_transform(range(1, 65), lambda i: (q.v[i] - p.v[i]) * (q.v[i] - p.v[i])))), p.id) AS r FROM v q JOIN v p ON p.id % 2 = 0 WHERE q.id % 2 = 1) WHERE r <= 15 GROUP BY id"""))
def _(t):
    v = t.vectors()
    refs = v.where("id % 2 = 0").select(F.col("id").alias("rid"), F.col("v").alias("w"), F.when(F.col("label") < 3, 1.0).otherwise(0.0).alias("y"))
    return E.knn_vote(v.where("id % 2 = 1"), refs, "id", 15).select("id", tidy(F.col("p"), 5).alias("p"))


_YP = "yp AS (SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS y, prob AS p, shard FROM t WHERE prob IS NOT NULL AND NOT isnan(prob))"


def scored(t):
    y = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 1).otherwise(0)
    return t.tiles().where(at_least("prob", 0.0)).select(y.alias("y"), F.col("prob").alias("p"), "shard")


_AUC = "(sum(CASE WHEN y = 1 THEN mid END) - sum(y) * (sum(y) + 1) / 2.0e0) / (sum(y) * sum(1 - y))"


@query("m10_auroc", sql("t", f"SELECT {tidy_sql(_AUC)} AS auroc FROM (SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0e0 AS mid FROM yp)", _YP))
def _(t):
    return M.auroc(scored(t)).select(tidy(F.col("auroc")).alias("auroc"))


_SC = _YP + ",\nsc AS (SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM yp GROUP BY p),\ncu AS (SELECT p, pos, CAST(sum(pos) OVER (ORDER BY p DESC) AS DOUBLE) AS tp, CAST(sum(neg) OVER (ORDER BY p DESC) AS DOUBLE) AS fp FROM sc)"


@query("m11_average_precision", sql("t", f"SELECT {tidy_sql('sum(pos * tp / (tp + fp)) / sum(pos)')} AS ap FROM cu", _SC))
def _(t):
    return M.average_precision(scored(t)).select(tidy(F.col("ap")).alias("ap"))


@query("m12_accuracy_f1", sql("t", f"SELECT {tidy_sql('avg(CASE WHEN (p > 0.5) = (y = 1) THEN 1.0e0 ELSE 0.0e0 END)')} AS accuracy, {tidy_sql('2.0e0 * count_if(p > 0.5 AND y = 1) / greatest(2 * count_if(p > 0.5 AND y = 1) + count_if(p > 0.5 AND y = 0) + count_if(p <= 0.5 AND y = 1), 1)')} AS f1 FROM yp", _YP))
def _(t):
    r = M.rates(M.confusion(scored(t), [0.5], strict=True))
    return r.select(tidy(F.col("accuracy")).alias("accuracy"), tidy(F.col("f1")).alias("f1"))


@query("m13_precision_recall_at", sql("t", f"SELECT t, {tidy_sql('count_if(p >= t AND y = 1) / greatest(count_if(p >= t), 1)')} AS precision, {tidy_sql('count_if(p >= t AND y = 1) / greatest(count_if(y = 1), 1)')} AS recall FROM yp, (SELECT unnest([0.5e0, 0.7e0, 0.9e0, 0.95e0]) AS t) GROUP BY t", _YP))
def _(t):
    r = M.rates(M.confusion(scored(t), [0.5, 0.7, 0.9, 0.95]))
    return r.select("t", tidy(F.col("precision")).alias("precision"), tidy(F.col("recall")).alias("recall"))


@query("m14_recall_at_precision", sql("t", f"SELECT {tidy_sql('coalesce(max(CASE WHEN tp / (tp + fp) >= 0.41e0 THEN tp / (SELECT sum(y) FROM yp) END), 0.0e0)')} AS recall FROM cu", _SC))
def _(t):
    return M.recall_at_precision(scored(t), 0.41).select(tidy(F.col("recall")).alias("recall"))


@query("m14_precision_at_recall", sql("t", f"SELECT {tidy_sql('max(tp / (tp + fp))')} AS precision, arg_min(p, (-(tp / (tp + fp)), p)) AS threshold FROM cu WHERE tp / (SELECT sum(y) FROM yp) >= 0.95e0", _SC))
def _(t):
    return M.precision_at_recall(scored(t), 0.95).select(tidy(F.col("precision")).alias("precision"), "threshold")


@query("m15_threshold_at_recall", sql("t", f"SELECT th AS threshold, {tidy_sql('(SELECT avg(CASE WHEN p >= th THEN 1.0e0 ELSE 0.0e0 END) FROM yp WHERE y = 0)')} AS fpr FROM (SELECT p AS th FROM (SELECT p, row_number() OVER (ORDER BY p) AS r, count(*) OVER () AS n FROM yp WHERE y = 1) WHERE r = greatest(1, least(n, CAST(floor(0.1e0 * n) AS BIGINT) + 1)))", _YP))
def _(t):
    c = M.score_counts(scored(t))
    pos = c.agg(F.sum("pos").alias("n"), F.sum("neg").alias("negs"))
    # the row of rank r among positives, ascending: the greatest score with at least n - r + 1 positives at or above it
    want = F.col("n") - F.least(F.col("n"), F.floor(0.1 * F.col("n")) + 1) + 1
    hit = c.crossJoin(F.broadcast(pos)).where((F.col("pos") > 0) & (F.col("tp") >= want))
    top = hit.agg(F.max("p").alias("threshold"), F.max_by(F.col("fp") / F.col("negs"), "p").alias("fpr"))
    return top.select("threshold", tidy(F.col("fpr")).alias("fpr"))


@query("m16_rates_by_class", sql("t", f"SELECT shard, {tidy_sql('avg(CASE WHEN y = 1 THEN CASE WHEN p >= 0.5 THEN 1.0e0 ELSE 0.0e0 END END)')} AS recall, {tidy_sql('avg(CASE WHEN y = 0 THEN CASE WHEN p >= 0.5 THEN 1.0e0 ELSE 0.0e0 END END)')} AS fpr FROM yp GROUP BY shard", _YP))
def _(t):
    said = F.when(F.col("p") >= 0.5, 1.0).otherwise(0.0)
    return scored(t).groupBy("shard").agg(tidy(F.avg(F.when(F.col("y") == 1, said))).alias("recall"), tidy(F.avg(F.when(F.col("y") == 0, said))).alias("fpr"))


@query("m17_worst_errors", sql("t", "SELECT id, prob FROM t WHERE prob IS NOT NULL AND NOT isnan(prob) AND prob >= 0.5 AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH') ORDER BY prob DESC, id LIMIT 30"))
def _(t):
    wrong = t.tiles().where(at_least("prob", 0.5) & ~F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return wrong.orderBy(F.desc("prob"), "id").limit(30).select("id", "prob")


@query("m18_slice_metric", sql("t", f"SELECT {tidy_sql(_AUC)} AS auroc FROM (SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0e0 AS mid FROM yp WHERE shard = 3)", _YP))
def _(t):
    return M.auroc(scored(t).where("shard = 3")).select(tidy(F.col("auroc")).alias("auroc"))


@query("m19_mean_of_models", sql("h", f"SELECT id, CASE WHEN (change IS NOT NULL)::INT + (footprint IS NOT NULL)::INT >= 2 THEN {tidy_sql('(change + footprint / 50.0e0) / 2')} END AS p_mean FROM h"))
def _(t):
    models = F.array_compact(F.array(F.col("change"), F.col("footprint") / 50.0))
    return t.changes().select("id", tidy(F.when(F.size(models) >= 2, V.mean(models))).alias("p_mean"))


NEAR = "pr AS (SELECT p.id AS a, q.id AS b FROM b p JOIN b q ON p.id < q.id AND abs(p.lat - q.lat) < 0.1e0 AND " + hav("p.lat", "p.lon", "q.lat", "q.lon") + " <= {r})"
CC = "sy AS (SELECT a, b FROM {e} UNION SELECT b, a FROM {e}),\ncc AS (SELECT a, b FROM sy UNION SELECT cc.a, sy.b FROM cc JOIN sy ON cc.b = sy.a),\nlb AS (SELECT a AS node, least(a, min(b)) AS comp FROM cc GROUP BY a)"


def recursive(text: str) -> str:
    return text.replace("WITH ", "WITH RECURSIVE ", 1)


@query("c01_dbscan_pairs", recursive(sql("b", "SELECT b.id, coalesce(lb.comp, -1) AS cluster FROM b LEFT JOIN lb ON b.id = lb.node", NEAR.format(r=3200) + ",\n" + CC.format(e="pr"))))
def _(t):
    return C.dbscan(t.buildings(), 3200, 2).select("id", "cluster")


@query("c03_dbscan_components", recursive(sql("b", "SELECT b.id, coalesce(lb.comp, b.id) AS cluster FROM b LEFT JOIN lb ON b.id = lb.node", NEAR.format(r=3000) + ",\n" + CC.format(e="pr"))))
def _(t):
    return C.dbscan(t.buildings(), 3000, 1).select("id", "cluster")


@query("c04_components", recursive(sql("", "SELECT node, comp FROM lb", "e0 AS (SELECT p_partkey AS a, (p_partkey * 7 + 3) % 1999 AS b FROM part WHERE p_size < 25),\n" + CC.format(e="e0"))))
def _(t):
    edges = t.raw("part").where("p_size < 25").select(F.col("p_partkey").alias("a"), ((F.col("p_partkey") * 7 + 3) % 1999).alias("b"))
    return C.connected_components(edges)


#: Buildings on a plane in metres, with box sides of twice p_size.
_M = "m AS (SELECT id, class, area, (id % 3) AS parent, (lon + 100) * 95000.0e0 AS x, (lat - 30) * 110540.0e0 AS y, h * 100000.0e0 AS s, abs((xmax - xmin) * 111320.0e0 * cos(radians((ymin + ymax) / 2)) * (ymax - ymin) * 111320.0e0) AS box FROM b)"
_GE = """g0 AS (SELECT p.id AS a, q.id AS b, p.x AS xa, p.y AS ya, q.x AS xb, q.y AS yb, greatest(0.0e0, greatest(p.x - p.s, q.x - q.s) - least(p.x + p.s, q.x + q.s)) AS gx, greatest(0.0e0, greatest(p.y - p.s, q.y - q.s) - least(p.y + p.s, q.y + q.s)) AS gy
  FROM m p JOIN m q ON p.id < q.id AND p.parent = q.parent AND abs(p.x - q.x) < 6000 AND abs(p.y - q.y) < 6000),
ge AS (SELECT * FROM g0 WHERE sqrt(gx * gx + gy * gy) <= 5000),
rm AS (SELECT n_nationkey * 7600.0e0 AS x, n_nationkey * 8800.0e0 AS y FROM nation),
u AS (SELECT a, b FROM ge WHERE NOT EXISTS (SELECT 1 FROM rm WHERE (least(xa, xb) <= rm.x AND rm.x <= greatest(xa, xb)) OR (least(ya, yb) <= rm.y AND rm.y <= greatest(ya, yb))))"""


@query("c07_road_cut_clusters", recursive(sql("b", """SELECT cluster, count(*) AS n, CAST(floor(sum(area) + 0.5) AS BIGINT) AS area FROM (SELECT m.*, coalesce(lb.comp, m.id) AS cluster FROM m LEFT JOIN lb ON m.id = lb.node) GROUP BY cluster
HAVING (max(area) >= 4000 OR bool_or(coalesce(class = 'promo', false))) AND sum(box) >= 3000""", ",\n".join([_M, _GE, CC.format(e="u")]))))
def _(t):
    b = t.buildings().withColumns({"parent": F.col("id") % 3, "x": (F.col("lon") + 100) * 95000.0, "y": (F.col("lat") - 30) * 110540.0, "box": X.bbox_area_m2("xmin", "ymin", "xmax", "ymax")})
    half = t.raw("part").select(F.col("p_partkey").alias("id"), (F.col("p_size") / 100000.0 * 100000.0).alias("s"))
    m = b.join(half, "id").select("id", "class", "area", "parent", "box", "x", "y", (F.col("x") - F.col("s")).alias("xmin"), (F.col("y") - F.col("s")).alias("ymin"), (F.col("x") + F.col("s")).alias("xmax"), (F.col("y") + F.col("s")).alias("ymax"))
    n = t.raw("nation").select((F.col("n_nationkey") * 7600.0).alias("x"), (F.col("n_nationkey") * 8800.0).alias("y"))
    lines = n.select(F.col("x").alias("xa"), F.lit(-10000.0).alias("ya"), F.col("x").alias("xb"), F.lit(250000.0).alias("yb")).union(n.select(F.lit(-10000.0), F.col("y"), F.lit(250000.0), F.col("y")))
    kept = areas.anchored(areas.road_cut_clusters(m, lines, 5000.0), ("promo",), 4000.0, box_area="box", total_m2=3000.0)
    return kept.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.floor(F.sum("area") + 0.5).cast("long").alias("area"))


@query("c08_cell_groups", sql("b", "SELECT cy, cx, n, row_number() OVER (ORDER BY m DESC, cy, cx) AS position FROM (SELECT CAST(floor((y - y0) / 40000.0e0) AS BIGINT) AS cy, CAST(floor((x - x0) / 40000.0e0) AS BIGINT) AS cx, count(*) AS n, floor(avg(y) * 1e6 + 0.5) / 1e6 AS m FROM (SELECT (lon + 100) * 95000.0e0 AS x, (lat - 30) * 110540.0e0 AS y FROM b), (SELECT min((lon + 100) * 95000.0e0) AS x0, min((lat - 30) * 110540.0e0) AS y0 FROM b) GROUP BY 1, 2)"))
def _(t):
    b = t.buildings().select(((F.col("lon") + 100) * 95000.0).alias("x"), ((F.col("lat") - 30) * 110540.0).alias("y"))
    return areas.cell_groups(b, "x", "y", 40000.0)


_HIT = "EXISTS (SELECT 1 FROM {o} WHERE " + hav("a.lat", "a.lon", "{o}.lat", "{o}.lon") + " <= {r})"


@query("c09_joint_decomposition", sql("abc", f"SELECT id, CASE WHEN p AND o THEN 'A_both' WHEN p THEN 'A_pipeline_only' WHEN o THEN 'B_overture_only' ELSE 'D_missed' END AS part FROM (SELECT a.id, {_HIT.format(o='c', r=6000)} AS p, {_HIT.format(o='b', r=1500)} AS o FROM a)"))
def _(t):
    from ..operators.spatial import radius_join

    a = t.anchors().select("id", "lat", "lon")
    hit = lambda df, r, name: radius_join(a, targets(df), r, how="left_semi").select("id", F.lit(True).alias(name))
    j = a.select("id").join(hit(t.candidates(), 6000, "p"), "id", "left").join(hit(t.buildings(), 1500, "o"), "id", "left").na.fill(False)
    return j.select("id", F.when(F.col("p") & F.col("o"), "A_both").when(F.col("p"), "A_pipeline_only").when(F.col("o"), "B_overture_only").otherwise("D_missed").alias("part"))


@query("x01_sample", sql("b", "SELECT id FROM b ORDER BY md5('s1:' || id), id LIMIT 100"))
def _(t):
    return S.sample(t.buildings().select("id"), "id", 100, "s1")


_STRATUM = "CASE WHEN prob < 0.3 THEN 'low' WHEN prob < 0.7 THEN 'mid' ELSE 'high' END"


@query("x02_stratified", sql("t", f"SELECT id, stratum FROM (SELECT id, {_STRATUM} AS stratum, row_number() OVER (PARTITION BY {_STRATUM} ORDER BY md5('s2:' || id), id) AS r FROM t WHERE prob IS NOT NULL AND NOT isnan(prob)) WHERE r <= CASE stratum WHEN 'low' THEN 10 WHEN 'mid' THEN 20 ELSE 40 END"))
def _(t):
    stratum = F.when(F.col("prob") < 0.3, "low").when(F.col("prob") < 0.7, "mid").otherwise("high")
    return S.stratified(t.tiles().where(at_least("prob", 0.0)), stratum, "id", {"low": 10, "mid": 20, "high": 40}, "s2").select("id", "stratum")


@query("x03_decidable_mix", "SELECT o_orderkey FROM (SELECT *, o_orderstatus <> 'P' AS d, row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus <> 'P' ORDER BY md5('s3:' || o_orderkey), o_orderkey) AS r FROM orders) WHERE (d AND r <= 34) OR (NOT d AND r <= 6)")
def _(t):
    return S.decidable_mix(t.raw("orders"), ["o_orderpriority"], F.col("o_orderstatus") != "P", "o_orderkey", 40, 0.85, "s3").select("o_orderkey")


@query("x04_box_quota", sql("b", "SELECT id, stratum FROM (SELECT id, stratum, row_number() OVER (PARTITION BY stratum ORDER BY md5('s4:' || id), id) AS r FROM (SELECT id, CASE WHEN lon < -99.0e0 THEN 'west' WHEN lat < 31.0e0 THEN 'south' END AS stratum FROM b) WHERE stratum IS NOT NULL) WHERE r <= 15"))
def _(t):
    stratum = F.when(F.col("lon") < -99.0, "west").when(F.col("lat") < 31.0, "south")
    return S.stratified(t.buildings(), stratum, "id", {"west": 15, "south": 15}, "s4").select("id", "stratum")


_UNIT = "('0x' || substr(md5('jit{k}:' || id), 1, 7))::BIGINT / 268435456.0e0"


@query("x05_jitter", sql("a", f"SELECT id, {tidy_sql('(2 * (' + _UNIT.format(k='x') + ') - 1) * 400.0e0')} AS dx, {tidy_sql('(2 * (' + _UNIT.format(k='y') + ') - 1) * 400.0e0')} AS dy FROM a"))
def _(t):
    dx, dy = S.jitter(F.col("id"), 400.0, "jit")
    return t.anchors().select("id", tidy(dx).alias("dx"), tidy(dy).alias("dy"))


@query("x06_half_capped", "SELECT o_orderkey, pos FROM (SELECT o_orderkey, o_orderstatus = 'F' AS pos, row_number() OVER (PARTITION BY o_orderstatus = 'F' ORDER BY md5('s6:' || o_orderkey), o_orderkey) AS r FROM orders) WHERE r <= 100")
def _(t):
    o = t.raw("orders").select("o_orderkey", (F.col("o_orderstatus") == "F").alias("pos"))
    return S.half_capped(o, F.col("pos"), "o_orderkey", 200, "s6")


@query("i01_resume", "SELECT DISTINCT l_orderkey % 97 AS chunk FROM lineitem EXCEPT SELECT DISTINCT o_orderkey % 97 FROM orders WHERE o_totalprice > 499000")
def _(t):
    every = t.raw("lineitem").select((F.col("l_orderkey") % 97).alias("chunk")).distinct()
    done = t.raw("orders").where("o_totalprice > 499000").select((F.col("o_orderkey") % 97).alias("chunk"))
    return I.todo(every, done, ["chunk"])


@query("i02_upsert", "SELECT o_orderkey AS id, o_totalprice AS v FROM orders WHERE o_orderkey NOT IN (SELECT s_suppkey FROM supplier) UNION ALL SELECT s_suppkey, s_acctbal FROM supplier")
def _(t):
    base = t.raw("orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("v"))
    return I.upsert(base, t.raw("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("v")), ["id"])


@query("i03_log_fold", sql("l", "SELECT site, year, label FROM k WHERE label <> 'unsure'", "k AS (SELECT site, year, arg_max(label, (ts, event_id)) AS label FROM l GROUP BY 1, 2)"))
def _(t):
    return I.fold(t.labels(), ["site", "year"], ["ts", "event_id"], F.col("label") == "unsure").select("site", "year", "label")


@query("i04_status_refresh", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' AND n > 0 THEN 'COMPLETED' WHEN o_orderstatus = 'O' THEN 'RUNNING' ELSE o_orderstatus END AS status FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1) ON o_orderkey = l_orderkey")
def _(t):
    done = t.raw("lineitem").where("l_linestatus = 'F'").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    j = t.raw("orders").join(done, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    open_ = F.col("o_orderstatus") == "O"
    return j.select("o_orderkey", F.when(open_ & (F.col("n") > 0), "COMPLETED").when(open_, "RUNNING").otherwise(F.col("o_orderstatus")).alias("status"))


@query("i05_retry_and_dedup", sql("s", "SELECT key, year, min(scene) AS scene FROM s WHERE year <= 5 OR (key, year) NOT IN (SELECT (key, year) FROM s WHERE year <= 5) GROUP BY 1, 2"))
def _(t):
    s = t.scenes()
    first = s.where("year <= 5")
    retried = I.todo(s.where("year > 5"), first, ["key", "year"])
    return best(first.unionByName(retried), ["key", "year"], [F.col("scene")]).select("key", "year", "scene")


@query("i06_remap", "SELECT c_custkey, coalesce(s_name, c_name) AS tile FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey")
def _(t):
    names = t.raw("supplier").select("s_suppkey", "s_name")
    return t.raw("customer").join(names, F.col("c_custkey") == F.col("s_suppkey"), "left").select("c_custkey", F.coalesce("s_name", "c_name").alias("tile"))


@query("i09_batch_size", "SELECT p_partkey, greatest(1, least(64, (24000 - 9000) // (p_size * 25))) AS n FROM part")
def _(t):
    fits = F.floor(F.lit(24000 - 9000) / (F.col("p_size") * 25)).cast("int")
    return t.raw("part").select("p_partkey", F.greatest(F.lit(1), F.least(F.lit(64), fits)).alias("n"))


@query("i10_chunk_plan", sql("t", "SELECT shard, CAST(greatest(1, ceil(count(*) * 1000.0e0 / 250000)) AS BIGINT) AS chunks FROM t GROUP BY shard"))
def _(t):
    return t.tiles().groupBy("shard").agg(I.chunk_count(F.count(F.lit(1)) * 1000.0, 250_000).alias("chunks"))


@query("i11_verdicts", sql("t", "SELECT shard, CASE WHEN bad >= 0.17e0 THEN 'FAIL' WHEN bad >= 0.155e0 THEN 'WARN' ELSE 'PASS' END AS verdict FROM (SELECT shard, floor(avg(CASE WHEN prob IS NULL OR isnan(prob) THEN 1.0e0 ELSE 0.0e0 END) * 1e6 + 0.5) / 1e6 AS bad FROM t GROUP BY shard)"))
def _(t):
    bad = F.avg(F.when(F.col("prob").isNull() | F.isnan("prob"), 1.0).otherwise(0.0))
    return t.tiles().groupBy("shard").agg(tidy(bad).alias("bad")).select("shard", I.verdict(F.col("bad"), 0.155, 0.17).alias("verdict"))


@query("i13_work_list", sql("s", "SELECT DISTINCT key, year FROM s WHERE coalesce(cloud, 100) > 45 EXCEPT SELECT key, year FROM s WHERE coalesce(cloud, 100) < 2"))
def _(t):
    cloud = F.coalesce("cloud", F.lit(100.0))
    return I.todo(t.scenes().where(cloud > 45).select("key", "year").distinct(), t.scenes().where(cloud < 2), ["key", "year"])

