"""Kernels without a column expression: numpy functions of one shape or raster, and Arrow UDFs over them."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _numbers(*names: str) -> T.StructType:
    """A schema as an object: workers import this module without a session to parse text."""
    return T.StructType([T.StructField(n, T.DoubleType()) for n in names])


def hull(points: np.ndarray) -> np.ndarray:
    """Convex hull, counter-clockwise, by the monotone chain."""
    pts = np.unique(points, axis=0)
    if len(pts) < 3:
        return pts

    def half(seq):
        out: list = []
        for p in seq:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    return np.array(half(pts) + half(pts[::-1]))


def rotated_rectangle(points: np.ndarray) -> tuple[float, float]:
    """Sides (longer first) of the least-area rectangle around the points; one of its sides lies on a hull edge."""
    h = hull(points)
    if len(h) < 3:
        span = float(np.linalg.norm(h.max(axis=0) - h.min(axis=0))) if len(h) else 0.0
        return span, 0.0
    edges = np.roll(h, -1, axis=0) - h
    turn = np.arctan2(edges[:, 1], edges[:, 0])
    c, s = np.cos(turn), np.sin(turn)
    u, v = c[:, None] * h[:, 0] + s[:, None] * h[:, 1], -s[:, None] * h[:, 0] + c[:, None] * h[:, 1]
    wide, high = np.ptp(u, axis=1), np.ptp(v, axis=1)
    k = int((wide * high).argmin())
    return float(max(wide[k], high[k])), float(min(wide[k], high[k]))


def simple(ring: np.ndarray) -> bool:
    """Whether no two edges of a closed ring cross and it has an area."""
    a, b = ring, np.roll(ring, -1, axis=0)

    def side(p, q, r):
        return np.sign((q[..., 0] - p[..., 0]) * (r[..., 1] - p[..., 1]) - (q[..., 1] - p[..., 1]) * (r[..., 0] - p[..., 0]))

    p, q, u, v = a[:, None], b[:, None], a[None], b[None]
    crossing = (side(p, q, u) * side(p, q, v) < 0) & (side(u, v, p) * side(u, v, q) < 0)
    return len(np.unique(ring, axis=0)) > 2 and not crossing.any() and bool((a[:, 0] * b[:, 1] - b[:, 0] * a[:, 1]).sum())


def shape_features(ring: list) -> tuple[float, float, float]:
    """rectangularity and aspect ratio by the upright box, elongation by the least rotated one; zeros if the ring is no simple polygon."""
    p = np.array(ring, dtype=float).reshape(-1, 2)
    if len(p):
        p = p - p[0]  # near the origin, or the products lose the digits that differ
    if not simple(p):
        return 0.0, 0.0, 0.0
    area = abs(float((p[:, 0] * np.roll(p[:, 1], -1) - np.roll(p[:, 0], -1) * p[:, 1]).sum()) / 2)
    wide, high = np.maximum(np.ptp(p, axis=0), 1e-6)
    long, short = rotated_rectangle(p)
    return area / (wide * high), max(wide, high) / min(wide, high), long / max(short, 1e-6)


@F.pandas_udf(_numbers("rectangularity", "aspect_ratio", "elongation"))
def shape_features_udf(rings: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([shape_features([(p["x"], p["y"]) if isinstance(p, dict) else tuple(p) for p in r]) for r in rings], columns=["rectangularity", "aspect_ratio", "elongation"])


def polygon_mask(ring: np.ndarray, height: int, width: int) -> np.ndarray:
    """Pixels, rows from y = 0, that a polygon in pixel coordinates covers or touches."""
    mask = np.zeros((height, width), dtype=bool)
    y, x = np.mgrid[0:height, 0:width] + 0.5
    a, b = ring, np.roll(ring, -1, axis=0)
    for (x0, y0), (x1, y1) in zip(a, b):
        cross = (y0 > y) != (y1 > y)
        with np.errstate(divide="ignore", invalid="ignore"):
            mask ^= cross & (x < (x1 - x0) * (y - y0) / (y1 - y0) + x0)
    for (x0, y0), (x1, y1) in zip(a, b):  # every pixel that an edge passes
        cuts = [0.0, 1.0]
        for p, q in ((x0, x1), (y0, y1)):
            if p != q:
                cuts += [(g - p) / (q - p) for g in range(math.ceil(min(p, q)), math.floor(max(p, q)) + 1)]
        t = np.unique(np.clip(cuts, 0, 1))
        mid = (t[1:] + t[:-1]) / 2 if len(t) > 1 else t
        for px, py in zip(np.floor(x0 + (x1 - x0) * mid).astype(int), np.floor(y0 + (y1 - y0) * mid).astype(int)):
            if 0 <= py < height and 0 <= px < width:
                mask[py, px] = True
    return mask


def label_components(mask: np.ndarray) -> np.ndarray:
    """Numbers of the 4-connected parts, from 1; 0 outside. Least labels spread until nothing changes."""
    label = np.where(mask, np.arange(1, mask.size + 1).reshape(mask.shape), 0)
    far = mask.size + 1
    while True:
        grown = np.where(mask, label, far)
        padded = np.pad(grown, 1, constant_values=far)
        least = np.minimum.reduce([grown, padded[:-2, 1:-1], padded[2:, 1:-1], padded[1:-1, :-2], padded[1:-1, 2:]])
        new = np.where(mask, least, 0)
        if (new == label).all():
            return np.unique(label, return_inverse=True)[1].reshape(mask.shape) if not mask.all() else np.unique(label, return_inverse=True)[1].reshape(mask.shape) + 1
        label = new


def largest_polygon(mask: np.ndarray) -> list[tuple[int, int]]:
    """Outer ring, in pixel corners, of the largest 4-connected part; none if the mask is empty."""
    if not mask.any():
        return []
    label = label_components(mask)
    part = label == 1 + np.bincount(label[label > 0] - 1).argmax()
    edges: dict = {}
    for y, x in zip(*np.nonzero(part)):
        for (dy, dx), (p, q) in {(-1, 0): ((x, y), (x + 1, y)), (0, 1): ((x + 1, y), (x + 1, y + 1)), (1, 0): ((x + 1, y + 1), (x, y + 1)), (0, -1): ((x, y + 1), (x, y))}.items():
            ny, nx = y + dy, x + dx
            if not (0 <= ny < part.shape[0] and 0 <= nx < part.shape[1] and part[ny, nx]):
                edges.setdefault((int(p[0]), int(p[1])), []).append((int(q[0]), int(q[1])))
    start = min(edges, key=lambda p: (p[1], p[0]))  # the top left corner is on the outer ring
    ring, at, came = [start], edges[start].pop(), start
    while at != start:
        ring.append(at)
        ways = edges[at]
        straight = (at[0] - came[0], at[1] - came[1])
        # at a corner where two pixels touch, turn right, so that the ring stays with its own pixels
        ways.sort(key=lambda q: straight[0] * (q[1] - at[1]) - straight[1] * (q[0] - at[0]))
        came, at = at, ways.pop()
    return [p for k, p in enumerate(ring) if not _in_line(ring[k - 1], p, ring[(k + 1) % len(ring)])]


def _in_line(a, b, c) -> bool:
    return (b[0] - a[0]) * (c[1] - b[1]) == (b[1] - a[1]) * (c[0] - b[0])


def sobel(img: np.ndarray) -> np.ndarray:
    p = np.pad(img.astype(float), 1, mode="edge")
    gx = p[:-2, 2:] + 2 * p[1:-1, 2:] + p[2:, 2:] - p[:-2, :-2] - 2 * p[1:-1, :-2] - p[2:, :-2]
    gy = p[2:, :-2] + 2 * p[2:, 1:-1] + p[2:, 2:] - p[:-2, :-2] - 2 * p[:-2, 1:-1] - p[:-2, 2:]
    return np.hypot(gx, gy)


def dilate(mask: np.ndarray, times: int = 1) -> np.ndarray:
    for _ in range(times):
        p = np.pad(mask, 1)
        mask = p[1:-1, 1:-1] | p[:-2, 1:-1] | p[2:, 1:-1] | p[1:-1, :-2] | p[1:-1, 2:]
    return mask


def eroded(mask: np.ndarray, times: int) -> np.ndarray:
    for _ in range(times):
        p = np.pad(mask, 1)
        mask = p[1:-1, 1:-1] & p[:-2, 1:-1] & p[2:, 1:-1] & p[1:-1, :-2] & p[1:-1, 2:]
    return mask


def fill_holes(mask: np.ndarray) -> np.ndarray:
    """The mask with what no path of outside pixels reaches from the edge."""
    outside = np.zeros_like(mask)
    outside[0], outside[-1], outside[:, 0], outside[:, -1] = ~mask[0], ~mask[-1], ~mask[:, 0], ~mask[:, -1]
    while True:
        grown = dilate(outside) & ~mask
        if (grown == outside).all():
            return ~outside
        outside = grown


def gradient_footprint(img: np.ndarray, centre: tuple[float, float] = (0.5, 0.5)) -> np.ndarray | None:
    """The part around the centre (shares of the width, from the left, and of the height, from the top) of the strong-gradient mask:
    upper quarter, closed twice, filled. Missing pixels count as the mean. If the centre is in no part, the commonest part within
    three pixels; none if there is none, if all pixels are missing, or if the image is flat."""
    if np.isnan(img).all():
        return None
    g = sobel(np.where(np.isnan(img), np.nanmean(img), img))
    top = np.percentile(g, 99)
    if top <= 0:
        return None
    g = g / top
    mask = fill_holes(eroded(dilate(g > np.percentile(g, 75), 2), 2))  # what is beyond the edge counts as outside
    label = label_components(mask) if mask.any() else np.zeros(mask.shape, dtype=int)
    at_x, at_y = (max(0, min(n - 1, round(c * n))) for c, n in zip(centre, (mask.shape[1], mask.shape[0])))
    at = label[at_y, at_x]
    if at == 0:
        near = label[max(0, at_y - 3) : at_y + 4, max(0, at_x - 3) : at_x + 4]
        near = near[near > 0]
        if not len(near):
            return None
        at = np.bincount(near).argmax()
    return label == at


def lanczos_square(img: np.ndarray, size: int, a: int = 3) -> np.ndarray:
    """(C, H, W) padded to a square with zeros and resampled to size with a windowed sinc; widened when it shrinks."""
    side = max(img.shape[1:])
    top, left = (side - img.shape[1]) // 2, (side - img.shape[2]) // 2
    square = np.zeros((img.shape[0], side, side))
    square[:, top : top + img.shape[1], left : left + img.shape[2]] = img
    scale = max(1.0, side / size)
    centre = (np.arange(size) + 0.5) * side / size
    x = (np.arange(side) + 0.5 - centre[:, None]) / scale
    w = np.where(np.abs(x) < a, np.sinc(x) * np.sinc(x / a), 0.0)
    w /= w.sum(axis=1, keepdims=True)
    return np.einsum("ij,cjk,lk->cil", w, square, w)


def utm(lat: np.ndarray, lon: np.ndarray, zone: np.ndarray | int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(easting, northing, zone) on WGS84, by the series in the third flattening to its sixth power."""
    lat, lon = np.asarray(lat, dtype=float), np.asarray(lon, dtype=float)
    zone = np.floor((lon + 180) / 6).astype(int) + 1 if zone is None else np.broadcast_to(zone, lat.shape)
    f = 1 / 298.257223563
    n = f / (2 - f)
    radius = 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240]
    phi, d = np.radians(lat), np.radians(lon - (zone * 6 - 183))
    e = 2 * np.sqrt(n) / (1 + n)
    t = np.sinh(np.arctanh(np.sin(phi)) - e * np.arctanh(e * np.sin(phi)))
    xi, eta = np.arctan2(t, np.cos(d)), np.arcsinh(np.sin(d) / np.hypot(t, np.cos(d)))
    x, y = eta.copy(), xi.copy()
    for j, a in enumerate(alpha, 1):
        x += a * np.cos(2 * j * xi) * np.sinh(2 * j * eta)
        y += a * np.sin(2 * j * xi) * np.cosh(2 * j * eta)
    return 500000 + 0.9996 * radius * x, 0.9996 * radius * y + np.where(lat < 0, 1e7, 0.0), zone


def mgrs_square(lat: np.ndarray, lon: np.ndarray) -> list[str]:
    """Zone, band and 100 km square, e.g. 14RNV (the irregular zones of the far north are left out)."""
    east, north, zone = utm(lat, lon)
    bands, columns, rows = "CDEFGHJKLMNPQRSTUVWX", ["STUVWXYZ", "ABCDEFGH", "JKLMNPQR"], "ABCDEFGHJKLMNPQRSTUV"
    out = []
    for la, e, no, z in zip(np.atleast_1d(lat), np.atleast_1d(east), np.atleast_1d(north), np.atleast_1d(zone)):
        band = bands[int(min(19, max(0, (la + 80) // 8)))]
        out.append(f"{z:02d}{band}{columns[z % 3][int(e // 100000) - 1]}{rows[int(no // 100000 + (5 if z % 2 == 0 else 0)) % 20]}")
    return out


@F.arrow_udf(T.StringType())
def number_text_udf(x: pa.Array) -> pa.Array:
    """Doubles as their shortest text that reads back as the same double, plain between 1e-4 and 1e16; -0.0 keeps its sign."""
    return pa.array([None if v is None else repr(v) for v in x.to_pylist()], pa.string())


@F.pandas_udf(T.StringType())
def mgrs_udf(lat: pd.Series, lon: pd.Series) -> pd.Series:
    return pd.Series(mgrs_square(lat.to_numpy(), lon.to_numpy()))


@F.pandas_udf(_numbers("x", "y"))
def utm_udf(lat: pd.Series, lon: pd.Series) -> pd.DataFrame:
    x, y, _ = utm(lat.to_numpy(), lon.to_numpy())
    return pd.DataFrame({"x": x, "y": y})


#: Pairs of points that are compared at once, and offsets to the cells that hold a point's neighbours, half of them.
COMPARED = 1 << 20
AROUND = [(dx, dy) for dx in range(-2, 3) for dy in range(-2, 3)]
HALF = [o for o in AROUND if o > (0, 0)]


def _expanded(left: np.ndarray, start: np.ndarray, size: np.ndarray):
    """(k, l, r) in parts of about COMPARED: each left[k] beside start[k], start[k] + 1 and so on, size[k] of them."""
    ends, lo = np.cumsum(size), 0
    while lo < len(left):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + COMPARED, side="right")))
        n = size[lo:hi]
        k = np.repeat(np.arange(lo, hi), n)
        yield k, left[k], start[k] + np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n)
        lo = hi


def _cells(x: np.ndarray, y: np.ndarray, side: float) -> tuple[np.ndarray, int]:
    """A number for each point's square cell, and what the number grows by from column to column: two empty rows lie between columns."""
    cx, cy = (np.floor((v - v.min()) / side).astype(np.int64) for v in (x, y))
    width = int(cy.max()) + 5
    return cx * width + cy + 2, width


def _beside(cells: np.ndarray, width: int, some: np.ndarray, offsets: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(k, j): some[k] has cells[j], which is ascending, at one of the offsets."""
    sought = some[:, None] + np.array([dx * width + dy for dx, dy in offsets])[None, :]
    at = np.minimum(np.searchsorted(cells, sought), len(cells) - 1)
    k, o = np.nonzero(cells[at] == sought)
    return k, at[k, o]


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each the least of its set) once the sets of a and b are one."""
    while True:
        la, lb = label[a], label[b]
        open_ = la != lb
        if not open_.any():
            return label
        a, b = a[open_], b[open_]
        np.minimum.at(label, np.maximum(la, lb)[open_], np.minimum(la, lb)[open_])
        while (label[label] != label).any():
            label = label[label]


def _meet(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray, eps: float) -> bool:
    """Whether a point of a is within eps of one of b: those nearest to the other side's box are compared first."""

    def gap(some, other):
        out = lambda v: np.maximum(0.0, np.maximum(v[other].min() - v[some], v[some] - v[other].max()))
        return np.sqrt(out(x) ** 2 + out(y) ** 2)

    def near(some, other):
        d = gap(some, other)
        order = np.argsort(d, kind="stable")
        return some[order][d[order] <= eps * (1 + 1e-9)]

    a, b = near(a, b), near(b, a)
    step = 1024
    return any(
        (np.sqrt((x[a[i : i + step], None] - x[None, b[j : j + step]]) ** 2 + (y[a[i : i + step], None] - y[None, b[j : j + step]]) ** 2) <= eps).any()
        for i, j in sorted(((i, j) for i in range(0, len(a), step) for j in range(0, len(b), step)), key=sum)
    )


def tile_clusters(ids: np.ndarray, x: np.ndarray, y: np.ndarray, n: np.ndarray, sure: np.ndarray, eps: float, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(label, at, near) of density clusters of points that stand for n each: the least id of its component for a core point, else -1; and for each
    other point at[k] the component near[k] of a core point within eps, each once.

    Cells have a diagonal under eps, so the core points of one are joined; of two cells only whether they meet is asked. Where ``sure`` is false
    points only count as neighbours. Memory follows the points, not their pairs.
    """
    side = 0.7071 * eps
    order = np.argsort(_cells(x, y, side)[0], kind="stable")
    ids, x, y, n, sure = (v[order] for v in (ids, x, y, n, sure))
    number, width = _cells(x, y, side)
    cells, start, of, size = np.unique(number, return_index=True, return_inverse=True, return_counts=True)
    core = (np.add.reduceat(n, start) >= least)[of]
    apart = lambda l, r: np.sqrt((x[l] - x[r]) ** 2 + (y[l] - y[r]) ** 2)

    def around(points):  # (k, l, r) of points and all those in the cells about them
        k, j = _beside(cells, width, number[points], AROUND)
        return _expanded(points[k], start[j], size[j])

    thin = np.flatnonzero(~core)
    count = np.zeros(len(x), np.int64)
    for _, l, r in around(thin):
        hit = apart(l, r) <= eps
        np.add.at(count, l[hit], n[r[hit]])
    core = (core | (count >= least)) & sure
    label, own = np.full(len(x), -1, np.int64), np.flatnonzero(core)
    near = [np.empty((0, 2), np.int64)]
    if len(own):
        full, first, cell, many = np.unique(number[own], return_index=True, return_inverse=True, return_counts=True)
        low, high = ([f.reduceat(v[own], first) for v in (x, y)] for f in (np.minimum, np.maximum))
        a, b = _beside(full, width, full, HALF)
        gap = np.sqrt(sum(np.maximum(0.0, np.maximum(lo[a] - hi[b], lo[b] - hi[a])) ** 2 for lo, hi in zip(low, high)))
        far = np.sqrt(sum(np.maximum(hi[a] - lo[b], hi[b] - lo[a]) ** 2 for lo, hi in zip(low, high)))
        inside = far <= eps * (1 - 1e-9)
        sets = _joined(np.arange(len(full)), a[inside], b[inside])
        asked = ~inside & (gap <= eps * (1 + 1e-9)) & (sets[a] != sets[b])
        a, b = a[asked], b[asked]
        cost = many[a] * many[b]
        p, q, lo = a[cost <= COMPARED], b[cost <= COMPARED], 0
        while lo < len(p):
            hi = max(lo + 1, lo + int(np.searchsorted(np.cumsum(many[p[lo:]] * many[q[lo:]]), COMPARED, side="right")))
            some = lo + np.flatnonzero(sets[p[lo:hi]] != sets[q[lo:hi]])
            pair = np.repeat(some, many[p[some]])
            points = first[p[pair]] + np.arange(len(pair)) - np.repeat(np.cumsum(many[p[some]]) - many[p[some]], many[p[some]])
            met = [pair[k[apart(own[l], own[r]) <= eps]] for k, l, r in _expanded(points, first[q[pair]], many[q[pair]])]
            met = np.unique(np.concatenate(met)) if met else some
            sets = _joined(sets, p[met], q[met])
            lo = hi
        for p, q in zip(a[cost > COMPARED], b[cost > COMPARED]):
            if sets[p] != sets[q] and _meet(x, y, own[first[p] : first[p] + many[p]], own[first[q] : first[q] + many[q]], eps):
                sets = _joined(sets, np.array([p]), np.array([q]))
        named = np.full(len(full), np.iinfo(np.int64).max)
        np.minimum.at(named, sets[cell], ids[own])
        label[own] = named[sets[cell]]
        for _, l, r in around(np.flatnonzero(~core)):
            hit = (label[r] >= 0) & core[r]
            hit[hit] = apart(l[hit], r[hit]) <= eps
            near.append(np.unique(np.stack([l[hit], label[r[hit]]], axis=1), axis=0))
    near = np.unique(np.concatenate(near), axis=0)
    back = np.empty(len(x), np.int64)
    back[order] = label
    return back, order[near[:, 0]], near[:, 1]
