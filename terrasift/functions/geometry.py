"""Geometry over rings (array<struct<x,y>>) and boxes as column expressions; numpy kernels where none exists."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def box_overlap(l=("xmin", "ymin", "xmax", "ymax"), r=("rxmin", "rymin", "rxmax", "rymax")) -> Column:
    """The share of the right box that the left one covers."""
    side = lambda a, b: F.greatest(F.lit(0.0), F.least(F.col(l[b]), F.col(r[b])) - F.greatest(F.col(l[a]), F.col(r[a])))
    return side(0, 2) * side(1, 3) / ((F.col(r[2]) - F.col(r[0])) * (F.col(r[3]) - F.col(r[1])))


def ring_area(ring: Column) -> Column:
    """Signed shoelace area, counter-clockwise positive."""
    n = F.size(ring)
    at = lambda i: F.get(ring, F.pmod(i, n))
    parts = F.transform(F.sequence(F.lit(0), n - 1), lambda i: at(i)["x"] * at(i + 1)["y"] - at(i + 1)["x"] * at(i)["y"])
    return F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / 2


def ring_centroid(ring: Column, axis: str) -> Column:
    n = F.size(ring)
    at = lambda i: F.get(ring, F.pmod(i, n))
    parts = F.transform(F.sequence(F.lit(0), n - 1), lambda i: (at(i)[axis] + at(i + 1)[axis]) * (at(i)["x"] * at(i + 1)["y"] - at(i + 1)["x"] * at(i)["y"]))
    return F.try_divide(F.aggregate(parts, F.lit(0.0), lambda a, x: a + x), 6 * ring_area(ring))


def ring_bound(ring: Column, axis: str, least: bool) -> Column:
    values = F.transform(ring, lambda p: p[axis])
    return F.array_min(values) if least else F.array_max(values)


def valid_outline(points: Column) -> Column:
    """Three points or more, all in the unit square."""
    inside = F.forall(points, lambda p: (F.get(p, F.lit(0)) >= 0) & (F.get(p, F.lit(0)) <= 1) & (F.get(p, F.lit(1)) >= 0) & (F.get(p, F.lit(1)) <= 1))
    return F.coalesce((F.size(points) >= 3) & inside, F.lit(False))


#: The GRS80 ellipsoid and the parameters of the conterminous US Albers projection.
GRS80_A, GRS80_F = 6378137.0, 1 / 298.257222101
ALBERS = {"lat0": 23.0, "lon0": -96.0, "p1": 29.5, "p2": 45.5}


def albers(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Longitude and latitude to equal-area conic metres (x, y)."""
    e2 = GRS80_F * (2 - GRS80_F)
    e = math.sqrt(e2)

    def q_of(s):
        return (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))

    def m_of(p):
        return math.cos(p) / math.sqrt(1 - e2 * math.sin(p) ** 2)

    p0, p1, p2 = (math.radians(ALBERS[k]) for k in ("lat0", "p1", "p2"))
    n = (m_of(p1) ** 2 - m_of(p2) ** 2) / (q_of(math.sin(p2)) - q_of(math.sin(p1)))
    c = m_of(p1) ** 2 + n * q_of(math.sin(p1))
    rho0 = GRS80_A * math.sqrt(c - n * q_of(math.sin(p0))) / n
    s = F.sin(F.radians(lat))
    q = (1 - e2) * (s / (1 - e2 * s * s) - F.log((1 - e * s) / (1 + e * s)) / (2 * e))
    rho, theta = GRS80_A * F.sqrt(c - n * q) / n, n * F.radians(lon - ALBERS["lon0"])
    return rho * F.sin(theta), rho0 - rho * F.cos(theta)


def inverse_albers(x: Column, y: Column) -> tuple[Column, Column]:
    """Equal-area conic metres to (lat, lon), by the series for the authalic latitude."""
    e2 = GRS80_F * (2 - GRS80_F)
    e = math.sqrt(e2)
    q_of = lambda s: (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))
    m_of = lambda p: math.cos(p) / math.sqrt(1 - e2 * math.sin(p) ** 2)
    p0, p1, p2 = (math.radians(ALBERS[k]) for k in ("lat0", "p1", "p2"))
    n = (m_of(p1) ** 2 - m_of(p2) ** 2) / (q_of(math.sin(p2)) - q_of(math.sin(p1)))
    c = m_of(p1) ** 2 + n * q_of(math.sin(p1))
    rho0 = GRS80_A * math.sqrt(c - n * q_of(math.sin(p0))) / n
    rho = F.sqrt(x * x + (rho0 - y) * (rho0 - y))
    q = (c - F.pow(rho * n / GRS80_A, 2)) / n
    beta = F.asin(q / q_of(1.0))
    series = (e2 / 3 + 31 * e2**2 / 180 + 517 * e2**3 / 5040) * F.sin(2 * beta) + (23 * e2**2 / 360 + 251 * e2**3 / 3780) * F.sin(4 * beta) + (761 * e2**3 / 45360) * F.sin(6 * beta)
    return F.degrees(beta + series), ALBERS["lon0"] + F.degrees(F.atan2(x, rho0 - y)) / n
