"""Scalar expressions: distances, grid cells, identifiers, labels. All are built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M, EARTH_KM = 6_371_000.0, 6371.0088
#: The metre-per-degree conventions that different operators use.
DEG_PLAIN, DEG_LAT, DEG_LON = 111_000.0, 110_540.0, 111_320.0


def tidy(x: Column, digits: int = 6) -> Column:
    """x rounded half up by floor, which engines agree on."""
    return F.floor(x * 10.0**digits + 0.5) / 10.0**digits


def haversine(lat1, lon1, lat2, lon2, radius: float = EARTH_M) -> Column:
    lat1, lon1, lat2, lon2 = (F.radians(x) for x in (lat1, lon1, lat2, lon2))
    a = F.pow(F.sin((lat2 - lat1) / 2), 2) + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin((lon2 - lon1) / 2), 2)
    return 2 * radius * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def clean(x: str) -> Column:
    """x without NaN."""
    return F.when(F.isnan(x), None).otherwise(F.col(x))


def lon_scale(lat: Column) -> Column:
    """Metres a degree of longitude, the cosine floored at 0.1."""
    return DEG_LON * F.greatest(F.cos(F.radians(lat)), F.lit(0.1))


def bbox_area_m2(xmin, ymin, xmax, ymax) -> Column:
    mid = (F.col(ymin) + F.col(ymax)) / 2
    return F.abs((F.col(xmax) - F.col(xmin)) * DEG_LON * F.cos(F.radians(mid)) * (F.col(ymax) - F.col(ymin)) * DEG_LON)


def bbox_area_km2(xmin, ymin, xmax, ymax) -> Column:
    mid = (F.col(ymin) + F.col(ymax)) / 2
    wide, high = (F.col(xmax) - F.col(xmin)) * 111.0 * F.cos(F.radians(mid)), (F.col(ymax) - F.col(ymin)) * 111.0
    return F.greatest(F.lit(0.0), wide) * F.greatest(F.lit(0.0), high)


def expand_bbox(xmin, ymin, xmax, ymax, margin_m: float) -> list[Column]:
    """The box with margin_m more on every side."""
    mid = (F.col(ymin) + F.col(ymax)) / 2
    dy, dx = F.lit(margin_m / DEG_PLAIN), F.lit(margin_m) / (DEG_PLAIN * F.cos(F.radians(mid)))
    return [F.col(xmin) - dx, F.col(ymin) - dy, F.col(xmax) + dx, F.col(ymax) + dy]


def decimal_places(text: Column) -> Column:
    """Decimals of a number as written; none without a point."""
    return F.coalesce(F.length(F.get(F.split(text, "\\."), F.lit(1))), F.lit(0))


def stripped_places(text: Column) -> Column:
    """Decimals without closing zeros."""
    return F.coalesce(F.length(F.rtrim(F.get(F.split(text, "\\."), F.lit(1)), F.lit("0"))), F.lit(0))


def precision_label(lat_places: Column, lng_places: Column) -> Column:
    n = F.least(lat_places, lng_places)
    return F.when(n >= 5, "parcel").when(n >= 3, "city").otherwise("approximate")


def grid_cell(x: Column, deg: float) -> Column:
    return F.floor(x / deg).cast("long")


def utm_epsg(lat: Column, lng: Column) -> Column:
    return (F.when(lat >= 0, 32600).otherwise(32700) + F.floor((lng + 180.0) / 6.0) + 1).cast("long")


def short_id(prefix: str, *parts: Column, size: int = 10) -> Column:
    return F.concat(F.lit(prefix + "_"), F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, size))


#: Fixed value: names of image files; quad, corner, zone, resolution, day taken and, in some, day processed.
TILE_FILE = r"^m_(\d{7,8})_(ne|nw|se|sw)_(\d+)_(\d+)_(\d{8})(?:_(\d{8}))?\.tif$"


def tile_parts(name) -> dict[str, Column]:
    """quad_id, quadrant, utm_zone, res_code, acquired and processed of a file name; null where it isn't one (or has no such day)."""
    fits = F.rlike(name, F.lit(TILE_FILE))
    part = lambda k: F.when(fits, F.nullif(F.regexp_extract(name, TILE_FILE, k), F.lit("")))
    return {c: part(k) for k, c in enumerate(("quad_id", "quadrant", "utm_zone", "res_code", "acquired", "processed"), 1)}


def tile_name(quad_id, quadrant, utm_zone, res_code, acquired, processed=None) -> Column:
    """The file name of these parts; without a day of processing, or where it is null, the short form."""
    last = [] if processed is None else [processed]
    return F.concat(F.concat_ws("_", F.lit("m"), quad_id, quadrant, utm_zone, res_code, acquired, *last), F.lit(".tif"))


#: Closings of a band's files in the surface-reflectance product, and what changes in the path to it.
BAND_FILES = {"blue": "_SR_B1.TIF", "green": "_SR_B2.TIF", "red": "_SR_B3.TIF", "nir08": "_SR_B4.TIF", "swir16": "_SR_B5.TIF", "swir22": "_SR_B7.TIF"}
LEVEL_PARTS = (("/level-1/", "/level-2/"), ("_L1TP_", "_L2SP_"), ("_L1GT_", "_L2SP_"))


def surface_href(href: Column, band: str) -> Column:
    """The path of a band's reflectance for the path of a scene's panchromatic file."""
    for old, new in (*LEVEL_PARTS, ("_B8.TIF", BAND_FILES[band])):
        href = F.replace(href, F.lit(old), F.lit(new))
    return href


def hash_unit(seed: str, key: Column) -> Column:
    """A number in [0, 1) from the seed and a key: the first 7 hexadecimal digits of their md5."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), key.cast("string")).cast("binary")), 1, 7), 16, 10).cast("long") / float(16**7)


def hash_order(seed: str, key: Column) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), key.cast("string")).cast("binary"))


def change_status(change: Column, footprint: Column, error: Column, threshold: float, min_pixels: int = 10) -> Column:
    """changed over error over ambiguous over stable; a missing score is ambiguous."""
    return (
        F.when(F.coalesce(change, F.lit(-1.0)) >= threshold, "changed").when(error.isNotNull(), "error")
        .when((F.coalesce(footprint, F.lit(0)) < min_pixels) | change.isNull(), "ambiguous").otherwise("stable")
    )


def ndvi(nir: Column, red: Column, guard: float = 0.0) -> Column:
    return F.try_divide(nir - red, nir + red + guard)


def reflectance(dn: Column) -> Column:
    """Digital numbers to reflectance; 0 and what falls outside [0, 1] are missing."""
    r = dn * 2.75e-5 - 0.2
    return F.when((dn != 0) & (r >= 0) & (r <= 1), r)


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def clip(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))
