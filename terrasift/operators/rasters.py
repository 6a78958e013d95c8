"""Small rasters as arrays of pixels in row order; missing pixels are null (or NaN at the edge of the engine)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import mean, present, stdev


def _once(value: Column, body) -> Column:
    """body(value), value being worked out once."""
    return F.transform(F.array(value), body)[0]


def box_mask(height: int, width: int, box: tuple, extent: tuple) -> Column:
    """Booleans of the pixels that a box covers in an extent, both (x0, y0, x1, y1), rows from the top."""
    x0, x1 = ((v - extent[0]) / (extent[2] - extent[0]) * width for v in (box[0], box[2]))
    y0, y1 = ((extent[3] - v) / (extent[3] - extent[1]) * height for v in (box[3], box[1]))
    left, right, top, bottom = int(x0 + 0.5), int(x1 + 0.5), int(y0 + 0.5), int(y1 + 0.5)
    at = F.sequence(F.lit(0), F.lit(height * width - 1))
    return F.transform(at, lambda i: (F.floor(i / width) >= top) & (F.floor(i / width) < bottom) & (i % width >= left) & (i % width < right))


def pixel_median(scenes: DataFrame, key: str, pixels: str) -> DataFrame:
    """(key, pixels): the median of each pixel over a key's scenes, cut to the shortest scene; null where no scene has it."""
    each = scenes.where(F.col(pixels).isNotNull()).withColumn("_n", F.size(pixels)).select(key, "_n", F.posexplode(pixels).alias("_i", "_v"))
    shortest = scenes.where(F.col(pixels).isNotNull()).groupBy(key).agg(F.min(F.size(pixels)).alias("_least"))
    value = F.when(~F.isnan("_v"), F.col("_v"))
    medians = each.groupBy(key, "_i").agg(F.median(value).alias("_m")).join(shortest, key).where("_i < _least")
    return medians.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_m"))), lambda p: p["_m"]).alias(pixels))


def composite(scenes: DataFrame, key: str, bands: list[str], least_pixels: int = 256, least_scenes: int = 1) -> DataFrame:
    """(key, bands): median composites of masked scenes (missing pixels null). Scenes with fewer than ``least_pixels`` pixels and
    keys with fewer than ``least_scenes`` of the others are left out, missing pixels get their band's median (0 if it has none),
    and keys with a band whose percentiles 1 and 99 are less than 1 apart are rejected."""
    clear = scenes.where(F.size(present(F.col(bands[0]))) >= least_pixels)
    enough = clear.groupBy(key).count().where(F.col("count") >= least_scenes).select(key)
    out, clear = enough, clear.join(enough, key)
    for band in bands:
        out = out.join(pixel_median(clear, key, band), key)
        middle = F.coalesce(percentile_of(F.col(band), 0.5), F.lit(0.0))
        out = out.withColumn("_fill", middle).withColumn(band, F.transform(band, lambda x: F.coalesce(x, F.col("_fill")))).drop("_fill")
        out = out.where(percentile_of(F.col(band), 0.99) - percentile_of(F.col(band), 0.01) >= 1)
    return out


def stretch(pixels: Column, low: Column, high: Column) -> Column:
    """Between two values to [0, 1], clipped; nothing if they are equal."""
    return F.transform(pixels, lambda x: F.when(high > low, F.least(F.greatest((x - low) / (high - low), F.lit(0.0)), F.lit(1.0))))


def percentile_of(pixels: Column, q: float) -> Column:
    """Linear-interpolated percentile of the pixels that are there."""
    v = F.array_sort(present(pixels))
    at = (F.size(v) - 1) * q
    low, high = F.floor(at).cast("int"), F.ceil(at).cast("int")
    return F.get(v, low) + (F.get(v, high) - F.get(v, low)) * (at - low)


def masked(pixels: Column, mask: Column, inside: bool = True) -> Column:
    """The pixels inside (or outside) a mask that are there."""
    pairs = F.zip_with(pixels, mask, lambda x, m: F.struct(x.alias("x"), m.alias("m")))
    return present(F.transform(F.filter(pairs, lambda p: p["m"] if inside else ~p["m"]), lambda p: p["x"]))


def inside_ratio(pixels: Column, mask: Column) -> Column:
    """Mean inside over mean outside; null if either is empty or the outside isn't positive."""
    within, out = mean(masked(pixels, mask)), mean(masked(pixels, mask, inside=False))
    return F.when(out > 0, within / out)


def statistics(values: Column) -> list[Column]:
    """n, mean, std (population), median, max, p25, p75 of the values that are there."""
    v = present(values)
    return [F.size(v).cast("long"), mean(v), stdev(v), percentile_of(v, 0.5), F.array_max(v), percentile_of(v, 0.25), percentile_of(v, 0.75)]


def dilated(mask: Column, height: int, width: int) -> Column:
    """One pixel more in the four directions."""
    at = F.sequence(F.lit(0), F.lit(height * width - 1))
    on = lambda i: F.coalesce(F.get(mask, i), F.lit(False))
    return F.transform(at, lambda i: on(i) | ((i % width > 0) & on(i - 1)) | ((i % width < width - 1) & on(i + 1)) | ((i >= width) & on(i - width)) | ((i < (height - 1) * width) & on(i + width)))


def mosaic(layers: DataFrame, key: str, pixels: str, order: str) -> DataFrame:
    """(key, pixels): of each pixel the first layer, by order, that has it."""
    each = layers.select(key, order, F.posexplode(pixels).alias("_i", "_v"))
    first = each.groupBy(key, "_i").agg(F.min_by(F.when(~F.isnan("_v"), F.col("_v")), F.when(F.col("_v").isNotNull() & ~F.isnan("_v"), F.col(order))).alias("_v"))
    return first.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_v"))), lambda p: p["_v"]).alias(pixels))


def edge_strength(pixels: Column, height: int, width: int) -> Column:
    """Gradient magnitude by Sobel windows, edges repeated."""
    at = F.sequence(F.lit(0), F.lit(height * width - 1))
    row, col = lambda i: F.floor(i / width).cast("int"), lambda i: (i % width).cast("int")

    def v(p, i, dy, dx):
        y = F.least(F.greatest(row(i) + dy, F.lit(0)), F.lit(height - 1))
        x = F.least(F.greatest(col(i) + dx, F.lit(0)), F.lit(width - 1))
        return F.get(p, (y * width + x).cast("int"))

    def size(p, i):
        gx = v(p, i, -1, 1) + 2 * v(p, i, 0, 1) + v(p, i, 1, 1) - v(p, i, -1, -1) - 2 * v(p, i, 0, -1) - v(p, i, 1, -1)
        gy = v(p, i, 1, -1) + 2 * v(p, i, 1, 0) + v(p, i, 1, 1) - v(p, i, -1, -1) - 2 * v(p, i, -1, 0) - v(p, i, -1, 1)
        return F.sqrt(gx * gx + gy * gy)

    return _once(pixels, lambda p: F.transform(at, lambda i: size(p, i)))


def _window(pixels: Column, i: Column, height: int, width: int, reach: int) -> Column:
    """The pixels of the square window around pixel i, cut at the edges."""
    row, col = F.floor(i / width).cast("int"), (i % width).cast("int")
    x0, x1 = F.greatest(col - reach, F.lit(0)), F.least(col + reach, F.lit(width - 1))
    rows = F.sequence(F.greatest(row - reach, F.lit(0)), F.least(row + reach, F.lit(height - 1)))
    return F.flatten(F.transform(rows, lambda y: F.slice(pixels, y * width + x0 + 1, x1 - x0 + 1)))


def window_mode(pixels: Column, height: int, width: int, reach: int) -> Column:
    """For each pixel the commonest value of the square window around it, the least of tied ones; missing pixels don't count."""

    def mode(i):
        near = F.array_compact(_window(pixels, i, height, width, reach))
        return F.array_max(F.transform(F.array_distinct(near), lambda c: F.struct(F.size(F.filter(near, lambda x: x == c)).alias("n"), (-c).alias("v"))))

    return F.transform(F.sequence(F.lit(0), F.lit(height * width - 1)), lambda i: (-mode(i)["v"]))


def distance_to(wanted: Column, height: int, width: int, metres: float = 30.0) -> Column:
    """For each pixel the distance to the nearest one of the mask; null if there is none."""
    at = F.sequence(F.lit(0), F.lit(height * width - 1))
    there = F.filter(at, lambda i: F.coalesce(F.get(wanted, i), F.lit(False)))
    row, col = lambda i: F.floor(i / width), lambda i: i % width
    square = lambda x: x * x
    return _once(there, lambda js: F.transform(at, lambda i: F.sqrt(F.array_min(F.transform(js, lambda j: square(row(i) - row(j)) + square(col(i) - col(j))))) * metres))


def band_statistics(bands: dict[str, Column], mask: Column, height: int, width: int, red: str, nir: str, suffix: str = "") -> dict[str, Column]:
    """footprint_pixels; mean, std (population) and mean edge strength of each band inside the mask; mean index of the pixels whose nir + red is positive. Nulls in an empty mask."""
    out = {"footprint_pixels": F.size(F.filter(mask, lambda m: m)).cast("long")}
    for name, pixels in bands.items():
        inside = masked(pixels, mask)
        out |= {f"mean_{name}": mean(inside), f"std_{name}": stdev(inside), f"edge_{name}": mean(masked(edge_strength(pixels, height, width), mask))}
    pairs = F.filter(F.arrays_zip(bands[red].alias("r"), bands[nir].alias("n"), mask.alias("m")), lambda p: p["m"] & (p["n"] + p["r"] > 1e-6))
    out["ndvi"] = mean(F.transform(pairs, lambda p: (p["n"] - p["r"]) / (p["n"] + p["r"])))
    return {k + suffix: v for k, v in out.items()}


def joint_means(bands: dict[str, Column], mask: Column) -> dict[str, Column]:
    """footprint_pixels and each band's mean over the pixels of the mask that every band has; the means are null if there are none."""
    zipped = F.arrays_zip(mask.alias("m"), *[x.alias(name) for name, x in bands.items()])
    ok = lambda p: F.coalesce(p["m"], F.lit(False)) & F.forall(F.array(*[p[name] for name in bands]), lambda x: x.isNotNull() & ~F.isnan(x))
    valid = F.filter(zipped, ok)
    band = lambda name: mean(F.transform(valid, lambda p: p[name]))
    return {"footprint_pixels": F.size(valid).cast("long")} | {name: band(name) for name in bands}


def raster_window(box: tuple, x0: float, y0: float, res: float, width: int, height: int) -> Column:
    """(col, row, cols, rows) of the part of a raster (corner x0, y0 at the top left) that a box (xmin, ymin, xmax, ymax columns) covers: offsets and ends
    rounded half to even, cut at the raster's edges; null if nothing is left."""
    xmin, ymin, xmax, ymax = (F.col(c) for c in box)
    # the size is taken apart, as window readers do, so that the rounding is theirs
    left, top, wide, high = (xmin - x0) / res, (y0 - ymax) / res, (xmax - xmin) / res, (ymax - ymin) / res
    col, row = (F.greatest(F.lit(0), F.bround(v).cast("int")) for v in (left, top))
    cols, rows = F.least(F.lit(width), F.bround(left + wide).cast("int")) - col, F.least(F.lit(height), F.bround(top + high).cast("int")) - row
    return F.when((cols > 0) & (rows > 0), F.struct(col.alias("col"), row.alias("row"), cols.alias("cols"), rows.alias("rows")))


def resampled(pixels: Column, height: int, width: int, to_height: int, to_width: int) -> Column:
    """The nearest pixel for each of a raster of another size."""
    at = F.sequence(F.lit(0), F.lit(to_height * to_width - 1))
    place = lambda i: F.floor((F.floor(i / to_width) + 0.5) * height / to_height) * width + F.floor((i % to_width + 0.5) * width / to_width)
    return F.transform(at, lambda i: F.get(pixels, place(i).cast("int")))
