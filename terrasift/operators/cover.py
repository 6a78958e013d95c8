"""Land-cover, colour and chip-quality rules. The thresholds are parameters of the rules' tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.arrays import stdev
from ..functions.scalar import tidy


#: Classes that the cover rule drops.
COVER_DROPPED = ("water", "concrete", "metal_roof", "asphalt", "rust_brick")


def cover_tier(blue="blue", green="green", red="red", nir="nir") -> Column:
    """(cover, tier) of band means: the first of the tiers below that holds. A band that is null or NaN makes it missing, 0;
    red over a blue that isn't positive counts as 99."""
    b, g, r, n = (F.col(c) for c in (blue, green, red, nir))
    yellow = F.when(b > 0, r / b).otherwise(99.0)
    bright = (r > 0.2) & (yellow < 1.2) & (n <= 1.1 * r)
    tiers = [
        (0, "missing", b.isNull() | g.isNull() | r.isNull() | n.isNull() | F.isnan(b) | F.isnan(g) | F.isnan(r) | F.isnan(n)),
        (1, "water", (n < 0.05) & (b > r)),
        (2, "vegetation", n > 2.0 * r),
        (3, "metal_roof", bright & (r > 0.35) & (b > 0.25)),
        (3, "concrete", bright),
        (4, "asphalt", (r < 0.12) & (g < 0.12) & (b < 0.12) & (n < 0.15)),
        (5, "rust_brick", (yellow > 1.4) & (r > 0.18) & (n <= 1.05 * r)),
        (6, "sand", (yellow > 1.2) & (n > 1.05 * r)),
        (7, "sparse_veg", n > 1.2 * r),
        (8, "bare_soil", (r > 0.1) & (r < 0.3) & (yellow > 1.1) & (n > 0.9 * r)),
        (9, "ambiguous", F.lit(True)),
    ]
    said = [F.when(test, F.struct(F.lit(name).alias("cover"), F.lit(tier).alias("tier"))) for tier, name, test in tiers]
    return F.coalesce(*said)


def colour_class(ndvi: Column, brightness: Column, nir_over_red: Column) -> Column:
    """natural for green or a near-infrared surplus, built for bright or dark without one, else ambiguous; null or NaN: missing."""
    absent = [x.isNull() | F.isnan(x) for x in (ndvi, brightness, nir_over_red)]
    return (
        F.when(absent[0] | absent[1] | absent[2], "missing").when((ndvi > 0.10) | (nir_over_red > 1.1), "natural")
        .when((brightness > 0.30) | (brightness < 0.15), "built").otherwise("ambiguous")
    )


def chip_quality(red: Column, green: Column, blue: Column, dark: float = 10.0, dark_share: float = 0.3, least_std: float = 8.0) -> Column:
    """missing, empty (more than dark_share of the pixels with a band sum under dark), cloudy (too even over all bands) or ok."""
    total = F.transform(F.arrays_zip(red.alias("r"), green.alias("g"), blue.alias("b")), lambda p: p["r"] + p["g"] + p["b"])
    share = F.size(F.filter(total, lambda x: x < dark)) / F.size(total)
    none = red.isNull() | green.isNull() | blue.isNull() | (F.size(red) == 0)
    return F.when(none, "missing").when(share > dark_share, "empty").when(tidy(stdev(F.concat(red, green, blue))) < least_std, "cloudy").otherwise("ok")


#: Groups of building classes; every other class is "other".
CLASS_GROUPS = {
    "industrial": ["industrial", "warehouse", "hangar", "manufacture"],
    "commercial": ["commercial"],
    "retail": ["retail"],
    "office": ["office"],
    "parking": ["parking"],
    "education": ["school", "university", "college", "kindergarten", "library"],
    "residential": ["apartments", "residential", "house", "detached", "terrace", "semidetached_house", "dormitory"],
    "religious": ["church", "cathedral", "mosque", "synagogue", "religious"],
    "institutional": ["hospital", "hotel", "civic", "government", "post_office", "public", "fire_station", "stadium", "grandstand"],
    "agricultural": ["farm_auxiliary", "barn", "greenhouse"],
}


def group_of(name: str, groups: dict[str, list[str]], other: str = "other") -> Column:
    out = F.lit(other)
    for group, values in groups.items():
        out = F.when(F.coalesce(F.col(name).isin(values), F.lit(False)), group).otherwise(out)
    return out
