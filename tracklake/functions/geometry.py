"""Boxes, gaps, distances, projections and unit conversions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FEET_PER_METRE = 3.281
EARTH_METRES = 6_371_000


def clamp(x: Column, low, high) -> Column:
    return F.greatest(F.least(x, F.lit(high)), F.lit(low))


def centre_x(x: Column, direction: Column, length: Column) -> Column:
    """Middle of a vehicle whose back is at x."""
    return x + direction * length * 0.5


def back_x(cx: Column, direction: Column, length: Column) -> Column:
    return cx - direction * length * 0.5


def box(cx: Column, cy: Column, length: Column, width: Column) -> Column:
    """Left, top, right, bottom."""
    return F.struct((cx - length / 2).alias("lx"), (cy + width / 2).alias("ty"), (cx + length / 2).alias("rx"), (cy - width / 2).alias("by"))


def overlaps(a: Column, b: Column, xpad: float = 0, ypad: float = 0) -> Column:
    """Whether two boxes share a point; touching edges count."""
    return ~((a["lx"] > b["rx"] + xpad) | (a["ty"] + ypad < b["by"]) | (a["rx"] + xpad < b["lx"]) | (a["by"] > b["ty"] + ypad))


def space_gap(a: Column, b: Column) -> Column:
    """Bumper gap of two boxes in one lane (their middles less than 6 ft apart), else null."""
    same = F.abs(a["ty"] + a["by"] - b["ty"] - b["by"]) / 2 < 6
    return F.when(same, F.greatest(b["lx"] - a["rx"], a["lx"] - b["rx"]))


def configuration(a: Column, b: Column, xpad: float = 5, ypad: float = 1) -> Column:
    """On which sides of b the box a (cx, cy, l, w) is clear of it; on none: they overlap."""
    return F.struct(
        (a["cx"] - a["l"] * 0.5 - xpad > b["cx"] + b["l"] * 0.5).alias("ahead"),
        (a["cx"] + a["l"] * 0.5 + xpad < b["cx"] - b["l"] * 0.5).alias("behind"),
        (a["cy"] + a["w"] * 0.5 + ypad < b["cy"] - b["w"] * 0.5).alias("right"),
        (a["cy"] - a["w"] * 0.5 - ypad > b["cy"] + b["w"] * 0.5).alias("left"),
    )


def corners(width: Column, length: Column, x: Column, y: Column, theta: Column) -> Column:
    """The footprint of a vehicle whose back centre is at (x, y), turned by theta: back right, front right, front left, back left."""
    c, s = F.cos(theta), F.sin(theta)
    at = lambda ahead, left: (x + c * ahead - s * left, y + s * ahead + c * left)
    names = ("bbr", "fbr", "fbl", "bbl")
    places = (at(F.lit(0), -width / 2), at(length, -width / 2), at(length, width / 2), at(F.lit(0), width / 2))
    return F.struct(*[v.alias(f"{n}_{axis}") for n, p in zip(names, places, strict=True) for axis, v in zip("xy", p, strict=True)])


def reordered_corners(xs: list[Column], ys: list[Column], direction: Column) -> Column:
    """Corners of an axis-parallel box put where the direction wants them."""
    lo_x, hi_x, lo_y, hi_y = F.least(*xs), F.greatest(*xs), F.least(*ys), F.greatest(*ys)
    east = direction == 1
    back, front = F.when(east, lo_x).otherwise(hi_x), F.when(east, hi_x).otherwise(lo_x)
    right, left = F.when(east, lo_y).otherwise(hi_y), F.when(east, hi_y).otherwise(lo_y)
    return F.struct(*[v.alias(n) for n, v in (("bbr_x", back), ("bbr_y", right), ("fbr_x", front), ("fbr_y", right), ("fbl_x", front), ("fbl_y", left), ("bbl_x", back), ("bbl_y", left))])


def capped_width(width: Column, cap: float = 2.59) -> Column:
    return F.least(width, F.lit(cap))


def planar_distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres east, north and between, on a plane that touches the first point."""
    rad = F.radians
    dx = EARTH_METRES * (rad(lon2) - rad(lon1)) * F.cos((rad(lat1) + rad(lat2)) / 2)
    dy = EARTH_METRES * (rad(lat2) - rad(lat1))
    return F.struct(F.sqrt(dx * dx + dy * dy).alias("d"), dx.alias("dx"), dy.alias("dy"))


def project(h: list[float], x: Column, y: Column) -> Column:
    """A point under the projective map with the nine coefficients h, row by row."""
    w = x * h[6] + y * h[7] + h[8]
    return F.struct(((x * h[0] + y * h[1] + h[2]) / w).alias("x"), ((x * h[3] + y * h[4] + h[5]) / w).alias("y"))


def fit_projection(source: list[tuple[float, float]], target: list[tuple[float, float]]) -> list[float]:
    """The projective map of at least four point pairs, by direct linear transformation."""
    import numpy as np

    rows = []
    for (x, y), (u, v) in zip(source, target, strict=True):
        rows += [[x, y, 1, 0, 0, 0, -u * x, -u * y, -u], [0, 0, 0, x, y, 1, -v * x, -v * y, -v]]
    h = np.linalg.svd(np.array(rows, float))[2][-1]
    return (h / h[-1]).tolist()


def box_iou(a: Column, b: Column) -> Column:
    """Shared area over the smaller area of two axis-parallel boxes."""
    w = F.greatest(F.least(a["rx"], b["rx"]) - F.greatest(a["lx"], b["lx"]), F.lit(0.0))
    h = F.greatest(F.least(a["ty"], b["ty"]) - F.greatest(a["by"], b["by"]), F.lit(0.0))
    area = lambda q: (q["rx"] - q["lx"]) * (q["ty"] - q["by"])
    return w * h / F.nullif(F.least(area(a), area(b)), F.lit(0.0))


def to_feet(metres: Column) -> Column:
    return metres * FEET_PER_METRE


def mph_to_feet_per_second(v: Column) -> Column:
    return v * 5280 / 3600


def lane_centre(lane: Column) -> Column:
    """Metres from the yellow line to the middle of a lane counted from the right."""
    return ((4 - lane) * 12 + 6) / FEET_PER_METRE


def vehicle_class(column: Column) -> Column:
    """A class number, 1 where it isn't one."""
    return F.coalesce(column.try_cast("int"), F.lit(1))


def camera_of(file_name: Column) -> Column:
    return F.regexp_extract(file_name, r"(p(\d)*c(\d)*)", 1)


def camera_at(x: Column, ranges: list[tuple[str, float, float]]) -> Column:
    """The first camera whose range holds x."""
    out = F.lit(None).cast("string")
    for name, low, high in reversed(ranges):
        out = F.when((x >= low) & (x < high), name).otherwise(out)
    return out
