"""Speeds, accelerations, lanes, runs, fills and smoothing as window expressions over a trajectory's samples."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

LANE_FEET = 12
LANES_FROM, LAST_LANE = -12, 13
#: Degrees in a radian as this data model has them.
DEGREES = 180 / 3.14


def along(key: str = "fragment_id", *order: str) -> WindowSpec:
    return Window.partitionBy(key).orderBy(*(order or ("t", "event_id")))


def difference(x: Column, w: WindowSpec) -> Column:
    return x - F.lag(x).over(w)


def rate(x: Column, t: Column, w: WindowSpec) -> Column:
    """First difference over time; null at the first sample, and where no time passed."""
    dt = difference(t, w)
    return difference(x, w) / F.nullif(dt, F.lit(0).cast("double"))


def acceleration(x: Column, t: Column, w: WindowSpec) -> Column:
    """Second difference ahead over the square of the next gap; null at the last two samples."""
    dt = F.lead(t).over(w) - t
    return (F.lead(x, 2).over(w) - 2 * F.lead(x).over(w) + x) / F.nullif(dt * dt, F.lit(0).cast("double"))


def velocity_ahead(x: Column, dt: float, w: WindowSpec) -> Column:
    """Difference to the next sample, the last value repeated."""
    return F.coalesce(F.lead(x).over(w) - x, x - F.lag(x).over(w)) / dt


def rotation(vx: Column, vy: Column) -> Column:
    return F.atan2(F.abs(vy), F.abs(vx)) * DEGREES


def lane(y: Column) -> Column:
    """0 below the first edge, then one more at each edge of 12 ft (an edge belongs to the upper lane), 13 at most."""
    return F.least(F.greatest(F.floor((y - LANES_FROM) / LANE_FEET) + 1, F.lit(0)), F.lit(LAST_LANE)).cast("int")


def metric_lane(y: Column) -> Column:
    """Lane of a position in metres; the eleventh and above is none."""
    number = F.floor(y / (LANE_FEET / 3.281)).cast("int")
    return F.when((number >= 0) & (number < 11), number)


def lane_changes(lane_now: Column, w: WindowSpec) -> Column:
    """1 at a sample in another lane than the one before."""
    return F.when(lane_now != F.lag(lane_now).over(w), 1).otherwise(0)


def travel_direction(x: Column, y: Column, key: str = "fragment_id") -> Column:
    """Sign of the way from the first to the last valid x; without two, by the side of the road."""
    w = along(key).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    way = F.last(x, ignorenulls=True).over(w) - F.first(x, ignorenulls=True).over(w)
    return F.when(way > 0, 1).when(way < 0, -1).when(F.first(y, ignorenulls=True).over(w) < 18, 1).otherwise(-1)


def longest_run(df: DataFrame, key: str, frame: str, gaps: int = 0) -> DataFrame:
    """The first longest run of frames with at most `gaps` frames missing in a row, without its last frame."""
    w = Window.partitionBy(key).orderBy(frame)
    new = F.when(F.col(frame) - F.lag(frame).over(w) <= 1 + gaps, 0).otherwise(1)
    runs = df.withColumn("_new", new).withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    sizes = runs.groupBy(key, "_run").agg(F.count(F.lit(1)).alias("_size"), F.min(frame).alias("_start"), F.max(frame).alias("_stop"))
    best = sizes.groupBy(key).agg(F.max_by(F.struct("_run", "_stop"), F.struct("_size", -F.col("_start"))).alias("_best"))
    kept = runs.join(best, key).where((F.col("_run") == F.col("_best._run")) & (F.col(frame) < F.col("_best._stop")))
    return kept.drop("_new", "_run", "_best")


def fill_forward(x: Column, w: WindowSpec) -> Column:
    return F.last(x, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def interpolate(x: Column, at: Column, w: WindowSpec, clamp: bool = True) -> Column:
    """Linear in `at` between the nearest valid values; past the end the last value; before the start the
    first value if clamp, else null."""
    back, ahead = w.rowsBetween(Window.unboundedPreceding, Window.currentRow), w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    valid = F.when(x.isNotNull(), at)
    x0, x1 = F.last(x, ignorenulls=True).over(back), F.first(x, ignorenulls=True).over(ahead)
    a0, a1 = F.last(valid, ignorenulls=True).over(back), F.first(valid, ignorenulls=True).over(ahead)
    between = x0 + (x1 - x0) * (at - a0) / F.nullif((a1 - a0).cast("double"), F.lit(0.0))
    return F.when(x.isNotNull(), x).when(x0.isNull(), x1 if clamp else F.lit(None).cast("double")).when(x1.isNull(), x0).otherwise(between)


def moving_average(x: Column, size: int, w: WindowSpec) -> Column:
    """A centred sum of `size` samples over `size`, as if zeros lay beyond the ends."""
    return F.sum(x).over(w.rowsBetween(-(size // 2), (size - 1) // 2)) / size


def edge_corrected_average(x: Column, size: int, w: WindowSpec) -> Column:
    """A centred mean over the samples that are there."""
    return F.avg(x).over(w.rowsBetween(-(size // 2), (size - 1) // 2))


def gaussian_smooth(df: DataFrame, key: str, order: list[str], x: str, sigma: float = 10.0) -> DataFrame:
    """A Gaussian-weighted sum over all samples of a key, the kernel as long as the series.

    Each key's series is one array, so the work stays in one row: no self-join.
    """
    series = df.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*order, F.col(x).cast("double").alias("_x")))).alias("_s"))
    weight = lambda d: F.exp(-(d * d) / (2 * sigma * sigma)) / (sigma * math.sqrt(2 * math.pi))
    n = F.size("_s")
    # Kernel place k lies at k - (n - 1) / 2; the middle of the full convolution starts at (n - 1) // 2.
    shift = F.floor((n - 1) / 2) - (n - 1) / F.lit(2.0)
    smooth = F.transform("_s", lambda own, i: F.struct(*[own[c].alias(c) for c in order], F.aggregate(F.transform("_s", lambda v, j: v["_x"] * weight((i - j) + shift)), F.lit(0.0), lambda a, b: a + b).alias("smooth")))
    return series.select(key, F.explode(smooth).alias("_v")).select(key, "_v.*")


def integrate(rate_column: Column, dt: float, w: WindowSpec) -> Column:
    """Where Euler steps of dt lead from 0: the sum of all earlier rates times dt."""
    return F.coalesce(F.sum(rate_column).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) * dt
