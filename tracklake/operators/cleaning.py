"""Removal and marking of bad samples: masks, outliers, short tracks, wrong directions, repeated measurements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Share of a bound within which doubles are taken to lie on it; sums of doubles err by less.
BOUND_MARGIN = 1e-12


def whole(key: str):
    return Window.partitionBy(key)


def confident(points: DataFrame, least: float = 0.5, min_samples: int = 4, key: str = "fragment_id") -> DataFrame:
    """Samples of at least this confidence, of fragments that keep enough of them."""
    kept = points.where(F.col("conf") >= least)
    return kept.withColumn("_n", F.count(F.lit(1)).over(whole(key))).where(F.col("_n") >= min_samples).drop("_n")


def confident_series(trajectories: DataFrame, series: Sequence[str], confidence: str = "detection_confidence", least: float = 0.5, min_samples: int = 4) -> DataFrame:
    """The same on array rows: all series are cut to the shortest, then masked alike."""
    shortest = F.least(*[F.size(c) for c in (*series, confidence)])
    zipped = F.arrays_zip(*[F.slice(F.col(c), F.lit(1), shortest).alias(c) for c in dict.fromkeys((*series, confidence))])
    kept = F.filter(zipped, lambda s: s[confidence] >= least)
    rows = trajectories.withColumn("_kept", kept).where(F.size("_kept") >= min_samples)
    return rows.withColumns({c: F.col("_kept")[c] for c in dict.fromkeys((*series, confidence))}).drop("_kept")


def long_enough(points: DataFrame, x: str, more_than: int = 3, key: str = "fragment_id") -> DataFrame:
    """Samples of tracks with more than this many rows and valid values."""
    n = F.least(F.count(F.lit(1)).over(whole(key)), F.count(x).over(whole(key)))
    return points.withColumn("_n", n).where(F.col("_n") > more_than).drop("_n")


def right_direction(points: DataFrame, y: Column, direction: Column, key: str = "fragment_id", middle: float = 18.5) -> DataFrame:
    """Tracks whose mean y lies on the side of the road of their direction (below the middle: +1)."""
    side = F.when(F.avg(y).over(whole(key)) < middle, 1).otherwise(-1)
    return points.withColumn("_side", side).where(F.col("_side") == direction).drop("_side")


def null_beyond(x: Column, key: str, sds: float = 2) -> Column:
    """Null where further than so many standard deviations from the track's mean.

    What lies on the bound stays: without the margin, the order in which rows are summed would decide there.
    """
    w = whole(key)
    return F.when(F.abs(x - F.avg(x).over(w)) <= sds * F.stddev_pop(x).over(w) * (1 + BOUND_MARGIN), x)


def off_line(points: DataFrame, t: Column, xs: Sequence[str], key: str, low: float = 0.1, high: float = 0.9) -> DataFrame:
    """Adds `outlier`: the residual of a line through any of xs lies outside its track's inner quantiles."""
    w = whole(key)
    rows = points.withColumn("_t", t)
    for x in xs:
        slope, intercept = F.regr_slope(x, "_t").over(w), F.regr_intercept(x, "_t").over(w)
        rows = rows.withColumn(f"_r_{x}", F.col(x) - (slope * F.col("_t") + intercept))
    out = F.lit(False)
    for x in xs:
        r = F.col(f"_r_{x}")
        bounds = F.percentile(r, F.array(F.lit(low), F.lit(high))).over(w)
        rows = rows.withColumn(f"_b_{x}", bounds)
        out = out | (r < F.col(f"_b_{x}")[0]) | (r > F.col(f"_b_{x}")[1])
    return rows.withColumn("outlier", F.coalesce(out, F.lit(False))).drop("_t", *[f"_{p}_{x}" for x in xs for p in "rb"])


def far_from_median(x: str, key: str, sds: float = 2) -> Column:
    w = whole(key)
    return F.abs(F.col(x) - F.median(x).over(w)) > sds * F.stddev_pop(x).over(w)


def trimmed(points: DataFrame, x: str, key: str, order: str) -> DataFrame:
    """Without the rows before the first and after the last valid value of a track."""
    at = F.when(F.col(x).isNotNull(), F.col(order))
    w = whole(key)
    rows = points.withColumn("_first", F.min(at).over(w)).withColumn("_last", F.max(at).over(w))
    return rows.where(F.col(order).between(F.col("_first"), F.col("_last"))).drop("_first", "_last")


def mean_of_repeats(points: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    return points.groupBy(*keys).agg(*[F.avg(v).alias(v) for v in values])


def first_of_repeats(points: DataFrame, keys: Sequence[str], x: str, order: Sequence[str]) -> DataFrame:
    """One row per key: the first in order that is valid, if any is."""
    w = Window.partitionBy(*keys).orderBy(F.col(x).isNull(), *order)
    return points.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def duplicate_frames(points: DataFrame, key: str, frame: str) -> DataFrame:
    """Keys with repeated frames, and how many rows are repeats."""
    counted = points.groupBy(key).agg((F.count(frame) - F.count_distinct(frame)).alias("duplicates"))
    return counted.where("duplicates > 0")


def mapped_time(points: DataFrame, frame: str, t: str) -> DataFrame:
    """Adds mapped_t: time as the straight line of the frame number through the first and last frames."""
    ends = points.agg(F.min(frame).alias("f0"), F.max(frame).alias("f1"), F.min_by(t, frame).alias("t0"), F.max_by(t, frame).alias("t1"))
    rows = points.crossJoin(F.broadcast(ends))  # one row
    span, at = F.col("t1") - F.col("t0"), F.col(frame) - F.col("f0")
    if all(kind == "bigint" for name, kind in rows.select("t0", "f0").dtypes):  # their product can be larger than a long
        span, at = span.cast("decimal(19,0)"), at.cast("decimal(19,0)")
    return rows.withColumn("mapped_t", F.col("t0") + (span * at).cast("double") / F.nullif(F.col("f1") - F.col("f0"), F.lit(0))).drop("f0", "f1", "t0", "t1")


def extended(ends: DataFrame, key: str, frames: tuple[int, int], edges: tuple[float, float], most: int = 1000) -> DataFrame:
    """New rows of a track (key, frame, x, direction, v per frame, first_frame, last_frame, first_x, last_x) ahead of
    its last frame and behind its first, at constant speed, until the road or the frames end."""
    ahead = F.least(F.lit(most), F.lit(frames[1]) - F.col("last_frame"), F.floor(F.when(F.col("direction") == 1, edges[1] - F.col("last_x")).otherwise(F.col("last_x") - edges[0]) / F.col("v")))
    behind = F.least(F.lit(most), F.col("first_frame") - F.lit(frames[0]), F.floor(F.when(F.col("direction") == 1, F.col("first_x") - edges[0]).otherwise(edges[1] - F.col("first_x")) / F.col("v")))
    steps = lambda n: F.when(n >= 1, F.sequence(F.lit(1), n.cast("int"))).otherwise(F.array().cast("array<int>"))
    moving = ends.where(F.col("v") >= 1)
    fore = moving.select(key, F.explode(steps(ahead)).alias("k"), "direction", "v", "last_frame", "last_x").select(
        key, (F.col("last_frame") + F.col("k")).alias("frame"), (F.col("last_x") + F.col("direction") * F.col("v") * F.col("k")).alias("x"), F.lit("Extended").alias("method")
    )
    back = moving.select(key, F.explode(steps(behind)).alias("k"), "direction", "v", "first_frame", "first_x").select(
        key, (F.col("first_frame") - F.col("k")).alias("frame"), (F.col("first_x") - F.col("direction") * F.col("v") * F.col("k")).alias("x"), F.lit("Extended").alias("method")
    )
    return fore.unionByName(back)
