"""Resampling of trajectories to a time grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.kinematics import interpolate


def grid_means(points: DataFrame, key: str, t: str, step: int, values: Sequence[str], anchored: bool = False) -> DataFrame:
    """One row per key and grid slot that has samples: slot, and the mean of each value.

    Slots are counted on the global grid, so that slots of different keys can be joined; anchored counts
    from each key's first sample instead.
    """
    at = F.col(t) - F.min(t).over(Window.partitionBy(key)) if anchored else F.col(t)
    rows = points.withColumn("slot", F.floor(at / step))
    return rows.groupBy(key, "slot").agg(*[F.avg(v).alias(v) for v in values])


def full_grid(means: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """Adds the empty slots between each key's first and last, with null values."""
    ends = means.groupBy(key).agg(F.min("slot").alias("_a"), F.max("slot").alias("_b"))
    slots = ends.select(F.col(key).alias("_key"), F.explode(F.sequence("_a", "_b")).alias("_slot"))
    joined = slots.join(means, (slots["_key"] == means[key]) & (slots["_slot"] == means["slot"]), "left")
    return joined.select(F.col("_key").alias(key), F.col("_slot").alias("slot"), *values)


def linear_grid(points: DataFrame, key: str, t: str, step: int, values: Sequence[str], anchored: bool = False) -> DataFrame:
    """Every slot from a key's first to its last; empty ones are interpolated in time."""
    grid = full_grid(grid_means(points, key, t, step, values, anchored), key, values)
    w = Window.partitionBy(key).orderBy("slot")
    return grid.select(key, "slot", *[interpolate(F.col(v), F.col("slot"), w, clamp=False).alias(v) for v in values])


def fine_then_coarse(points: DataFrame, key: str, t: str, fine: int, ratio: int, values: Sequence[str]) -> DataFrame:
    """Means on a fine grid anchored at each key's first sample, interpolated, and every ratio-th slot kept."""
    return linear_grid(points, key, t, fine, values, anchored=True).where(F.col("slot") % ratio == 0).withColumn("slot", F.expr(f"slot div {ratio}"))


def clip_extrapolation(grid: DataFrame, key: str, x: str, reach: int) -> DataFrame:
    """Without the slots more than `reach` beyond a key's valid ones."""
    w = Window.partitionBy(key)
    at = F.when(F.col(x).isNotNull(), F.col("slot"))
    rows = grid.withColumn("_a", F.min(at).over(w)).withColumn("_b", F.max(at).over(w))
    return rows.where(F.col("slot").between(F.col("_a") - reach, F.col("_b") + reach)).drop("_a", "_b")
