"""Trajectories to snapshots of an instant, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def snapshots(grid: DataFrame, key: str, extra: list[str]) -> DataFrame:
    """Long form, one row per (slot, vehicle): centre, dimensions, speed to the next slot.

    grid: key, slot, x, y, length, width, direction.
    """
    w = Window.partitionBy(key).orderBy("slot")
    step = F.coalesce(F.lead("slot").over(w) - F.col("slot"), F.col("slot") - F.lag("slot").over(w))
    move = F.coalesce(F.lead("x").over(w) - F.col("x"), F.col("x") - F.lag("x").over(w))
    cx = F.col("x") + F.col("direction") * F.col("length") * 0.5
    return grid.select("slot", key, "direction", cx.alias("cx"), F.col("y").alias("cy"), F.col("length").alias("l"), F.col("width").alias("w"), (F.col("direction") * move / step).alias("v"), *extra)


def nested(long: DataFrame, key: str) -> DataFrame:
    """One row per slot: maps eb and wb from vehicle to [cx, cy, l, w, direction, v]."""
    six = F.array("cx", "cy", "l", "w", F.col("direction").cast("double"), F.coalesce("v", F.lit(0.0)))
    entry = F.struct(F.col(key).cast("string").alias("key"), six.alias("value"))
    side = lambda d: F.map_from_entries(F.collect_list(F.when(F.col("direction") == d, entry)))
    return long.groupBy("slot").agg(side(1).alias("eb"), side(-1).alias("wb"))


def flat(nested_rows: DataFrame, key: str) -> DataFrame:
    """The long form of nested snapshots."""
    both = F.map_concat("eb", "wb")
    rows = nested_rows.select("slot", F.explode(both).alias(key, "s"))
    at = lambda k: F.col("s")[k]
    return rows.select("slot", key, at(0).alias("cx"), at(1).alias("cy"), at(2).alias("l"), at(3).alias("w"), at(4).cast("int").alias("direction"), at(5).alias("v"))


def tracks(long: DataFrame, key: str, most_gap: float = 1) -> DataFrame:
    """One row per stay of a vehicle: a new one begins where it was away for more than most_gap slots."""
    w = Window.partitionBy(key).orderBy("slot")
    rows = long.withColumn("_new", F.when(F.col("slot") - F.lag("slot").over(w) > most_gap, 1).otherwise(0))
    rows = rows.withColumn("stay", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    back = F.col("cx") - F.col("direction") * F.col("l") * 0.5
    sample = F.struct("slot", back.alias("x"), F.col("cy").alias("y"))
    return rows.groupBy(key, "stay").agg(
        F.sort_array(F.collect_list(sample)).alias("samples"), F.first("direction").alias("direction"), F.avg("l").alias("length"), F.avg("w").alias("width"), F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot")
    )
