"""Trajectories read out of an event table: a user is a vehicle, its running value is the way it went.

The time unit is hours, so that windows given in seconds keep their ratios to the length of a fragment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

HOUR = 3_600_000_000  # microseconds
FRAGMENT_GAP = 12 * HOUR


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sample: event_id, t, vehicle_id, fragment_id, direction, compute_node_id, x_cents, y, conf, length, width."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    t = F.unix_micros(F.col("ts").cast("timestamp"))
    k = F.get_json_object("props", "$.k").cast("int")
    rows = events.select("event_id", t.alias("t"), F.col("user_id").alias("vehicle_id"), F.round(F.col("value") * 100).cast("bigint").alias("cents"), k.alias("k"))
    by_vehicle = Window.partitionBy("vehicle_id").orderBy("t", "event_id")
    so_far = by_vehicle.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    new = F.when(F.col("t") - F.lag("t").over(by_vehicle) > FRAGMENT_GAP, 1).otherwise(0)
    rows = rows.withColumn("new", new)
    direction = F.when(F.col("vehicle_id") % 2 == 0, 1).otherwise(-1)
    return rows.select(
        "event_id",
        "t",
        "vehicle_id",
        (F.col("vehicle_id") * 1000 + F.sum("new").over(so_far)).alias("fragment_id"),
        direction.alias("direction"),
        (F.col("vehicle_id") % 4).alias("compute_node_id"),
        (direction * F.sum("cents").over(so_far)).alias("x_cents"),
        (F.col("k") * 72 / F.lit(100.0)).alias("y"),
        ((F.col("event_id") * 37) % 100 / F.lit(100.0)).alias("conf"),
        (F.lit(15.0) + F.col("vehicle_id") % 5).alias("length"),
        (F.lit(6.0) + (F.col("vehicle_id") % 3) * 0.5).alias("width"),
    )


def fragments(points: DataFrame) -> DataFrame:
    """One row per fragment, with first and last sample."""
    first, last = F.struct("t", "event_id"), F.struct("t", "event_id")
    return points.groupBy("fragment_id", "vehicle_id", "direction", "compute_node_id", "length", "width").agg(
        F.min("t").alias("first_t"),
        F.max("t").alias("last_t"),
        F.count(F.lit(1)).alias("n"),
        F.min_by("x_cents", first).alias("starting_x"),
        F.max_by("x_cents", last).alias("ending_x"),
    )


def trajectories(points: DataFrame, min_samples: int = 4) -> DataFrame:
    """One row per fragment with its samples as parallel arrays; shorter fragments are left out."""
    sample = F.struct("t", "event_id", F.col("x_cents").cast("double").alias("x"), "y", "conf")
    rows = points.groupBy("fragment_id", "vehicle_id", "direction", "compute_node_id", "length", "width").agg(F.sort_array(F.collect_list(sample)).alias("s"))
    rows = rows.where(F.size("s") >= min_samples)
    series = lambda f: F.transform("s", lambda v: v[f])
    return rows.select(
        "fragment_id", "vehicle_id", "direction", "compute_node_id", "length", "width",
        series("t").alias("timestamp"), series("x").alias("x_position"), series("y").alias("y_position"), series("conf").alias("detection_confidence"),
    )
