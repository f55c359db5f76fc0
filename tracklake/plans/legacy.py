"""The older preparation of camera tables: units, the rear centre of a box, times from frames, directions and lanes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.kinematics import metric_lane
from ..operators.cleaning import mapped_time

#: Feet in a metre as these tables have it, the mean y above which a table is in feet, and frames a second.
FEET, FEET_ABOVE, FRAMES = 3.281, 40.0, 30
CORNERS = ("fbr", "fbl", "bbr", "bbl")
SCALED = ("length", "width", *(f"{c}_{v}" for c in CORNERS for v in "xy"))


def in_metres(rows: DataFrame) -> DataFrame:
    """Lengths divided by FEET where the table's mean rear right y tells that they are feet."""
    mean = rows.agg(F.coalesce(F.avg("bbr_y") > FEET_ABOVE, F.lit(False)).alias("_feet"))
    out = rows.crossJoin(F.broadcast(mean))  # one row
    return out.withColumns({c: F.when(F.col("_feet"), F.col(c) / FEET).otherwise(F.col(c)) for c in SCALED if c in rows.columns}).drop("_feet")


def prepared(rows: DataFrame, key: str = "id", lanes: bool = False) -> DataFrame:
    """A camera's rows (key, frame, t or null, corners, length, width) with x and y of the rear centre in metres, times mapped
    linearly from frames (FRAMES a second where none is given), and the direction of each key; and its lane if asked for."""
    rows = in_metres(rows).withColumns({v: (F.col(f"bbr_{v}") + F.col(f"bbl_{v}")) / 2 for v in "xy"})
    rows = mapped_time(rows, "frame", "t").withColumn("t", F.coalesce("mapped_t", F.col("frame") / float(FRAMES))).drop("mapped_t")
    own = Window.partitionBy(key)
    first, last = F.min_by("bbr_x", "frame").over(own), F.max_by("bbr_x", "frame").over(own)
    rows = rows.withColumn("direction", F.signum(last - first).cast("int"))
    return rows.withColumn("lane", metric_lane(F.col("y"))) if lanes else rows
