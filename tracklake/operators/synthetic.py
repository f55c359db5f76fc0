"""Ground truth made worse on purpose: missing stretches that break a track into fragments, and outliers; vehicle dimensions.

Chance is a hash of the seed, the track and the sample's place, so that a track is spoilt alike wherever it is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A class number's kind of vehicle, and the length and width of each kind in metres.
KINDS = {1: "sedan", 2: "sedan", 3: "sedan", 4: "SUV", 5: "truck", 6: "trailer", 7: "bus"}
DIMENSIONS = {"sedan": (4.5, 1.7), "SUV": (4.5, 1.9), "truck": (8.0, 2.0), "bus": (12.0, 2.2), "trailer": (12.0, 2.2)}
#: Missing stretches for each sample of a track, the deviation of their length, and the variance of an
#: outlier as a share of the vehicle's length and width.
STRETCHES, LENGTH_DEVIATION, OUTLIER_VARIANCE = 0.01, 20.0, 0.3


def kind(number: Column) -> Column:
    """The kind of vehicle of a class number; what is no class number counts as 1."""
    table = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.coalesce(number.cast("string").try_cast("int"), F.lit(1))), F.lit(KINDS[1]))


def dimension(of: Column, side: int) -> Column:
    """The length (side 0) or width (1) of a kind of vehicle, in metres."""
    return F.try_element_at(F.create_map(*[F.lit(x) for name, sizes in DIMENSIONS.items() for x in (name, sizes[side])]), of)


def _uniform(seed: int, what: int, *parts: str) -> Column:
    return (F.pmod(F.xxhash64(F.lit(seed), F.lit(what), *parts), F.lit(1 << 40)) + 1) / float((1 << 40) + 1)


def _normal(seed: int, what: int, *parts: str) -> Column:
    """Box and Muller: two uniform numbers make a normal one."""
    return F.sqrt(-2 * F.log(_uniform(seed, what, *parts))) * F.cos(2 * F.pi() * _uniform(seed, what + 1, *parts))


def polluted(points: DataFrame, key: str, order: str, mean_stretch: float, outliers: float, seed: int = 0) -> DataFrame:
    """Samples (key, order, x, y, length, width) with x and y null in missing stretches, or moved where `outlier`, and the
    fragment_id that a sample belongs to after them.

    A track of n samples loses int(n / 100) stretches of normally distributed length; the samples from the end of the
    k-th on are fragment 1000 * key + k - 1, those before the first end keep the key.
    """
    own = Window.partitionBy(key)
    rows = points.withColumn("_place", F.row_number().over(own.orderBy(order)) - 1).withColumn("_n", F.count(F.lit(1)).over(own))

    def chosen(what: int, share: float) -> Column:
        place = F.row_number().over(own.orderBy(_uniform(seed, what, key, "_place"), "_place"))
        return place <= F.floor(F.col("_n") * share)

    so_far = own.orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_begins", chosen(1, STRETCHES)).withColumn("outlier", chosen(2, outliers))
    length = F.greatest(F.lit(0.0), F.lit(mean_stretch) + LENGTH_DEVIATION * _normal(seed, 3, key, "_place"))
    rows = rows.withColumn("_end", F.when(F.col("_begins"), F.col("_place") + F.floor(length)))
    rows = rows.withColumn("_number", F.when(F.col("_begins"), F.sum(F.col("_begins").cast("int")).over(so_far)))
    rows = rows.withColumn("_gone", F.coalesce(F.max("_end").over(so_far) >= F.col("_place"), F.lit(False)))
    ends = rows.where("_begins").groupBy(key, F.col("_end").alias("_place")).agg(F.max("_number").alias("_after"))
    rows = rows.join(ends, [key, "_place"], "left").withColumn("_after", F.max("_after").over(so_far))
    fragment = F.when(F.col("_after").isNull(), F.col(key)).otherwise(F.col(key) * 1000 + F.col("_after") - 1)
    moved = lambda c, size, what: F.when(F.col("outlier"), F.col(c) + F.sqrt(OUTLIER_VARIANCE * F.col(size)) * _normal(seed, what, key, "_place")).otherwise(F.col(c))
    new = {"x": moved("x", "length", 5), "y": moved("y", "width", 7)}
    out = rows.withColumns({c: F.when(~F.col("_gone"), v) for c, v in new.items()} | {"fragment_id": fragment})
    return out.drop("_place", "_n", "_begins", "_end", "_number", "_gone", "_after")
