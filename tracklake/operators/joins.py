"""Interval joins without all pairs: rows meet only in a bucket of time that both touch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _sides(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    return a.select(*[F.col(c).alias(f"a_{c}") for c in a.columns]), b.select(*[F.col(c).alias(f"b_{c}") for c in b.columns])


def _dealt(a: DataFrame) -> DataFrame:
    """Rows dealt out by their first column: Spark makes tasks by bytes, and a task of few bytes can have most of the pairs."""
    return a.repartition(int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")), a.columns[0])


def overlap_join(a: DataFrame, b: DataFrame, on: list[str], start: str, end: str, width: int) -> DataFrame:
    """Pairs whose intervals share a point, columns prefixed a_ and b_.

    Each interval is in every bucket of `width` it touches; a pair is taken in the first bucket both touch,
    so once. Choose a width near the usual length of an interval.
    """
    a, b = _sides(a, b)
    buckets = lambda p: F.sequence(F.floor(F.col(f"{p}_{start}") / width), F.floor(F.col(f"{p}_{end}") / width))
    a, b = _dealt(a).withColumn("_bucket", F.explode(buckets("a"))), b.withColumn("_bucket_b", F.explode(buckets("b")))
    same = (F.col("_bucket") == F.col("_bucket_b"))
    for c in on:
        same = same & (F.col(f"a_{c}") == F.col(f"b_{c}"))
    pairs = a.join(b, same)
    first = F.greatest(F.floor(F.col(f"a_{start}") / width), F.floor(F.col(f"b_{start}") / width))
    touch = (F.col(f"a_{start}") <= F.col(f"b_{end}")) & (F.col(f"b_{start}") <= F.col(f"a_{end}"))
    return pairs.where((F.col("_bucket") == first) & touch).drop("_bucket", "_bucket_b")


def gap_join(a: DataFrame, b: DataFrame, on: list[str], end: str, start: str, most: int) -> DataFrame:
    """Ordered pairs with 0 <= b.start - a.end <= most; two buckets of `most` cover a gap."""
    a, b = _sides(a, b)
    at = F.floor(F.col(f"a_{end}") / most)
    a = _dealt(a).withColumn("_bucket", F.explode(F.array(at, at + 1)))
    same = F.col("_bucket") == F.floor(F.col(f"b_{start}") / most)
    for c in on:
        same = same & (F.col(f"a_{c}") == F.col(f"b_{c}"))
    gap = F.col(f"b_{start}") - F.col(f"a_{end}")
    return a.join(b, same).withColumn("gap", gap).where((F.col("gap") >= 0) & (F.col("gap") <= most)).drop("_bucket")


def asof_join(left: DataFrame, right: DataFrame, on: str, t: str, value: str) -> DataFrame:
    """Each left row with the value of the last right row of its key not after it: one sort, no pairs."""
    from pyspark.sql import Window

    tagged = left.select(on, t, F.lit(None).cast(dict(right.dtypes)[value]).alias("_v"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_row"))
    other = right.select(on, t, F.col(value).alias("_v"), F.lit(0).alias("_side"), F.lit(None).cast(tagged.schema["_row"].dataType).alias("_row"))
    w = Window.partitionBy(on).orderBy(t, "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return tagged.union(other).withColumn("_seen", F.last("_v", ignorenulls=True).over(w)).where("_side = 1").select("_row.*", F.col("_seen").alias(value))
