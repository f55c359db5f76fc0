"""Scores and statistics of trajectories: feasibility, conflicts, distributions, and comparison with ground truth."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import box, overlaps

#: A distance score from here on counts as 1.
DISTANCE_TOLERANCE = 0.8
MOST_DEGREES, MOST_ACCELERATION = 30, 10
SCORES = ("distance", "backward", "rotation", "acceleration", "conflict")


def five_numbers(df: DataFrame, columns: list[str], by: list[str] = []) -> DataFrame:  # noqa: B006
    """min, max, median, avg and population stdev of each column, one row each; nulls are passed over."""
    stats = {"min": F.min, "max": F.max, "median": F.median, "avg": F.avg, "stdev": F.stddev_pop}
    entries = [F.struct(F.lit(c).alias("metric"), *[f(F.col(c).cast("double")).alias(n) for n, f in stats.items()]) for c in columns]
    wide = df.groupBy(*by).agg(*[e.alias(f"_{i}") for i, e in enumerate(entries)])
    return wide.select(*by, F.inline(F.array(*[F.col(f"_{i}") for i in range(len(entries))])))


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    return df.agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])


def pairs_at(snapshots: DataFrame, key: str, most_length: float, reach: float = 0.0) -> DataFrame:
    """Unordered pairs of one slot and direction that may touch: columns prefixed a_ and b_.

    Vehicles meet in buckets of x as long as the longest vehicle, so a crowded slot isn't paired with itself.
    """
    width = most_length + reach
    bucket = F.floor(F.col("cx") / width)
    names = [c for c in snapshots.columns if c not in ("slot", "direction")]
    a = snapshots.select("slot", "direction", *[F.col(c).alias(f"a_{c}") for c in names], F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("_bucket"))
    b = snapshots.select("slot", "direction", *[F.col(c).alias(f"b_{c}") for c in names], bucket.alias("_bucket"))
    return a.join(b, ["slot", "direction", "_bucket"]).where(F.col(f"a_{key}") < F.col(f"b_{key}")).drop("_bucket")


def side_box(p: str) -> Column:
    return box(F.col(f"{p}_cx"), F.col(f"{p}_cy"), F.col(f"{p}_l"), F.col(f"{p}_w"))


def overlapping(pairs: DataFrame) -> DataFrame:
    return pairs.where(overlaps(side_box("a"), side_box("b")))


def conflict_seconds(overlap_pairs: DataFrame, key: str, rate: float = 25, sample_rate: float = 1) -> DataFrame:
    """Seconds that each pair overlaps."""
    return overlap_pairs.groupBy(f"a_{key}", f"b_{key}").agg((F.count(F.lit(1)) / sample_rate / rate).alias("seconds"))


def conflicts_of_each(seconds: DataFrame, key: str) -> DataFrame:
    """(id, other, seconds) for both sides of each pair."""
    a, b = F.col(f"a_{key}"), F.col(f"b_{key}")
    return seconds.select(a.alias("id"), b.alias("other"), "seconds").union(seconds.select(b, a, "seconds"))


def conflict_lists(each: DataFrame) -> DataFrame:
    return each.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("other", "seconds"))).alias("conflicts"))


def feasibility(points: DataFrame, key: str, x_range: float, conflicts: DataFrame | None = None) -> DataFrame:
    """The five scores of each trajectory; points: key, t, event_id, x, y, direction.

    Windows give the differences of neighbours, one aggregate the scores.
    """
    w = Window.partitionBy(key).orderBy("t", "event_id")
    dt = F.nullif(F.lead("t").over(w) - F.col("t"), F.lit(0.0))
    rows = points.withColumns(
        {
            "_dx": F.lead("x").over(w) - F.col("x"),
            "_vx": (F.lead("x").over(w) - F.col("x")) / dt,
            "_vy": (F.lead("y").over(w) - F.col("y")) / dt,
            "_a": (F.lead("x", 2).over(w) - 2 * F.lead("x").over(w) + F.col("x")) / (dt * dt),
        }
    )
    rows = rows.withColumn("_theta", F.atan2(F.abs("_vy"), F.abs("_vx")) * (180 / 3.14))
    share = lambda bad, of: 1 - F.count_if(bad) / F.nullif(F.count(of), F.lit(0))
    first = F.struct("t", "event_id")
    scores = rows.groupBy(key).agg(
        F.least(F.lit(1.0), F.abs(F.max_by("x", first) - F.min_by("x", first)) / F.lit(float(x_range))).alias("distance"),
        share(F.col("_dx") * F.col("direction") < 0, "_dx").alias("backward"),
        share(F.col("_theta") >= MOST_DEGREES, "_theta").alias("rotation"),
        share(F.abs("_a") > MOST_ACCELERATION, "_a").alias("acceleration"),
        (F.max("t") - F.min("t")).alias("_duration"),
    )
    if conflicts is None:
        return scores.withColumn("conflict", F.lit(1.0)).drop("_duration")
    most = conflicts.groupBy(F.col("id").alias("_id")).agg(F.max("seconds").alias("_seconds"))
    joined = scores.join(most, scores[key] == most["_id"], "left")
    return joined.withColumn("conflict", 1 - F.coalesce("_seconds", F.lit(0.0)) / F.nullif(F.col("_duration"), F.lit(0.0))).drop("_duration", "_id", "_seconds")


def feasible_flags(scores: DataFrame) -> DataFrame:
    """Adds all_feasible, any_infeasible and the product score, distances of the tolerance counting as 1."""
    tolerant = F.when(F.col("distance") >= DISTANCE_TOLERANCE, 1.0).otherwise(F.col("distance"))
    values = [tolerant, *[F.coalesce(F.col(c), F.lit(1.0)) for c in SCORES[1:]]]
    product, good = F.lit(1.0), F.lit(True)
    for v in values:
        product, good = product * v, good & (v == 1)
    return scores.withColumns({"all_feasible": good, "any_infeasible": ~good, "score": product})


def histogram(df: DataFrame, column: str, bins: int, by: list[str] = []) -> DataFrame:  # noqa: B006
    """Counts in equal bins between the smallest and largest value; the largest falls in the last bin."""
    ends = df.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    at = F.floor((F.col(column) - F.col("_lo")) * bins / F.nullif((F.col("_hi") - F.col("_lo")).cast("double"), F.lit(0.0)))
    rows = df.where(F.col(column).isNotNull()).crossJoin(F.broadcast(ends)).withColumn("bin", F.least(F.coalesce(at, F.lit(0)), F.lit(bins - 1)))  # one row
    return rows.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"))


def density(df: DataFrame, column: str, grid: int = 200, bandwidth: float | None = None) -> DataFrame:
    """Gaussian kernel density at `grid` places between the smallest and largest value.

    Values are counted first, so a row is a distinct value and not an observation.
    """
    values = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("times"))
    facts = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("times").alias("n"), F.sum(F.col("v") * F.col("times")).alias("s"), F.sum(F.col("v") * F.col("v") * F.col("times")).alias("q"))
    sd = F.sqrt((F.col("q") - F.col("s") * F.col("s") / F.col("n")) / (F.col("n") - 1))
    h = F.lit(float(bandwidth)) if bandwidth else sd * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    at = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("place") / (grid - 1)
    rows = values.crossJoin(F.broadcast(facts.withColumn("h", h))).withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))  # one row
    z = (at - F.col("v")) / F.col("h")
    return rows.groupBy("place").agg((F.sum(F.col("times") * F.exp(-z * z / 2)) / F.first(F.col("n") * F.col("h")) / math.sqrt(2 * math.pi)).alias("density"), F.first(at).alias("at"))


def confusion_shares(df: DataFrame, truth: str, guess: str) -> DataFrame:
    """Share of each guess among all rows with it, by truth."""
    counts = df.groupBy(truth, guess).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(guess)))


def variation(df: DataFrame, key: str, column: str) -> DataFrame:
    return df.groupBy(key).agg((F.stddev_pop(column) / F.nullif(F.avg(column), F.lit(0.0))).alias("cv"))


def covered(df: DataFrame, key: str, x: str) -> DataFrame:
    """Range of x of each key, and its share of the whole range."""
    own = df.groupBy(key).agg(F.min(x).alias("_a"), F.max(x).alias("_b"))
    whole = own.agg((F.max("_b") - F.min("_a")).alias("_whole"))
    return own.crossJoin(F.broadcast(whole)).select(key, (F.col("_b") - F.col("_a")).alias("covered"), ((F.col("_b") - F.col("_a")) / F.col("_whole")).alias("share"))  # one row


def correction(raw: DataFrame, fixed: DataFrame, keys: list[str], key: str, values: list[str]) -> DataFrame:
    """Mean distance between the two versions of each key's samples, over the samples that both have."""
    other = fixed.select(*keys, *[F.col(v).alias(f"_{v}") for v in values])
    d2 = sum(((F.col(v) - F.col(f"_{v}")) * (F.col(v) - F.col(f"_{v}")) for v in values), F.lit(0.0))
    return raw.join(other, keys).groupBy(key).agg(F.avg(F.sqrt(d2)).alias("correction"), F.count(F.lit(1)).alias("n"))


def switches_and_fragments(members: DataFrame, truth: str, trajectory: str) -> DataFrame:
    """ids: sum over trajectories of their distinct truths - 1; fgmt: the same the other way round."""
    ids = members.groupBy(trajectory).agg(F.count_distinct(truth).alias("k")).agg(F.sum(F.col("k") - 1).alias("ids"))
    fgmt = members.groupBy(truth).agg(F.count_distinct(trajectory).alias("k")).agg(F.sum(F.col("k") - 1).alias("fgmt"))
    return ids.crossJoin(fgmt)  # one row each


def stage_scores(members: DataFrame, scores: DataFrame, each_conflict: DataFrame, member: str, key: str) -> DataFrame:
    """Scores of a set of members: means, and the largest conflict with a vehicle outside of the set."""
    means = members.join(scores, members[member] == scores[scores.columns[0]]).groupBy(key).agg(*[F.avg(c).alias(c) for c in ("rotation", "acceleration", "backward")], F.count(F.lit(1)).alias("n_members"))
    own = members.select(F.col(key).alias("_set"), F.col(member).alias("_m"))
    outside = own.join(each_conflict, own["_m"] == each_conflict["id"]).select("_set", "other", "seconds")
    inside = own.withColumnRenamed("_set", "_s2")
    outside = outside.join(inside, (F.col("_set") == F.col("_s2")) & (F.col("other") == F.col("_m")), "left_anti")
    per_other = outside.groupBy("_set", "other").agg(F.max("seconds").alias("seconds"))
    most = per_other.groupBy("_set").agg(F.max("seconds").alias("most_conflict"), F.count(F.lit(1)).alias("n_conflicts"))
    joined = means.join(most, means[key] == most["_set"], "left").drop("_set")
    return joined.fillna({"most_conflict": 0.0, "n_conflicts": 0})


def conflict_edges(each: DataFrame, durations: DataFrame) -> DataFrame:
    """(u, v, weight) with weight = seconds over u's duration; conflicts with vehicles that aren't there go."""
    there = durations.select(F.col("id").alias("other"))
    rows = each.join(durations, "id").join(there, "other", "left_semi")
    return rows.select(F.col("id").alias("u"), F.col("other").alias("v"), (F.col("seconds") / F.col("duration")).alias("weight"))


def aggregate_score(flags: DataFrame, boxes_per_second: float, weights: tuple[float, float, float] = (2, 2, 0.5)) -> DataFrame:
    """realtime = boxes per second over 30, soft = mean product score, hard = share that is all feasible; and their weighted sum."""
    soft, hard = F.avg("score"), F.avg(F.col("all_feasible").cast("int"))
    rows = flags.agg(F.lit(boxes_per_second / 30).alias("realtime"), soft.alias("soft"), hard.alias("hard"))
    return rows.withColumn("total", F.col("realtime") * weights[2] + F.col("soft") * weights[0] + F.col("hard") * weights[1])


def relative_to_larger(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """Two one-row tables of metrics, each value over the larger of the two."""
    both = a.select(*[F.col(c).cast("double").alias(f"a_{c}") for c in columns]).crossJoin(b.select(*[F.col(c).cast("double").alias(f"b_{c}") for c in columns]))
    entries = [F.struct(F.lit(c).alias("metric"), (F.col(f"a_{c}") / F.greatest(f"a_{c}", f"b_{c}")).alias("a"), (F.col(f"b_{c}") / F.greatest(f"a_{c}", f"b_{c}")).alias("b")) for c in columns]
    return both.select(F.inline(F.array(*entries)))


def shares(df: DataFrame, by: str) -> DataFrame:
    counts = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    return counts.crossJoin(F.broadcast(counts.agg(F.sum("n").alias("_all")))).select(by, "n", (F.col("n") / F.col("_all")).alias("share"))  # one row


def best_run(results: DataFrame, group: str, score: str, time: str) -> DataFrame:
    """The best and the latest result of each group."""
    return results.groupBy(group).agg(F.max(score).alias("best"), F.max_by(score, time).alias("latest"))


def valid_tracks(tracks: DataFrame, key: str, ratio: float = 0.4, border: int = 2) -> DataFrame:
    """Adds valid: covers enough of the view, or begins or ends at its border in time.

    tracks: key, first_frame, last_frame, min_x, max_x.
    """
    view = tracks.agg(F.min("min_x").alias("_x0"), F.max("max_x").alias("_x1"), F.min("first_frame").alias("_f0"), F.max("last_frame").alias("_f1"))
    rows = tracks.crossJoin(F.broadcast(view))  # one row
    long = F.col("max_x") - F.col("min_x") > ratio * (F.col("_x1") - F.col("_x0"))
    edge = (F.col("first_frame") <= F.col("_f0") + border) | (F.col("last_frame") >= F.col("_f1") - border)
    return rows.withColumn("valid", long | edge).drop("_x0", "_x1", "_f0", "_f1")


def metrics(df: DataFrame, registry: Mapping[str, Column], key: str) -> DataFrame:
    """One row per key with the named aggregates: where users add their own."""
    return df.groupBy(key).agg(*[c.alias(n) for n, c in registry.items()])


def moments(rows: DataFrame, metric: Column, by: str) -> DataFrame:
    """mean, mean_size (of the absolute values), sd and most (the largest absolute value) of a metric, per group."""
    r = lambda c: F.round(c, 6)
    return rows.groupBy(by).agg(r(F.avg(metric)).alias("mean"), r(F.avg(F.abs(metric))).alias("mean_size"), r(F.stddev_pop(metric)).alias("sd"), r(F.max(F.abs(metric))).alias("most"))
