"""Every operator as a query over the event adapter, with exact or rounded scalar columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import geometry as G
from .functions import kinematics as K
from .functions.cost import coefficient, fold, nll
from .operators import cleaning as C
from .operators import collision, evaluate, merge, pivot, rectify, series, stitch, synthetic
from .operators import documents as D
from .operators import graph as gr
from .operators.joins import asof_join, gap_join, overlap_join
from .plans import pipelines
from .schema import Params
from .sources import tables
from .sources.adapter import HOUR, fragments, points, trajectories

REGISTRY: dict = {}
#: The grid of the adapter, and units that stand for the reference's 20 s and 5 s windows.
SLOT = 2 * HOUR
WINDOW, MASTER_WINDOW = 20 * HOUR, 5 * HOUR
BAND = 20 * HOUR
#: The threshold of a stitch.
MOST_COST = 50.0


def query(f):
    REGISTRY[f.__name__] = f
    return f


def r6(c):
    return F.round(c, 6)


def scaled6(c):
    """Six places for numbers that often lie half-way between two of them: scaled before, as SQL does."""
    return F.round(c * 1e6) / 1e6


def pts(spark: SparkSession, d: str) -> DataFrame:
    return points(spark, d)


def frs(spark: SparkSession, d: str, more_than: int = 0) -> DataFrame:
    f = fragments(points(spark, d))
    return f.where(F.col("n") > more_than) if more_than else f


def hours(spark: SparkSession, d: str) -> DataFrame:
    """Points with time in hours from 2024-01-01 and x in units of a dollar, as doubles."""
    p = points(spark, d)
    return p.withColumn("th", (F.col("t") - 1704067200000000) / F.lit(float(HOUR))).withColumn("x", F.col("x_cents") / F.lit(100.0))


def slots(spark: SparkSession, d: str) -> DataFrame:
    """Grid means of every fragment: x, y, length, width."""
    p = points(spark, d).withColumn("x", F.col("x_cents").cast("double"))
    g = series.grid_means(p, "fragment_id", "t", SLOT, ["x", "y"])
    facts = fragments(points(spark, d)).select("fragment_id", "direction", "length", "width")
    return g.join(facts, "fragment_id")


# --- documents, filters, sorts ---------------------------------------------------------------------------


@query
def fragments_all(spark, d):
    return frs(spark, d).select("fragment_id", "vehicle_id", "direction", "compute_node_id", "first_t", "last_t", "n", "starting_x", "ending_x")


@query
def scan_long_fragments(spark, d):
    return frs(spark, d, 3).where("direction = 1").select("fragment_id", "compute_node_id", "last_t", "n")


@query
def find_filter(spark, d):
    return D.find(frs(spark, d), equals={"direction": 1, "compute_node_id": 2}, select=["fragment_id", "first_t", "last_t"])


@query
def find_in(spark, d):
    return D.find(frs(spark, d), isin={"vehicle_id": [2, 3, 5, 8, 13, 21]}, select=["fragment_id", "vehicle_id", "n"])


@query
def find_range(spark, d):
    low = 1704067200000000 + 100 * HOUR
    return D.find(frs(spark, d), between={"first_t": (low, low + 100 * HOUR)}, select=["fragment_id", "first_t"])


@query
def find_exists_min(spark, d):
    p = pts(spark, d).withColumn("eastbound", F.when(F.col("direction") == 1, F.col("x_cents")))
    return D.first_existing(p, "eastbound", "t")


@query
def projection_ids(spark, d):
    return D.find(frs(spark, d), between={"n": (4, 1 << 40)}, select=["fragment_id"])


@query
def topk_starting_x(spark, d):
    return D.top_k(frs(spark, d).select("fragment_id", "starting_x"), "starting_x", 20, "fragment_id")


@query
def latest_per_vehicle(spark, d):
    return D.latest(pts(spark, d), "vehicle_id", ["t", "event_id"], "event_id", "t", "x_cents")


@query
def distinct_nodes_ordered(spark, d):
    return D.nodes_in_order(frs(spark, d)).select("compute_node_id", "first_x", "position")


@query
def time_bounds(spark, d):
    return frs(spark, d).groupBy("direction").agg(F.min("last_t").alias("t_min"), F.max("last_t").alias("t_max"), F.count_distinct("compute_node_id").alias("nodes"))


@query
def range_read_batches(spark, d):
    b = tables.range_batches(frs(spark, d), "last_t", 10 * HOUR)
    return b.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.min("fragment_id").alias("first_id"))


@query
def interval_touch(spark, d):
    low = 1704067200000000 + 200 * HOUR
    f = frs(spark, d)
    ok = D.touches(F.col("first_t"), F.col("last_t"), low, low + 48 * HOUR) & D.touches(F.col("starting_x"), F.col("ending_x"), -200000, 200000)
    return f.where(ok).select("fragment_id", "direction")


@query
def slice_time_space(spark, d):
    low = 1704067200000000 + 150 * HOUR
    p = D.slice_points(pts(spark, d), "fragment_id", ["t", "event_id"], (low, low + 200 * HOUR), (-300000, 300000))
    return D.summarise(p, "fragment_id", "direction")


@query
def chunk_export_plan(spark, d):
    return D.chunks(frs(spark, d), "first_t", 24 * HOUR).groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.min("first_t").alias("first_t"), F.max("first_t").alias("last_first_t"))


@query
def csv_sessions(spark, d):
    s = tables.idle_sessions(pts(spark, d), "vehicle_id", "t", 6 * HOUR)
    return s.groupBy("vehicle_id", "session").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("first_t"), F.max("t").alias("last_t"))


@query
def size_histogram(spark, d):
    t = frs(spark, d).groupBy("vehicle_id").agg(F.collect_set("fragment_id").alias("ids"))
    return D.size_histogram(t, F.size("ids"))


@query
def fragment_length_histogram(spark, d):
    return D.size_histogram(frs(spark, d), F.col("n"))


@query
def sample_every_k(spark, d):
    return D.every_kth(pts(spark, d), "vehicle_id", ["t", "event_id"], 7).select("event_id", "vehicle_id", "t")


@query
def sample_by_id(spark, d):
    return D.sample_by_id(pts(spark, d), "event_id", 10, 3).select("event_id", "fragment_id")


def _listed(spark, d):
    """Vehicles as reconciled rows: the ids of their fragments of more than 3 samples."""
    return frs(spark, d, 3).groupBy("vehicle_id").agg(F.collect_set("fragment_id").alias("fragment_ids"))


@query
def anti_lookup(spark, d):
    return D.without_parent(frs(spark, d), "fragment_id", _listed(spark, d), "fragment_ids").select("fragment_id", "n")


@query
def member_join(spark, d):
    f = frs(spark, d).select("fragment_id", "n", "first_t")
    return D.with_parent(f, "fragment_id", _listed(spark, d), "vehicle_id", "fragment_ids").select(F.col("parent").alias("vehicle_id"), "fragment_id", "n", "first_t")


@query
def gt_fragment_map(spark, d):
    f = frs(spark, d, 3).select("fragment_id", F.expr("fragment_id div 1000").alias("gt_id"))
    return f.groupBy("gt_id").agg(F.count(F.lit(1)).alias("n_fragments"), F.min("fragment_id").alias("first_id"), F.max("fragment_id").alias("last_id"))


@query
def existing_members(spark, d):
    lists = _listed(spark, d)
    present = frs(spark, d, 6).select("fragment_id")
    m = D.members(lists, "vehicle_id", "fragment_ids").join(present, F.col("member") == F.col("fragment_id"), "left_semi")
    return m.groupBy("vehicle_id").agg(F.count(F.lit(1)).alias("n_left"))


@query
def id_set_difference(spark, d):
    a = frs(spark, d).groupBy("vehicle_id").agg(F.collect_set("fragment_id").alias("all_ids"))
    rest = a.join(_listed(spark, d), "vehicle_id", "left").select("vehicle_id", F.size(F.array_except("all_ids", F.coalesce("fragment_ids", F.array().cast("array<bigint>")))).cast("bigint").alias("n_unlisted"))
    return rest


@query
def union_in_order(spark, d):
    f = frs(spark, d).select("fragment_id", "direction", "last_t")
    rows = D.union(f.where("direction = 1"), f.where("direction = -1"))
    w = Window.partitionBy("direction").orderBy("last_t", "fragment_id")
    return rows.withColumn("place", F.row_number().over(w).cast("bigint"))


@query
def set_unset(spark, d):
    f = frs(spark, d).select("fragment_id", "vehicle_id", "n")
    updates = frs(spark, d, 5).select("fragment_id", (F.col("n") * 10).alias("n"), F.lit(1).alias("checked"))
    return D.unset_fields(D.set_fields(f, updates, "fragment_id"), "vehicle_id")


@query
def push_upsert(spark, d):
    docs = frs(spark, d, 3).where("vehicle_id % 3 <> 0").groupBy("vehicle_id").agg(F.sort_array(F.collect_list("fragment_id")).alias("ids"))
    more = frs(spark, d).where("n <= 3").select("vehicle_id", "fragment_id")
    out = D.push(docs, more, "vehicle_id", "ids", "fragment_id")
    return out.select("vehicle_id", F.size("ids").cast("bigint").alias("n_ids"), F.element_at("ids", 1).alias("first_id"), F.element_at("ids", -1).alias("last_id"))


@query
def delete_many(spark, d):
    return D.delete_in(frs(spark, d).select("fragment_id", "n"), "fragment_id", frs(spark, d).where("n = 1").select("fragment_id"))


@query
def time_align(spark, d):
    p = pts(spark, d).withColumn("slot", F.floor(F.col("t") / HOUR))
    a, b = p.where("direction = 1").groupBy("slot").agg(F.count(F.lit(1)).alias("n_east")), p.where("direction = -1").groupBy("slot").agg(F.count(F.lit(1)).alias("n_west"))
    a, b = D.in_common_time(a, b, "slot")
    return a.join(b, "slot")


@query
def json_documents(spark, d):
    p = spark.read.parquet(f"{d}/events.parquet")
    return p.groupBy(F.get_json_object("props", "$.k").cast("int").alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query
def date_parts(spark, d):
    p = pts(spark, d)
    at = F.timestamp_micros("t")
    return p.groupBy(F.date_format(at, "yyyy-MM-dd").alias("day"), F.hour(at).alias("hour")).agg(F.count(F.lit(1)).alias("n"))


@query
def name_parts(spark, d):
    f = frs(spark, d).select("fragment_id", F.concat(F.lit("raw__"), F.when(F.col("direction") == 1, "eb").otherwise("wb"), F.lit("--"), F.col("compute_node_id").cast("string")).alias("name"))
    tail = F.split(F.split("name", "__")[1], "--")
    return f.groupBy(tail[0].alias("side"), tail[1].cast("int").alias("node")).agg(F.count(F.lit(1)).alias("n"))


@query
def rollup_nodes(spark, d):
    return frs(spark, d).rollup("direction", "compute_node_id").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("samples"))


@query
def cube_nodes(spark, d):
    return frs(spark, d).cube("direction", "compute_node_id").agg(F.count(F.lit(1)).alias("n"))


@query
def set_operations(spark, d):
    f = frs(spark, d)
    a, b = f.where("n > 3").select("vehicle_id"), f.where("direction = 1").select("vehicle_id")
    both, rest = a.intersect(b).withColumn("kind", F.lit("both")), a.exceptAll(b).distinct().withColumn("kind", F.lit("only"))
    return both.unionByName(rest)


# --- cleaning ----------------------------------------------------------------------------------------------


@query
def conf_mask(spark, d):
    p = C.confident(pts(spark, d))
    return D.summarise(p, "fragment_id")


@query
def conf_mask_arrays(spark, d):
    t = C.confident_series(trajectories(pts(spark, d)), ["timestamp", "x_position"])
    return t.select("fragment_id", F.size("timestamp").cast("bigint").alias("n"), F.element_at("timestamp", 1).alias("first_t"), F.element_at("x_position", -1).alias("ending_x"))


@query
def short_track_filter(spark, d):
    p = pts(spark, d).withColumn("valid", F.when(F.col("conf") >= 0.2, F.col("x_cents")))
    return C.long_enough(p, "valid").groupBy("fragment_id").agg(F.count(F.lit(1)).alias("n"), F.count("valid").alias("n_valid"))


@query
def wrong_direction(spark, d):
    return C.right_direction(pts(spark, d), F.col("y"), F.col("direction"), middle=36.0).groupBy("fragment_id").agg(F.count(F.lit(1)).alias("n"))


@query
def null_outliers_2sd(spark, d):
    p = pts(spark, d).withColumn("y2", C.null_beyond(F.col("y"), "vehicle_id", 1.5))
    return p.groupBy("vehicle_id").agg(F.count("y2").alias("n_kept"), F.count(F.lit(1)).alias("n"))


@query
def quantile_outliers(spark, d):
    p = hours(spark, d)
    return C.off_line(p, F.col("th"), ["x", "y"], "vehicle_id").groupBy("vehicle_id").agg(F.count_if("outlier").alias("n_outliers"), F.count(F.lit(1)).alias("n"))


@query
def median_outliers(spark, d):
    p = pts(spark, d).withColumn("far", C.far_from_median("y", "vehicle_id", 1.5))
    return p.groupBy("vehicle_id").agg(F.count_if("far").alias("n_far"))


@query
def trim_ends(spark, d):
    p = pts(spark, d).withColumn("valid", F.when(F.col("conf") >= 0.5, F.col("x_cents")))
    return C.trimmed(p, "valid", "fragment_id", "t").groupBy("fragment_id").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("first_t"), F.max("t").alias("last_t"))


@query
def duplicate_frames(spark, d):
    p = pts(spark, d).withColumn("frame", F.floor(F.col("t") / (6 * HOUR)))
    return C.duplicate_frames(p, "vehicle_id", "frame")


@query
def mean_of_repeats(spark, d):
    p = pts(spark, d).withColumn("frame", F.floor(F.col("t") / (6 * HOUR)))
    m = C.mean_of_repeats(p, ["vehicle_id", "frame"], ["x_cents", "y"])
    return m.select("vehicle_id", "frame", r6("x_cents").alias("x"), r6("y").alias("y"))


@query
def first_of_repeats(spark, d):
    p = pts(spark, d).withColumn("frame", F.floor(F.col("t") / (6 * HOUR))).withColumn("valid", F.when(F.col("conf") >= 0.5, F.col("x_cents")))
    return C.first_of_repeats(p, ["vehicle_id", "frame"], "valid", ["t", "event_id"]).select("vehicle_id", "frame", "event_id", "valid")


@query
def frame_time_map(spark, d):
    p = pts(spark, d).select("event_id", "t", F.floor(F.col("t") / HOUR).alias("frame"))
    m = C.mapped_time(p, "event_id", "t")
    return m.select("event_id", scaled6((F.col("mapped_t") - F.col("t")) / HOUR).alias("shift"))


@query
def extend_tracks(spark, d):
    p = pts(spark, d).withColumn("frame", F.floor(F.col("t") / HOUR))
    e = p.groupBy("fragment_id", "direction").agg(
        F.min("frame").alias("first_frame"), F.max("frame").alias("last_frame"), F.min_by("x_cents", F.struct("t", "event_id")).cast("double").alias("first_x"),
        F.max_by("x_cents", F.struct("t", "event_id")).cast("double").alias("last_x"),
    )
    e = e.withColumn("v", F.abs(F.col("last_x") - F.col("first_x")) / F.nullif(F.col("last_frame") - F.col("first_frame"), F.lit(0))).where("v is not null")
    frame0 = 1704067200000000 // HOUR
    out = C.extended(e, "fragment_id", (frame0, frame0 + 720), (-2000000.0, 2000000.0))
    return out.groupBy("fragment_id").agg(F.count(F.lit(1)).alias("n"), F.min("frame").alias("first_frame"), F.max("frame").alias("last_frame"), r6(F.max("x")).alias("max_x"))


# --- resampling and windows ---------------------------------------------------------------------------------


@query
def grid_resample_mean(spark, d):
    p = pts(spark, d)
    m = series.grid_means(p, "fragment_id", "t", HOUR // 2, ["x_cents", "y"])
    return m.select("fragment_id", "slot", r6("x_cents").alias("x"), r6("y").alias("y"))


@query
def grid_resample_linear(spark, d):
    m = series.linear_grid(pts(spark, d), "fragment_id", "t", SLOT, ["x_cents", "y"])
    return m.select("fragment_id", "slot", r6("x_cents").alias("x"), r6("y").alias("y"))


@query
def merge_resample(spark, d):
    p = C.confident(pts(spark, d))
    m = series.fine_then_coarse(p, "fragment_id", "t", HOUR // 2, 4, ["x_cents", "y"])
    return m.select("fragment_id", "slot", r6("x_cents").alias("x"), r6("y").alias("y"))


@query
def index_interpolate(spark, d):
    p = pts(spark, d).withColumn("i", F.row_number().over(K.along())).withColumn("seen", F.when(F.col("conf") >= 0.5, F.col("x_cents").cast("double")))
    return p.select("event_id", "fragment_id", r6(K.interpolate(F.col("seen"), F.col("i"), K.along())).alias("x"))


@query
def speed(spark, d):
    w = K.along()
    return hours(spark, d).select("event_id", r6(K.rate(F.col("x"), F.col("th"), w)).alias("vx"), r6(K.rate(F.col("y"), F.col("th"), w)).alias("vy"), r6(F.abs(K.rate(F.col("x"), F.col("th"), w))).alias("speed"))


@query
def accel(spark, d):
    return hours(spark, d).select("event_id", r6(K.acceleration(F.col("x"), F.col("th"), K.along())).alias("ax"))


@query
def velocity_signed(spark, d):
    return hours(spark, d).select("event_id", r6(F.col("direction") * K.velocity_ahead(F.col("x"), 0.04, K.along())).alias("v"))


@query
def rotation(spark, d):
    w = K.along()
    p = hours(spark, d).withColumn("vx", K.rate(F.col("x"), F.col("th"), w)).withColumn("vy", K.rate(F.col("y"), F.col("th"), w))
    return p.where("vx is not null").select("event_id", r6(K.rotation(F.col("vx"), F.col("vy"))).alias("theta"))


@query
def lane_index(spark, d):
    return pts(spark, d).groupBy(K.lane(F.col("y")).alias("lane")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("vehicle_id").alias("vehicles"))


@query
def lane_changes(spark, d):
    p = pts(spark, d).withColumn("lane", K.lane(F.col("y"))).withColumn("change", K.lane_changes(F.col("lane"), K.along()))
    return p.groupBy("fragment_id").agg(F.sum("change").alias("changes"))


@query
def lane_change_vehicles(spark, d):
    p = pts(spark, d).withColumn("lane", K.lane(F.col("y")))
    return p.groupBy("fragment_id").agg(F.count_distinct("lane").alias("lanes"), r6(F.max("y") - F.min("y")).alias("span")).where("lanes > 1 and span > 12")


@query
def longest_run(spark, d):
    p = pts(spark, d).select("vehicle_id", F.floor(F.col("t") / (12 * HOUR)).alias("frame")).distinct()
    return K.longest_run(p, "vehicle_id", "frame").groupBy("vehicle_id").agg(F.count(F.lit(1)).alias("n"), F.min("frame").alias("first_frame"))


@query
def travel_direction(spark, d):
    p = pts(spark, d).withColumn("seen", F.when(F.col("conf") >= 0.5, F.col("x_cents"))).withColumn("way", K.travel_direction(F.col("seen"), F.col("y")))
    return p.groupBy("fragment_id").agg(F.max("way").alias("way"))


@query
def fill_forward(spark, d):
    p = pts(spark, d).withColumn("seen", F.when(F.col("conf") >= 0.7, F.col("x_cents")))
    return p.select("event_id", K.fill_forward(F.col("seen"), K.along("vehicle_id")).alias("x"))


@query
def moving_avg(spark, d):
    return pts(spark, d).select("event_id", r6(K.moving_average(F.col("x_cents"), 5, K.along("vehicle_id"))).alias("x"), r6(K.edge_corrected_average(F.col("x_cents"), 5, K.along("vehicle_id"))).alias("x_edge"))


@query
def gaussian_smooth(spark, d):
    p = pts(spark, d).withColumn("xs", F.col("x_cents") / F.lit(100.0))
    return K.gaussian_smooth(p, "fragment_id", ["t", "event_id"], "xs").select("event_id", r6("smooth").alias("x"))


@query
def euler_path(spark, d):
    p = pts(spark, d).withColumn("v", F.col("direction") * F.round(F.col("y") * 100).cast("bigint"))
    return p.select("event_id", r6(K.integrate(F.col("v"), 0.04, K.along())).alias("x"))


@query
def track_facts(spark, d):
    w = K.along()
    p = hours(spark, d).withColumn("vx", F.col("direction") * K.rate(F.col("x"), F.col("th"), w)).withColumn("vy", K.rate(F.col("y"), F.col("th"), w))
    return p.groupBy("fragment_id").agg(
        F.max(F.when(F.col("vx") < 0, 1).otherwise(0)).alias("backward"), r6(F.min("vy")).alias("min_vy"), r6(F.max("y") - F.min("y")).alias("y_range"),
        (F.max("t") - F.min("t")).alias("duration"), (F.max("x_cents") - F.min("x_cents")).alias("x_travelled"),
    )


# --- geometry ------------------------------------------------------------------------------------------------


@query
def box_corners(spark, d):
    theta = F.when(F.col("direction") == 1, 0.1).otherwise(-0.1)
    c = G.corners(F.col("width"), F.col("length"), F.col("x"), F.col("y"), theta)
    p = hours(spark, d).select("event_id", c.alias("c"))
    return p.select("event_id", *[r6(F.col(f"c.{n}")).alias(n) for n in ("bbr_x", "bbr_y", "fbr_x", "fbr_y", "fbl_x", "fbl_y", "bbl_x", "bbl_y")])


@query
def reorder_corners(spark, d):
    x, y = F.col("x"), F.col("y")
    c = G.reordered_corners([x, x + F.col("length")], [y, y + F.col("width")], F.col("direction"))
    p = hours(spark, d).select("event_id", c.alias("c"))
    return p.select("event_id", *[r6(F.col(f"c.{n}")).alias(n) for n in ("bbr_x", "bbr_y", "fbl_x", "fbl_y")])


H = [1.2, 0.1, 30.0, -0.05, 0.9, 4.0, 1e-4, 2e-4, 1.0]


@query
def homography(spark, d):
    p = hours(spark, d).withColumn("u", F.abs("x") / 100).select("event_id", G.project(H, F.col("u"), F.col("y")).alias("q"))
    return p.select("event_id", r6("q.x").alias("u"), r6("q.y").alias("v"))


@query
def planar_distance(spark, d):
    lat, lon = 36.0 + F.col("y") / 1000, -86.6 + F.col("x") / 1e6
    p = hours(spark, d).select("event_id", G.planar_distance(F.lit(36.0), F.lit(-86.6), lat, lon).alias("q"))
    return p.select("event_id", F.round("q.d", 4).alias("d"), F.round("q.dx", 4).alias("dx"), F.round("q.dy", 4).alias("dy"))


@query
def unit_scale(spark, d):
    p = hours(spark, d)
    return p.select("event_id", r6(G.to_feet(F.col("x"))).alias("feet"), r6(G.mph_to_feet_per_second(F.col("y"))).alias("fps"), r6(G.clamp(F.col("x"), -100.0, 100.0)).alias("clamped"), r6(G.lane_centre(K.lane(F.col("y")))).alias("lane_y"))


CAMERAS = [("p1c1", 0.0, 500.0), ("p1c2", 500.0, 2000.0), ("p2c1", 2000.0, 8000.0), ("p2c2", 8000.0, 1e9)]


@query
def camera_lookup(spark, d):
    p = hours(spark, d).withColumn("camera", G.camera_at(F.abs("x"), CAMERAS))
    p = p.withColumn("again", G.camera_of(F.concat(F.lit("record_"), F.coalesce("camera", F.lit("")), F.lit("_00.csv"))))
    return p.groupBy("camera", "again").agg(F.count(F.lit(1)).alias("n"))


@query
def vehicle_class(spark, d):
    p = spark.read.parquet(f"{d}/events.parquet").withColumn("class", G.vehicle_class(F.substring("event_type", 1, 1)))
    return p.groupBy("class").agg(F.count(F.lit(1)).alias("n"))


# --- snapshots -----------------------------------------------------------------------------------------------


def _snapshots(spark, d):
    g = slots(spark, d).withColumn("x", F.col("x") / 100)
    return pivot.snapshots(g, "fragment_id", [])


@query
def snapshot_pivot(spark, d):
    s = _snapshots(spark, d)
    return s.select("slot", "fragment_id", "direction", r6("cx").alias("cx"), r6("cy").alias("cy"), "l", "w", r6("v").alias("v"))


@query
def snapshot_nested(spark, d):
    n = pivot.nested(_snapshots(spark, d), "fragment_id")
    return n.select("slot", F.size("eb").cast("bigint").alias("n_eb"), F.size("wb").cast("bigint").alias("n_wb"))


def _crowd(spark, d):
    """Snapshots on a short road, so that vehicles meet: x modulo 2000 ft."""
    g = slots(spark, d).withColumn("x", F.pmod(F.round(F.col("x")).cast("bigint"), F.lit(200000)) / F.lit(100.0))
    return pivot.snapshots(g, "fragment_id", [])


def _touching(spark, d):
    return evaluate.overlapping(evaluate.pairs_at(_crowd(spark, d), "fragment_id", 19.0))


@query
def snapshot_pairs_overlap(spark, d):
    return _touching(spark, d).select("slot", "direction", "a_fragment_id", "b_fragment_id")


@query
def space_gap(spark, d):
    p = evaluate.pairs_at(_crowd(spark, d), "fragment_id", 19.0, reach=181.0)
    gap = G.space_gap(evaluate.side_box("a"), evaluate.side_box("b"))
    return p.withColumn("gap", gap).where(F.col("gap").isNotNull() & (F.col("gap") <= 181)).select("slot", "a_fragment_id", "b_fragment_id", r6("gap").alias("gap"))


@query
def pair_configuration(spark, d):
    p = evaluate.pairs_at(_crowd(spark, d), "fragment_id", 19.0)
    side = lambda k: F.struct(F.col(f"{k}_cx").alias("cx"), F.col(f"{k}_cy").alias("cy"), F.col(f"{k}_l").alias("l"), F.col(f"{k}_w").alias("w"))
    p = p.where(F.abs(F.col("a_cx") - F.col("b_cx")) <= 19).withColumn("c", G.configuration(side("a"), side("b")))
    return p.groupBy("c.ahead", "c.behind", "c.right", "c.left").agg(F.count(F.lit(1)).alias("n"))


@query
def box_iou(spark, d):
    p = _touching(spark, d)
    return p.select("slot", "a_fragment_id", "b_fragment_id", r6(G.box_iou(evaluate.side_box("a"), evaluate.side_box("b"))).alias("iou"))


@query
def conflict_seconds(spark, d):
    s = evaluate.conflict_seconds(_touching(spark, d), "fragment_id")
    return s.select("a_fragment_id", "b_fragment_id", r6("seconds").alias("seconds"))


def _each_conflict(spark, d):
    return evaluate.conflicts_of_each(evaluate.conflict_seconds(_touching(spark, d), "fragment_id", rate=1.0), "fragment_id")


@query
def conflict_lists(spark, d):
    c = evaluate.conflict_lists(_each_conflict(spark, d))
    return c.select("id", F.size("conflicts").cast("bigint").alias("n"), r6(fold(F.col("conflicts"), lambda x: x["seconds"])).alias("seconds"), F.element_at("conflicts", 1)["other"].alias("first_other"))


@query
def snapshot_to_tracks(spark, d):
    t = pivot.tracks(_snapshots(spark, d), "fragment_id", 1)
    return t.select("fragment_id", "stay", F.size("samples").cast("bigint").alias("n"), "first_slot", "last_slot", r6(F.element_at("samples", 1)["x"]).alias("starting_x"))


# --- merging -------------------------------------------------------------------------------------------------


def _merge_pairs(spark, d):
    return merge.candidates(frs(spark, d), BAND, feet=100)


@query
def merge_candidates(spark, d):
    return _merge_pairs(spark, d).select("a_fragment_id", "b_fragment_id")


def _shared(spark, d, least=1):
    """Pairs that share so many slots, with them; fragments bring their slots into the join of pairs."""
    g = slots(spark, d).withColumn("x", F.col("x") / 100)
    f = merge.with_series(frs(spark, d), g, ["x", "y", "length", "width"])
    return merge.shared_by_pair(merge.candidates(f, BAND, feet=100, carry=merge.SERIES), least)


@query
def grid_track_join(spark, d):
    slot = lambda k: F.element_at("both", k)["a"]["slot"]
    return _shared(spark, d).select("a_fragment_id", "b_fragment_id", F.size("both").cast("bigint").alias("shared"), slot(1).alias("first_slot"), slot(-1).alias("last_slot"))


@query
def merge_cost(spark, d):
    return merge.pair_overlap_cost(_shared(spark, d)).select("a_fragment_id", "b_fragment_id", F.round("cost", 4).alias("cost"))


@query
def merge_cost_all(spark, d):
    c = merge.pair_overlap_cost(_shared(spark, d, 0), default=merge.NO_OVERLAP)
    return c.groupBy((F.col("cost") >= merge.NO_OVERLAP).alias("apart")).agg(F.count(F.lit(1)).alias("n"))


@query
def merge_cost_simple(spark, d):
    return merge.pair_simple_distance(_shared(spark, d)).select("a_fragment_id", "b_fragment_id", F.round("cost", 4).alias("cost"))


@query
def merge_cost_samples(spark, d):
    return merge.pair_mean_sample_cost(_shared(spark, d)).select("a_fragment_id", "b_fragment_id", F.round("cost", 4).alias("cost"))


def _links(spark, d):
    f = frs(spark, d).select("fragment_id", "direction", "first_t", "last_t", "starting_x")
    pairs = overlap_join(f, f, ["direction"], "first_t", "last_t", BAND)
    return pairs.where("a_fragment_id < b_fragment_id and a_last_t > b_first_t and b_last_t > a_first_t and abs(a_starting_x - b_starting_x) < 2000").select("a_fragment_id", "b_fragment_id")


@query
def merge_components(spark, d):
    return merge.components(frs(spark, d), _links(spark, d))


@query
def merge_by_cost(spark, d):
    """The whole of a merge: pairs, their cost, links of at most the threshold, components."""
    g = slots(spark, d).withColumn("x", F.col("x") / 100)
    return merge.components(frs(spark, d), merge.links(frs(spark, d), g, Params().merge_thresh, feet=100))


@query
def merge_combined(spark, d):
    found = merge.components(frs(spark, d), _links(spark, d))
    c = merge.combined(slots(spark, d), found, ["x", "y"])
    return c.select("component", "slot", r6("x").alias("x"), r6("y").alias("y"), "n")


@query
def merge_summary(spark, d):
    found = merge.components(frs(spark, d), _links(spark, d))
    s = merge.merged_summary(frs(spark, d), found)
    return s.select("component", "base_id", F.size("merged_ids").cast("bigint").alias("n_ids"), "first_t", "last_t")


# --- stitching -----------------------------------------------------------------------------------------------


def _lines(spark, d):
    p = hours(spark, d)
    return p.withColumn("c", F.col("th") - F.max("th").over(Window.partitionBy("fragment_id")))


@query
def ols_fit(spark, d):
    p = _lines(spark, d)
    fit = p.groupBy("fragment_id").agg(F.regr_slope("x", "c").alias("s"), F.regr_intercept("x", "c").alias("i"), F.count(F.lit(1)).alias("n")).where("n >= 4")
    return fit.select("fragment_id", F.round("s", 4).alias("slope"), F.round("i", 4).alias("intercept"))


@query
def wls_fit(spark, d):
    from .functions import cost

    n = Window.partitionBy("fragment_id")
    p = _lines(spark, d).withColumn("w", F.row_number().over(n.orderBy("t", "event_id")) / F.count(F.lit(1)).over(n))
    sums = cost.sums(F.col("c"), F.col("x"), F.col("w"))
    s = p.groupBy("fragment_id").agg(*[v.alias(k) for k, v in sums.items()], F.count(F.lit(1)).alias("n")).where("n >= 4")
    by = {k: F.col(k) for k in sums}
    return s.select("fragment_id", F.round(cost.slope(by), 4).alias("slope"), F.round(cost.intercept(by), 4).alias("intercept"))


def _stitch_pairs(spark, d, mode="local", window=WINDOW):
    f = frs(spark, d)
    positions = D.nodes_in_order(f) if mode == "master" else None
    return stitch.candidates(f, window, mode, positions).withColumn("gap_units", F.col("gap") / float(HOUR))


@query
def stitch_candidates(spark, d):
    c = _stitch_pairs(spark, d).groupBy("a_fragment_id").agg(F.count(F.lit(1)).alias("n_next"), F.min("gap").alias("least_gap"))
    return c


@query
def stitch_candidates_master(spark, d):
    return _stitch_pairs(spark, d, "master", MASTER_WINDOW).select("a_fragment_id", "b_fragment_id", "gap")


def _tracks(spark, d):
    sample = F.struct(F.col("th").alias("t"), "x", F.col("y").alias("y"))
    return hours(spark, d).groupBy("fragment_id").agg(F.sort_array(F.collect_list(sample)).alias("s")).where(F.size("s") >= 3)


def _stitch_costs(spark, d):
    return stitch.cone_costs(frs(spark, d), _tracks(spark, d), WINDOW, HOUR)


@query
def stitch_cost(spark, d):
    return _stitch_costs(spark, d).select("a_fragment_id", "b_fragment_id", F.round("cost", 3).alias("cost"))


@query
def legacy_nll_cost(spark, d):
    p = _lines(spark, d)
    lines = p.groupBy("fragment_id").agg(F.regr_slope("x", "c").alias("slope"), F.regr_intercept("x", "c").alias("intercept"), F.count(F.lit(1)).alias("n")).where("n >= 4")
    firsts = frs(spark, d).select("fragment_id", (F.col("starting_x") / F.lit(100.0)).alias("x"))
    return stitch.line_nll(frs(spark, d), lines, firsts, WINDOW, HOUR).select("a_fragment_id", "b_fragment_id", F.round("cost", 2).alias("cost"))


@query
def headway_cost(spark, d):
    """The headway cost of older versions: half the gap beyond two units, and its normal likelihood."""
    p = _stitch_pairs(spark, d)
    return p.select("a_fragment_id", "b_fragment_id", scaled6(0.5 * (F.abs("gap_units") - 2)).alias("headway"), r6(coefficient(nll(F.col("gap_units"), F.lit(2.0)))).alias("likelihood"))


def _near(spark, d):
    """The pairs that may be linked, as a written table; the others are written nowhere."""
    return gr.materialise(stitch.near_costs(frs(spark, d), _tracks(spark, d), WINDOW, HOUR, MOST_COST))


def _chains(spark, d):
    return stitch.stitched(gr.materialise(frs(spark, d)), _near(spark, d), MOST_COST)


@query
def stitched(spark, d):
    return _chains(spark, d)


@query
def id_combinations(spark, d):
    """All pairs of the fragments of a vehicle."""
    return D.combinations(frs(spark, d), "fragment_id", "vehicle_id").withColumnsRenamed({"a": "a_fragment_id", "b": "b_fragment_id"})


def _run_summary(out):
    """What a whole run made of its samples, one row per trajectory."""
    return out.groupBy(F.col("fragment_id").alias("trajectory_id")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("vehicle_id").alias("n_vehicles"), F.min("direction").alias("direction"), F.min("t").alias("first_t"), F.max("t").alias("last_t")
    )


@query
def one_pass(spark, d):
    """The whole single-pass run: mask, merge by cost, stitch."""
    return _run_summary(pipelines.one_pass(pts(spark, d), SLOT, HOUR))


@query
def two_passes(spark, d):
    """The whole two-pass run: mask, then merge and stitch within each node, then across nodes."""
    return _run_summary(pipelines.two_passes(pts(spark, d), SLOT, HOUR, D.nodes_in_order(frs(spark, d))))


@query
def rectify_first(spark, d):
    """The whole run on series that are rectified first."""
    return _run_summary(pipelines.rectify_first(pts(spark, d), SLOT, HOUR))


@query
def reconciled_trajectories(spark, d):
    """A single-pass run and, as its last step, the constrained series of each trajectory."""
    return pipelines.reconciled(pipelines.one_pass(pts(spark, d), SLOT, HOUR), SLOT)


@query
def stitched_greedy(spark, d):
    return stitch.stitched_greedy(gr.materialise(frs(spark, d)), _near(spark, d), MOST_COST)


@query
def combined(spark, d):
    return stitch.combined(pts(spark, d), _chains(spark, d))


@query
def combine_by_vehicle(spark, d):
    chains = frs(spark, d).select("fragment_id", F.col("vehicle_id").alias("trajectory_id"))
    c = stitch.combined(pts(spark, d), chains)
    return c.select("trajectory_id", "length", "width", "compute_node_id", "first_t", "last_t", "starting_x", "ending_x", "n", "n_fragments", "direction")


@query
def asof_previous(spark, d):
    """For each eastbound sample the last westbound y of the same node: an as-of join."""
    p = pts(spark, d)
    out = asof_join(p.where("direction = 1").select("compute_node_id", "t", "event_id").withColumn("part", F.col("compute_node_id") % 2), p.where("direction = -1").select((F.col("compute_node_id") % 2 + 0).alias("part0"), "t", "x_cents").withColumn("part", F.pmod(F.col("part0") + 1, F.lit(2))), "part", "t", "x_cents")
    return out.select("event_id", F.col("x_cents").alias("last_x"))


@query
def follow_counts(spark, d):
    """Gap join of whole vehicles: who began within an hour of another's end."""
    f = frs(spark, d).select("fragment_id", "direction", "first_t", "last_t")
    return gap_join(f, f, ["direction"], "last_t", "first_t", HOUR).groupBy(F.col("a_direction").alias("direction")).agg(F.count(F.lit(1)).alias("n"))


# --- rectification and collision ---------------------------------------------------------------------------


def _rect_grid(spark, d):
    p = pts(spark, d).withColumn("x", F.col("x_cents") / F.lit(100.0)).withColumn("direction", F.col("direction").cast("double"))
    big = frs(spark, d, 3).select("fragment_id")
    g = series.full_grid(series.grid_means(p.join(big, "fragment_id", "left_semi"), "fragment_id", "t", SLOT, ["x", "y", "direction"]), "fragment_id", ["x", "y", "direction"])
    return g.select(F.col("fragment_id").alias("id"), "slot", "x", "y", F.coalesce(F.max("direction").over(Window.partitionBy("fragment_id")), F.lit(1)).cast("int").alias("direction"))


def _rectified(method):
    def run(spark, d):
        return rectify.rectified(_rect_grid(spark, d), method, lam3=1e-7)

    run.__name__ = f"rectified_{method}"
    return run


for _m in ("opt1", "opt2", "opt1_l1", "opt2_l1", "constrained"):
    query(_rectified(_m))


@query
def receding_horizon(spark, d):
    return rectify.rectified(_rect_grid(spark, d), "receding", horizon=12)


@query
def separatum(spark, d):
    return collision.separated(gr.materialise(_crowd(spark, d).select("slot", "fragment_id", F.col("direction").cast("int").alias("direction"), "cx", "cy", "l", "w")), "fragment_id")


@query
def separatum_smooth(spark, d):
    return collision.separated_smoothly(_crowd(spark, d).select("slot", "fragment_id", F.col("direction").cast("int").alias("direction"), "cx", "cy", "l", "w"), "fragment_id", 12)


@query
def rolling_collision(spark, d):
    return collision.rolling(_crowd(spark, d).select("slot", "fragment_id", F.col("direction").cast("int").alias("direction"), "cx", "cy", "l", "w"), "fragment_id", 12, 4)


# --- evaluation ----------------------------------------------------------------------------------------------


@query
def moments(spark, d):
    """Mean, mean size, deviation and largest size of a metric, per direction."""
    return evaluate.moments(pts(spark, d), F.col("y") - 36, "direction")


@query
def dimensions_of_class(spark, d):
    """Kinds of vehicle and their dimensions, from class numbers; what is no number counts as 1."""
    p = pts(spark, d).select("event_id", F.when(F.col("event_id") % 9 == 0, F.lit("x")).otherwise((F.col("event_id") % 9).cast("string")).alias("c"))
    k = synthetic.kind(F.col("c"))
    return p.select("event_id", k.alias("kind"), synthetic.dimension(k, 0).alias("length"), synthetic.dimension(k, 1).alias("width"))


@query
def polluted_tracks(spark, d):
    """Whole vehicles with missing stretches and outliers put in, and the fragments that come of it."""
    p = pts(spark, d).select(F.col("vehicle_id"), "event_id", F.struct("t", "event_id").alias("at"), (F.col("x_cents") / 100).alias("x"), "y", "length", "width")
    out = synthetic.polluted(p, "vehicle_id", "at", 10.0, 0.01)
    return out.select("vehicle_id", "event_id", "fragment_id", r6("x").alias("x"), r6("y").alias("y"), "outlier")


def _scores(spark, d):
    p = hours(spark, d).select("fragment_id", F.col("th").alias("t"), "event_id", "x", "y", "direction")
    return evaluate.feasibility(p, "fragment_id", 2000.0, _each_conflict(spark, d))


@query
def feasibility(spark, d):
    s = _scores(spark, d)
    return s.select("fragment_id", *[r6(c).alias(c) for c in evaluate.SCORES])


@query
def feasible_flags(spark, d):
    f = evaluate.feasible_flags(_scores(spark, d))
    return f.select("fragment_id", "all_feasible", "any_infeasible", r6("score").alias("score"))


@query
def aggregate_score(spark, d):
    s = evaluate.aggregate_score(evaluate.feasible_flags(_scores(spark, d)), 12.0)
    return s.select(*[r6(c).alias(c) for c in ("realtime", "soft", "hard", "total")])


@query
def five_number(spark, d):
    f = frs(spark, d).withColumn("duration", (F.col("last_t") - F.col("first_t")) / 1000000).withColumn("travelled", F.abs(F.col("ending_x") - F.col("starting_x")))
    s = evaluate.five_numbers(f, ["duration", "travelled", "n"], ["direction"])
    return s.select("direction", "metric", *[F.round(c, 4).alias(c) for c in ("min", "max", "median", "avg", "stdev")])


@query
def binned_statistics(spark, d):
    p = pts(spark, d).withColumn("day", F.floor(F.col("t") / (24 * HOUR)))
    s = evaluate.five_numbers(p, ["y"], ["day"])
    return s.select("day", "metric", *[F.round(c, 4).alias(c) for c in ("min", "max", "median", "avg", "stdev")])


@query
def collection_counts(spark, d):
    return frs(spark, d).groupBy("direction", "compute_node_id").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("samples"))


@query
def stage_report(spark, d):
    f = frs(spark, d)
    return evaluate.conditional_counts(f, {"total": F.lit(True), "long": F.col("n") > 3, "east": F.col("direction") == 1, "still": F.col("starting_x") == F.col("ending_x"), "one_sample": F.col("n") == 1})


@query
def histogram(spark, d):
    return evaluate.histogram(pts(spark, d), "y", 30, ["direction"])


@query
def kde(spark, d):
    k = evaluate.density(pts(spark, d), "y", 50)
    return k.select("place", F.round("at", 4).alias("at"), F.round("density", 8).alias("density"))


@query
def confusion_pct(spark, d):
    p = pts(spark, d).select(K.lane(F.col("y")).alias("lane"), (F.col("vehicle_id") % 5).alias("class"))
    return evaluate.confusion_shares(p, "class", "lane").select("class", "lane", "n", r6("share").alias("share"))


@query
def cv_per_vehicle(spark, d):
    return evaluate.variation(pts(spark, d), "vehicle_id", "y").select("vehicle_id", r6("cv").alias("cv"))


@query
def x_covered(spark, d):
    return evaluate.covered(pts(spark, d), "vehicle_id", "x_cents").select("vehicle_id", "covered", r6("share").alias("share"))


@query
def frame_match_error(spark, d):
    p = pts(spark, d).withColumn("frame", F.floor(F.col("t") / (6 * HOUR)))
    raw = C.mean_of_repeats(p, ["vehicle_id", "frame"], ["x_cents", "y"])
    fixed = C.mean_of_repeats(p.where("conf >= 0.5"), ["vehicle_id", "frame"], ["x_cents", "y"])
    c = evaluate.correction(raw, fixed, ["vehicle_id", "frame"], "vehicle_id", ["x_cents", "y"])
    return c.select("vehicle_id", F.round("correction", 4).alias("correction"), "n")


@query
def r2(spark, d):
    return pts(spark, d).groupBy("direction").agg(r6(F.regr_r2("y", "conf")).alias("r2"), r6(F.regr_slope("y", "conf")).alias("slope"))


@query
def ids_fgmt(spark, d):
    m = frs(spark, d).select("vehicle_id", F.expr("(vehicle_id div 7) * 100 + fragment_id % 3").alias("trajectory_id"))
    return evaluate.switches_and_fragments(m, "vehicle_id", "trajectory_id")


@query
def merge_stage_eval(spark, d):
    members = frs(spark, d).select(F.col("vehicle_id").alias("set_id"), F.col("fragment_id").alias("member"))
    s = evaluate.stage_scores(members, _scores(spark, d), _each_conflict(spark, d), "member", "set_id")
    return s.select("set_id", "n_members", *[r6(c).alias(c) for c in ("rotation", "acceleration", "backward", "most_conflict")], "n_conflicts")


def _conflict_edges(spark, d):
    dur = frs(spark, d).select(F.col("fragment_id").alias("id"), ((F.col("last_t") - F.col("first_t")) / float(HOUR)).alias("duration")).where("duration > 0")
    return evaluate.conflict_edges(_each_conflict(spark, d), dur)


@query
def conflict_graph_edges(spark, d):
    e = gr.heavier_direction(_conflict_edges(spark, d))
    return e.select("u", "v", r6("weight").alias("weight"))


@query
def conflict_removed(spark, d):
    return gr.greedy_removal(gr.materialise(gr.heavier_direction(_conflict_edges(spark, d))))


@query
def valid_tracks(spark, d):
    p = pts(spark, d).withColumn("frame", F.floor(F.col("t") / HOUR))
    t = p.groupBy("fragment_id").agg(F.min("frame").alias("first_frame"), F.max("frame").alias("last_frame"), F.min("x_cents").alias("min_x"), F.max("x_cents").alias("max_x"))
    return evaluate.valid_tracks(t, "fragment_id", 0.02).select("fragment_id", "valid")


@query
def dashboard_ratio(spark, d):
    f = frs(spark, d)
    one = lambda k: f.where(F.col("direction") == k).agg(F.count(F.lit(1)).alias("tracks"), F.sum("n").alias("samples"), F.max("n").alias("longest"))
    r = evaluate.relative_to_larger(one(1), one(-1), ["tracks", "samples", "longest"])
    return r.select("metric", r6("a").alias("a"), r6("b").alias("b"))


@query
def pie_shares(spark, d):
    return evaluate.shares(frs(spark, d), "compute_node_id").select("compute_node_id", "n", r6("share").alias("share"))


@query
def best_run(spark, d):
    return evaluate.best_run(frs(spark, d), "compute_node_id", "n", "last_t")


@query
def bounding_extents(spark, d):
    c = G.corners(F.col("width"), F.col("length"), F.col("x"), F.col("y"), F.lit(0.0))
    p = hours(spark, d).select(c.alias("c"))
    xs, ys = [F.col(f"c.{n}_x") for n in ("bbr", "fbr", "fbl", "bbl")], [F.col(f"c.{n}_y") for n in ("bbr", "fbr", "fbl", "bbl")]
    return p.agg(r6(F.min(F.least(*xs))).alias("min_x"), r6(F.max(F.greatest(*xs))).alias("max_x"), r6(F.min(F.least(*ys))).alias("min_y"), r6(F.max(F.greatest(*ys))).alias("max_y"))


@query
def metric_registry(spark, d):
    named = {"mean_y": r6(F.avg("y")), "samples": F.count(F.lit(1)), "mean_conf": r6(F.avg("conf"))}
    return evaluate.metrics(pts(spark, d), named, "vehicle_id")
