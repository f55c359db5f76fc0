"""Whole runs, streaming against batch, sources and sinks, and the driver entry."""

import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tracklake.operators.documents import nodes_in_order
from tracklake.plans import pipelines
from tracklake.queries import SLOT
from tracklake.schema import Params
from tracklake.sources import tables
from tracklake.sources.adapter import HOUR, fragments, points
from tracklake.streaming import live

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def samples(spark):
    return points(spark, SF).cache()


def checked(out, samples):
    """Each kept sample is in one trajectory, under the smallest rules of a merge and stitch."""
    kept = pipelines.confident(samples, Params())
    assert out.select("event_id").distinct().count() == out.count() == kept.count()
    before = kept.select("event_id", F.col("fragment_id").alias("old"))
    both = out.join(before, "event_id")
    assert both.groupBy("old").agg(F.count_distinct("fragment_id").alias("n")).where("n > 1").isEmpty()
    assert both.groupBy("fragment_id").agg(F.count_distinct("direction").alias("n")).where("n > 1").isEmpty()


def test_one_pass(samples):
    checked(pipelines.one_pass(samples, SLOT, HOUR), samples)


def test_two_passes(samples):
    checked(pipelines.two_passes(samples, SLOT, HOUR, nodes_in_order(fragments(samples))), samples)


def test_a_merged_fragment_ends_with_its_last_vehicle(spark):
    """Fragment 1 holds vehicle 1 up to hour 10 and vehicle 2 up to hour 40; nothing that begins at 14 follows it, what begins at 44 may."""
    from tracklake.schema import Params

    row = lambda f, v, h: (f * 1000 + v * 100 + h, h * HOUR, v, f, 1, v % 2, h * 1000 + f, 10.0 + h / 10, 0.9, 15.0 + v, 6.0)
    rows = [row(f, v, h) for f, v, hours in ((1, 1, range(0, 12, 2)), (1, 2, range(8, 42, 2)), (2, 3, range(14, 36, 2)), (3, 1, range(44, 60, 2))) for h in hours]
    p = spark.createDataFrame(rows, "event_id long, t long, vehicle_id long, fragment_id long, direction int, compute_node_id long, x_cents long, y double, conf double, length double, width double")
    joined = pipelines.merged(p.withColumn("fragment_id", F.col("fragment_id") * 10 + F.col("vehicle_id")).where("fragment_id < 20"), SLOT, 20 * HOUR, Params().merge_thresh, ("direction",))
    assert {tuple(r) for r in joined.select("fragment_id", "compute_node_id").distinct().collect()} == {(11, 1)}
    whole = joined.withColumn("fragment_id", F.lit(1).cast("long")).unionByName(p.where("fragment_id > 1").withColumn("compute_node_id", F.lit(1).cast("long")))
    assert [(r.fragment_id, r.first_t, r.last_t) for r in pipelines.fragments_of(whole).orderBy("fragment_id").collect()] == [(1, 0, 40 * HOUR), (2, 14 * HOUR, 34 * HOUR), (3, 44 * HOUR, 58 * HOUR)]
    out = pipelines.stitched(whole, HOUR, 20.0, 50.0, "local")
    chains = {tuple(r) for r in out.join(p.select("event_id", F.col("fragment_id").alias("own")), "event_id").select("own", "fragment_id").distinct().collect()}
    assert (2, 2) in chains and len(chains) == 3 and out.count() == p.count()


def test_stitched_chains_keep_gaps(samples):
    from tracklake.operators import stitch

    f = fragments(samples)
    pairs = stitch.candidates(f, 20 * HOUR)
    costs = pairs.select("a_fragment_id", "b_fragment_id", (F.col("gap") / HOUR / 10).alias("cost"))
    chains = stitch.stitched(f, costs, 3.0).join(f.select("fragment_id", "first_t", "last_t"), "fragment_id")
    assert chains.count() == f.count() == chains.select("fragment_id").distinct().count()
    rows = {}
    for r in chains.orderBy("trajectory_id", "place").collect():
        rows.setdefault(r.trajectory_id, []).append(r)
    assert any(len(v) > 1 for v in rows.values())
    for own in rows.values():
        assert [r.place for r in own] == list(range(len(own))) and own[0].fragment_id == own[0].trajectory_id
        assert all(0 <= b.first_t - a.last_t <= 20 * HOUR for a, b in zip(own, own[1:], strict=False))
    greedy = stitch.stitched_greedy(f, costs, 3.0)
    assert greedy.count() == f.count()


# --- streaming


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stream") / "events")
    rows = spark.read.parquet(f"{SF}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "user_id", F.round(F.col("value") * 100).cast("long").alias("cents"))
    rows.repartitionByRange(4, "ts").sortWithinPartitions("ts").write.parquet(path)
    return path


def sorted_rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("make", [lambda s: live.tumbling(s, "10 hours", "user_id"), lambda s: live.hopping(s, "5 hours", "1 hour", "user_id"), lambda s: live.sessions(s, "6 hours", "user_id")])
def test_windows_equal_batch(spark, folder, make):
    batch = spark.read.parquet(folder)
    stream = live.event_time(live.replay(spark, folder, batch.schema), delay="30 days")
    column = make(batch).columns[0]
    plain = lambda df: df.select(F.col(f"{column}.start").alias("a"), F.col(f"{column}.end").alias("b"), "user_id", "n", "cents")
    name = f"w{abs(hash(str(make(batch).schema) + make.__code__.co_consts.__repr__()))}"
    assert sorted_rows(plain(live.run_to_memory(make(stream), name))) == sorted_rows(plain(make(batch)))


def test_stateful_merge_equals_components(spark, samples, tmp_path):
    """Sentinel fragments far later push the watermark, so that every real component is given out."""
    f = fragments(samples).where("n > 1").select("fragment_id", F.col("direction").cast("int").alias("direction"), "first_t", "last_t")
    late = spark.createDataFrame([(-1, 1, 4_000_000_000_000_000, 4_000_000_000_000_000), (-2, -1, 4_000_000_000_000_000, 4_000_000_000_000_000)], f.schema)
    path = str(tmp_path / "fragments")
    f.orderBy("last_t").coalesce(1).withColumn("ts", F.timestamp_micros("last_t")).write.parquet(path)
    late.coalesce(1).withColumn("ts", F.timestamp_micros("last_t")).write.mode("append").parquet(path)
    schema = spark.read.parquet(path).schema
    out = live.run_to_memory(live.merge_live(live.event_time(live.replay(spark, path, schema, 10)), 20 * HOUR), "merged_live", "append")
    got = {r.fragment_id: r.component for r in out.where("fragment_id >= 0").collect()}
    rows = sorted((r.last_t, r.fragment_id, r.first_t, r.direction) for r in f.collect())
    want = {}
    for d in (1, -1):
        open_ = []
        for last, i, first, side in rows:
            if side != d:
                continue
            near = {want[j] for other, j in open_ if other > first}
            root = min([*near, i])
            for j in [j for j in want if want[j] in near]:
                want[j] = root
            want[i] = root
            open_.append((last, i))
    assert got == want


def with_sentinels(spark, rows, path, names, more, step=1):
    """Rows as files in order of their last sample, and far later ones that push the watermark, so that all else is given out."""
    rows = rows.select(*names)
    rows.orderBy("last_t").coalesce(1).withColumn("ts", F.timestamp_micros("last_t")).write.parquet(path)
    late = spark.createDataFrame([(-k - 1, *x) for k, x in enumerate(more)], rows.schema)
    late.coalesce(1).withColumn("ts", F.timestamp_micros("last_t")).write.mode("append").parquet(path)
    return live.event_time(live.replay(spark, path, spark.read.parquet(path).schema, step))


FAR = 4_000_000_000_000_000


def test_merge_looks_at_ways(spark, tmp_path):
    """Overlapping fragments whose ways are far apart stay apart; nodes are states of their own."""
    rows = [(1, 1, 0, 0, 100, 0.0, 10.0), (2, 1, 0, 50, 120, 12.0, 20.0), (3, 1, 0, 60, 130, 500.0, 510.0), (4, 1, 1, 60, 130, 0.0, 10.0), (5, 1, 0, 110, 140, 21.0, 30.0)]
    names = ["fragment_id", "direction", "compute_node_id", "first_t", "last_t", "low_x", "high_x"]
    df = spark.createDataFrame([(i, d, n, a * HOUR, b * HOUR, x, y) for i, d, n, a, b, x, y in rows], "fragment_id long, direction int, compute_node_id int, first_t long, last_t long, low_x double, high_x double")
    stream = with_sentinels(spark, df, str(tmp_path / "f"), names, [(1, 0, FAR, FAR, 0.0, 0.0), (1, 1, FAR, FAR, 0.0, 0.0)], 10)
    out = live.run_to_memory(live.merge_live(stream, 20 * HOUR, ("direction", "compute_node_id"), reach=5.0), "merged_ways", "append")
    assert {r.fragment_id: r.component for r in out.where("fragment_id >= 0").collect()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 1}


def test_ordered_release(spark, tmp_path):
    rows = [(k, 1 if k % 3 else -1, (9 + k * 7919 % 50) * HOUR, (9 + k * 7919 % 50 + k % 5) * HOUR) for k in range(60)]
    df = spark.createDataFrame(rows, "fragment_id long, direction int, first_t long, last_t long")
    stream = with_sentinels(spark, df, str(tmp_path / "f"), df.columns, [(1, FAR, FAR), (-1, FAR, FAR)], 1)
    out = live.run_to_memory(live.ordered(stream, HOUR), "in_order", "append").where("fragment_id >= 0").collect()
    for side in (1, -1):
        own = [r.fragment_id for r in sorted((r for r in out if r.direction == side), key=lambda r: r.place)]
        assert own == [i for _, i in sorted((last, i) for i, d, _, last in rows if d == side)]


def test_matching_live_equals_batch(spark, samples, tmp_path):
    """Chains of the live matcher, by key, against the same matcher over all fragments at once."""
    from tracklake.operators.stitch import Matcher

    f = fragments(samples).where("n > 1").withColumn("direction", F.col("direction").cast("int")).withColumn("compute_node_id", F.col("compute_node_id").cast("int"))
    f = f.withColumn("first_x", F.col("starting_x") / 1e5).withColumn("last_x", F.col("ending_x") / 1e5).withColumn("v", F.lit(0.0))
    names = ["fragment_id", "direction", "compute_node_id", "first_t", "last_t", "first_x", "last_x", "v"]
    keys = [tuple(r) for r in f.select("direction", "compute_node_id").distinct().collect()]
    stream = with_sentinels(spark, f, str(tmp_path / "f"), names, [(*k, FAR, FAR, 0.0, 0.0, 0.0) for k in keys], 10)
    out = live.run_to_memory(live.match_live(stream, 20 * HOUR), "matched_live", "append").where("fragment_id >= 0")
    got = {(r.fragment_id, r.trajectory_id, r.place) for r in out.collect()}
    want, rows = set(), [r.asDict() for r in f.select(*names).collect()]
    for key in keys:
        matcher, seen = Matcher(), []
        for head in sorted((r for r in rows if (r["direction"], r["compute_node_id"]) == key), key=lambda r: (r["last_t"], r["fragment_id"])):
            matcher.add(head["fragment_id"], {t["fragment_id"]: 3.0 - live.step_cost(t, head) for t in seen if 0 <= head["first_t"] - t["last_t"] <= 20 * HOUR})
            seen.append(head)
        want |= {(i, path[0], k) for path in matcher.paths() for k, i in enumerate(path)}
    assert got == want and any(place > 0 for _, _, place in want)


def test_snapshots_live_equal_batch(spark, tmp_path):
    rows = [(k, 1 if k % 2 else -1, float(s * 10 + k), float(k), 15.0, 6.0, s * 3600) for k in range(4) for s in range(12)]
    df = spark.createDataFrame(rows, "id long, direction int, cx double, cy double, l double, w double, s long").withColumn("ts", F.timestamp_seconds("s"))
    path = str(tmp_path / "s")
    df.orderBy("s").coalesce(1).write.parquet(path)
    df.limit(1).withColumn("ts", F.timestamp_seconds(F.lit(10**8))).coalesce(1).write.mode("append").parquet(path)
    stream = live.event_time(live.replay(spark, path, df.schema, 1))
    got = live.run_to_memory(live.snapshots_live(stream, "1 hour", "id"), "snapshots_live", "append").where("slot_start < timestamp'1971-01-01'")
    want = live.snapshots_live(df, "1 hour", "id")
    shown = lambda x: sorted((r.slot_start, sorted(r.eb.items()), sorted(r.wb.items())) for r in x.collect())
    assert shown(got) == shown(want) and len(shown(got)) == 12


def test_bulk_sink_and_results(spark, folder, tmp_path):
    schema = spark.read.parquet(folder).schema
    for _ in range(2):
        tables.bulk_sink(live.replay(spark, folder, schema, 2), str(tmp_path / "bulk"), str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "bulk")).count() == spark.read.parquet(folder).count()
    for run in ("a", "b"):
        tables.write_results(spark.createDataFrame([(1, run)], "k long, v string"), str(tmp_path / "r"), run)
    assert [tuple(r) for r in tables.read_results(spark, str(tmp_path / "r"), "b").collect()] == [(1, "b")]
    assert tables.source_of("east_master_feed", "raw", "temp") == "temp" and tables.source_of("east_feed", "raw", "temp") == "raw"


def test_simulation_in_metres_with_noise_and_parts(spark, tmp_path):
    lines = ["row,id,vehicle_class,timestamp,x,y,length,width,height,direction,configuration_id,mask,real_id"]
    for k in range(18):  # id 1 comes back after id 2
        lines.append(f"{k},{2 if 6 <= k < 12 else 1},sedan,{k * 0.1},{100 + k},2,5,2,1.5,1,0,1,{2 if 6 <= k < 12 else 1}")
    (tmp_path / "s.csv").write_text("\n".join(lines))
    path = str(tmp_path / "s.csv")
    feet = tables.read_simulation(spark, path, metres=True, contiguous=True).orderBy("real_id", "part").collect()
    assert [(r.real_id, r.part, len(r.x_position)) for r in feet] == [(1, 0, 6), (1, 1, 6), (2, 0, 6)]
    assert feet[0].starting_x == pytest.approx(95 * tables.FEET)
    plain, one, again, other = (tables.read_simulation(spark, path, noise=n, seed=s).orderBy("real_id").collect() for n, s in ((0, 0), (1.0, 1), (1.0, 1), (1.0, 2)))
    assert one == again and one != other and plain[0].x_position != one[0].x_position
    assert max(abs(a - b) for a, b in zip(plain[0].x_position, one[0].x_position, strict=True)) < 6


def test_checkpointed_run_goes_on(spark, folder, tmp_path):
    schema = spark.read.parquet(folder).schema
    for _ in range(2):  # the second run finds nothing new
        live.run_to_table(live.replay(spark, folder, schema), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == spark.read.parquet(folder).count()
    batch = spark.read.parquet(folder)
    assert live.late_rows(batch, batch.agg(F.max("ts")).first()[0]).count() == batch.count() - 1


# --- sources and sinks


def test_simulation_csv(spark, tmp_path):
    lines = ["row,id,vehicle_class,timestamp,x,y,length,width,height,direction,configuration_id,mask,real_id"]
    for k in range(12):
        lines.append(f"{k},{1 if k < 6 else 2},sedan,{k % 6 * 0.1},{100 + k},6,15,6,5,1,0,{0 if k == 3 else 1},{7 if k < 6 else 8}")
    (tmp_path / "s.csv").write_text("\n".join(lines))
    gt = tables.read_simulation(spark, str(tmp_path / "s.csv")).orderBy("real_id").collect()
    assert [r.real_id for r in gt] == [7, 8] and gt[0].starting_x == 85 and len(gt[0].x_position) == 6
    raw = tables.read_simulation(spark, str(tmp_path / "s.csv"), mode="raw", min_samples=6)
    assert [r.id for r in raw.collect()] == [2]


def test_cameras(spark, tmp_path):
    for name in ("record_p1c2_00.csv", "record_p10c3_00.csv"):
        (tmp_path / name).write_text("id,x\n1,2.0\n")
    out = tables.read_cameras(spark, str(tmp_path), "id long, x double")
    assert sorted(r.camera for r in out.collect()) == ["p10c3", "p1c2"]


def test_stage_tables(spark, samples, tmp_path):
    rows = fragments(samples).withColumn("last_timestamp", F.col("last_t") / 1e6).withColumn("timestamp", F.sequence(F.lit(1), F.col("n").cast("int")))
    tables.write_stage(rows, str(tmp_path / "stage"))
    back = tables.read_fragments(spark, str(tmp_path / "stage"), direction=1, node="2")
    assert back.count() == rows.where("direction = 1 and compute_node_id = 2 and n > 3").count()
    assert "PartitionFilters: [isnotnull(direction" in back._jdf.queryExecution().toString()
    tables.export_json(rows.select("fragment_id", "last_timestamp"), str(tmp_path / "json"), "last_timestamp", 86400)
    assert spark.read.json(str(tmp_path / "json")).count() == rows.count()
    tables.export_csv(rows.select("fragment_id", "n"), str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == rows.count()
    record = tables.run_record(spark, "r1", Params())
    tables.write_results(record.drop("run_id"), str(tmp_path / "runs"), "r1")
    assert json.loads(spark.read.parquet(str(tmp_path / "runs")).first().parameters)["time_win"] == 20.0


# --- driver


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    names = set(entry.queries())
    assert len(names) > 100 and set(entry.oracle_sql()) <= names
