"""Small cases with known answers, and invariants of the operators that SQL cannot express."""

import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tracklake import schema
from tracklake.functions import geometry, kinematics
from tracklake.operators import cleaning, collision, documents, evaluate, graph, merge, pivot, rectify, series, stitch
from tracklake.operators.joins import asof_join, gap_join, overlap_join


def collected(df):
    return sorted(map(tuple, df.collect()))


# --- cleaning


def test_samples_on_a_bound_stay(spark):
    """k values of one track; the one on 1.5 standard deviations is decided by no order of summing."""
    ks = [99, 3, 98, 37, 96, 34, 53, 21, 53, 8, 47, 75, 23]
    n, s, q = len(ks), sum(ks), sum(k * k for k in ks)
    want = sum(4 * (n * k - s) ** 2 <= 9 * (n * q - s * s) for k in ks)
    assert any(4 * (n * k - s) ** 2 == 9 * (n * q - s * s) for k in ks)
    for order in (ks, ks[::-1], sorted(ks)):
        p = spark.createDataFrame([(1, k * 72 / 100.0) for k in order], "v long, y double").coalesce(1)
        assert p.select(cleaning.null_beyond(F.col("y"), "v", 1.5).alias("y")).where("y is not null").count() == want


def test_mapped_time_of_many_frames(spark):
    day = 86_400_000_000
    p = spark.createDataFrame([(0, 0), (3_000_000, 20 * day), (6_000_000, 30 * day)], "frame long, t long")
    assert collected(cleaning.mapped_time(p, "frame", "t").select("frame", "mapped_t")) == [(0, 0.0), (3_000_000, 15.0 * day), (6_000_000, 30.0 * day)]


# --- graph structures


def test_sorted_list():
    nodes = graph.SortedList()
    for k, key in enumerate("abcde"):
        nodes.append(key, k)
    for key, t in (("a", 2), ("d", 5), ("b", 1), ("d", 3), ("e", 5), ("b", 0.5), ("a", 1)):
        nodes.update(key, t)
    assert nodes.order() == list("bacde") and [nodes.times[k] for k in nodes.order()] == [0.5, 1, 2, 3, 5] and nodes.first() == "b"
    nodes.delete("b")
    assert nodes.first() == "a"


def test_path_cache():
    cache = graph.PathCache()
    for k, key in enumerate("abcdefghij"):
        cache.add(key, k)
    for a, b in ("ac", "cf", "hj", "dj", "bi", "ei"):
        cache.union(a, b)
    assert "".join(cache.find(k) for k in "abcdefghij") == "abadbagdbd"
    assert ["".join(p) for p in cache.paths()] == ["acf", "g", "bei", "dhj"]
    assert cache.pop_first() == list("acf") and len(cache.path) == 3 and len(cache.parent) == 7


def matched(steps):
    m = stitch.Matcher()
    for node, gains in steps:
        m.add(node, gains)
    return m


def test_matching_traces():
    start = [(k, {}) for k in "abc"]
    one = [("a", {}), ("b", {}), ("c", {"a": 2, "b": 3.5})]
    assert sorted(matched(one).paths()) == [["a"], ["b", "c"]]
    two = [*one, ("d", {"b": 3, "a": 0.2})]
    assert sorted(matched(two).paths()) == [["a", "d"], ["b", "c"]]
    three = [*two, ("e", {"a": 5})]
    assert sorted(matched(three).paths()) == [["a", "e"], ["b", "c"], ["d"]]
    four = [("a", {}), ("b", {}), ("c", {"a": 6, "b": 1}), ("d", {"b": 3, "a": 7})]
    assert sorted(matched(four).paths()) == [["a", "c"], ["b", "d"]] and matched(four).total() == 9
    assert start


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 10**6))
def test_matching_is_valid_and_bounded(seed):
    rng = random.Random(seed)
    n = rng.randrange(2, 12)
    steps = [(j, {i: round(rng.random() * 4, 3) for i in range(j) if rng.random() < 0.5}) for j in range(n)]
    m = matched(steps)
    assert sorted(x for p in m.paths() for x in p) == list(range(n))
    assert all(b in dict(steps) and a in dict(steps)[b] for p in m.paths() for a, b in zip(p, p[1:], strict=False))
    best = stitch.best_matching([(i, j, g) for j, gains in steps for i, g in gains.items()])
    assert m.total() <= best + 1e-9


def test_best_matching():
    assert stitch.best_matching([("a", "c", 6), ("b", "c", 1), ("b", "d", 3), ("a", "d", 7)]) == 9
    assert stitch.best_matching([]) == 0


def test_connected_components(spark):
    nodes = spark.range(60).toDF("id")
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(40, 50), (50, 45)], "a long, b long")
    out = dict(collected(graph.connected_components(nodes, edges)))
    assert all(out[i] == 0 for i in range(31)) and out[40] == out[50] == out[45] == 40 and out[35] == 35


def test_greedy_removal(spark):
    star = [(1, k) for k in range(2, 7)] + [(10, 11), (11, 12), (12, 10)]
    out = graph.greedy_removal(spark.createDataFrame(star, "u long, v long"))
    assert collected(out.select("removed")) == [(1,), (10,), (11,)]


# --- joins


def intervals(rng, n):
    rows = []
    for k in range(n):
        a = rng.randrange(0, 500)
        rows.append((k, k % 2, a, a + rng.choice([0, 3, 20, 90])))
    return rows


def test_interval_joins_equal_all_pairs(spark):
    rows = intervals(random.Random(1), 80)
    df = spark.createDataFrame(rows, "id long, side long, lo long, hi long")
    for width in (7, 50, 1000):
        got = overlap_join(df, df, ["side"], "lo", "hi", width).where("a_id < b_id").select("a_id", "b_id")
        assert collected(got) == sorted((a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[1] == b[1] and a[2] <= b[3] and b[2] <= a[3])
    got = gap_join(df, df, ["side"], "hi", "lo", 25).select("a_id", "b_id")
    assert collected(got) == sorted((a[0], b[0]) for a in rows for b in rows if a[1] == b[1] and 0 <= b[2] - a[3] <= 25)
    plan = overlap_join(df, df, ["side"], "lo", "hi", 50)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_asof(spark):
    left = spark.createDataFrame([(1, 5, "a"), (1, 10, "b"), (2, 1, "c")], "k long, t long, name string")
    right = spark.createDataFrame([(1, 3, 1.0), (1, 5, 2.0), (1, 11, 3.0), (2, 2, 4.0)], "k long, t long, v double")
    assert sorted((r.name, r.v) for r in asof_join(left, right, "k", "t", "v").collect()) == [("a", 2.0), ("b", 2.0), ("c", None)]


# --- functions


def test_boxes_touch(spark):
    rows = [(0, 0, 2, 2, 2, 0, 2, 2), (0, 0, 2, 2, 2.1, 0, 2, 2), (0, 0, 2, 2, 0, 2, 2, 2), (0, 0, 2, 2, 0, 2.1, 2, 2)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in rows], "ax double, ay double, al double, aw double, bx double, by double, bl double, bw double")
    a, b = geometry.box(*[F.col(c) for c in ("ax", "ay", "al", "aw")]), geometry.box(*[F.col(c) for c in ("bx", "by", "bl", "bw")])
    df = df.withColumn("a", a).withColumn("b", b)
    assert [r[0] for r in df.select(geometry.overlaps(F.col("a"), F.col("b"))).collect()] == [True, False, True, False]


def test_lanes(spark):
    df = spark.createDataFrame([(v,) for v in (-13.0, -12.0, 0.0, 11.9, 12.0, 132.0)], "y double")
    assert [r[0] for r in df.select(kinematics.lane(F.col("y"))).collect()] == [0, 1, 2, 2, 3, 13]


def test_projection_fit():
    h = [1.1, 0.2, 3, -0.1, 0.9, 5, 1e-3, 2e-3, 1]
    src = [(0, 0), (10, 0), (0, 10), (10, 10), (5, 3)]
    at = lambda x, y: ((h[0] * x + h[1] * y + h[2]) / (h[6] * x + h[7] * y + 1), (h[3] * x + h[4] * y + h[5]) / (h[6] * x + h[7] * y + 1))
    assert np.allclose(geometry.fit_projection(src, [at(*p) for p in src]), h)


def test_interpolation_edges(spark):
    df = spark.createDataFrame([(1, k, v) for k, v in enumerate([None, 1.0, None, 3.0, None])], "fragment_id long, i long, v double")
    w = kinematics.along("fragment_id", "i")
    assert [r[0] for r in df.select("i", kinematics.interpolate(F.col("v"), F.col("i"), w, clamp=False).alias("x")).orderBy("i").select("x").collect()] == [None, 1, 2, 3, 3]
    assert [r[0] for r in df.select("i", kinematics.interpolate(F.col("v"), F.col("i"), w).alias("x")).orderBy("i").select("x").collect()] == [1, 1, 2, 3, 3]


def test_resampling_phase(spark):
    t = [100013, 100053, 100093, 100173, 100213]
    df = spark.createDataFrame([(1, v, 10.0 * k) for k, v in enumerate(t)], "fragment_id long, t long, x double")
    out = series.fine_then_coarse(df, "fragment_id", "t", 10, 4, ["x"])
    assert [r.x for r in out.orderBy("slot").collect()] == [0, 10, 20, 25, 30, 40]
    plain = series.full_grid(series.grid_means(df, "fragment_id", "t", 40, ["x"], anchored=True), "fragment_id", ["x"])
    assert [r.x for r in plain.orderBy("slot").collect()] == [0, 10, 20, None, 30, 40]


def test_shared_samples_drop_the_last(spark):
    """Two grids that share two slots: the costs look at the first of them and divide by two."""
    grid = spark.createDataFrame([(1, s, float(s), 0.0, 4.0, 2.0) for s in range(4)] + [(2, s, float(s) + 1, 0.0, 4.0, 2.0) for s in range(2, 5)], "fragment_id long, slot long, x double, y double, length double, width double")
    pairs = spark.createDataFrame([(1, 2)], "a_fragment_id long, b_fragment_id long")
    row = merge.overlap_cost(merge.shared_samples(pairs, grid, ["x", "y", "length", "width"])).first()
    assert row.shared == 2 and row.cost == pytest.approx(1 / 4 / 8 / 2)


def test_snapshots_round_trip(spark):
    grid = spark.createDataFrame([(k, s, 10.0 * s + k, float(k), 4.0, 2.0, 1 if k % 2 else -1) for k in range(4) for s in range(5)], "id long, slot long, x double, y double, length double, width double, direction int")
    long = pivot.snapshots(grid, "id", [])
    back = pivot.tracks(pivot.flat(pivot.nested(long, "id"), "id"), "id")
    rows = {int(r.id): r for r in back.collect()}
    assert len(rows) == 4 and all([(s.slot, s.x) for s in rows[k].samples] == [(s, 10.0 * s + k) for s in range(5)] for k in range(4))


def test_slice_keeps_what_is_inside(spark):
    points = spark.createDataFrame([(1, k, k, 10 * k) for k in range(10)], "fragment_id long, event_id long, t long, x_cents long")
    out = documents.slice_points(points, "fragment_id", ["t"], (2, 8), (30, 200))
    assert [r.t for r in out.orderBy("t").collect()] == [3, 4, 5, 6, 7]


def test_upserts(spark):
    docs = spark.createDataFrame([(1, [5]), (2, None)], "id long, ids array<long>")
    more = spark.createDataFrame([(1, 7), (2, 3), (9, 1)], "id long, v long")
    assert sorted((r.id, r.ids) for r in documents.push(docs, more, "id", "ids", "v").collect()) == [(1, [5, 7]), (2, [3]), (9, [1])]
    new = documents.set_fields(spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id long, n string, k int"), spark.createDataFrame([(2, "c"), (3, "d")], "id long, n string"), "id")
    assert sorted(map(tuple, new.collect())) == [(1, "a", 1), (2, "c", 2), (3, "d", None)]
    flat = documents.flat_name(spark.createDataFrame([(1, (2, (3,)))], "id long, s struct<a:long,b:struct<c:long>>"), "s")
    assert flat.columns == ["id", "s.a", "s.b.c"]


def test_ingest(spark):
    df = spark.createDataFrame([("a", [1.0, float("nan")], [0.0], 1.0)], "_id string, timestamp array<double>, x_position array<double>, last_timestamp double")
    clean = schema.nan_to_null(df)
    assert clean.first().timestamp == [1.0, None]
    assert schema.validate(clean, schema.FRAGMENT).count() == 1
    with pytest.raises(ValueError, match="missing"):
        schema.validate(df.drop("timestamp"), schema.FRAGMENT)
    with pytest.raises(Exception, match="null in required"):
        schema.validate(df.withColumn("_id", F.lit(None).cast("string")), schema.FRAGMENT).collect()
    assert schema.evolve(df, schema.FRAGMENT).columns[: len(schema.FRAGMENT)] == schema.FRAGMENT.names


def test_switches_and_fragments(spark):
    paths = [[100001, 100002, 200001], [100003], [200002, 300001]]
    rows = [(k, f, f // 100000) for k, p in enumerate(paths) for f in p]
    df = spark.createDataFrame(rows, "trajectory long, fragment long, truth long")
    assert tuple(evaluate.switches_and_fragments(df, "truth", "trajectory").first()) == (2, 2)


# --- rectification


def noisy(seed, n=60, missing=0.2, outliers=2):
    rng = np.random.default_rng(seed)
    x = np.cumsum(80 + rng.normal(0, 0.3, n)) / 30
    z = x + rng.normal(0, 0.3, n)
    z[rng.choice(n, outliers, replace=False)] += 15
    z[rng.random(n) < missing] = np.nan
    return z


@pytest.mark.parametrize("seed", range(4))
def test_least_squares_is_stationary(seed):
    z = noisy(seed)
    for lam2, lam3 in ((0, 1e-7), (1e-5, 1e-7)):
        x = rectify.least_squares(z, lam2, lam3)
        q, seen, m = rectify._quadratic(z, lam2, lam3, rectify.DT)
        assert np.abs(q @ x - np.where(seen, z, 0) / m).max() < 1e-8


@pytest.mark.parametrize("seed", range(4))
def test_outlier_term(seed):
    z = noisy(seed)
    base = rectify.objective(rectify.least_squares(z, 1e-5, 1e-7), z, 0.5, 1e-5, 1e-7)
    x = rectify.solve(z, 0.5, 1e-5, 1e-7)
    best = rectify.objective(x, z, 0.5, 1e-5, 1e-7)
    assert best <= base + 1e-9
    rng = np.random.default_rng(seed)
    for _ in range(20):  # no nearby series is better
        assert rectify.objective(x + rng.normal(0, 1e-3, len(x)), z, 0.5, 1e-5, 1e-7) >= best - 1e-6
    # with a large price no sample is an outlier
    assert np.abs(rectify.solve(z, 1e3, 1e-5, 1e-7) - rectify.least_squares(z, 1e-5, 1e-7)).max() < 1e-3


@pytest.mark.parametrize("seed", range(3))
def test_limits_hold(seed):
    z = noisy(seed) - 1
    x, error = rectify.with_growing_outlier_term(z, 1e-3, 0.0, 1e-7, 1)
    d = rectify.differences
    assert (d(len(z), 1) @ x).min() > -1e-2
    assert np.abs(d(len(z), 2) @ x).max() < 10 + 1e-1 and np.abs(d(len(z), 3) @ x).max() < 10 + 2
    assert np.isfinite(error)


@pytest.mark.parametrize("n", [4, 5, 47, 48, 49, 50, 51, 99, 200])
def test_banded_solves(n):
    """Against dense matrices, at lengths around those of the blocks."""
    rng = np.random.default_rng(n)
    d1, d2, d3 = (rectify.differences(n, k) for k in (1, 2, 3))
    w = [rng.random(n - k) + 0.1 for k in (0, 1, 2, 3)]
    dense = np.diag(w[0]) + 1e-3 * d1.T @ np.diag(w[1]) @ d1 + 1e-6 * d2.T @ np.diag(w[2]) @ d2 + 1e-8 * d3.T @ np.diag(w[3]) @ d3
    band = rectify.Band.diagonal(w[0])
    for k, by in ((1, 1e-3), (2, 1e-6), (3, 1e-8)):
        band = band + rectify.Band.squares(rectify._taps(k, rectify.DT), w[k], n).times(by)
    v = rng.standard_normal(n)
    assert np.allclose(band @ v, dense @ v) and np.allclose(band.solve(v), np.linalg.solve(dense, v), rtol=1e-7)


@pytest.mark.parametrize("n", [200, 401, 2000])
def test_limits_hold_at_every_length(n):
    z = noisy(5, n, 0.2, n // 30)
    z[n // 2 : n // 2 + 20] = z[np.flatnonzero(~np.isnan(z))[n // 3]]  # a stop that noise would turn backward
    x, error = rectify.with_growing_outlier_term(z, 1e-3, 0.0, 1e-7, 1)
    assert np.diff(x).min() > -1e-3 and np.isfinite(error)
    assert np.abs(np.diff(x, 2)).max() / rectify.DT**2 < 10.1


def test_weights_that_follow_the_result(monkeypatch):
    """Which weights are tried, one after the other, against a plain walk through the three loops."""
    z = noisy(7, 60, 0.2, 4)
    seen, plain = [], rectify.solve
    monkeypatch.setattr(rectify, "solve", lambda z, *weights, **more: (seen.append(weights[:3]), plain(z, *weights, **more))[1])
    x = rectify.adaptive(z, 1e-3, 1e-5, 1e-7, 1)
    step, k1, k2, k3, want = 1e-6, 1e-3, 1e-5, 1e-7, []

    def one():
        want.append((k1, k2, k3))
        return plain(z, k1, k2, k3)

    for _ in range(11):
        y = one()
        k3 += step
        if np.diff(y).min() >= 0:
            break
    if np.abs(np.diff(y, 2)).max() / rectify.DT**2 > 6:
        for _ in range(11):
            y = one()
            k2 += step
            if np.abs(np.diff(y, 2)).max() / rectify.DT**2 <= 6:
                break
    before, now = np.inf, rectify.mean_error(y, z)
    for _ in range(11):
        if now >= before:
            break
        k1 += step
        y = one()
        before, now = now, rectify.mean_error(y, z)
    assert np.allclose(seen, want) and np.allclose(x, y)


def test_rectified_tells_what_it_did(spark):
    rng = np.random.default_rng(0)
    rows = [(1, s, 80.0 * s / 30 + rng.normal(0, 0.2), 5.0, 1) for s in range(500)] + [(2, s, 1.0, 1.0, 1) for s in range(3)] + [(3, s, None, 2.0, 1) for s in range(9)]
    grid = spark.createDataFrame(rows, "id long, slot long, x double, y double, direction int")
    for method in ("opt1", "constrained"):
        out = rectify.rectified(grid, method).toPandas()
        assert set(out["id"]) == {1} and set(out["status"]) <= {"solved", "not settled"} and np.diff(out.sort_values("slot")["x"]).min() > (-1e-3 if method == "constrained" else -5)


def test_receding_windows():
    z = noisy(1, 200, 0.1, 0)
    whole, parts = rectify.least_squares(z), rectify.receding(z, 80, 40)
    assert np.isfinite(parts).all() and np.abs(whole - parts).mean() < 1.0
    z[100:150] = np.nan
    assert np.isfinite(rectify.receding(z, 40, 20)).all()
    with pytest.raises(ZeroDivisionError):
        rectify.solve(np.array([1.0, 2.0, 3.0]))


def test_pollution(spark):
    """Stretches, fragments and outliers against the rule, from the samples that were chosen."""
    from tracklake.operators import synthetic

    rows = [(k, s, float(s), 5.0, 16.0, 4.0) for k in (3, 4) for s in range(500)]
    points = spark.createDataFrame(rows, "id long, s long, x double, y double, length double, width double")
    one, again, other = (synthetic.polluted(points, "id", "s", 12.0, 0.02, seed).orderBy("id", "s").collect() for seed in (1, 1, 2))
    assert one == again and one != other and len(one) == 1000
    for k in (3, 4):
        own = [r for r in one if r.id == k]
        assert sum(r.outlier for r in own) == 10 and any(r.x is None for r in own) and own[0].s == 0
        ids = [r.fragment_id for r in own]
        assert set(ids) <= {k, *(1000 * k + j for j in range(5))} and max(ids) > k
        assert all((r.x != r.s) == r.outlier for r in own if r.x is not None)
        assert [i for i in ids if i > k] == sorted(i for i in ids if i > k)


def test_older_preparation(spark):
    from tracklake.plans import legacy

    rows = [(1, f, None if f % 2 else f / 10, 3.281 * f, 3.281 * 30, 3.281 * f, 3.281 * 32, 32.81, 6.562) for f in range(5)] + [(2, f, f / 10, -3.281 * f, 3.281 * 30, -3.281 * f, 3.281 * 32, 32.81, 6.562) for f in range(5)]
    df = spark.createDataFrame(rows, "id long, frame long, t double, bbr_x double, bbr_y double, bbl_x double, bbl_y double, length double, width double")
    out = {(r.id, r.frame): r for r in legacy.prepared(df, lanes=True).collect()}
    assert out[1, 3].x == pytest.approx(3) and out[1, 3].y == pytest.approx(31) and out[1, 3].t == pytest.approx(0.3) and out[1, 3].length == pytest.approx(10)
    assert {r.direction for (k, _), r in out.items() if k == 1} == {1} and {r.direction for (k, _), r in out.items() if k == 2} == {-1} and out[1, 0].lane is not None
    short = legacy.prepared(df.withColumn("t", F.lit(None).cast("double")).withColumn("bbr_y", F.lit(4.0))).where("id = 1 and frame = 3").first()
    assert short.t == pytest.approx(0.1) and short.length == pytest.approx(32.81)


def test_smoothers():
    v = np.arange(40.0) ** 3
    assert np.allclose(rectify.savitzky_golay(v, 9), v)
    t = np.arange(50.0)
    y = 3 * t + 2
    y[::7] += 100
    slope, intercept, inside = rectify.ransac_line(t, y, 1.0)
    assert slope == pytest.approx(3) and intercept == pytest.approx(2) and inside.sum() == 50 - len(t[::7])


# --- separation


def test_separation():
    boxes = np.array([[0, 0, 15, 6], [4, 1, 15, 6], [100, 0, 15, 6], [102, 3, 15, 6]], float)
    out, moved = collision.separate(boxes)
    assert moved and all(collision.sides(out[i], out[j]).any() for i in range(4) for j in range(i))
    same, moved = collision.separate(out)
    assert not moved and (same == out).all()
    assert collision.slack(boxes[0], boxes[1]).min() > 0 and collision.slack(out[0], out[1]).min() == 0


def test_smooth_separation_pushes_apart():
    frames = {t: {1: [0, 0, 15, 6], 2: [6, 2, 15, 6]} for t in range(12)}
    out = collision.separate_smoothly(frames)
    assert all(np.hypot(*(out[t][1][:2] - out[t][2][:2])) > np.hypot(6, 2) for t in range(3, 9))


def test_metrics_are_python_free(spark):
    df = spark.createDataFrame(pd.DataFrame({"k": [1, 1, 2], "y": [1.0, 3.0, 5.0]}))
    out = evaluate.metrics(df, {"m": F.avg("y")}, "k")
    assert collected(out) == [(1, 2.0), (2, 5.0)] and "Python" not in out._jdf.queryExecution().toString()
