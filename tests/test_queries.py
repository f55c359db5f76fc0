"""Every query with an oracle against DuckDB, on the smallest tables."""

import math
import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tracklake.oracle import ORACLE
from tracklake.queries import REGISTRY

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    con.execute(f"create view events as select * from read_parquet('{SF}/events.parquet')")
    return con


def shown(rows, names, order):
    at = [names.index(c) for c in order]
    plain = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else repr(v)
    return sorted(tuple(plain(r[k]) for k in at) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_oracle(spark, duck, name):
    df = REGISTRY[name](spark, SF)
    found = duck.execute(ORACLE[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    assert shown([tuple(r) for r in df.collect()], df.columns, order) == shown(found.fetchall(), names, order)


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - set(ORACLE)))
def test_runs(spark, name):
    df = REGISTRY[name](spark, SF)
    assert df.columns and df.count() >= 0


def test_stitched_chains_partition_the_fragments(spark):
    rows = REGISTRY["stitched"](spark, SF).collect()
    want = {r.fragment_id for r in REGISTRY["fragments_all"](spark, SF).select("fragment_id").distinct().collect()}
    assert {r.fragment_id for r in rows} == want and len(rows) == len(want)
    chains = {}
    for r in rows:
        chains.setdefault(r.trajectory_id, []).append((r.place, r.fragment_id))
    assert all([p for p, _ in sorted(c)] == list(range(len(c))) and min(c)[1] == k for k, c in chains.items())
    assert any(len(c) > 1 for c in chains.values())


def test_separated_boxes_do_not_overlap(spark):
    from itertools import combinations

    from tracklake.operators.collision import sides
    from tracklake.queries import _crowd

    size = {(r.slot, r.fragment_id): (r.l, r.w) for r in _crowd(spark, SF).collect()}
    slots = {}
    for r in REGISTRY["separatum"](spark, SF).collect():
        slots.setdefault((r.slot, r.direction), []).append(np.array([r.cx, r.cy, *size[r.slot, r.fragment_id]], float))
    assert slots and all(sides(a, b).any() for boxes in slots.values() for a, b in combinations(boxes, 2))


def test_rectified_series_are_stationary(spark):
    """opt1: the gradient of the objective is zero at every sample of every series."""
    from tracklake.operators import rectify
    from tracklake.queries import _rect_grid

    given = _rect_grid(spark, SF).toPandas().sort_values(["id", "slot"])
    found = REGISTRY["rectified_opt1"](spark, SF).toPandas().sort_values(["id", "slot"])
    assert set(found["status"]) == {"solved"} and len(found)
    for number, own in found.groupby("id"):
        z = given[given["id"] == number]["x"].to_numpy(float)
        q, seen, m = rectify._quadratic(z, 0.0, 1e-7, rectify.DT)
        base = np.nanmin(z)
        assert np.abs(q @ (own["x"].to_numpy() - base) - np.where(seen, z - base, 0) / m).max() < 1e-5 * max(1.0, np.nanmax(z) - base)


@pytest.mark.parametrize("name", ["grid_track_join", "merge_cost", "merge_cost_simple", "merge_cost_samples", "stitch_cost", "legacy_nll_cost"])
def test_pairs_stream_out_of_their_join(spark, name):
    """Pairs grow with the square of what is in one window: above their join nothing sorts, groups, writes or joins them."""
    plan = REGISTRY[name](spark, SF)._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() in ("Project", "Filter"):
        plan = plan.children().head()
    assert plan.nodeName() == "Join" and "_bucket" in plan.condition().toString()


@pytest.mark.parametrize("name", ["stitched", "stitched_greedy", "combined"])
def test_only_pairs_that_may_be_linked_are_written(spark, name, monkeypatch):
    from tracklake.operators import graph

    written = []
    monkeypatch.setattr(graph, "materialise", lambda df, f=graph.materialise: written.append(f(df)) or written[-1])
    REGISTRY[name](spark, SF)
    costs = [df for df in written if "cost" in df.columns]
    assert costs and all(df.where("cost > 50").isEmpty() for df in costs)


def test_halves_round_as_in_sql(spark, duck):
    from tracklake.queries import scaled6

    gap = [57848903001 + 3600 * k for k in range(2000)]
    found = spark.createDataFrame([(g,) for g in gap], "g long").select(scaled6(0.5 * (F.col("g") / float(3_600_000_000) - 2)).alias("r")).collect()
    want = duck.execute("select round(0.5 * (cast(g as double) / 3600000000 - 2), 6) from (select unnest(?::bigint[]) as g)", [gap]).fetchall()
    assert [r.r for r in found] == [w[0] for w in want]


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(REGISTRY)
