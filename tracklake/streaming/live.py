"""The live path: replayed or arriving fragments, watermarks, sessions, rolling windows and stateful merging."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.stitch import Matcher
from ..sources.adapter import HOUR


def replay(spark: SparkSession, folder: str, schema, files_per_batch: int = 1) -> DataFrame:
    """Files of a folder as a stream, so many at a time: the rate limit is the back-pressure."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def event_time(stream: DataFrame, column: str = "ts", delay: str = "1 second") -> DataFrame:
    """With a watermark on the time of the first sample. Late rows leave stateful steps only."""
    return stream.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def tumbling(stream: DataFrame, every: str, key: str) -> DataFrame:
    return stream.groupBy(F.window("ts", every), key).agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))


def hopping(stream: DataFrame, size: str, every: str, key: str) -> DataFrame:
    """Rolling windows: `size` long, one beginning every `every`."""
    return stream.groupBy(F.window("ts", size, every), key).agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))


def sessions(stream: DataFrame, gap: str, key: str) -> DataFrame:
    """A key's rows with no pause of `gap` or more between them."""
    return stream.groupBy(F.session_window("ts", gap), key).agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))


def late_rows(batch: DataFrame, watermark) -> DataFrame:
    """The rows of a batch that a stateful step would drop, for a side table."""
    return batch.where(F.col("ts") < F.lit(watermark))


_STATE = "tails array<struct<id:long,last:long,component:long,low:double,high:double>>"
_OUT = "fragment_id long, component long, last_t long"


def _merge_window(batches: Iterator[pd.DataFrame], state: GroupState, window: int, reach: float | None) -> Iterator[pd.DataFrame]:
    """Live fragments of one key: those that overlap (in time, and in x where it is looked at) share a component until
    all of it is older than the window."""
    live = [tuple(x.values()) if isinstance(x, dict) else tuple(x) for x in state.get[0]] if state.exists else []
    rows = pd.concat(list(batches), ignore_index=True) if not state.hasTimedOut else pd.DataFrame()
    newest = None
    for row in rows.sort_values(["last_t", "fragment_id"]).itertuples(index=False) if len(rows) else ():
        low, high = (float(row.low_x), float(row.high_x)) if reach is not None else (0.0, 0.0)
        near = {c for _, last, c, a, b in live if last > row.first_t and (reach is None or (a - reach <= high and low - reach <= b))}
        component = min([*near, row.fragment_id])
        if near:
            live = [(i, last, component if c in near else c, a, b) for i, last, c, a, b in live]
        live.append((row.fragment_id, row.last_t, component, low, high))
        newest = max(newest or row.last_t, row.last_t)
    oldest = {}
    for _, last, c, _, _ in live:
        oldest[c] = max(oldest.get(c, last), last)
    done = {c for c, last in oldest.items() if state.hasTimedOut or (newest is not None and last < newest - window)}
    out = pd.DataFrame([(i, c, last) for i, last, c, _, _ in live if c in done], columns=["fragment_id", "component", "last_t"], dtype="int64")
    live = [x for x in live if x[2] not in done]
    if live:
        state.update(([{"id": i, "last": last, "component": c, "low": a, "high": b} for i, last, c, a, b in live],))
        state.setTimeoutTimestamp(max(x[1] for x in live) // 1000 + window // 1000 + 1)
    else:
        state.remove()
    yield out


def merge_live(stream: DataFrame, window: int = 20 * HOUR, on: Sequence[str] = ("direction",), reach: float | None = None) -> DataFrame:
    """Components of fragments that overlap in time, per value of `on`, given out when their window has passed.

    stream: ts (watermarked), fragment_id, first_t, last_t in microseconds and the columns `on`; the more of these
    (direction, compute_node_id), the more tasks share the work. With `reach` also low_x and high_x: ways of overlapping
    fragments must come as near as that. The state of a key is its fragments of the last window; timers empty
    it at the end.
    """

    def step(key, batches, state):
        yield from _merge_window(batches, state, window, reach)

    return stream.groupBy(*on).applyInPandasWithState(step, _OUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


_HELD = "rows array<struct<id:long,first:long,last:long>>, newest long"


def ordered(stream: DataFrame, buffer: int = 1_000_000, on: Sequence[str] = ("direction",)) -> DataFrame:
    """Fragments in order of (last_t, fragment_id), per value of `on`, each as soon as it ended more than `buffer` microseconds
    before the newest beginning; the rest when the stream ends (by the watermark). `place` counts them per key.

    stream: ts (watermarked), fragment_id, first_t, last_t and the columns `on`, by which the rows are routed.
    """

    def step(key, batches, state):
        held, newest, given = (list(state.get[0]), state.get[1], state.get[2]) if state.exists else ([], -(1 << 62), 0)
        held = [tuple(x.values()) if isinstance(x, dict) else tuple(x) for x in held]
        if not state.hasTimedOut:
            for pdf in batches:
                held += [(int(i), int(a), int(b)) for i, a, b in pdf[["fragment_id", "first_t", "last_t"]].itertuples(index=False)]
                newest = max(newest, int(pdf["first_t"].max()))
        held.sort(key=lambda x: (x[2], x[0]))
        n = len(held) if state.hasTimedOut else sum(last < newest - buffer for _, _, last in held)
        out, held = held[:n], held[n:]
        if held:
            state.update(([{"id": i, "first": a, "last": b} for i, a, b in held], newest, given + n))
            state.setTimeoutTimestamp(max(max(x[2] for x in held) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        else:
            state.update(([], newest, given + n))
        yield pd.DataFrame([(*key, i, a, b, given + k) for k, (i, a, b) in enumerate(out)], columns=[*on, "fragment_id", "first_t", "last_t", "place"])

    kinds = ", ".join(f"{c} {stream.schema[c].dataType.simpleString()}" for c in on)
    return stream.groupBy(*on).applyInPandasWithState(step, f"{kinds}, fragment_id long, first_t long, last_t long, place long", _HELD + ", given long", "append", GroupStateTimeout.EventTimeTimeout)


_MATCHER = "state string"
_LINKS = "trajectory_id long, fragment_id long, place long"


def step_cost(tail: dict, head: dict, unit: float = HOUR) -> float:
    """The older stitch cost of a live pair: how far the head begins from where the tail's speed would have brought it, as half
    a normal log-likelihood whose variance grows with the gap."""
    gap = (head["first_t"] - tail["last_t"]) / unit
    error = tail["last_x"] + tail["v"] * gap - head["first_x"]
    return (math.log(2 + gap) + error * error / (2 + gap)) / 2


def match_live(stream: DataFrame, window: int = 20 * HOUR, threshold: float = 3.0, on: Sequence[str] = ("direction", "compute_node_id"), cost=step_cost) -> DataFrame:
    """Chains of fragments that follow one another, matched online, given out when their window has passed.

    stream: ts (watermarked), fragment_id, first_t, last_t, first_x, last_x, v (x in one of the cost's time units) and the
    columns `on`. A key's state is the matcher's: the fragments whose chain may still grow, their edges and links.
    Rows of a batch are taken in order of (last_t, fragment_id), as they come out of `ordered`. A chain whose
    last fragment ended longer ago than the window leaves the state; nothing that comes later can change it, as
    edges are no longer than the window.
    """

    def step(key, batches, state):
        matcher, facts, newest = Matcher(), {}, -(1 << 62)
        if state.exists:
            kept = json.loads(state.get[0])
            facts = {f["fragment_id"]: f for f in kept["facts"]}
            newest = kept["newest"]
            matcher.nodes = list(facts)
            for x, u, gain in kept["edges"]:
                matcher.weight[x][u] = gain
            for x, u in kept["links"]:
                matcher.before[x], matcher.after[u] = u, x
        if not state.hasTimedOut:
            rows = pd.concat(list(batches), ignore_index=True).sort_values(["last_t", "fragment_id"])
            for row in rows[["fragment_id", "first_t", "last_t", "first_x", "last_x", "v"]].to_dict("records"):
                head = {k: (float(v) if k in ("first_x", "last_x", "v") else int(v)) for k, v in row.items()}
                near = {i: threshold - cost(tail, head) for i, tail in facts.items() if 0 <= head["first_t"] - tail["last_t"] <= window}
                facts[head["fragment_id"]] = head
                matcher.add(head["fragment_id"], near)
                newest = max(newest, head["last_t"])
        done = [path for path in matcher.paths() if state.hasTimedOut or facts[path[-1]]["last_t"] < newest - window]
        gone = {i for path in done for i in path}
        live = [i for i in matcher.nodes if i not in gone]
        if live:
            edges = [(x, u, g) for x in live for u, g in matcher.weight[x].items() if u not in gone]
            links = [(x, u) for x, u in matcher.before.items() if x not in gone]
            state.update((json.dumps({"facts": [facts[i] for i in live], "edges": edges, "links": links, "newest": newest}),))
            state.setTimeoutTimestamp(max(facts[i]["last_t"] for i in live) // 1000 + window // 1000 + 1)
        elif state.exists:
            state.remove()
        yield pd.DataFrame([(path[0], i, k) for path in done for k, i in enumerate(path)], columns=["trajectory_id", "fragment_id", "place"], dtype="int64")

    return stream.groupBy(*on).applyInPandasWithState(step, _LINKS, _MATCHER, "append", GroupStateTimeout.EventTimeTimeout)


def snapshots_live(stream: DataFrame, every: str, key: str) -> DataFrame:
    """Snapshots of an instant as they become complete: one row per slot of time, maps eb and wb from vehicle to
    [cx, cy, l, w, direction], given out once the watermark has passed the slot.

    stream: ts (watermarked), key, direction, cx, cy, l, w. A slot is stale when the watermark says so, by event time;
    the number of later rows does not matter.
    """
    five = F.array("cx", "cy", "l", "w", F.col("direction").cast("double"))
    entry = F.struct(F.col(key).cast("string").alias("key"), five.alias("value"))
    side = lambda d: F.map_from_entries(F.array_sort(F.collect_set(F.when(F.col("direction") == d, entry))))
    return stream.groupBy(F.window("ts", every)).agg(side(1).alias("eb"), side(-1).alias("wb")).select(F.col("window.start").alias("slot_start"), "eb", "wb")


def run_to_memory(df: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """Runs a stream over all that is there and gives the result table; the drain of a live run."""
    query = df.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    query.awaitTermination()
    return df.sparkSession.table(name)


def run_to_table(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Runs a stream into Parquet with a checkpoint, from which a stopped run goes on."""
    df.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
