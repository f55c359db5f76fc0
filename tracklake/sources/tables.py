"""Readers and writers: tables, CSV simulations, exports, metadata."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import Params

#: Columns of the simulation CSV, in order.
SIMULATION_COLUMNS = "row int, id long, vehicle_class string, timestamp double, x double, y double, length double, width double, height double, direction int, configuration_id int, mask int, real_id long"


def read_fragments(spark: SparkSession, path: str, direction: int | None = None, node: str | None = None, more_than: int = 3) -> DataFrame:
    """Fragments of more than so many samples; direction and node are partition columns, so other files aren't read."""
    df = spark.read.parquet(path)
    for name, value in (("direction", direction), ("compute_node_id", node)):
        if value is not None:
            df = df.where(F.col(name) == value)
    return df.where(F.size("timestamp") > more_than)


def range_batches(df: DataFrame, column: str, increment: float) -> DataFrame:
    """Adds the number of the read batch: consecutive ranges of `increment`, counted from the smallest value."""
    low = df.agg(F.min(column).alias("_low"))
    return df.crossJoin(F.broadcast(low)).withColumn("batch", F.floor((F.col(column) - F.col("_low")) / increment)).drop("_low")  # one row


#: Feet in a metre.
FEET = 3.2808
#: Columns of a simulation CSV that are lengths.
LENGTHS = ("x", "y", "length", "width", "height")


def source_of(process: str, raw: str, stage: str) -> str:
    """The table that a process reads: the stage table between the passes if its name speaks of a master, else the raw one."""
    return stage if "master" in process.lower() else raw


def read_simulation(spark: SparkSession, path: str, mode: str = "gt", start: float = 0, end: float = float("inf"), min_samples: int = 5, metres: bool = False, noise: float = 0.0, seed: int = 0, contiguous: bool = False) -> DataFrame:
    """One row per vehicle of a simulation CSV. Raw mode drops masked rows; x is moved from the front to the back.

    metres: lengths are converted to feet. noise: standard deviation of what is added to x and y, the same for the same
    seed and row. contiguous: an id whose rows are interrupted by another's in the file comes back as a new document
    (`part` counts them).
    """
    rows = spark.read.csv(path, schema=SIMULATION_COLUMNS, header=True).withColumn("_file", F.col("_metadata.file_path"))
    if metres:
        rows = rows.withColumns({c: F.col(c) * FEET for c in LENGTHS})
    rows = rows.where(F.col("timestamp").between(start, end))
    key = "real_id" if mode == "gt" else "id"
    if mode == "raw":
        rows = rows.where("mask <> 0")
    rows = rows.withColumn("x", F.col("x") - F.col("direction") * F.col("length"))
    if noise:
        # A uniform number of the row, twice, makes a normal one (Box and Muller): the same wherever the row is read.
        uniform = lambda k: (F.pmod(F.xxhash64(F.lit(seed), F.lit(k), "_file", "row"), F.lit(1 << 40)) + 1) / float((1 << 40) + 1)
        normal = lambda k: F.sqrt(-2 * F.log(uniform(k))) * F.cos(2 * F.pi() * uniform(k + 1))
        rows = rows.withColumns({"x": F.col("x") + noise * normal(0), "y": F.col("y") + noise * normal(2)})
    return assemble(contiguous_parts(rows, key), key, min_samples, ("part",)) if contiguous else assemble(rows, key, min_samples)


def contiguous_parts(rows: DataFrame, key: str, file: str = "_file", place: str = "row") -> DataFrame:
    """Adds `part`: how often the key had been interrupted in its file before this row."""
    before = F.lag(key).over(Window.partitionBy(file).orderBy(place))
    rows = rows.withColumn("_begins", F.when(before.isNull() | (before != F.col(key)), 1).otherwise(0))
    so_far = Window.partitionBy(file, key).orderBy(place).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("part", F.sum("_begins").over(so_far) - 1).drop("_begins")


def assemble(rows: DataFrame, key: str, min_samples: int, more: Sequence[str] = ()) -> DataFrame:
    """Samples (key, timestamp, x, y, length, width, direction) as one row per key with parallel arrays."""
    sample = F.struct("timestamp", "x", "y")
    out = rows.groupBy(key, *more).agg(F.sort_array(F.collect_list(sample)).alias("s"), F.first("direction").alias("direction"), F.median("length").alias("length"), F.median("width").alias("width"))
    series = lambda f: F.transform("s", lambda v: v[f])
    ends = {"first_timestamp": F.element_at("s", 1)["timestamp"], "last_timestamp": F.element_at("s", -1)["timestamp"], "starting_x": F.element_at("s", 1)["x"], "ending_x": F.element_at("s", -1)["x"]}
    out = out.where(F.size("s") >= min_samples).withColumns({**ends, "x_position": series("x"), "y_position": series("y")})
    return out.withColumn("timestamp", series("timestamp")).drop("s")


def idle_sessions(rows: DataFrame, key: str, t: str, idle) -> DataFrame:
    """Adds `session`: a key that was away for longer than `idle` comes back as a new document."""
    w = Window.partitionBy(key).orderBy(t)
    new = F.when(F.col(t) - F.lag(t).over(w) > idle, 1).otherwise(0)
    return rows.withColumn("_new", new).withColumn("session", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("_new")


def read_cameras(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All camera CSV files of a folder, with the camera's name from the file's."""
    name = F.regexp_extract(F.col("_metadata.file_name"), r"(p(\d)*c(\d)*)", 1)
    return spark.read.option("recursiveFileLookup", True).csv(folder, schema=schema, header=True).select("*", name.alias("camera"))


def latest_table(spark: SparkSession, prefix: str = "") -> str | None:
    """The last of the catalog's tables by name, names holding their time."""
    names = [t.name for t in spark.catalog.listTables() if t.name.startswith(prefix)]
    return max(names, default=None)


def write_stage(df: DataFrame, path: str, partition_by: Sequence[str] = ("direction", "compute_node_id"), sort_by: Sequence[str] = ("last_timestamp",), mode: str = "append") -> None:
    """A stage's rows by direction and node, sorted inside the files so that row groups can be skipped."""
    df.repartition(*partition_by, F.floor(F.col(sort_by[0]) / 600)).sortWithinPartitions(*partition_by, *sort_by).write.mode(mode).partitionBy(*partition_by).parquet(path)


def export_json(df: DataFrame, path: str, column: str, seconds: float) -> None:
    """JSON files by time range of `column`, compressed."""
    range_batches(df, column, seconds).repartition("batch").sortWithinPartitions("batch", column).write.mode("overwrite").partitionBy("batch").option("compression", "gzip").json(path)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def run_record(spark: SparkSession, run_id: str, params: Params) -> DataFrame:
    """One row for the table of runs: the settings as JSON."""
    return spark.createDataFrame([(run_id, json.dumps(asdict(params), sort_keys=True))], "run_id string, parameters string")


def write_results(df: DataFrame, path: str, run_id: str) -> None:
    df.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(path)


def read_results(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """The rows that a run wrote; run_id is a partition column, so other runs' files aren't read."""
    return spark.read.parquet(path).where(F.col("run_id") == run_id).drop("run_id")


def bulk_sink(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Writes a stream in bulk, one unordered write for each micro-batch; a batch that is done again replaces what it wrote."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
