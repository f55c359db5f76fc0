"""Document queries as DataFrame operations: find, distinct, slice, upsert, push, and joins through id lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def find(df: DataFrame, equals: Mapping | None = None, isin: Mapping | None = None, between: Mapping | None = None, exists: Sequence[str] = (), select: Sequence[str] = ()) -> DataFrame:
    """Rows that meet all conditions. between is half-open: low <= value < high. Filters reach the scan."""
    for name, value in (equals or {}).items():
        df = df.where(F.col(name) == value)
    for name, values in (isin or {}).items():
        df = df.where(F.col(name).isin(list(values)))
    for name, (low, high) in (between or {}).items():
        df = df.where((F.col(name) >= low) & (F.col(name) < high))
    for name in exists:
        df = df.where(F.col(name).isNotNull())
    return df.select(*select) if select else df


def first_existing(df: DataFrame, column: str, key: str) -> DataFrame:
    """The smallest key among rows where column exists."""
    return df.where(F.col(column).isNotNull()).agg(F.min(key).alias(f"first_{key}"))


def top_k(df: DataFrame, by: str, k: int, *ties: str) -> DataFrame:
    return df.orderBy(F.desc(by), *ties).limit(k)


def latest(df: DataFrame, key: str, by: Sequence[str], *columns: str) -> DataFrame:
    """One row per key: the columns of its last row in order of `by`."""
    return df.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(*by)).alias("_last")).select(key, "_last.*")


def nodes_in_order(fragments: DataFrame) -> DataFrame:
    """Distinct nodes with the starting_x of their first fragment, and their place in that order.

    The window runs over one row per node, not over fragments.
    """
    nodes = fragments.groupBy("compute_node_id").agg(F.min_by("starting_x", F.struct("first_t", "fragment_id")).alias("first_x"))
    return nodes.withColumn("position", F.row_number().over(Window.orderBy("first_x", "compute_node_id")) - 1)


def every_kth(df: DataFrame, key: str, by: Sequence[str], k: int) -> DataFrame:
    """Rows 0, k, 2k, ... of each key."""
    number = F.row_number().over(Window.partitionBy(key).orderBy(*by)) - 1
    return df.withColumn("_n", number).where(F.col("_n") % k == 0).drop("_n")


def sample_by_id(df: DataFrame, key: str, k: int, keep: int = 0) -> DataFrame:
    """A sample that is the same in every run: ids that leave `keep` modulo k."""
    return df.where(F.pmod(F.col(key), F.lit(k)) == keep)


def random_document(df: DataFrame, seed: int) -> DataFrame:
    return df.orderBy(F.rand(seed)).limit(1)


def bernoulli_sample(df: DataFrame, rate: float, seed: int) -> DataFrame:
    return df.sample(rate, seed)


def touches(start: Column, end: Column, low, high) -> Column:
    """Whether the interval start..end (ends in any order) has a point in low..high."""
    return (F.least(start, end) <= high) & (F.greatest(start, end) >= low)


def slice_points(points: DataFrame, key: str, order: Sequence[str], t: tuple, x: tuple) -> DataFrame:
    """Samples inside both bounds, without the last one of each key; keys with fewer than two go.

    One pass: a window per key numbers the samples from the end.
    """
    inside = points.where(F.col("t").between(*t) & F.col("x_cents").between(*x))
    backwards = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    return inside.withColumn("_left", F.row_number().over(backwards)).where("_left > 1").drop("_left")


def summarise(points: DataFrame, *keys: str) -> DataFrame:
    """First and last time and place of each key's samples."""
    return points.groupBy(*keys).agg(
        F.min("t").alias("first_t"), F.max("t").alias("last_t"), F.min_by("x_cents", F.struct("t", "event_id")).alias("starting_x"),
        F.max_by("x_cents", F.struct("t", "event_id")).alias("ending_x"), F.count(F.lit(1)).alias("n"),
    )


def chunks(df: DataFrame, column: str, size: int) -> DataFrame:
    """Adds the number of the export chunk of `size` units that each row falls in, from the smallest value on."""
    start = df.agg(F.min(column).alias("_start"))
    return df.crossJoin(F.broadcast(start)).withColumn("chunk", F.floor((F.col(column) - F.col("_start")) / size)).drop("_start")  # one row


def size_histogram(df: DataFrame, size: Column) -> DataFrame:
    return df.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("n"))


def members(df: DataFrame, key: str, ids: str) -> DataFrame:
    """(key, member) for each element of the id list."""
    return df.select(key, F.explode(ids).alias("member"))


def without_parent(children: DataFrame, child: str, parents: DataFrame, ids: str) -> DataFrame:
    """Children that are in no parent's id list."""
    listed = parents.select(F.explode(ids).alias("member")).distinct()
    return children.join(listed, children[child] == listed["member"], "left_anti")


def with_parent(children: DataFrame, child: str, parents: DataFrame, key: str, ids: str) -> DataFrame:
    listed = members(parents, key, ids).withColumnRenamed(key, "parent")
    return children.join(listed, children[child] == listed["member"]).drop("member")


def set_fields(df: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Upsert: fields of updates replace those of equal key; new keys are added; absent fields are null."""
    fields = [c for c in updates.columns if c != key]
    old, new = df.alias("old"), updates.alias("new")
    columns = [*df.columns, *[c for c in fields if c not in df.columns]]
    pick = lambda c: F.coalesce(F.col(f"new.{c}"), F.col(f"old.{c}")) if c in df.columns and c in [key, *fields] else (F.col(f"old.{c}") if c in df.columns else F.col(f"new.{c}"))
    return old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer").select(*[pick(c).alias(c) for c in columns])


def unset_fields(df: DataFrame, *fields: str) -> DataFrame:
    return df.drop(*fields)


def push(df: DataFrame, additions: DataFrame, key: str, field: str, value: str) -> DataFrame:
    """Appends each key's added values, in order, to its array field; keys that have no row get one."""
    added = additions.groupBy(key).agg(F.sort_array(F.collect_list(value)).alias("_added"))
    old = df.select(F.col(key).alias("_key"), *[F.col(c) for c in df.columns if c != key])
    joined = old.join(added, old["_key"] == added[key], "full_outer")
    both = F.concat(F.coalesce(F.col(field), F.array().cast(dict(df.dtypes)[field])), F.coalesce("_added", F.array().cast(dict(df.dtypes)[field])))
    return joined.select(F.coalesce("_key", key).alias(key), both.alias(field), *[c for c in df.columns if c not in (key, field)])


def delete_in(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    gone = ids.select(F.col(ids.columns[0]).alias("_gone")).distinct()
    return df.join(gone, df[key] == gone["_gone"], "left_anti")


def in_common_time(a: DataFrame, b: DataFrame, time: str) -> tuple[DataFrame, DataFrame]:
    """Both tables cut to the range of time they share."""
    bounds = lambda df, p: df.agg(F.min(time).alias(f"{p}0"), F.max(time).alias(f"{p}1"))
    both = bounds(a, "a").crossJoin(bounds(b, "b")).select(F.greatest("a0", "b0").alias("_from"), F.least("a1", "b1").alias("_to"))
    cut = lambda df: df.crossJoin(F.broadcast(both)).where(F.col(time).between(F.col("_from"), F.col("_to"))).drop("_from", "_to")  # noqa: E731  one row
    return cut(a), cut(b)


def union(*tables: DataFrame) -> DataFrame:
    out = tables[0]
    for more in tables[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def in_release_order(*queues: DataFrame, by: Sequence[str] = ("last_t", "fragment_id")) -> DataFrame:
    """Several queues as one, in order of their rows' release."""
    return union(*queues).orderBy(*by)


def flat_name(df: DataFrame, column: str, prefix: str = "") -> DataFrame:
    """A struct's fields as columns named outer.inner, at any depth."""
    out, todo = [], [((column,), df.schema[column].dataType)]
    while todo:
        path, kind = todo.pop(0)
        if hasattr(kind, "fields"):
            todo = [((*path, f.name), f.dataType) for f in kind.fields] + todo
        else:
            out.append(F.col(".".join(f"`{p}`" for p in path)).alias(prefix + ".".join(path)))
    return df.select(*[c for c in df.columns if c != column], *out)


def combinations(rows: DataFrame, key: str, within: str) -> DataFrame:
    """All pairs a < b of the keys that share a value of `within`."""
    keys = rows.select(key, within).distinct()
    a, b = keys.select(F.col(key).alias("a"), within), keys.select(F.col(key).alias("b"), within)
    return a.join(b, within).where("a < b").select(within, "a", "b")
