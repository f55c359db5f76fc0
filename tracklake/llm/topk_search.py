"""Exact top-k inner-product search with an impact-ordered, score-at-a-time index.

Vectors are scaled to integers. The postings of a block of rows are segments by (dimension, level): the rows whose
component there has a magnitude of that power of sixteen. A query's components have levels too, and the impact of a
segment is quantised to the sum of both, counted down from the largest there can be. Segments are processed by
descending impact, a tier at a time and for many queries at once; each adds its part to its rows' scores. What
is not processed yet of a row is bounded by the norms of what is left (Cauchy and Schwarz, level by level). A query
stops only on proof: when at most as many rows as are worth rescoring can still reach the k-th best lower bound.
Those rows, ties included, get their exact integer score.

Rows are dealt into blocks once, and each block's index is built once; the queries stream through it in batches:
the stated queries against all rows, in blocks. A task holds one block and one batch, whatever the size of the
table. Each block hands on k rows per query, which a window with a group limit reduces to k.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, has_columns, partitions, trim

#: Rows of a block (at most, and at least where there are tasks without a block), and queries of a batch.
BLOCK_ROWS, LEAST_ROWS, QUERY_ROWS = 32768, 4096, 64
#: No finite component is too large. Rows and queries with one of INDEXED and more are scored by whole numbers of any size.
LARGEST, INDEXED = math.inf, 2.0**18
#: Scores and bounds of the index are exact in a double while no sum can reach this.
PACKED = 2.0**50
#: Bits of a level: a magnitude's level is its power of 2 ** LEVEL_BITS.
LEVEL_BITS = 4
#: Segments whose impact is at most TIERS[0] levels below the largest are processed first, and so on; behind the last tier
#: nothing is left.
TIERS = (1, 2, 1 << 20)
#: A query is proved once at most this share of the block could be members (or four times as many as asked for).
RESCORE_SHARE = 0.05
#: A score that leaves 64 bits is null; size (its bytes, with its sign) and digits then tell its place.
_SCHEMA = "query_id long, vec_id long, score long, size int, digits binary"
_ARROW = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("size", pa.int32()), ("digits", pa.binary())])


def _levels(x: np.ndarray) -> np.ndarray:
    """The level of each magnitude, -1 for 0."""
    return (np.frexp(np.abs(x))[1].astype(np.int16) - 1) // LEVEL_BITS


class BlockIndex:
    """Posting segments of one block of integer vectors, as the levels of all components, with the norms of what lies below a level."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors.astype(float)
        self.level = _levels(self.vectors)
        self.top = int(self.level.max(initial=-1))
        squares = np.zeros((self.top + 2, len(vectors)))
        for b in range(self.top + 1):
            squares[b + 1] = squares[b] + np.where(self.level == b, self.vectors * self.vectors, 0.0).sum(axis=1)
        #: below[b]: each row's norm over its components of lower levels than b.
        self.below = np.sqrt(squares)

    def segments(self, low: int, high: int) -> np.ndarray:
        """The components of the levels low .. high - 1, zero elsewhere."""
        return np.where((self.level >= low) & (self.level < high), self.vectors, 0.0)

    def search(self, queries: np.ndarray, k: int, live: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query rows of live[query] (the k best, their ties and perhaps more) and their exact scores."""
        queries = queries.astype(float)
        most = _levels(queries).max(axis=1, keepdims=True, initial=-1)
        down = most - _levels(queries)  # 0 for a query's largest components
        out: list = [None] * len(queries)
        todo, score, before = np.arange(len(queries)), np.zeros((len(queries), len(self.vectors))), -1
        for tier in TIERS:
            rest = np.zeros_like(score)
            for a in range(int(down[todo].max(initial=0)) + 1):
                own = np.where(down[todo] == a, queries[todo], 0.0)
                if not own.any():
                    continue
                # Of the row's levels, counted down from the top, those up to tier - a are processed now.
                low, high = max(0, self.top - tier + a), max(0, min(self.top + 1, self.top - before + a)) if before >= 0 else self.top + 1
                if low < high:
                    score += own @ self.segments(low, high).T
                low = min(low, self.top + 1)
                if low:
                    rest += np.linalg.norm(own, axis=1)[:, None] * self.below[low]
            rest = np.where(rest > 0, rest * (1 + 1e-9) + 1, 0.0)  # more than any rounding
            own_live = live[todo]
            lower = np.where(own_live, score - rest, -np.inf)
            kth = np.partition(lower, -k, axis=1)[:, -k] if lower.shape[1] > k else np.full(len(todo), -np.inf)
            possible = own_live & (score + rest >= kth[:, None])
            proved = (possible.sum(axis=1) <= max(4 * k, RESCORE_SHARE * len(self.vectors))) | (tier == TIERS[-1])
            for i in np.flatnonzero(proved).tolist():
                rows = np.flatnonzero(possible[i])
                out[todo[i]] = rows, (self.vectors[rows] @ queries[todo[i]]).astype(np.int64)
            todo, score, before = todo[~proved], score[~proved], tier
            if not len(todo):
                break
        return out


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of lists as one matrix; shorter rows are padded with zeros."""
    own = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(own.offsets.to_numpy())
    out = np.zeros((len(lengths), int(lengths.max(initial=0))))
    flat = own.flatten().to_numpy(zero_copy_only=False)
    out[np.arange(out.shape[1]) < lengths[:, None]] = flat
    return out


def _whole(x: np.ndarray) -> np.ndarray:
    """floor(256 * x) of any finite x, as Python integers."""
    out = np.empty(x.shape, object)
    for at, v in np.ndenumerate(x):
        out[at] = math.floor(256.0 * v) if abs(v) < 2.0**1000 else 256 * int(v)
    return out


def _place(score: int) -> tuple[int | None, int, bytes | None]:
    """score, size and digits: scores are in order of (size, digits, score)."""
    if -(1 << 63) <= score < 1 << 63:
        return score, 0, None
    size = (score.bit_length() + 7) // 8
    digits = (score if score > 0 else (1 << 8 * size) + score).to_bytes(size, "big")
    return None, size if score > 0 else -size, digits


class Block:
    """The rows of a block: indexed, or those with a component of INDEXED and more as whole numbers."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, k: int):
        usual = (np.abs(rows) < INDEXED).all(axis=1)
        self.k, self.ids, self.width = k, ids[usual], rows.shape[1]
        self.whole = np.floor(256.0 * rows[usual])
        self.wide, self.wide_ids = _whole(rows[~usual]), ids[~usual]
        self.index = BlockIndex(self.whole) if len(self.ids) else None
        self.peak = np.abs(self.whole).max(axis=0, initial=0) + 1

    def best(self, wanted: np.ndarray, asked: np.ndarray) -> Iterator[tuple]:
        """(query, vec_id, score, size, digits) of the k best rows for each query."""
        width = max(self.width, asked.shape[1])
        if width > self.width:  # longer queries than rows: what is beyond meets zeros
            asked = asked[:, : self.width]
        asked = np.pad(asked, ((0, 0), (0, self.width - asked.shape[1])))
        near = (np.abs(asked) < INDEXED).all(axis=1)
        reach = np.where(near, np.abs(np.floor(256.0 * np.where(near[:, None], asked, 0.0))) @ self.peak, np.inf)
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        easy = np.flatnonzero(reach < PACKED)
        if self.index is not None and len(easy):
            live = self.ids != wanted[easy, None]
            found = dict(zip(easy.tolist(), self.index.search(np.floor(256.0 * asked[easy]), self.k, live), strict=True))
        for i, (query, vector) in enumerate(zip(wanted.tolist(), asked, strict=True)):
            if i in found:
                rows, score = found[i]
            else:
                rows = np.flatnonzero(self.ids != query)
                if reach[i] < 2.0**62:
                    score = self.whole[rows].astype(np.int64) @ np.floor(256.0 * vector).astype(np.int64)
                else:
                    score = self.whole[rows].astype(np.int64).astype(object) @ _whole(vector)
            order = np.lexsort((self.ids[rows], -score))[: self.k] if score.dtype != object else sorted(range(len(rows)), key=lambda r: (-score[r], self.ids[rows[r]]))[: self.k]
            own = [(int(score[r]), int(self.ids[rows[r]])) for r in order]
            if len(self.wide_ids):
                other = np.flatnonzero(self.wide_ids != query)
                own += zip((self.wide[other] @ _whole(vector)).tolist(), self.wide_ids[other].tolist(), strict=True)
                own = sorted(own, key=lambda x: (-x[0], x[1]))[: self.k]
            for value, row in own:
                yield (query, row, *_place(value))


def _searcher(k: int):
    """Batches of (block, asked, vec_id, vector), in order of block, a block's rows (asked 0) before its queries (1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, block = None, [], None
        for b in batches:
            for part in _runs(b):
                number, asked = part.column(0)[0].as_py(), part.column(1)[0].as_py()
                if number != now:
                    now, held, block = number, [], None
                    trim()
                if not asked:
                    held.append(part)
                elif held or block is not None:
                    if block is None:
                        rows = pa.Table.from_batches(held)
                        block, held = Block(rows["vec_id"].to_numpy(), _matrix(rows["vector"]), k), []
                    for a in range(0, len(part), QUERY_ROWS):
                        own = part.slice(a, QUERY_ROWS)
                        out = list(block.best(own.column(2).to_numpy(), _matrix(own.column(3))))
                        if out:
                            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), _ARROW, strict=True)], schema=_ARROW)

    return run


def _runs(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The parts of a batch with one block and one kind of row each."""
    block, asked = (b.column(i).to_numpy() for i in range(2))
    cuts = [0, *(np.flatnonzero((np.diff(block) != 0) | (np.diff(asked) != 0)) + 1).tolist(), len(b)]
    for a, z in zip(cuts[:-1], cuts[1:], strict=True):
        if z > a:
            yield b.slice(a, z - a)


def finite_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id and the components, for the rows that take part; equal rows once."""
    # A null, NaN or infinite component fails the test.
    usable = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < LARGEST, F.lit(False)))
    rows = embeddings.where("vec_id is not null and embedding is not null").where(usable)
    return rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector")).distinct()


def top_k(embeddings: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """The k rows of highest score for each row whose vec_id is divisible by `every`.

    query_id, rank from 1, vec_id, score; fewer than k where there are fewer rows; ties go to the
    smaller vec_id; a query is no answer to itself. Rows without vec_id, and vectors that are null or
    hold a null or non-finite component, take no part. Rows that repeat a vec_id with another vector each take
    part, but are no answer to one another; equal rows are one. Shorter vectors are as if padded with zeros. Ranks are by the exact score; one that
    leaves 64 bits is null in the result. An empty table gives no rows; other columns are ignored.
    """
    has_columns(embeddings, "vec_id", "embedding")
    vectors = cut(finite_vectors(embeddings))
    n = vectors.count()
    tasks = partitions(embeddings.sparkSession)
    blocks = max(1, -(-n // BLOCK_ROWS), min(tasks, -(-n // LEAST_ROWS)))
    rows = vectors.select(F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).alias("block"), F.lit(0).alias("asked"), "vec_id", "vector")
    queries = vectors.where(F.col("vec_id") % every == 0).select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), F.lit(1).alias("asked"), "vec_id", "vector")
    dealt = rows.unionByName(queries).repartition(max(tasks, blocks), "block").sortWithinPartitions("block", "asked")
    found = dealt.mapInArrow(_searcher(k), _SCHEMA)
    best = Window.partitionBy("query_id").orderBy(F.desc("size"), F.desc("digits"), F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


ORACLE = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and not list_contains(list_transform(embedding, lambda x: coalesce(isfinite(x), false)), false)),
s as (
  select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.v, c.v) as bigint) as score
  from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id)
select query_id, cast(rank as integer) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) r
where rank <= 5
"""
