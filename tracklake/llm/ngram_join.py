"""N-gram Jaccard join: documents whose sets of 5-word shingles are at least 0.8 alike, and their groups.

The join is exact over 64-bit shingle hashes, in these steps.

1. Every document becomes its set: size and a 128-bit sum of the members. Equal sets are one class from
   here on, whatever their number.
2. Prefix filter. With members in one global order (rare before frequent), two sets that are 0.8 alike
   share `needed` of the first size - ceil(0.8 * size) + needed members of each, where `needed` grows with the size: two
   texts with one line in common share a few members, near copies many. Members found often within
   partitions are ordered last; the order is only a matter of speed. Each map task sends one copy of each
   class, packed by bucket of the member, so a class of any number of copies costs a row per task.
3. Classes that share a prefix member form a posting, in runs of sizes that allow a link. Runs of up to LARGE_POSTING
   classes give their pairs, less those that the sizes and the places in both prefixes rule out. A pair that was given as
   often as it needs, and whose hashed parity bitmaps (a bit for a member: the number of bits in which two bitmaps differ
   bounds the overlap from above) allow a link, is tied. A larger run is cut into size-banded tiles: a band holds sizes
   within a factor 1.25, so links join classes of one band or of neighbouring bands. Large tiles are cut into blocks,
   and each pair of blocks is a task's work; within a tile the bitmaps decide, and a spanning forest is tied.
   A link that shares a member with a large run is found there, any other by its pairs; so no work is done for two classes
   only because others connect them.
4. The components of all ties are tiled in the same way, and a second pass, with the sorted arrays, intersects
   exactly what the bounds leave. Classes already known to be connected within a tile are not compared again, so a
   group of n near copies takes about n comparisons, and each pass gives the links of a spanning forest.
5. The components of the exact links, with the smallest doc_id of each, are the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import batch, byte_array, concat_ranges, cut, discard, external_id, has_columns, hash_runs, hash_spans, internal_id, lower_ascii, mix, partitions, slices, words

SHINGLE_WORDS = 5
#: Two sets link when NEED_PART * |union| <= NEED_WHOLE * |intersection|.
NEED_PART, NEED_WHOLE = 80, 100
#: Classes in a block of a large tile; a task holds two blocks.
BLOCK_CLASSES = 4096
#: Classes of a posting that are paired one by one; a larger posting is cut into tiles.
LARGE_POSTING = 16
#: A set needs one shared member more in its prefix for each so many members.
MEMBERS_A_NEED = 32
#: Members counted as frequent: seen this often in a partition, this often in all, and at most so many.
FREQUENT_IN_TASK, FREQUENT_IN_ALL, FREQUENT_MOST = 2, 6, 200_000
SENT_BYTES = 64 << 20
BUCKETS_PER_PARTITION = 4

_SETS = "id long, n_shingles long, a long, b long"
_SETS_ARROW = pa.schema([("id", pa.int64()), ("n_shingles", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])
_COUNTS_ARROW = pa.schema([("member", pa.int64()), ("times", pa.int64())])
_SENT_ARROW = pa.schema([("bucket", pa.int32()), ("postings", pa.binary())])
#: A pair of classes (u of n, v of m members, no smaller) that a bucket gave `times` times; or, with 0 times, the class u of the large run v.
_GIVEN = "u long, v long, times long, n long, m long"
_GIVEN_ARROW = pa.schema([(c, pa.int64()) for c in ("u", "v", "times", "n", "m")])
_EDGE_ARROW = pa.schema([("u", pa.int64()), ("v", pa.int64())])
_MEMBERS_ARROW = pa.schema([("node", pa.int64()), ("members", pa.binary())])


def shingle_sets(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, members, n + 1 offsets) of slices of the rows; each row's members are sorted and distinct.

    With fewer than five words, the whole sequence is the one shingle; with none, the set is empty.
    """
    data, offsets = byte_array(texts)
    for a, b in slices(offsets):
        own = lower_ascii(data[offsets[a] : offsets[b]])
        starts, ends, first = words(own, offsets[a : b + 1] - offsets[a])
        hashes = hash_spans(own, starts, ends)
        runs = hash_runs(hashes, SHINGLE_WORDS)
        members, at = [], np.zeros(b - a + 1, np.int64)
        for i in range(b - a):
            s, e = first[i], first[i + 1]
            if e - s >= SHINGLE_WORDS:
                members.append(np.unique(runs[s : e - SHINGLE_WORDS + 1]))
            elif e > s:
                members.append(mix(hash_runs(hashes[s:e], int(e - s)) + np.uint64(e - s)))
            else:
                members.append(np.zeros(0, np.uint64))
            at[i + 1] = at[i] + len(members[-1])
        yield a, np.concatenate(members), at


def _sums(members: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set; equal sets have equal sums."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(members)])
    other = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(members ^ np.uint64(0x51ED270B35AE0C11)))])
    n = np.diff(at).astype(np.uint64)
    return mix(total[at[1:]] - total[at[:-1]] + n), mix(other[at[1:]] - other[at[:-1]])


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for first, members, at in shingle_sets(b.column(1)):
            x, y = _sums(members, at)
            rest = [c.slice(first, len(at) - 1) for c in b.columns[2:]]
            schema = _SETS_ARROW.append(pa.field("row", rest[0].type)) if rest else _SETS_ARROW
            yield batch(schema, b.column(0).slice(first, len(at) - 1), np.diff(at), x.view(np.int64), y.view(np.int64), *rest)


def _distinct_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(node, members, offsets) of slices, each class once for each task as far as memory bounds allow."""
    seen: set[int] = set()
    for b in batches:
        for _, members, at in shingle_sets(b.column(1)):
            node, n = _sums(members, at)[0], np.diff(at)
            if len(seen) > 500_000:
                seen.clear()
            keep = []
            for i, x in enumerate(node.tolist()):
                if n[i] and x not in seen:
                    seen.add(x)
                    keep.append(i)
            keep = np.array(keep, np.int64)
            yield node[keep], members[concat_ranges(at[keep], n[keep])], np.concatenate([[0], np.cumsum(n[keep])]).astype(np.int64)


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members that several classes of the task hold, with their number."""
    held, size = [], 0

    def told():
        member, times = np.unique(np.concatenate(held), return_counts=True)
        often = np.flatnonzero(times >= FREQUENT_IN_TASK)
        often = often[np.argsort(-times[often], kind="stable")[:FREQUENT_MOST]]
        return batch(_COUNTS_ARROW, member[often].view(np.int64), times[often].astype(np.int64))

    for _, members, _ in _distinct_sets(batches):
        held.append(members)
        size += len(members)
        if size > 8_000_000:
            yield told()
            held, size = [], 0
    if held:
        yield told()


def prefix_length(n: np.ndarray) -> np.ndarray:
    """How many members of a set of n must be looked at: n - ceil(0.8 n) + 1."""
    return n - -(-NEED_PART * n // NEED_WHOLE) + 1


def needed(n: np.ndarray) -> np.ndarray:
    """How many members a set of n shares within the prefixes with any set that is no smaller and linked to it, at least."""
    return 1 + n // MEMBERS_A_NEED


def _prefixes(buckets: int, frequent: np.ndarray, rank: np.ndarray):
    """Sends (member, node, size and place) of each set's prefix, packed by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def sent():
            member, node, at = (np.concatenate(x) for x in zip(*held, strict=True))
            bucket = (mix(member) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            for own in np.split(order, cuts):
                body = np.concatenate([member[own], node[own], at[own]]).tobytes()
                yield batch(_SENT_ARROW, [int(bucket[own[0]])], [body])

        for node, members, at in _distinct_sets(batches):
            if not len(node):
                continue
            n = np.diff(at)
            place = np.zeros(len(members), np.int64)
            if len(frequent):
                i = np.minimum(np.searchsorted(frequent, members), len(frequent) - 1)
                place = np.where(frequent[i] == members, rank[i], 0)
            row = np.repeat(np.arange(len(n)), n)
            # Members are sorted within a row, so the rare ones are in order of hash already; frequent ones go last.
            order = np.lexsort((members, place, row)) if place.any() else np.arange(len(members))
            take = concat_ranges(at[:-1], prefix_length(n) + needed(n) - 1)
            row = row[take]
            held.append((members[order[take]], node[row], (n[row] << 32 | take - at[row]).astype(np.uint64)))
            size += 24 * len(take)
            if size > SENT_BYTES:
                yield from sent()
                held, size = [], 0
        if held:
            yield from sent()

    return run


def _postings(table: pa.Table, most: int) -> pa.Table:
    """One bucket: of the classes that hold one member, in runs whose sizes form allowed steps, the pairs, or of more than `most` the run."""
    parts = [np.frombuffer(x, np.uint64).reshape(3, -1) for x in table["postings"].to_pylist()]
    member, node, at = (np.concatenate([p[k] for p in parts]) for k in range(3))
    order = np.lexsort((node, at >> np.uint64(32), member))
    member, node, at = member[order], node[order], at[order]
    once = np.ones(len(member), bool)
    once[1:] = (member[1:] != member[:-1]) | (node[1:] != node[:-1])
    member, node, n, place = member[once], node[once].view(np.int64), (at[once] >> np.uint64(32)).astype(np.int64), (at[once] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(member), bool)
    new[1:] = (member[1:] != member[:-1]) | (NEED_PART * n[1:] > NEED_WHOLE * n[:-1])
    heads = np.flatnonzero(new)
    size = np.diff(np.append(heads, len(node)))
    run, size = np.repeat(np.arange(len(heads)), size), np.repeat(size, size)
    large = np.flatnonzero(size > most)
    name = mix(member[heads] + n[heads].astype(np.uint64)).view(np.int64)
    small = np.flatnonzero((size > 1) & (size <= most))
    pairs, first = [np.zeros((2, 0), np.int64)], np.arange(len(small))
    for step in range(1, most):
        first = first[first + step < len(small)]
        first = first[run[small[first]] == run[small[first + step]]]
        if not len(first):
            break
        u, v = small[first], small[first + step]
        both, left = n[u] + n[v], np.minimum(n[u] - place[u], n[v] - place[v]) - 1
        # What is left behind this member, and as many as are needed up to it, must be enough for a link.
        may = (NEED_PART * n[v] <= NEED_WHOLE * n[u]) & (NEED_PART * both <= (NEED_WHOLE + NEED_PART) * (needed(n[u]) + left))
        pairs.append(np.stack([u[may], v[may]]))
    u, v = np.concatenate(pairs, axis=1)
    order = np.lexsort((node[v], node[u]))
    u, v = u[order], v[order]
    new = np.ones(len(u), bool)
    new[1:] = (node[u[1:]] != node[u[:-1]]) | (node[v[1:]] != node[v[:-1]])
    heads = np.flatnonzero(new)
    times = np.diff(np.append(heads, len(u)))
    u, v, none = u[heads], v[heads], np.zeros(len(large), np.int64)
    columns = (node[u], node[large]), (node[v], name[run[large]]), (times, none), (n[u], n[large]), (n[v], none)
    return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in columns], schema=_GIVEN_ARROW)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, root: for every node of an edge, the smallest node of its connected component.

    Large-star and small-star steps in turn, each a partial and final minimum and a join whose large
    partitions Spark can split; about as many rounds as the logarithm of a component's diameter.
    The table of each round is written in the shared folder. Edges are (u, v) in any direction; loops
    are dropped.
    """
    now = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    for _ in range(rounds):
        edges_now, below = now.agg(F.count(F.lit(1)), F.count_distinct("u")).first()
        roots = now.select("v").distinct()
        if edges_now == below and now.select(F.col("u").alias("v")).join(roots, "v", "left_semi").isEmpty():
            break  # stars: every node below a root, and no root below another
        both = now.union(now.select("v", "u").toDF("u", "v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.toDF("u", "v"))
        before, now = now, cut(small.distinct())
        discard(before)
    else:
        raise RuntimeError("components did not settle")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    out = nodes.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    out.cut_path = now.cut_path
    return out


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's node and sorted members."""
    for b in batches:
        for _, members, at in shingle_sets(b.column(1)):
            body = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at * 8), pa.py_buffer(members)]).cast(pa.binary())
            yield batch(_MEMBERS_ARROW, _sums(members, at)[0].view(np.int64), body)


def _bits(n: np.ndarray) -> np.ndarray:
    """Bits of a set's bitmap: the next power of two from its size on, 64 at least and 65536 at most."""
    return np.minimum(1 << 16, 1 << np.ceil(np.log2(np.maximum(n, 64))).astype(np.int64))


def _bitmap(members: np.ndarray, bits: int) -> np.ndarray:
    """Parity bitmap: bit k tells whether an odd number of members hash to k modulo `bits`.

    The bitmap of half as many bits is the XOR of its halves.
    """
    odd = np.bincount((mix(members + np.uint64(99)) % np.uint64(bits)).astype(np.int64), minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view(np.uint64)


def _send_bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bitmap of each class, once for each task."""
    for node, members, at in _distinct_sets(batches):
        bits = _bits(np.diff(at))
        body = [_bitmap(members[at[i] : at[i + 1]], int(bits[i])).tobytes() for i in range(len(node))]
        yield batch(_MEMBERS_ARROW, node.view(np.int64), body)


def _may_link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs (u, v, n, m, bitmaps of both), with m no smaller than n, those (u, v) that the bound on the overlap allows."""
    for b in batches:
        n, m = b.column(2).to_numpy(), b.column(3).to_numpy()
        few, many, may = _bits(n), _bits(m), np.zeros(len(n), bool)
        for x, y in np.unique(np.stack([few, many]), axis=1).T.tolist():
            own = np.flatnonzero((few == x) & (many == y))
            one, other = (byte_array(c.take(pa.array(own)))[0].view(np.uint64).reshape(len(own), -1) for c in b.columns[4:])
            if y > x:  # a doubling at most, as sizes allow a link
                other = other[:, : x // 64] ^ other[:, x // 64 :]
            differ = np.bitwise_count(one ^ other).sum(axis=1, dtype=np.int64)
            may[own] = _enough(n[own] + m[own], differ)
        yield b.select([0, 1]).filter(pa.array(may))


def _enough(both: np.ndarray, differ: np.ndarray) -> np.ndarray:
    """Whether sets of `both` members together may link: |x ^ y| is at least the number of differing parity bits."""
    return (NEED_WHOLE + NEED_PART) * ((both - differ) // 2) >= NEED_PART * both


class Tile:
    """The classes of a tile in order of size, with their bitmaps and, in the exact pass, their members."""

    def __init__(self, nodes: np.ndarray, side: np.ndarray, n: np.ndarray, bitmaps: list[np.ndarray], members: list[np.ndarray] | None = None):
        order = np.lexsort((nodes, n))
        self.nodes, self.side, self.n = nodes[order], side[order], n[order]
        self.members = [members[i] for i in order] if members is not None else None
        self.bits = _bits(self.n)
        #: For each number of bits: the first class with that many, and the bitmaps of all such.
        self.level = {}
        for b in np.unique(self.bits).tolist():
            own = np.flatnonzero(self.bits == b)
            self.level[b] = (int(own[0]), np.stack([bitmaps[order[i]] for i in own]))
        self.root = np.arange(len(n))

    def close(self, i: int, rest: np.ndarray) -> np.ndarray:
        """Which of `rest` (no larger than i) may link with i. Sizes of a link differ by one doubling at most."""
        differ = np.empty(len(rest), np.int64)
        at, own = self.level[int(self.bits[i])]
        mine, same = own[i - at], self.bits[rest] == self.bits[i]
        differ[same] = np.bitwise_count(own[rest[same] - at] ^ mine).sum(axis=1, dtype=np.int64)
        if not same.all():
            at, own = self.level[int(self.bits[i]) // 2]
            half = mine[: len(mine) // 2] ^ mine[len(mine) // 2 :]
            differ[~same] = np.bitwise_count(own[rest[~same] - at] ^ half).sum(axis=1, dtype=np.int64)
        return rest[_enough(self.n[rest] + self.n[i], differ)]

    def links(self, cross: bool) -> Iterator[tuple[int, int]]:
        """A spanning forest of the links; if cross, only links between side 0 and side 1 are looked for."""
        for i in range(1, len(self.n)):
            first = int(np.searchsorted(self.n[:i], -(-NEED_PART * self.n[i] // NEED_WHOLE)))
            rest = np.arange(first, i)
            rest = rest[self.root[rest] != self.root[i]]
            if cross:
                rest = rest[self.side[rest] != self.side[i]]
            if len(rest):
                rest = self.close(i, rest)
            # Each success takes a whole known group out of the rest.
            group = self.root[rest]
            while len(rest):
                j = int(rest[-1])
                keep = np.arange(len(rest)) < len(rest) - 1
                if self.members is None or self.linked(i, j):
                    yield int(self.nodes[i]), int(self.nodes[j])
                    keep = group != group[-1]
                    self.root[self.root == group[-1]] = self.root[i]
                rest, group = rest[keep], group[keep]

    def linked(self, i: int, j: int) -> bool:
        x, y = self.members[i], self.members[j]
        if len(x) > len(y):
            x, y = y, x
        common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()) if len(x) else 0
        return NEED_WHOLE * common >= NEED_PART * (len(x) + len(y) - common)


def _forest(table: pa.Table, exact: bool) -> pa.Table:
    node, at = np.unique(table["node"].to_numpy(), return_index=True)
    body = [np.frombuffer(x, np.uint64) for x in table["members"].take(pa.array(at)).to_pylist()]
    n, side = table["n"].to_numpy()[at], table["side"].to_numpy()[at]
    bitmaps = [_bitmap(x, int(b)) for x, b in zip(body, _bits(n), strict=True)] if exact else body
    tile = Tile(node, side, n, bitmaps, body if exact else None)
    for _ in tile.links(bool(table["crossing"][0].as_py())):
        pass
    tied = tile.root != np.arange(len(tile.root))  # stars: the same components in fewer rounds
    return pa.Table.from_arrays([pa.array(tile.nodes[tied]), pa.array(tile.nodes[tile.root[tied]])], schema=_EDGE_ARROW)


def _links(classes: DataFrame, body: DataFrame, exact: bool) -> DataFrame:
    """Links (u, v) between classes (node, n, root) of one root; body: node and its bitmap, or its members if exact."""
    tiles = _dealt_to_tiles(classes).join(body, "node")
    return tiles.groupBy("root", "lo", "i", "hi", "j").applyInArrow(lambda table: _forest(table, exact), "u long, v long")


def _dealt_to_tiles(classes: DataFrame) -> DataFrame:
    """A row for each tile that a class (node, n, root) takes part in: tile keys, side, crossing.

    Small components are one tile. In the others, each band, and each two neighbouring bands, are split
    into blocks by hash of the node; every two blocks form a tile.
    """
    band = F.floor(F.log("n") / F.log(F.lit(1.25)) + 1e-9).cast("int")
    classes = classes.withColumn("band", band)
    by_band = classes.groupBy("root", "band").agg(F.count(F.lit(1)).alias("size"))
    whole = by_band.groupBy("root").agg(F.sum("size").alias("all"), F.map_from_entries(F.collect_list(F.struct("band", "size"))).alias("sizes"))
    rows = classes.join(whole, "root")
    blocks = lambda b: F.ceil(F.coalesce(F.try_element_at("sizes", b), F.lit(0)) / BLOCK_CLASSES).cast("int")
    block = F.pmod(F.xxhash64("node"), F.greatest(blocks(F.col("band")), F.lit(1))).cast("int")
    tile = lambda lo, i, hi, j, side, crossing: F.struct(lo.alias("lo"), i.alias("i"), hi.alias("hi"), j.alias("j"), F.lit(side).alias("side"), crossing.alias("crossing"))
    none, no, yes = F.lit(-1), F.lit(False), F.lit(True)
    b, k = F.col("band"), F.col("block")
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    tiles = F.when(F.col("all") <= BLOCK_CLASSES, F.array(tile(none, none, none, none, 0, no))).otherwise(
        F.concat(
            F.transform(upto(blocks(b)), lambda j: F.when(j >= k, tile(b, k, b, j, 0, j != k)).otherwise(tile(b, j, b, k, 1, yes))),
            F.transform(upto(blocks(b + 1)), lambda j: tile(b, k, b + 1, j, 0, yes)),
            F.transform(upto(blocks(b - 1)), lambda j: tile(b - 1, j, b, k, 1, yes)),
        )
    )
    rows = rows.withColumn("block", block).withColumn("tile", F.explode(tiles))
    return rows.select("node", "n", "root", "tile.*")


def near_groups(docs: DataFrame, key: str | None = None) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id; and `key` and kept, if a key column is named.

    Words are compared after lower-casing A-Z. Null or wordless text has an empty set and is linked with
    nothing, not even another empty one. A null doc_id counts as smaller than any other, so the
    component_id of a group that holds one is null. Rows that repeat a doc_id are linked like any others.
    Texts of any length are taken whole; an empty table gives no rows; other columns are ignored, whatever their names. A
    key is a value that tells a row wherever docs is read again, and can be put in order; kept is true for one row of
    each group, that of the smallest (doc_id, key).
    """
    has_columns(docs, "doc_id", "text")
    spark = docs.sparkSession
    rows = docs.select(internal_id().alias("id"), "text", *([F.col(key).alias("row")] if key else []))
    own, told = (F.struct("id", "row"), "row") if key else (F.col("id"), "id")  # what names a row
    sets = cut(rows.mapInArrow(_describe, StructType([*StructType.fromDDL(_SETS), *rows.schema[2:]])))
    classes = sets.where("n_shingles > 0").groupBy("a", "b", F.col("n_shingles").alias("n")).agg(F.min(own).alias("least"))
    classes = cut(classes.select(F.col("a").alias("node"), "n", "least"))

    counts = rows.mapInArrow(_frequent, "member long, times long").groupBy("member").agg(F.sum("times").alias("times"))
    often = counts.where(F.col("times") >= FREQUENT_IN_ALL).orderBy(F.desc("times"), "member").limit(FREQUENT_MOST).toArrow()
    frequent = often["member"].to_numpy().view(np.uint64)
    order = np.argsort(frequent)

    buckets = BUCKETS_PER_PARTITION * partitions(spark)
    sent = rows.mapInArrow(_prefixes(buckets, frequent[order], often["times"].to_numpy()[order]), "bucket int, postings binary")
    most = LARGE_POSTING
    given = cut(sent.groupBy("bucket").applyInArrow(lambda table: _postings(table, most), _GIVEN))
    pairs = given.where("times > 0").groupBy("u", "v", "n", "m").agg(F.sum("times").alias("times"))
    pairs = cut(pairs.where(F.col("times") >= 1 + F.floor(F.col("n") / MEMBERS_A_NEED)).select("u", "v", "n", "m"))
    large = given.where("times = 0").select(F.col("u").alias("node"), "n", F.col("v").alias("root"))

    def texts(nodes: DataFrame) -> DataFrame:
        """A row or more of each class."""
        least = classes.join(nodes, "node", "left_semi").select(F.col("least.row" if key else "least").alias(told)).distinct()
        return rows.join(least, told, "left_semi").select("id", "text")

    nodes = large.select("node").union(pairs.select("u")).union(pairs.select("v"))
    bitmaps = cut(texts(nodes).mapInArrow(_send_bitmaps, "node long, members binary"))
    near = pairs.join(bitmaps.select(F.col("node").alias("u"), F.col("members").alias("one")), "u")
    near = near.join(bitmaps.select(F.col("node").alias("v"), F.col("members").alias("other")), "v")
    near = near.select("u", "v", "n", "m", "one", "other").mapInArrow(_may_link, "u long, v long")
    alike = components(near.union(_links(large, bitmaps, exact=False)))
    for table in (given, pairs, bitmaps):
        discard(table)

    work = cut(classes.join(alike, "node"))
    discard(alike)
    members = texts(work).mapInArrow(_members, "node long, members binary")
    links = _links(work, members, exact=True)

    joined = components(links)
    discard(work)
    grouped = classes.join(joined, "node", "left").select("node", "n", "least", F.coalesce("root", "node").alias("root"))
    smallest = grouped.groupBy("root").agg(F.min("least").alias("component"))
    by_class = grouped.join(smallest, "root").select(F.col("node").alias("a"), F.col("n").alias("n_shingles"), "component")
    out = sets.join(by_class, ["a", "n_shingles"], "left")
    component = F.coalesce("component", own)
    least = component["id"] if key else component
    more = [F.col("row").alias(key), (F.col("row") == component["row"]).alias("kept")] if key else []
    return out.select(external_id(F.col("id")).alias("doc_id"), "n_shingles", external_id(least).alias("component_id"), *more)


ORACLE = r"""
with recursive w as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
sh as (
  select distinct doc_id, unnest(case
    when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from w),
n as (select doc_id, count(*) as n from sh group by doc_id),
c as (select a.doc_id as x, b.doc_id as y, count(*) as c from sh a join sh b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
l as (select x, y from c join n a on a.doc_id = x join n b on b.doc_id = y where 100 * c >= 80 * (a.n + b.n - c)),
r as (select doc_id as x, doc_id as y from w union select r.x, l.y from r join l on r.y = l.x)
select w.doc_id, coalesce(n.n, 0) as n_shingles, m.component_id
from w left join n using (doc_id) join (select x as doc_id, min(y) as component_id from r group by x) m using (doc_id)
"""
