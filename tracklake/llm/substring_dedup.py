"""Exact repeated-passage removal by super-k-mer partitioning.

A window is WINDOW consecutive words. Its minimiser is the first of the runs of MINIMISER_WORDS words in it, in
one order of all runs: by hash, but the frequent ones behind all others, the most frequent last, so that no
common phrase draws the windows around it to one bucket. Consecutive windows with one minimiser form a
super-k-mer, which travels once, as one packed string of words, to the bucket of that minimiser. Equal windows
have equal minimisers, so all copies of a window meet in one bucket, where windows are sorted and the smallest
doc_id of each is found. Words are compared as words: hashes only order them, and every run of equal hashes is
checked word by word. The order of the runs is a matter of balance alone; no result depends on it.

Documents are dealt into chunks by id, packed and compressed. A chunk sends each distinct super-k-mer
once, with the smallest and largest doc_id that holds it, so a passage in a third of all documents reaches
its bucket as one row per chunk. The bucket answers to the chunk, not to the document: for the windows that some document of
the chunk must give up, the smallest doc_id. Each chunk then cuts its own documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import NO_ID, SLICE_BYTES, batch, byte_array, concat_ranges, has_columns, hash_runs, hash_spans, internal_id, mix, partitions, slices, trim, words

WINDOW = 13
MINIMISER_WORDS = 2
#: Bytes of text in a chunk; a chunk is what one task holds.
CHUNK_BYTES = 8 << 20
#: Bytes of packed strings in a bucket, about, and buckets for each shuffle partition at least; a bucket is what one
#: reducer holds at a time. Packed strings are about SENT_SHARE times the text.
BUCKET_BYTES, BUCKETS_PER_PARTITION, SENT_SHARE = 16 << 20, 4, 3
#: Runs counted as frequent: seen this often in one count of COUNTED runs, and at most so many in one and in all.
FREQUENT_IN_COUNT, FREQUENT_MOST, COUNTED = 8, 65_536, 2_000_000
#: Words of a bucket that are worked on together, about, and windows whose hashes are.
PART_WORDS, HASHED = 1 << 19, 1 << 18

_RUNS_ARROW = pa.schema([("run", pa.int64()), ("times", pa.int64())])
_DEALT_ARROW = pa.schema([("chunk", pa.int64()), ("docs", pa.binary())])
_SENT = "bucket int, chunk long, strings binary"
_SENT_ARROW = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("strings", pa.binary())])
_ANSWER = "chunk long, windows binary"
_ANSWER_ARROW = pa.schema([("chunk", pa.int64()), ("windows", pa.binary())])
_RESULT = "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string"
_RESULT_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string()), ("kept_sha256", pa.string())])


def _packed(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(a.nbytes for a in arrays)], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(a.tobytes() for a in arrays))


def _unpacked(data: bytes, *kinds) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    sizes = np.frombuffer(raw, np.int64, 1 + len(kinds))[1:]
    at, out = 8 * (1 + len(kinds)), []
    for kind, size in zip(kinds, sizes, strict=True):
        out.append(np.frombuffer(raw, kind, int(size) // np.dtype(kind).itemsize, at))
        at += int(size)
    return out


class Chunk:
    """The documents of a chunk: their words, and their distinct super-k-mers in a fixed order.

    Documents are ordered by (id, text), so the same rows give the same numbers each time.
    """

    def __init__(self, ids: np.ndarray, texts: pa.Array, carried: pa.Array | None = None, frequent: np.ndarray | None = None, rank: np.ndarray | None = None):
        self.frequent, self.rank = frequent if frequent is not None else np.zeros(0, np.uint64), rank
        data, offsets = byte_array(texts)
        order = sorted(range(len(ids)), key=lambda i: (ids[i], data[offsets[i] : offsets[i + 1]].tobytes()))
        self.order = np.array(order, np.int64)
        lengths = np.diff(offsets)[self.order] if len(order) else np.zeros(0, np.int64)
        self.data = np.concatenate([data[offsets[i] : offsets[i + 1]] for i in order]) if len(order) else data
        del data
        self.offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        self.ids = np.asarray(ids, np.int64)[self.order]
        self.carried = carried.take(pa.array(self.order)) if carried is not None else None
        starts, ends, first = [], [], [np.zeros(1, np.int64)]
        spans = ([], [], [], [], [])  # hash, bucket hash, first word, number of words, document
        base, place = 0, np.int32 if len(self.data) < 1 << 31 else np.int64
        for a, b in slices(self.offsets):
            at = self.offsets[a]
            own = self.data[at : self.offsets[b]]
            s, e, f = words(own, self.offsets[a : b + 1] - at)
            for out, x in zip(spans, self._super_kmers(own, s, e, f), strict=True):
                out.append(x)
            spans[2][-1] = spans[2][-1] + base
            spans[4][-1] = spans[4][-1] + a
            starts.append((s + at).astype(place))
            ends.append((e + at).astype(place))
            first.append(f[1:] + base)
            base += len(s)
        join = lambda xs, kind: np.concatenate(xs) if xs else np.zeros(0, kind)
        self.starts, self.ends, self.first = join(starts, place), join(ends, place), np.concatenate(first)
        key, self.minimiser, self.word, self.count, self.doc = (join(x, k) for x, k in zip(spans, (np.uint64, np.uint64, np.int64, np.int64, np.int64), strict=True))
        self._distinct(key)

    def _in_order(self, runs: np.ndarray) -> np.ndarray:
        """The place of each run in the order that minimisers are taken by."""
        out = runs >> np.uint64(1)
        if len(self.frequent):
            i = np.minimum(np.searchsorted(self.frequent, runs), len(self.frequent) - 1)
            hit = self.frequent[i] == runs
            out[hit] = np.uint64(1 << 63) + self.rank[i[hit]]
        return out

    def _super_kmers(self, data, starts, ends, first):
        """For the runs of windows with one minimiser: string hash, minimiser, first word, words, row."""
        kinds = (np.uint64, np.uint64, np.int64, np.int64, np.int64)
        if len(starts) < WINDOW:
            return [np.zeros(0, k) for k in kinds]
        hashes = hash_spans(data, starts, ends)
        runs = self._in_order(hash_runs(hashes, MINIMISER_WORDS))
        n = len(starts) - WINDOW + 1
        row = np.searchsorted(first, np.arange(len(starts)), "right") - 1
        whole = row[:n] == row[WINDOW - 1 :]
        least = runs[:n].copy()
        for k in range(1, WINDOW - MINIMISER_WORDS + 1):
            np.minimum(least, runs[k : k + n], out=least)
        at = np.flatnonzero(whole)
        if not len(at):
            return [np.zeros(0, k) for k in kinds]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (least[at[1:]] != least[at[:-1]]) | (row[at[1:]] != row[at[:-1]])
        head = at[new]
        length = np.diff(np.append(np.flatnonzero(new), len(at))) + WINDOW - 1
        # A string hash over its word hashes, by prefix sums of position-weighted words.
        up = np.full(len(hashes) + 1, 0x9E3779B97F4A7C15, np.uint64)
        up[0] = 1
        up = np.multiply.accumulate(up)
        down = np.full(len(hashes) + 1, pow(0x9E3779B97F4A7C15, -1, 1 << 64), np.uint64)
        down[0] = 1
        down = np.multiply.accumulate(down)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[:-1])])
        key = (total[head + length] - total[head]) * down[head] + length.astype(np.uint64)
        return [key, least[head], head, length, row[head]]

    def _distinct(self, key: np.ndarray) -> None:
        """Gives equal strings one number; equal hashes are checked word by word."""
        order = np.lexsort((self.word, key, self.minimiser))
        k, m = key[order], self.minimiser[order]
        new = np.ones(len(order), bool)
        new[1:] = (k[1:] != k[:-1]) | (m[1:] != m[:-1])
        again = np.flatnonzero(~new)
        new[again] = ~self._equal(order[again], order[again - 1])
        self.string = np.zeros(len(order), np.int64)
        self.string[order] = np.cumsum(new) - 1
        heads = np.flatnonzero(new)
        self.sample = order[heads]  # a super-k-mer of each string; strings are in order of minimiser
        ids = self.ids[self.doc[order]]
        self.low = np.minimum.reduceat(ids, heads) if len(heads) else np.zeros(0, np.int64)
        self.high = np.maximum.reduceat(ids, heads) if len(heads) else np.zeros(0, np.int64)

    def _equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether super-k-mers a[i] and b[i] are the same words (the cheap tests first)."""
        same = self.count[a] == self.count[b]
        for k in range(int(self.count.max(initial=0))):
            i = np.flatnonzero(same & (self.count[a] > k))
            if not len(i):
                break
            x, y = self.word[a[i]] + k, self.word[b[i]] + k
            nx, ny = self.ends[x] - self.starts[x], self.ends[y] - self.starts[y]
            same[i] &= nx == ny
            i, x, y, nx = i[nx == ny], x[nx == ny], y[nx == ny], nx[nx == ny]
            if len(i):
                bytes_x, bytes_y = self.data[concat_ranges(self.starts[x], nx)], self.data[concat_ranges(self.starts[y], nx)]
                same[i] &= np.logical_and.reduceat(bytes_x == bytes_y, np.concatenate([[0], np.cumsum(nx)[:-1]]))
        return same

    def send(self, buckets: int) -> Iterator[tuple[int, bytes]]:
        """For each bucket, the distinct strings that belong to it."""
        if not len(self.sample):
            return
        bucket = (mix(self.minimiser[self.sample]) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        for own in np.split(order, cuts):
            sample = self.sample[own]
            at = concat_ranges(self.word[sample], self.count[sample])
            n = self.ends[at] - self.starts[at]
            text = np.full(int((n + 1).sum()), 32, np.uint8)
            text[concat_ranges(np.concatenate([[0], np.cumsum(n + 1)[:-1]]), n)] = self.data[concat_ranges(self.starts[at], n)]
            part = (mix(self.minimiser[sample]) >> np.uint64(56)).astype(np.uint8)
            yield int(bucket[own[0]]), _packed(own, self.count[sample].astype(np.int32), self.low[own], self.high[own], part, text)

    def removed(self, string: np.ndarray, offset: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Which words go, given the windows (string, offset in it) and the smallest doc_id of each."""
        gone = np.zeros(len(self.starts) + 1, np.int32)
        if len(string):
            order = np.argsort(string, kind="stable")
            string, offset, least = string[order], offset[order], least[order]
            a, b = np.searchsorted(string, self.string, "left"), np.searchsorted(string, self.string, "right")
            at = concat_ranges(a, b - a)
            own = np.repeat(np.arange(len(self.string)), b - a)
            hit = least[at] < self.ids[self.doc[own]]
            head = self.word[own[hit]] + offset[at[hit]]
            np.add.at(gone, head, 1)
            np.add.at(gone, head + WINDOW, -1)
        return np.cumsum(gone[:-1]) > 0

    def kept(self, gone: np.ndarray) -> pa.Table:
        n = self.ends - self.starts
        total = np.diff(self.first)
        lost = np.diff(np.concatenate([[0], np.cumsum(gone)])[self.first])
        texts = []
        for i in range(len(self.ids)):
            own = np.arange(self.first[i], self.first[i + 1])
            if not lost[i]:
                own_text = b" ".join(self.data[self.offsets[i] : self.offsets[i + 1]].tobytes().translate(_SPACES).split(b" ")) if total[i] else b""
                texts.append(_SQUEEZE(own_text))
                continue
            own = own[~gone[own]]
            text = np.full(int((n[own] + 1).sum()), 32, np.uint8)
            text[concat_ranges(np.concatenate([[0], np.cumsum(n[own] + 1)[:-1]]), n[own])] = self.data[concat_ranges(self.starts[own], n[own])]
            texts.append(text[:-1].tobytes() if len(own) else b"")
        ids = pa.array(self.ids, pa.int64(), mask=self.ids == NO_ID)
        shas = [hashlib.sha256(t).hexdigest() for t in texts]
        columns, schema = [ids, pa.array(total), pa.array(lost), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(shas)], _RESULT_ARROW
        if self.carried is not None:
            whole = [t if gone_words else self.data[a:b].tobytes() for t, gone_words, a, b in zip(texts, lost, self.offsets[:-1], self.offsets[1:], strict=True)]
            columns += [pa.array(whole, pa.binary()).cast(pa.string()), self.carried]
            schema = schema.append(pa.field("new_text", pa.string())).append(pa.field("carried", self.carried.type))
        return pa.Table.from_arrays(columns, schema=schema)


_SPACES = bytes.maketrans(b"\t\n\v\f\r", b"     ")


def _SQUEEZE(text: bytes) -> bytes:  # noqa: N802
    return b" ".join(w for w in text.split(b" ") if w)


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packs rows (chunk, id, text, and what is carried) of one chunk that come in one batch."""
    for b in batches:
        chunk, ids = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
        data, offsets = byte_array(b.column(2))
        order = np.argsort(chunk, kind="stable")
        numbers, packed = [], []
        for own in np.split(order, np.flatnonzero(np.diff(chunk[order])) + 1):
            if len(own):
                n = offsets[own + 1] - offsets[own]
                numbers.append(int(chunk[own[0]]))
                packed.append(_packed(ids[own], n, data[concat_ranges(offsets[own], n)], _written([c.take(pa.array(own)) for c in b.columns[3:]])))
        yield batch(_DEALT_ARROW, numbers, packed)


def _written(columns: list[pa.Array]) -> np.ndarray:
    """Columns as the bytes of an Arrow stream; none: no bytes."""
    if not columns:
        return np.zeros(0, np.uint8)
    sink = pa.BufferOutputStream()
    own = pa.RecordBatch.from_arrays(columns, [str(k) for k in range(len(columns))])
    with pa.ipc.new_stream(sink, own.schema) as stream:
        stream.write_batch(own)
    return np.frombuffer(sink.getvalue(), np.uint8)


def _chunk(packed: list[bytes], frequent: np.ndarray, rank: np.ndarray) -> Chunk:
    parts = [_unpacked(x, np.int64, np.int64, np.uint8, np.uint8) for x in packed]
    carried = [pa.ipc.open_stream(pa.py_buffer(p[3])).read_all().column(0).combine_chunks() for p in parts if len(p[3])]
    ids, n, data = (np.concatenate([p[k] for p in parts]) for k in range(3))
    offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
    del parts
    texts = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return Chunk(ids, texts, pa.concat_arrays(carried) if carried else None, frequent, rank)


def _chunks(batches: Iterator[pa.RecordBatch], frequent: np.ndarray, rank: np.ndarray) -> Iterator[tuple[int, Chunk]]:
    """Rows arrive in order of chunk; a chunk is complete when the next one begins."""
    held: list[bytes] = []
    now = None
    for b in batches:
        for number, packed in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            if held and number != now:
                yield now, _chunk(held, frequent, rank)
                held = []
            now = number
            held.append(packed.as_py())
    if held:
        yield now, _chunk(held, frequent, rank)


def _send(buckets: int, frequent: np.ndarray, rank: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, chunk in _chunks(batches, frequent, rank):
            held, size = [], 0
            for own in chunk.send(buckets):
                held.append(own)
                size += len(own[1])
                if size > SLICE_BYTES:
                    yield batch(_SENT_ARROW, [b for b, _ in held], [number] * len(held), [x for _, x in held])
                    held, size = [], 0
            if held:
                yield batch(_SENT_ARROW, [b for b, _ in held], [number] * len(held), [x for _, x in held])
            del chunk, held
            trim()

    return run


def _often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of words that come often among COUNTED runs, with their number."""
    held, size = [], 0

    def told():
        run, times = np.unique(np.concatenate(held), return_counts=True)
        often = np.flatnonzero(times >= FREQUENT_IN_COUNT)
        often = often[np.argsort(-times[often], kind="stable")[:FREQUENT_MOST]]
        return batch(_RUNS_ARROW, run[often].view(np.int64), times[often].astype(np.int64))

    for b in batches:
        data, offsets = byte_array(b.column(0))
        for a, z in slices(offsets):
            own = data[offsets[a] : offsets[z]]
            starts, ends, _ = words(own, offsets[a : z + 1] - offsets[a])
            held.append(hash_runs(hash_spans(own, starts, ends), MINIMISER_WORDS))
            size += len(held[-1])
            if size > COUNTED:
                yield told()
                held, size = [], 0
    if held:
        yield told()


def frequent_runs(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the most frequent runs of MINIMISER_WORDS words of all texts, in order, and the rank of each, the rarest
    first; FREQUENT_MOST at most. Runs that cross from one document into the next are counted with them."""
    counts = docs.select("text").mapInArrow(_often, "run long, times long").groupBy("run").agg(F.sum("times").alias("times"))
    often = counts.orderBy(F.desc("times"), "run").limit(FREQUENT_MOST).toArrow()
    run, rank = often["run"].to_numpy().view(np.uint64), np.arange(often.num_rows)[::-1].astype(np.uint64)
    order = np.argsort(run)
    return run[order], rank[order]


def _window_minima(table: pa.Table) -> pa.Table:
    """One bucket: the smallest doc_id of every window that some chunk has to hear about.

    A large bucket is worked on in parts, by the top bits of the minimisers.
    """
    rows = [_unpacked(x.as_py(), np.int64, np.int32, np.int64, np.int64, np.uint8, np.uint8) for x in table["strings"]]
    chunk = np.repeat(table["chunk"].to_numpy(), [len(r[0]) for r in rows])
    string, count, low, high, part = (np.concatenate([r[k] for r in rows]) for k in range(5))
    text = np.concatenate([r[5] for r in rows])
    del table, rows
    parts = 1 << min(8, int(count.sum() // PART_WORDS).bit_length())
    part = part.astype(np.int64) * parts >> 8
    told: list[tuple[np.ndarray, ...]] = []
    if parts == 1:
        told.append(_told(count, low, high, text))
    else:
        size = np.diff(np.flatnonzero(text == 32)[np.cumsum(count) - 1] + 1, prepend=0)
        start = np.cumsum(size) - size
        for k in range(parts):
            own = np.flatnonzero(part == k)
            if len(own):
                found, offset, least = _told(count[own], low[own], high[own], text[concat_ranges(start[own], size[own])])
                told.append((own[found], offset, least))
    own, offset, least = (np.concatenate(x) for x in zip(*told, strict=True))
    del text, told
    back = np.argsort(chunk[own], kind="stable")
    cuts = np.flatnonzero(np.diff(chunk[own][back])) + 1
    answers = [(int(chunk[own[i[0]]]), _packed(string[own[i]], offset[i], least[i])) for i in np.split(back, cuts) if len(i)]
    out = pa.Table.from_arrays([pa.array([a for a, _ in answers], pa.int64()), pa.array([b for _, b in answers], pa.binary())], schema=_ANSWER_ARROW)
    trim()
    return out


def _told(count: np.ndarray, low: np.ndarray, high: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, offset in it, smallest doc_id) of every window of some strings that is in a larger document of its chunk too."""
    codes = _codes(text)
    del text
    first = np.cumsum(count, dtype=np.int64) - count
    windows = count.astype(np.int64) - WINDOW + 1
    place = np.int32 if len(codes) < 1 << 31 else np.int64
    at = concat_ranges(first, windows).astype(place)  # first word of each window
    own = np.repeat(np.arange(len(count), dtype=place), windows)
    order, group = _equal_windows(codes, at)
    del codes
    heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    del group
    own = own[order]
    least = np.repeat(np.minimum.reduceat(low[own], heads), np.diff(np.append(heads, len(order))))
    tell = least < high[own]
    own = own[tell].astype(np.int64)
    return own, at[order[tell]] - first[own], least[tell]


def _codes(text: np.ndarray) -> np.ndarray:
    """A number for each word of a text whose words have one space behind each; equal words have equal numbers."""
    stop = np.flatnonzero(text == 32)
    offsets = np.concatenate([[0], stop + 1]) - np.arange(len(stop) + 1)
    strings = pa.Array.from_buffers(pa.large_binary(), len(stop), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(text[text != 32])])
    return strings.dictionary_encode().indices.to_numpy()


def _equal_windows(codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows sorted so that equal ones are neighbours, and the number of each one's group."""
    hashes, done = np.empty(len(at), np.uint64), 0
    for a in range(0, len(codes) - WINDOW + 1, HASHED):  # at is in order
        upto = int(np.searchsorted(at, a + HASHED))
        hashes[done:upto] = hash_runs(codes[a : a + HASHED + WINDOW - 1].astype(np.uint64), WINDOW)[at[done:upto] - a]
        done = upto
    order = np.argsort(hashes, kind="stable")
    same_hash = hashes[order[1:]] == hashes[order[:-1]]
    del hashes
    same = same_hash.copy()
    i = np.flatnonzero(same_hash)
    x, y = at[order[1:][i]], at[order[:-1][i]]
    for k in range(WINDOW):
        same[i] &= codes[x + k] == codes[y + k]
    if (same != same_hash).any():  # two windows share a hash: sort by the words themselves
        order = np.lexsort([codes[at + k] for k in reversed(range(WINDOW))])
        same = np.logical_and.reduce([codes[at[order[1:]] + k] == codes[at[order[:-1]] + k] for k in range(WINDOW)])
    return order, np.concatenate([[0], np.cumsum(~same)])


def _cut_chunk(frequent: np.ndarray, rank: np.ndarray):
    def run(answers: pa.Table, docs: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _RESULT_ARROW.empty_table()
        chunk = _chunk([x.as_py() for x in docs["docs"]], frequent, rank)
        parts = [_unpacked(x.as_py(), np.int64, np.int64, np.int64) for x in answers["windows"]]
        told = [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in range(3)]
        out = chunk.kept(chunk.removed(*told))
        del chunk, parts, told
        trim()
        return out

    return run


def remove_repeats(docs: DataFrame, carry: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_removed, kept_text, kept_sha256.

    A word goes if a window that covers it also starts in a document with a smaller doc_id. A null doc_id
    counts as smaller than any other, so such rows lose nothing; neither do rows that repeat a doc_id
    to each other. Null text has no words; a text of fewer than 13 words has no window; a very long text is worked on
    whole, in a chunk of its own size; an empty table gives no rows; other columns are ignored, whatever their
    names.

    With carry also new_text, which is the text itself where nothing goes, and the struct `carried`: the
    struct `row` of the other columns, and whether the text is null (`no_text`).
    """
    has_columns(docs, "doc_id", "text")
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(BUCKETS_PER_PARTITION * partitions(spark), -(-SENT_SHARE * size // BUCKET_BYTES))
    chunks = max(partitions(spark), -(-size // CHUNK_BYTES))
    often = frequent_runs(docs)
    rows = docs.select(internal_id().alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    if carry:
        others = F.struct(*(docs[c] for c in docs.columns if c != "text"))
        rows = docs.select(internal_id().alias("id"), F.coalesce("text", F.lit("")).alias("text"), F.struct(others.alias("row"), docs["text"].isNull().alias("no_text")).alias("carried"))
    # Rows that share one id, or have none, are spread by their texts.
    rows = rows.select(F.pmod(F.xxhash64("id", "text"), F.lit(chunks)).alias("chunk"), *rows.columns)
    # One exchange serves both passes over the chunks.
    dealt = rows.mapInArrow(_deal, "chunk long, docs binary").repartition("chunk")
    sent = dealt.sortWithinPartitions("chunk").mapInArrow(_send(buckets, *often), _SENT)
    schema = StructType([*StructType.fromDDL(_RESULT + ", new_text string" * carry), *rows.schema[3:]])
    answers = sent.groupBy("bucket").applyInArrow(_window_minima, _ANSWER)
    return answers.groupBy("chunk").cogroup(dealt.groupBy("chunk")).applyInArrow(_cut_chunk(*often), schema)


ORACLE = r"""
with w as (
  select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
s as (
  select doc_id, p, array_to_string(w[p:p + 12], ' ') as win
  from (select doc_id, w, unnest(range(1, len(w) - 11)) as p from w where len(w) >= 13) u),
f as (select win, min(doc_id) as least from s group by win),
gone as (
  select distinct s.doc_id, unnest(range(s.p, s.p + 13)) as i
  from s join f using (win) where f.least < s.doc_id),
words as (select doc_id, unnest(range(1, len(w) + 1)) as i, unnest(w) as word from w),
kept as (
  select doc_id, count(*) as n, string_agg(word, ' ' order by i) as kept
  from words anti join gone using (doc_id, i) group by doc_id)
select w.doc_id, len(w) as n_words, len(w) - coalesce(k.n, 0) as n_removed, sha256(coalesce(k.kept, '')) as kept_sha256
from w left join kept k on w.doc_id = k.doc_id
"""
