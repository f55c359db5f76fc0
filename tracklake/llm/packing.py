"""Packing documents into fixed-length training sequences, balanced by attention cost.

Every scan partition packs its own rows: no row is shuffled, so copies, hot sources and very long
documents never meet in one task, and a lost partition is simply packed again to the same result.
A document longer than a sequence is cut at multiples of the sequence length; the cut-off rest is
placed with the others, in descending order, into the sequence of lowest estimated cost
(LINEAR * n + QUADRATIC * n * n, summed over the pieces in it) that still has room. A rest that fits
nowhere is cut to fill the cheapest gaps. Sequences of one chunk hold as many tokens as they need and
no more, so padding is under one sequence for each partition.
"""

from __future__ import annotations

import heapq
import os
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import batch, has_columns
from .vocab import byte_bpe

SEQUENCE = 2048
END_ID = 1
LINEAR, QUADRATIC = 1.0, 1.0 / 1024
#: Tokens gathered before a chunk is packed; bounds a task's memory.
CHUNK_TOKENS = 1 << 20

_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_ARROW = pa.schema([(f.split()[0], pa.int64()) for f in _SCHEMA.split(", ")])


def assign(lengths: list[int], room: int = SEQUENCE, linear: float = LINEAR, quadratic: float = QUADRATIC) -> list[list[tuple[int, int, int]]]:
    """Sequences of (item, start in the item, length) for items of at most `room` tokens each.

    As few sequences as hold all tokens. Ties in length go to the earlier item, ties in cost to the
    earlier sequence. No items: no sequences.
    """
    total = sum(lengths)
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(-(-total // room))]
    left = [room] * len(out)
    heap = [(0.0, s) for s in range(len(out))]
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        start, n = 0, lengths[item]
        passed = []
        while n and heap:
            cost, s = heapq.heappop(heap)
            if left[s] < n:
                passed.append((cost, s))
                continue
            out[s].append((item, start, n))
            left[s] -= n
            if left[s]:
                heapq.heappush(heap, (cost + linear * n + quadratic * n * n, s))
            start, n = start + n, 0
        kept = []
        for cost, s in passed:  # in order of cost; no single gap is wide enough if n is left
            k = min(left[s], n)
            if k:
                out[s].append((item, start, k))
                left[s], start, n = left[s] - k, start + k, n - k
                cost += linear * k + quadratic * k * k
            if left[s]:
                kept.append((cost, s))
        for x in kept:
            heapq.heappush(heap, x)
    return out


def _packed(items: list[tuple[int | None, np.ndarray]], first: int) -> tuple[pa.RecordBatch, int]:
    pieces, at = [], first  # (doc, start, length, crc, tokens, sequence, offset)

    def piece(doc, ids, start, n, sequence, offset):
        pieces.append((doc, start, n, zlib.crc32(ids[start : start + n].tobytes()), len(ids), sequence, offset))

    rests = []
    for doc, ids in items:
        whole = len(ids) // SEQUENCE
        for k in range(whole):
            piece(doc, ids, k * SEQUENCE, SEQUENCE, at, 0)
            at += 1
        if len(ids) % SEQUENCE:
            rests.append((doc, ids, whole * SEQUENCE))
    for own in assign([len(ids) - start for _, ids, start in rests]):
        offset = 0
        for item, start, n in own:
            doc, ids, base = rests[item]
            piece(doc, ids, base + start, n, at, offset)
            offset += n
        at += 1
    return batch(_ARROW, *zip(*pieces, strict=True)), at


def _pack(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_bpe(vocabulary)
        first = TaskContext.get().partitionId() << 32
        items, tokens = [], 0
        for b in batches:
            for doc, text in zip(b.column(0), b.column(1), strict=True):
                ids = np.array([*encode(text.as_py() or ""), END_ID], np.uint32)
                items.append((doc.as_py(), ids))
                tokens += len(ids)
                if tokens >= CHUNK_TOKENS:
                    out, first = _packed(items, first)
                    items, tokens = [], 0
                    yield out
        if items:
            yield _packed(items, first)[0]

    return run


def pack(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """One row for each piece: where it starts in its document, and where it lies in which sequence.

    A null text is empty and still has its end id; a null doc_id stays null; repeated rows are packed
    each for itself; an empty table gives no rows; other columns are ignored, whatever their names. A document of any length
    is cut into pieces. Of equally long documents the earlier is placed first, into the first of equally cheap
    sequences. sequence_id tells the partition (high bits) and the sequence in it.
    """
    has_columns(docs, "doc_id", "text")
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    if not os.path.basename(vocabulary).endswith(".json"):
        raise ValueError("the vocabulary is a tokenizers .json file")
    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(_pack(vocabulary), _SCHEMA)
