"""Token counts that follow edits.

A document's text is cut into leaves at safe places (pre-token boundaries that no other text can move), each
leaf's tokens are counted, and a segment tree holds the sums of counts and of lengths. An edit finds its
leaves by length in the tree, re-encodes those and the leaf on either side, and updates the sums above
them; everything else is kept.

A cut is safe where a letter or digit is followed by a single space and a letter or digit: the pre-token
pattern then always ends one token and begins the next (the space belongs to it), whatever stands before
or after. An edit can only make or unmake safe places within its own leaves and next to them, so leaves
beside the touched ones are re-encoded with them. No special token's string holds a safe place.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, has_columns
from .vocab import byte_bpe, library

#: Characters in a leaf, about.
LEAF_CHARS = 512
#: Edits that the query makes to each document.
EDITS = 3

_SAFE = re.compile(r"(?<=[A-Za-z0-9À-ÖØ-öø-ÿ])(?= [A-Za-z0-9À-ÖØ-öø-ÿ])")
_RESULT = "doc_id long, n_tokens long, n_edits long, n_tokens_edited long, n_chars long, n_chars_edited long, n_chars_encoded long"
_RESULT_ARROW = pa.schema([(f.split()[0], pa.int64()) for f in _RESULT.split(", ")])


@dataclass(frozen=True)
class Edit:
    """Replaces `length` characters from `start` by `text`; both ends are clipped to the document."""

    start: int
    length: int
    text: str


def leaves(text: str, size: int = LEAF_CHARS) -> list[str]:
    """The text in parts of `size` characters or a little more, cut at safe places only."""
    out, at = [], 0
    while len(text) - at > size:
        found = _SAFE.search(text, at + size)
        if not found or found.start() >= len(text):
            break
        out.append(text[at : found.start()])
        at = found.start()
    out.append(text[at:])
    return out


class CountTree:
    """A document's leaves, with a segment tree over their token counts and lengths.

    Replacing leaves by another number of them rebuilds the sums above (not the counts of leaves).
    """

    def __init__(self, text: str, encode, size: int = LEAF_CHARS):
        self.encode, self.size, self.encoded = encode, size, 0
        self.leaves = leaves(text, size)
        self.counts = [self._count(x) for x in self.leaves]
        self._build()

    def _count(self, leaf: str) -> int:
        self.encoded += len(leaf)
        return len(self.encode(leaf)) if leaf else 0

    def _build(self) -> None:
        self.width = 1 << max(0, len(self.leaves) - 1).bit_length()
        pad = [0] * (self.width - len(self.leaves))
        self.tokens = [0] * self.width + self.counts + pad
        self.chars = [0] * self.width + [len(x) for x in self.leaves] + pad
        for i in range(self.width - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    @property
    def length(self) -> int:
        return self.chars[1]

    def text(self) -> str:
        return "".join(self.leaves)

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds character `place`, and the characters before that leaf."""
        place = min(place, max(0, self.length - 1))
        i, before = 1, 0
        while i < self.width:
            i *= 2
            if place - before >= self.chars[i]:
                before += self.chars[i]
                i += 1
        return i - self.width, before

    def apply(self, edit: Edit) -> None:
        start = min(max(0, edit.start), self.length)
        stop = min(max(start, start + edit.length), self.length)
        first, _ = self.leaf_at(start)
        last, _ = self.leaf_at(max(start, stop - 1))
        first, last = max(0, first - 1), min(len(self.leaves) - 1, last + 1)
        before = sum(map(len, self.leaves[first : self.leaf_at(start)[0]])) if start else 0
        old = "".join(self.leaves[first : last + 1])
        base = self.leaf_at(start)[1] - before if start else 0
        new = old[: start - base] + edit.text + old[stop - base :]
        own = leaves(new, self.size) if new or last - first + 1 == len(self.leaves) else []
        counts = [self._count(x) for x in own]
        same = len(own) == last - first + 1
        self.leaves[first : last + 1], self.counts[first : last + 1] = own, counts
        if not same:
            self._build()
            return
        touched = set()
        for k, (leaf, n) in enumerate(zip(own, counts, strict=True), first + self.width):
            self.tokens[k], self.chars[k] = n, len(leaf)
            touched.add(k // 2)
        while touched:
            for i in touched:
                if i:
                    self._sum(i)
            touched = {i // 2 for i in touched if i > 1}


def edits_of(doc_id: int, length: int, text: str) -> list[Edit]:
    """The edits the query makes: a fixed rule of the id and the length, so that every run makes the same."""
    out, state = [], (doc_id * 2654435761 + 12345) & 0xFFFFFFFF
    for k in range(EDITS):
        state = (state * 1664525 + 1013904223) & 0xFFFFFFFF
        start = state % (length + 1)
        out.append(Edit(start, (state >> 7) % 24 if k else 0, ("", "n edit", text[start : start + 40])[k % 3] if k else f" [{doc_id}] "))
    return out


def _counted(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_bpe(vocabulary)
        for token in library(vocabulary).get_added_tokens_decoder().values():
            if _SAFE.search(token.content):
                raise ValueError(f"the vocabulary's token {token.content!r} can be cut at a safe place")
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                text = text.as_py() or ""
                tree = CountTree(text, encode)
                n, chars, tree.encoded = tree.total, tree.length, 0
                edits = edits_of(doc or 0, chars, text)
                for edit in edits:
                    tree.apply(edit)
                rows.append((doc, n, len(edits), tree.total, chars, tree.length, tree.encoded))
            if rows:
                yield batch(_RESULT_ARROW, *zip(*rows, strict=True))

    return run


def count_tokens(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """One row per row of docs: token counts before and after a fixed set of edits.

    doc_id, n_tokens, n_edits, n_tokens_edited, n_chars, n_chars_edited, n_chars_encoded (characters
    re-encoded for the edits). Null text is empty and is edited like any other; a null doc_id stays null
    (its edits are those of 0); repeated rows are each counted, to the same result; an empty table gives no rows; other
    columns are ignored, whatever their names. A text of any length is one tree; edits at the same place are applied in
    their order.
    """
    has_columns(docs, "doc_id", "text")
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_counted(vocabulary), _RESULT)
