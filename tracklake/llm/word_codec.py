"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

The frequent words of the corpus are compiled, with their ids as outputs, into a minimal automaton:
words share prefixes and suffixes, and each arc knows how many words it skips, so the path of a word adds
up to its number, which points to its ids. The automaton is a few flat arrays in one file in the shared folder,
which Spark brings to every executor once and each worker maps into memory, read-only. Words that are not in it
are merged exactly, pair by pair in order of rank, many words at a time.

No token spans white space, so a text is a row of segments between white space, and a segment is worked out
once for a worker's memory of segments. Segments are normalised and split into words as the vocabulary file
prescribes. Only a segment that holds a special token's string, or a character whose class may differ from one
Unicode version to another, is left to the library; the rest of its text is not.
"""

from __future__ import annotations

import contextlib
import functools
import gc
import hashlib
import heapq
import itertools
import json
import mmap
import re
import sys
import unicodedata
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from operator import itemgetter, not_

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch, concat_ranges, has_columns, shared_dir, text_slices
from .vocab import library

#: Words in the lexicon; bounds what is sent to each worker.
LEXICON_WORDS = 32_768
#: Words longer than this are never compiled.
LONGEST_WORD = 48
COUNTED_SEGMENTS = 300_000
#: Segments and words a worker remembers, and the characters of them.
CACHED_SEGMENTS, CACHED_CHARS = 400_000, 8_000_000
#: Pieces of a word above which the next pair is found by a heap; the result is the same.
HEAPED = 48
#: Words of up to 48 bytes are merged together: those of up to each of these widths are rows of a table, so many at a time.
WIDTHS = (2, 4, 6, 8, 10, 12, 16, 24, 48)
TABLE_ROWS = 65_536
END = "</w>"
_NONE = 1 << 62
#: In tables of words: what stands behind the end of a word, and the rank of a pair that is never merged.
_PAD, _UNRANKED = 0xFFFFF, np.iinfo(np.int32).max
#: Stands between words that are told together; no word and no token holds it.
_BREAK = "\n"
_FIRST, _SECOND = itemgetter(0), itemgetter(1)

_COUNTS_ARROW = pa.schema([("word", pa.string()), ("times", pa.int64())])
_RESULT_ARROW = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

#: White space, as the vocabulary's normaliser has it; str.split also takes U+001C to U+001F for it.
_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_NO_SPACE = "\x1c\x1d\x1e\x1f"


def _sure_characters() -> str:
    """Characters that the oldest Unicode data at hand put into their present class, as ranges: no version in between
    can see them otherwise. U+001C to U+001F are left out, on which engines differ as to white space."""
    old = unicodedata.ucd_3_2_0
    sure = lambda c: c not in range(0x1C, 0x20) and old.category(chr(c)) == unicodedata.category(chr(c)) not in ("Cn", "Cs", "Co")
    spans = (list(chars) for inside, chars in itertools.groupby(range(sys.maxunicode + 1), sure) if inside)
    return "".join(f"\\U{c[0]:08x}-\\U{c[-1]:08x}" for c in spans)


_DOUBTFUL = re.compile(f"[^{_sure_characters()}]")


@functools.cache
def byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte: itself if it is a visible
    Latin-1 character, else the next one from U+0100 on."""
    visible = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(rest)) for b in range(256)]


@contextlib.contextmanager
def _without_gc():
    """No search for cycles meanwhile: many tuples are made, and none is in a cycle."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def _normal(text: str) -> str:
    # A tokenizer lower-cases each character for itself: no sigma is final.
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def _by_break(found: list[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """Joins the firsts, and the seconds, of all that stand before each break."""
    return zip(*("".join(map(side, found)).split(_BREAK)[:-1] for side in (_FIRST, _SECOND)), strict=True)


def segments(text: str) -> list[str]:
    """What stands between white space."""
    if any(c in text for c in _NO_SPACE):
        return [s for s in _SPACE.split(text) if s]
    return text.split()


class Ranks:
    """Ranks of pairs of ids. A pair stands in one of two places that its hashes name, so many are looked up without a search."""

    FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

    def __init__(self, ranks: dict[int, int]):
        bits = max(4, (2 * len(ranks)).bit_length())
        while not self._place(ranks, bits):
            bits += 1

    def _place(self, ranks: dict[int, int], bits: int) -> bool:
        self.shift = np.uint64(64 - bits)
        self.keys, self.ranks = np.full((2, 1 << bits), -1, np.int64), np.full((2, 1 << bits), _UNRANKED, np.int32)
        for key, rank in ranks.items():
            for side in itertools.islice(itertools.cycle((0, 1)), 200):
                at = (key * self.FACTORS[side] & (1 << 64) - 1) >> 64 - bits
                pushed = int(self.keys[side, at]), int(self.ranks[side, at])
                self.keys[side, at], self.ranks[side, at] = key, rank
                key, rank = pushed  # goes to its other place
                if key < 0:
                    break
            else:
                return False
        return True

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 20 | right
        a, b = ((keys.view(np.uint64) * np.uint64(f) >> self.shift).view(np.int64) for f in self.FACTORS)
        return np.where(self.keys[0][a] == keys, self.ranks[0][a], np.where(self.keys[1][b] == keys, self.ranks[1][b], _UNRANKED))


@functools.cache
class Merger:
    """Splits segments into normalised words and merges a word's letters exactly."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.ids: dict[str, int] = spec["model"]["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        #: left << 20 | right -> rank << 20 | merged: a smaller value is an earlier merge.
        self.pair = {self.ids[a] << 20 | self.ids[b]: k << 20 | self.ids[a + b] for k, (a, b) in enumerate(merges)}
        self.letter = [self.ids[x] for x in byte_letters()]
        self.last = [self.ids[x + END] for x in byte_letters()]
        #: The merge of each two bytes inside a word.
        self.first = [self.pair.get(a << 20 | b, _NONE) for a in self.letter for b in self.letter]
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words, self.words_and_breaks = regex.compile(pattern).findall, regex.compile(f"{pattern}|{_BREAK}").findall
        self.tokens = {i: t for t, i in self.ids.items()}
        added = library(path).get_added_tokens_decoder()
        self.tokens |= {i: t.content for i, t in added.items()}
        #: For merging in tables: the rank of each pair, what each rank makes, and the rank of each two bytes inside a word.
        self._rank = Ranks({pair: m >> 20 for pair, m in self.pair.items()}).of
        self._made = np.zeros(len(merges), np.int32)
        for m in self.pair.values():
            self._made[m >> 20] = m & 0xFFFFF
        self._letter, self._last = np.array(self.letter, np.int32), np.array(self.last, np.int32)
        self._first = self._rank(np.repeat(self._letter, 256), np.tile(self._letter, 256))
        #: Each id and its token, with a space behind; the last stands for the end of a word.
        self.names = [(f"{i} ", self.tokens.get(i, "") + " ") for i in range(max(self.tokens) + 1)] + [(_BREAK, _BREAK)]
        self.special = re.compile("|".join(re.escape(t.content) for t in added.values()) or "(?!)").search

    def plain(self, segment: str) -> bool:
        return (segment.isascii() and segment.isprintable() or _DOUBTFUL.search(segment) is None) and self.special(segment) is None

    def all_plain(self, segments: list[str]) -> list[str]:
        """Those that are plain; one look at all of them tells, where all are."""
        return segments if self.plain("\n".join(segments)) else [s for s in segments if self.plain(s)]

    def split(self, segment: str) -> list[str]:
        if segment.isascii():
            return [segment.lower()] if segment.isalpha() else self.words(segment.lower())
        return self.words(_normal(segment))

    def split_all(self, segments: list[str]) -> list[str]:
        """The words of all segments, a break behind those of each."""
        return self.words_and_breaks(_normal("".join([s + _BREAK for s in segments])))

    def merge(self, word: str) -> list[int]:
        """The ids of a word: again and again its earliest pair is merged, the first of equals in front."""
        raw = word.encode()
        parts = [self.letter[b] for b in raw]
        parts[-1] = self.last[raw[-1]]
        if len(parts) > HEAPED:
            return self._merge_by_heap(parts)
        get, first = self.pair.get, self.first
        pairs = [first[a << 8 | b] for a, b in itertools.pairwise(raw)]
        if pairs:
            pairs[-1] = get(parts[-2] << 20 | parts[-1], _NONE)
        while pairs and (least := min(pairs)) != _NONE:
            i = pairs.index(least)
            parts[i] = now = least & 0xFFFFF
            del parts[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = get(now << 20 | parts[i + 1], _NONE)
            if i:
                pairs[i - 1] = get(parts[i - 1] << 20 | now, _NONE)
        return parts

    def _merge_by_heap(self, parts: list[int]) -> list[int]:
        """The same for many pieces: a heap of (merge, place), and links over the pieces that are left."""
        n, get = len(parts), self.pair.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m, i) for i, (a, b) in enumerate(itertools.pairwise(parts)) if (m := get(a << 20 | b)) is not None]
        heapq.heapify(heap)
        while heap:
            m, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] < 0 or j == n or get(parts[i] << 20 | parts[j]) != m:
                continue  # merged away meanwhile
            parts[i], parts[j] = m & 0xFFFFF, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (m := get(parts[a] << 20 | parts[b])) is not None:
                    heapq.heappush(heap, (m, a))
        return [p for p in parts if p >= 0]

    def merge_all(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of many words, one word after the other, and how many each has."""
        raw = [w.encode() for w in words]
        n = np.array([len(w) for w in raw], np.int64)
        data = np.frombuffer(b"".join(raw) + bytes(WIDTHS[-1]), np.uint8)
        at = np.cumsum(n) - n
        done = []
        for below, width in itertools.pairwise((0, *WIDTHS)):
            found = np.flatnonzero((n > below) & (n <= width))
            for rows in (found[k : k + TABLE_ROWS] for k in range(0, len(found), TABLE_ROWS)):
                done.extend(self._merge_rows(rows, data[at[rows][:, None] + np.arange(width)], n[rows]))
        for row in np.flatnonzero(n > WIDTHS[-1]).tolist():
            done.append((np.array([row]), np.array([self.merge(words[row])], np.int32)))
        counts = np.zeros(len(words), np.int64)
        for rows, parts in done:
            counts[rows] = (parts != _PAD).sum(1)
        begin = np.cumsum(counts) - counts
        flat = np.zeros(int(counts.sum()), np.int32)
        for rows, parts in done:
            flat[concat_ranges(begin[rows], counts[rows])] = parts[parts != _PAD]
        return flat, counts

    def _merge_rows(self, rows: np.ndarray, raw: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Merges words that are rows of a table of bytes, of which the first n count; (rows, their pieces) as they are done.

        Each round merges the earliest pair of every row, the first of equals in front, so all rows that are left
        lose one column.
        """
        own, width = np.arange(len(rows)), raw.shape[1]
        parts = np.where(np.arange(width) < n[:, None], self._letter[raw], _PAD).astype(np.int32)
        parts[own, n - 1] = self._last[raw[own, n - 1]]
        pairs = self._first[raw[:, :-1].astype(np.int64) << 8 | raw[:, 1:]]
        pairs[np.arange(1, width) >= n[:, None]] = _UNRANKED
        ended = np.flatnonzero(n > 1)
        pairs[ended, n[ended] - 2] = self._rank(parts[ended, n[ended] - 2], parts[ended, n[ended] - 1])
        while width > 1:
            place = pairs.argmin(1)
            least = pairs[own, place]
            live = least != _UNRANKED
            if not live.all():
                yield rows[~live], parts[~live]
                rows, parts, pairs, place, least = rows[live], parts[live], pairs[live], place[live], least[live]
                own = np.arange(len(rows))
            if not len(rows):
                return
            now = self._made[least]
            parts[own, place] = now
            stay = np.ones((len(rows), width), bool)
            stay[own, place + 1] = False
            parts = parts[stay].reshape(len(rows), width - 1)
            stay = np.ones((len(rows), width - 1), bool)
            stay[own, place] = False
            pairs = pairs[stay].reshape(len(rows), width - 2)
            width -= 1
            behind, before = np.flatnonzero(place < width - 1), np.flatnonzero(place)
            pairs[behind, place[behind]] = self._rank(now[behind], parts[behind, place[behind] + 1])
            pairs[before, place[before] - 1] = self._rank(parts[before, place[before] - 1], now[before])
        yield rows, parts

    def tell(self, flat: np.ndarray, counts: np.ndarray) -> Iterator[tuple[str, str]]:
        """Of words given as by `merge_all`: their ids, and the tokens that these decode to, each with a space behind."""
        return _by_break(list(map(self.names.__getitem__, np.insert(flat, np.cumsum(counts), len(self.names) - 1).tolist())))


def compile_lexicon(entries: dict[str, list[int]]) -> bytes:
    """The minimal acyclic automaton of the words (as UTF-8), with their ids, as one block of bytes.

    Words are added in byte order; whenever a word leaves a branch for good, its states are replaced by
    equal ones seen before. States get numbers so that an arc's target is known by number; an arc holds
    its state and byte, its target and how many words come before those behind it.
    """
    keys = sorted((w.encode(), ids) for w, ids in entries.items())
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    path: list[list] = [[False, []]]  # [final, [(byte, state)]] of the states along the last word
    before = b""

    def close(depth: int) -> None:
        while len(path) > depth:
            final, arcs = path.pop()
            key = (final, tuple(arcs))
            if key not in register:
                register[key] = len(states)
                states.append(key)
            path[-1][1].append((before[len(path) - 1], register[key]))

    for word, _ in keys:
        same = 0
        while same < min(len(word), len(before)) and word[same] == before[same]:
            same += 1
        close(same + 1)
        before = word
        path.extend([False, []] for _ in word[same:])
        path[-1][0] = True
    close(1)
    states.append((path[0][0], tuple(path[0][1])))
    words_below: list[int] = []
    arc, target, skip = [], [], []
    for state, (final, arcs) in enumerate(states):  # targets come before the states that point to them
        n = int(final)
        for byte, to in arcs:
            arc.append(state << 8 | byte)
            target.append(to)
            skip.append(n)
            n += words_below[to]
        words_below.append(n)
    outputs = np.concatenate([np.zeros(0, np.int32), *(np.array(ids, np.int32) for _, ids in keys)]).astype(np.int32)
    offsets = np.concatenate([[0], np.cumsum([len(ids) for _, ids in keys])]).astype(np.int32)
    arrays = [np.array(arc, np.int64), np.array(target, np.int32), np.array(skip, np.int32), offsets, outputs, np.array([f for f, _ in states], np.uint8)]
    return np.array([a.nbytes for a in arrays], np.int64).tobytes() + b"".join(a.tobytes() for a in arrays)


class Lexicon:
    """Looks many words up at once in an automaton, where it lies: in mapped memory, or any other bytes."""

    def __init__(self, block: bytes | mmap.mmap):
        sizes = np.frombuffer(block, np.int64, 6)
        at, found = 48, []
        for kind, size in zip([np.int64, *[np.int32] * 4, np.uint8], sizes.tolist(), strict=True):
            found.append(np.frombuffer(block, kind, size // np.dtype(kind).itemsize, at))
            at += size
        #: arc: state << 8 | byte of every arc in order, for a binary search over all arcs.
        self.arc, self.target, self.skip, self.offsets, self.outputs, self.final = found

    def numbers(self, words: list[str]) -> np.ndarray:
        """The number of each word, or -1."""
        raw = [w.encode() for w in words]
        n = np.array([len(w) for w in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        at = np.concatenate([[0], np.cumsum(n)])[:-1]
        state, number = np.full(len(raw), len(self.final) - 1, np.int64), np.zeros(len(raw), np.int64)
        live = np.flatnonzero(n <= LONGEST_WORD * 4)
        number[n > LONGEST_WORD * 4] = -1
        for depth in range(int(n[live].max(initial=0))):
            own = live[n[live] > depth]
            if not len(own) or not len(self.arc):
                break
            key = state[own] << 8 | data[at[own] + depth]
            arc = np.minimum(np.searchsorted(self.arc, key), len(self.arc) - 1)
            hit = self.arc[arc] == key
            number[own[~hit]] = -1
            state[own[hit]] = self.target[arc[hit]]
            number[own[hit]] += self.skip[arc[hit]]
            live = live[number[live] >= 0]
        known = number >= 0
        number[known & (self.final[state] == 0)] = -1
        return number

    def ids(self, number: int) -> list[int]:
        return self.outputs[self.offsets[number] : self.offsets[number + 1]].tolist()

    def all_ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of many words, one word after the other, and how many each has."""
        counts = (self.offsets[numbers + 1] - self.offsets[numbers]).astype(np.int64)
        return self.outputs[concat_ranges(self.offsets[numbers].astype(np.int64), counts)], counts


class Codec:
    """Encodes and decodes texts: remembered segments, then the lexicon, then exact merging."""

    def __init__(self, block: bytes | mmap.mmap, path: str):
        self.merger, self.lexicon, self.exact = Merger(path), Lexicon(block), library(path)
        self.forget()

    def forget(self) -> None:
        #: Of words and of segments: their ids, and the tokens that these decode to. Each id and each token has a space
        #: behind, so that what is joined needs none between.
        self.words: dict[str, tuple[str, str]] = {_BREAK: (_BREAK, _BREAK)}
        self.ids: dict[str, tuple[str, str]] = {}
        self.chars = 0
        self.before: tuple[dict[str, tuple[str, str]], ...] = ({}, {})  # the memory of the time before, in the same order

    def turn(self) -> None:
        """Forgets what has not been seen since the last turn; what comes often is never worked out again."""
        before = self.words, self.ids
        self.forget()
        self.before = before

    @staticmethod
    def _take_over(now: dict, old: dict, new: list[str]) -> list[str]:
        """Brings what is in the old memory into the new one; the rest."""
        if not old:
            return new
        found = list(map(old.get, new))
        now.update(zip(itertools.compress(new, found), filter(None, found), strict=True))
        return [s for s, known in zip(new, found, strict=True) if known is None]

    def _learn_words(self, words: list[str]) -> None:
        words = self._take_over(self.words, self.before[0], words)
        if not words:
            return
        numbers = self.lexicon.numbers(words)
        known = numbers >= 0
        listed, merged = list(itertools.compress(words, known.tolist())), list(itertools.compress(words, (~known).tolist()))
        self.words.update(zip(listed, self.merger.tell(*self.lexicon.all_ids(numbers[known])), strict=True))
        self.words.update(zip(merged, self.merger.tell(*self.merger.merge_all(merged)), strict=True))

    def learn(self, new: list[str]) -> None:
        """Works out segments that are not known yet, or takes them over from the time before."""
        self.chars += sum(map(len, new))
        new = self._take_over(self.ids, self.before[1], new)
        sure = self.merger.all_plain(new)
        letters = [s.isascii() and s.isalpha() for s in sure]
        simple, others = list(itertools.compress(sure, letters)), list(itertools.compress(sure, map(not_, letters)))
        single = list(itertools.chain.from_iterable(map(self.merger.split, simple)))  # one word each
        words = self.merger.split_all(others)
        self._learn_words(list({*single, *words}.difference(self.words)))
        self.ids.update(zip(simple, map(self.words.__getitem__, single), strict=True))
        self.ids.update(zip(others, _by_break(list(map(self.words.__getitem__, words))), strict=True))
        for s in new if len(sure) < len(new) else ():
            if s not in self.ids:
                ids = self.exact.encode(s, add_special_tokens=False).ids
                self.ids[s] = "".join([f"{i} " for i in ids]), self.exact.decode(ids, skip_special_tokens=False) + " " if ids else ""

    def encode(self, texts: list[str | None]) -> Iterator[tuple[int, str, str]]:
        """(number of ids, ids joined by a space, decoded text) of each text."""
        split = [segments(t) if t else [] for t in texts]
        if len(self.ids) > CACHED_SEGMENTS // 2 or self.chars > CACHED_CHARS // 2:
            self.turn()
        self.learn(list(itertools.filterfalse(self.ids.__contains__, dict.fromkeys(itertools.chain.from_iterable(split)))))
        for own in split:
            found = list(map(self.ids.__getitem__, own))
            ids = "".join(map(_FIRST, found))
            yield ids.count(" "), ids[:-1], "".join(map(_SECOND, found))[:-1]


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger, counted = Merger(path), Counter()

        def told():
            words, equal = Counter(), defaultdict(list)
            for segment, times in counted.items():
                equal[times].append(segment)
            counted.clear()
            for times, own in equal.items():  # no word spans white space, so segments are split together
                found = merger.words(_normal(_BREAK.join(own)))
                if times == 1:
                    words.update(found)
                else:
                    for word in found:
                        words[word] += times
            return batch(_COUNTS_ARROW, list(words), list(words.values()))

        for b in batches:
            for a, z in text_slices(b.column(0)):
                for text in b.column(0).slice(a, z - a).to_pylist():
                    counted.update(segments(text) if text else ())
                if len(counted) > COUNTED_SEGMENTS:
                    yield told()
        yield told()

    return run


def lexicon_of(docs: DataFrame, path: str, size: int = LEXICON_WORDS) -> bytes:
    """The automaton of the most frequent words of all texts (ties: in order of the words)."""
    counts = docs.select("text").mapInArrow(_count(path), "word string, times long").groupBy("word").agg(F.sum("times").alias("times"))
    top = counts.where(F.length("word") <= LONGEST_WORD).orderBy(F.desc("times"), "word").limit(size).toArrow()
    merger = Merger(path)
    return compile_lexicon({w: merger.merge(w) for w in top["word"].to_pylist()})


def distribute(spark: SparkSession, block: bytes) -> str:
    """Writes a block to the shared folder and has Spark bring it to every executor, also to those that come later;
    the name under which SparkFiles finds it there."""
    name = f"lexicon-{uuid.uuid4().hex}"
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/files/{name}")
    files = place.getFileSystem(context._jsc.hadoopConfiguration())
    stream = files.create(place)
    try:
        stream.write(bytearray(block))
    finally:
        stream.close()
    context.addFile(files.makeQualified(place).toUri().toString())
    return name


def encode(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """One row per row of docs: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Null text is empty: no tokens, and the digests of an empty string. Texts and words of any length are encoded
    whole, in time that grows with their length (times its logarithm within a word). A null doc_id stays null;
    repeated rows are each encoded, to the same result; words that are equally frequent enter the lexicon in order of
    the words, which no result depends on; an empty table gives no rows; other columns are ignored, whatever their
    names.
    """
    has_columns(docs, "doc_id", "text")
    vocabulary = vocabulary or public_tokenizers.path("word_bpe_49k.json")
    name = distribute(docs.sparkSession, lexicon_of(docs, vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with open(SparkFiles.get(name), "rb") as f:
            codec = Codec(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ), vocabulary)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        for b in batches:
            for a, z in text_slices(b.column(1)):
                part = b.slice(a, z - a)
                with _without_gc():
                    found = [(n, sha(ids), sha(text)) for n, ids, text in codec.encode(part.column(1).to_pylist())]
                yield batch(_RESULT_ARROW, part.column(0), *zip(*found, strict=True))

    rows = docs.selectExpr("cast(doc_id as long) as doc_id", "text")
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
