"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. The probability of a word
under a language is the sum over all ways to cut it into pieces, by the forward algorithm; words are
independent, so a text's log-likelihood is a sum over its words. A word of any length is scored whole, and
once for a worker's memory of words, whatever the number of times it occurs.

The forward sums run over plain probabilities, place by place for many words at once: only the pieces that
do end at a place are touched, and what has been summed is brought back to 1 every RESCALED places, with the
logarithm of the factor kept aside. Of a word the last `longest` places are held, so its length is not bounded.

Training counts words per language in each task, shares every word's count out over its segmentations
(one expectation step from a uniform start, by forward and backward sums), and adds up the expected piece
counts: at most vocabulary size times languages rows reach the driver, whatever the corpus size. It reads
the whole texts of about TRAINING_DOCS documents of each language, told by a hash of the id, or of all
where there are fewer.
"""

from __future__ import annotations

import functools
import itertools
import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import batch, has_columns, text_slices

UNDETERMINED = "und"
#: Added to every expected piece count of a language.
SMOOTHING = 0.1
#: A character outside the vocabulary has this log-probability in every language.
UNKNOWN = -16.0
#: Places between two rescalings; with pieces of e**LEAST at least, no product leaves a double's range.
RESCALED, LEAST = 12, -22.0
#: Places (words times their length) that one lattice holds; a longer word goes through it in blocks.
PLACES = 1 << 16
CACHED_WORDS, COUNTED_WORDS = 400_000, 200_000
#: The bound on the sample that the model is fitted on: documents of each language, as expected over ids.
TRAINING_DOCS = 4000
#: Documents whose crc32 is 0 modulo this are held out of training.
FOLDS = 5



def _marks() -> str:
    """The combining marks, as ranges of a character class."""
    own = (list(chars) for inside, chars in itertools.groupby(range(sys.maxunicode + 1), lambda c: unicodedata.category(chr(c))[0] == "M") if inside)
    return "".join(f"{chr(c[0])}-{chr(c[-1])}" for c in own)


#: Letters, and the combining marks among and behind them.
_WORD = re.compile(rf"[^\W\d_]+(?:(?![\x00-\x7f])[{_marks()}]+[^\W\d_]*)*")
_COUNTS_ARROW = pa.schema([("lang", pa.string()), ("piece", pa.int32()), ("expected", pa.float64())])
_RESULT_ARROW = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


@functools.cache
def pieces(path: str) -> tuple[dict[str, int], int]:
    """The letter pieces of the vocabulary (a word-start mark stands as a leading space), and the longest."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found: dict[str, int] = {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i).replace("▁", " ").lower()
        if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i)) and regex.fullmatch(r" ?[\p{L}\p{M}]*", piece) and piece:
            found.setdefault(piece, len(found))
    return found, max(map(len, found))


def size_of(path: str) -> int:
    return len(pieces(path)[0])


@functools.cache
def trie(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Arcs of the pieces' trie in order of (node, character), the node each leads to, each node's piece or -1,
    and the node behind the root for each character (0: none)."""
    known, _ = pieces(path)
    nodes = {"": 0}
    for piece in known:
        for k in range(1, len(piece) + 1):
            nodes.setdefault(piece[:k], len(nodes))
    arcs = sorted((nodes[text[:-1]] << 21 | ord(text[-1]), number) for text, number in nodes.items() if text)
    piece = np.full(len(nodes), -1, np.int32)
    for text, number in known.items():
        piece[nodes[text]] = number
    first = np.zeros(sys.maxunicode + 1, np.int32)
    for text, number in nodes.items():
        if len(text) == 1:
            first[ord(text)] = number
    return np.array([a for a, _ in arcs], np.int64), np.array([n for _, n in arcs], np.int64), piece, first


def words_of(text: str) -> list[str]:
    return _WORD.findall(unicodedata.normalize("NFC", text).lower())


class Lattice:
    """The pieces that some words (with their start marks) can be cut into, place by place.

    backward: places are counted from the ends of the words, so that forward sums over it are backward sums.
    """

    def __init__(self, words: list[str], path: str, backward: bool = False):
        self.path, self.backward = path, backward
        self.longest, self.unknown = pieces(path)[1], size_of(path)
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.width = int(self.lengths.max(initial=0))
        self.codes = np.zeros((len(words), self.width + self.longest), np.int32)
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.codes[:, : self.width][np.arange(self.width) < self.lengths[:, None]] = flat

    def _from(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
        """word, start, end and piece of all arcs that start at the places low[w] .. high[w] - 1 of word w."""
        arcs, target, piece, first = trie(self.path)
        least = int(low.min(initial=0))
        spread = least + np.arange(max(0, int(high.max(initial=0)) - least))[:, None]
        start, word = np.nonzero((spread >= low) & (spread < high))
        start += least
        node = first[self.codes[word, start]].astype(np.int64)
        alone = piece[node] < 0  # a character that is no piece keeps every place reachable
        out = [(word[alone], start[alone], start[alone] + 1, np.full(int(alone.sum()), self.unknown))]
        word, start, node = word[node > 0], start[node > 0], node[node > 0]
        for k in range(self.longest):
            own = piece[node] >= 0
            out.append((word[own], start[own], start[own] + k + 1, piece[node[own]]))
            key = node << 21 | self.codes[word, start + k + 1]
            arc = np.minimum(np.searchsorted(arcs, key), len(arcs) - 1)
            hit = arcs[arc] == key
            word, start, node = word[hit], start[hit], target[arc[hit]]
            if not len(word):
                break
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def blocks(self) -> Iterator[tuple[int, int, tuple[np.ndarray, ...]]]:
        """(lo, hi, arcs that end at the places lo + 1 .. hi, in order of end and word)."""
        step = max(PLACES // max(1, len(self.lengths)), self.longest)
        for lo in range(0, self.width, step):
            hi = min(lo + step, self.width)
            if self.backward:
                word, start, end, piece = self._from(np.maximum(0, self.lengths - hi), np.maximum(0, self.lengths - lo))
                start, end = self.lengths[word] - end, self.lengths[word] - start
            else:
                word, start, end, piece = self._from(np.minimum(max(0, lo - self.longest + 1), self.lengths), np.minimum(hi, self.lengths))
            keep = (end > lo) & (end <= hi) & (end <= self.lengths[word]) & (start >= 0)
            word, start, end, piece = word[keep], start[keep], end[keep], piece[keep]
            order = np.argsort(end * len(self.lengths) + word, kind="stable")
            yield lo, hi, (word[order], start[order], end[order], piece[order])

    def sums(self, p: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(place, words, logs): the summed probability of the segmentations up to a place, for the words that reach it.

        p has a row for each piece, the unknown character's last, and a column for each language.
        """
        own = np.zeros((self.longest + 1, len(self.lengths), p.shape[1]))
        own[-1] = 1.0  # the last row is the place lo
        offset = np.zeros(own.shape[1:])
        for lo, hi, (word, start, end, piece) in self.blocks():
            own = np.concatenate([own[-self.longest - 1 :], np.zeros((hi - lo, *own.shape[1:]))])
            row = self.longest - lo  # of place 0
            cuts = np.searchsorted(end, np.arange(lo + 1, hi + 2))
            head = np.ones(len(word), bool)
            head[1:] = (word[1:] != word[:-1]) | (end[1:] != end[:-1])
            for place, a, b in zip(range(lo + 1, hi + 1), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                heads = np.flatnonzero(head[a:b])
                if not len(heads):
                    return
                words = word[a:b][heads]
                total = np.add.reduceat(own[start[a:b] + row, word[a:b]] * p[piece[a:b]], heads, axis=0)
                own[place + row, words] = total
                yield place, words, np.log(total) + offset[words]
                if not place % RESCALED:
                    offset[words] += np.log(total)
                    own[place + row - self.longest : place + row + 1, words] /= total


def lattice(words: list[str], path: str) -> Lattice:
    return Lattice(words, path)


def forward(net: Lattice, log_p: np.ndarray) -> np.ndarray:
    """alpha[l, w, i]: log of the summed probability of all segmentations of the first i characters.

    log_p has a row per language and a column per piece, and behind them that of an unknown character.
    """
    alpha = np.full((len(log_p), len(net.lengths), net.width + 1), -np.inf)
    alpha[:, :, 0] = 0.0
    for place, words, logs in net.sums(np.exp(np.maximum(log_p[:, : net.unknown + 1].T, LEAST))):
        alpha[:, words, place] = logs.T
    return alpha


def _together(words: list[str]) -> Iterator[list[str]]:
    """Marked words in order of length, in parts of PLACES places; a longer word is a part of its own."""
    words, a = sorted(words, key=len), 0
    while a < len(words):
        b = a + 1
        while b < len(words) and (b - a + 1) * (len(words[b]) + 1) <= PLACES:
            b += 1
        yield words[a:b]
        a = b


def _expected(counted: Counter, path: str) -> np.ndarray:
    """Expected piece counts of words (with the times of each) when all pieces are equally likely."""
    size = size_of(path)
    # -log(size) for each piece: fewer, longer pieces are likelier.
    log_p = np.full((1, size + 1), -np.log(size))
    log_p[:, size] = UNKNOWN
    total = np.zeros(size)
    for own in _together(list(counted)):
        marked, times = [" " + w for w in own], np.array([counted[w] for w in own], float)
        net = Lattice(marked, path)
        alpha, beta = forward(net, log_p)[0], forward(Lattice(marked, path, backward=True), log_p)[0]
        whole = alpha[np.arange(len(own)), net.lengths]
        for _, _, (word, start, end, piece) in net.blocks():
            known = piece < size
            word, start, end, piece = word[known], start[known], end[known], piece[known]
            share = np.exp(alpha[word, start] - np.log(size) + beta[word, net.lengths[word] - end] - whole[word])
            total += np.bincount(piece, share * times[word], size)
    return total


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: dict[str, Counter] = {}

        def told():
            for lang, words in counted.items():
                total = _expected(words, path)
                some = np.flatnonzero(total)
                yield batch(_COUNTS_ARROW, [lang] * len(some), some.astype(np.int32), total[some])
            counted.clear()

        for b in batches:
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                counted.setdefault(lang, Counter()).update(words_of(text))
            if sum(map(len, counted.values())) > COUNTED_WORDS:
                yield from told()
        yield from told()

    return run


class Model:
    """Languages in order, and the log-probability of each piece in each."""

    def __init__(self, languages: list[str], log_p: np.ndarray, path: str):
        self.languages, self.log_p, self.path = languages, log_p, path
        self.p = np.ascontiguousarray(np.exp(np.maximum(log_p[:, : size_of(path) + 1].T, LEAST)))
        self.place: dict[str, int] = {}
        self.scores = np.zeros((1024, len(languages)))

    def word_scores(self, words: list[str]) -> None:
        """Scores the words that are not known yet."""
        if len(self.place) > CACHED_WORDS:
            self.place.clear()
        new = [w for w in dict.fromkeys(words) if w not in self.place]
        while len(self.place) + len(new) > len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
        for own in _together(new):
            net = Lattice([" " + w for w in own], self.path)
            at = len(self.place)
            for place, words_there, logs in net.sums(self.p):
                done = net.lengths[words_there] == place
                self.scores[at + words_there[done]] = logs[done]
            self.place.update(zip(own, range(at, at + len(own)), strict=True))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """A language and its posterior probability (uniform prior) for each text; the first of equals in order of name."""
        out = [(UNDETERMINED, 0.0)] * len(texts)
        split = [words_of(t) if t else [] for t in texts]
        some = [i for i, words in enumerate(split) if any(c.isalpha() for w in words for c in w)]
        if not some or not self.languages:
            return out
        flat = list(itertools.chain.from_iterable(split[i] for i in some))
        self.word_scores(flat)
        heads = np.cumsum([0, *(len(split[i]) for i in some[:-1])])
        total = np.add.reduceat(self.scores[np.fromiter(map(self.place.__getitem__, flat), np.int64, len(flat))], heads, axis=0)
        share = np.exp(total - total.max(axis=1, keepdims=True))
        share /= share.sum(axis=1, keepdims=True)
        for i, best, score in zip(some, share.argmax(axis=1).tolist(), share.max(axis=1).tolist(), strict=True):
            out[i] = (self.languages[best], score)
        return out


def train(docs: DataFrame, vocabulary: str, most: int = TRAINING_DOCS) -> Model:
    """From text and non-null lang of documents that are not held out, about `most` of each language."""
    labelled = ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    sizes = docs.where(labelled).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    share = sizes.select("lang", (F.lit(2.0**31) * F.least(F.lit(1.0), most / F.col("n"))).alias("below"))
    place = F.pmod(F.xxhash64(F.lit(8), "doc_id"), F.lit(1 << 31))
    rows = docs.where(labelled).select("text", "lang", place.alias("place")).join(F.broadcast(share), "lang").where("place < below").select("text", "lang")  # a row for each language
    counts = rows.mapInArrow(_count(vocabulary), "lang string, piece int, expected double").groupBy("lang", "piece").agg(F.sum("expected").alias("expected"))
    table = counts.toArrow()  # bounded: a row for each language and piece
    languages = sorted(set(table["lang"].to_pylist()))
    number = {x: i for i, x in enumerate(languages)}
    size = size_of(vocabulary)
    p = np.full((len(languages), size), SMOOTHING)
    np.add.at(p, (np.array([number[x] for x in table["lang"].to_pylist()], np.int64), table["piece"].to_numpy()), table["expected"].to_numpy())
    log_p = np.full((len(languages), size + 1), UNKNOWN)
    # Rounded, so that the order in which partial sums arrive cannot show in a result.
    log_p[:, :size] = np.round(np.log(p / p.sum(axis=1, keepdims=True)), 6) if len(languages) else 0
    return Model(languages, log_p, vocabulary)


def held_out(doc_id):
    """Whether the crc32 of the id as text is 0 modulo FOLDS; a null id counts as empty text, so it is."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def identify(docs: DataFrame, model: Model | None = None, vocabulary: str | None = None, carry: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, held_out, lang_pred, score; with carry also the row itself, a struct `carried`.

    lang_pred is a language of the training rows, or `und` with score 0 if the text is null or has no
    letter (or if nothing was learned). The score is the posterior probability of lang_pred; of equally
    likely languages the first in order of name is taken. Texts and words of any length are scored whole; every
    row, repeated ones too, is judged by its own text alone, so equal texts get equal answers. A null
    doc_id stays null and counts as held out. An empty table gives no rows; other columns are ignored,
    whatever their names. Without a model one is trained on docs, whose lang is not used otherwise.
    """
    has_columns(docs, "doc_id", "text")
    vocabulary = vocabulary or public_tokenizers.path("piece_bpe_32k.model")
    model = model or train(docs, vocabulary)
    languages, log_p = model.languages, model.log_p.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(languages, log_p.astype(np.float64), vocabulary)
        for b in batches:
            for start, stop in text_slices(b.column(2)):
                part = b.slice(start, stop - start)
                found = own.predict(part.column(2).to_pylist())
                schema = _RESULT_ARROW if not carry else _RESULT_ARROW.append(pa.field("carried", part.column(3).type))
                yield batch(schema, part.column(0), part.column(1), [x for x, _ in found], [y for _, y in found], *part.columns[3:])

    rows = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text", *([F.struct(*(docs[c] for c in docs.columns)).alias("carried")] if carry else []))
    schema = StructType.fromDDL("doc_id long, held_out boolean, lang_pred string, score double")
    return rows.mapInArrow(run, StructType([*schema, *rows.schema[3:]]))
