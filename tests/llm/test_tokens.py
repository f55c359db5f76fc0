"""Encoding, counting and packing against the tokenizers library."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tracklake.llm import packing, token_counts, vocab, word_codec

from .conftest import collected

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = ["<|endoftext|>", "a<|endoftext|>b <|startoftext|>", "Σίσυφος ΑΣ", "it's we'RE 'tis x''s", "\x1c\x1d a\x85b\xa0c d　e", "İstanbul ǅ ﬁ Å é", "  lead\n\n trail  ", "日本語 テスト 🙂👍🏽", "a​b­c", "1234567 12,5 ½ ²", "\U0001e900 Ა ", "\x00\x7f", "nä̈her"]


@pytest.fixture(scope="session")
def library():
    return {p: Tokenizer.from_file(p) for p in (BYTE, WORD)}


@pytest.fixture(scope="session")
def odd_docs(spark, docs):
    return docs.select("doc_id", "text").union(spark.createDataFrame([(900 + k, t) for k, t in enumerate(ODD)], "doc_id long, text string")).repartition(3)


def test_word_codec(odd_docs, library):
    t = library[WORD]
    want = []
    for r in odd_docs.collect():
        ids = t.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert collected(word_codec.encode(odd_docs), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0x24F) | st.sampled_from("‘’“”—…€'"), max_size=60))
def test_codecs_on_any_text(library, text):
    block = word_codec.compile_lexicon({"the": [1], "then": [2, 3], "hen": [4]} and {w: word_codec.Merger(WORD).merge(w) for w in ("the", "then", "hen", "é")})
    n, ids, decoded = next(word_codec.Codec(block, WORD).encode([text]))
    e = library[WORD].encode(text, add_special_tokens=False).ids
    assert (n, ids) == (len(e), " ".join(map(str, e))) and decoded == library[WORD].decode(e, skip_special_tokens=False)
    assert list(vocab.byte_bpe(BYTE)(text)) == library[BYTE].encode(text, add_special_tokens=False).ids


WIDE = ["the", "Straße", "ΟΔΥΣΣΕΥΣ", "привет", "Мир", "日本語", "한국어", "हिन्दी", "🙂", "👍🏽", "e\u0301", "\u0301", "\u180e", "\u200b", "\u2003", "\u3000", "\x1c", "\x1f", "\x85", "<|endoftext|>", "'s", "'LL", "Ⅷ", "½", "१२", "\u10a0", "\u13a0", "İ", "\U0001e900", "ﬁ", " ", "\n", "x" * 60, "-", "漢" * 30]


def test_frequent_segments_are_worked_out_once(library, monkeypatch):
    """A memory that is full of segments seen once forgets those, not the one that every text has."""
    monkeypatch.setattr(word_codec, "CACHED_SEGMENTS", 8)
    codec = word_codec.Codec(word_codec.compile_lexicon({"the": word_codec.Merger(WORD).merge("the")}), WORD)
    asked = []
    monkeypatch.setattr(codec.merger, "split", lambda s, f=codec.merger.split: asked.append(s) or f(s))
    texts = ["always " + " ".join(f"once{k}x{i} Mixed{k}" for i in range(3)) + " ... \x1c" for k in range(30)]
    exact = library[WORD]
    for t in texts:
        n, ids, decoded = next(codec.encode([t]))
        want = exact.encode(t, add_special_tokens=False).ids
        assert (n, ids, decoded) == (len(want), " ".join(map(str, want)), exact.decode(want, skip_special_tokens=False))
    assert asked.count("always") == 1 and len(codec.ids) < 30


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(WIDE), max_size=12).map("".join), st.text(max_size=30))
def test_word_codec_on_every_script(library, mixed, any_text):
    codec = word_codec.Codec(word_codec.compile_lexicon({w: word_codec.Merger(WORD).merge(w) for w in ("the", "мир", "語")}), WORD)
    for text, (n, ids, decoded) in zip([mixed, any_text], codec.encode([mixed, any_text]), strict=True):
        e = library[WORD].encode(text, add_special_tokens=False).ids
        assert (n, ids) == (len(e), " ".join(map(str, e))) and decoded == library[WORD].decode(e, skip_special_tokens=False)


def test_only_doubtful_segments_are_left_to_the_library(monkeypatch):
    codec = word_codec.Codec(word_codec.compile_lexicon({"the": word_codec.Merger(WORD).merge("the")}), WORD)
    left = []
    exact = codec.exact

    class Watched:
        def encode(self, text, **more):
            left.append(text)
            return exact.encode(text, **more)

        def decode(self, ids, **more):
            return exact.decode(ids, **more)

    codec.exact = Watched()
    list(codec.encode(["Привет мир, the 日本語 text <|endoftext|> one\u200btwo Ελλάς"]))
    assert left == ["<|endoftext|>", "one\u200btwo"]


@pytest.mark.parametrize("heaped", [0, 48, 10**9])
def test_merging_by_list_and_by_heap(library, monkeypatch, heaped):
    rng = random.Random(heaped)
    monkeypatch.setattr(word_codec, "HEAPED", heaped)
    merger = word_codec.Merger(WORD)
    for n in (1, 2, 3, 10, 200):
        for alphabet in ("ab", "etaoinshr", "aééä漢"):
            word = "".join(rng.choice(alphabet) for _ in range(n))
            assert merger.merge(word) == library[WORD].encode(word, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="etaoinshr", min_size=1, max_size=52) | st.text(alphabet="aéä漢😀Ġ1-'", min_size=1, max_size=9), max_size=40), st.sampled_from([1, 3, 1 << 16]))
def test_merging_many_words_together(library, words, rows):
    """Every word gets the ids that it gets alone, whatever its width and the rows of a table."""
    merger = word_codec.Merger(WORD)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(word_codec, "TABLE_ROWS", rows)
        flat, counts = merger.merge_all(words)
    alone = [merger.merge(w) for w in words]
    assert [p.tolist() for p in np.split(flat, np.cumsum(counts))][:-1] == alone
    assert list(merger.tell(flat, counts)) == [("".join(f"{i} " for i in ids), library[WORD].decode(ids, skip_special_tokens=False) + " ") for ids in alone]


def test_new_words_are_not_merged_one_by_one(library, monkeypatch):
    """Words outside the lexicon are merged in tables; only very long ones alone."""
    codec = word_codec.Codec(word_codec.compile_lexicon({}), WORD)
    alone = []
    monkeypatch.setattr(codec.merger, "merge", lambda w, f=codec.merger.merge: alone.append(w) or f(w))
    text = " ".join(f"word{k} Éa{'x' * (k % 40)}, tést&&&" for k in range(200)) + " " + "y" * 60
    n, ids, decoded = next(codec.encode([text]))
    want = library[WORD].encode(text, add_special_tokens=False).ids
    assert (n, ids, decoded) == (len(want), " ".join(map(str, want)), library[WORD].decode(want, skip_special_tokens=False))
    assert alone == ["y" * 60]


def test_counted_words():
    """Segments that are split together give the counts that each gives alone."""
    from collections import Counter

    import pyarrow as pa

    texts = [*ODD, *WIDE, None, "", "the the, The it's ΟΔΥΣΣΕΥΣ \u0301a \u0301a e\u0301 once"] * 2
    want, merger = Counter(), word_codec.Merger(WORD)
    for t in texts:
        for s in word_codec.segments(t) if t else ():
            want.update(merger.split(s))
    found = list(word_codec._count(WORD)(iter([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])])))
    assert {r["word"]: r["times"] for b in found for r in b.to_pylist()} == want


def test_ranks_of_pairs():
    table = {a << 20 | b: a * 7 + b for a in range(60) for b in range(0, 60, 3)}
    ranks = word_codec.Ranks(table)
    left, right = np.repeat(np.arange(70), 70), np.tile(np.arange(70), 70)
    assert ranks.of(left, right).tolist() == [table.get(a << 20 | b, word_codec._UNRANKED) for a, b in zip(left.tolist(), right.tolist(), strict=True)]
    assert (word_codec.Ranks({}).of(left, right) == word_codec._UNRANKED).all()


def test_a_very_long_word(library):
    """200,000 letters without white space, in time that hardly grows faster than the word."""
    rng = random.Random(1)
    word = "".join(rng.choice("etaoinshrdlu") for _ in range(200_000))
    codec = word_codec.Codec(word_codec.compile_lexicon({}), WORD)
    n, ids, _ = next(codec.encode([word]))
    assert ids == " ".join(map(str, library[WORD].encode(word, add_special_tokens=False).ids))


def test_the_lexicon_is_mapped(spark, tmp_path):
    """What is distributed is the block, byte for byte, and it is searched where it is mapped."""
    import mmap

    from pyspark import SparkFiles

    block = word_codec.compile_lexicon({"tap": [1], "top": [2, 3]})
    with open(SparkFiles.get(word_codec.distribute(spark, block)), "rb") as f:
        mapped = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
    lexicon = word_codec.Lexicon(mapped)
    assert bytes(mapped) == block and [lexicon.ids(n) for n in lexicon.numbers(["top", "tap"])] == [[2, 3], [1]]
    assert not any(a.flags.owndata for a in (lexicon.arc, lexicon.target, lexicon.skip, lexicon.outputs))


@settings(max_examples=100, deadline=None)
@given(st.sets(st.text(alphabet="abcé", min_size=1, max_size=6), max_size=40), st.lists(st.text(alphabet="abcé", max_size=7), max_size=20))
def test_automaton(entries, asked):
    table = {w: [len(w), *w.encode()] for w in entries}
    lexicon = word_codec.Lexicon(word_codec.compile_lexicon(table))
    numbers = lexicon.numbers([*asked, *entries])
    assert [lexicon.ids(n) if n >= 0 else None for n in numbers] == [table.get(w) for w in [*asked, *entries]]


def test_automaton_is_minimal():
    """States are right languages: none twice. tap, taps, top, tops share their ends."""
    block = word_codec.compile_lexicon({w: [1] for w in ("tap", "taps", "top", "tops")})
    assert len(word_codec.Lexicon(block).final) == 5


def test_counts_follow_edits(odd_docs, library):
    t = library[BYTE]
    for r in token_counts.count_tokens(odd_docs).join(odd_docs.select("doc_id", "text"), "doc_id").dropDuplicates(["doc_id", "n_chars"]).collect():
        if r.n_chars != len(r.text or ""):
            continue
        text = r.text or ""
        assert r.n_tokens == len(t.encode(text, add_special_tokens=False).ids)
        for e in token_counts.edits_of(r.doc_id, len(text), r.text or ""):
            start = min(max(0, e.start), len(text))
            text = text[:start] + e.text + text[max(start, start + e.length) :]
        assert (r.n_tokens_edited, r.n_chars_edited) == (len(t.encode(text, add_special_tokens=False).ids), len(text))
        if r.n_chars > 20_000:
            assert r.n_chars_encoded < r.n_chars / 2
    assert token_counts.count_tokens(odd_docs).count() == odd_docs.count()


def test_random_edits(library):
    """Long chains of edits, with small leaves, keep counts and sums right."""
    rng = random.Random(3)
    encode = vocab.byte_bpe(BYTE)
    for _ in range(30):
        text = " ".join(rng.choice(["word", "it's", "42", "été", "...", "a", "\n\n", "<|endoftext|>"]) for _ in range(80))
        tree = token_counts.CountTree(text, encode, size=24)
        for _ in range(25):
            start, length = rng.randrange(len(text) + 2), rng.choice([0, 1, 3, 200])
            new = rng.choice(["", " ", "x", "'s", " more words here", "\n", "9"])
            tree.apply(token_counts.Edit(start, length, new))
            start = min(start, len(text))
            text = text[:start] + new + text[start + length :]
            assert tree.text() == text and tree.length == len(text)
            assert tree.total == len(encode(text))


def test_packing(odd_docs, library):
    t = library[BYTE]
    want = defaultdict(int)
    ids_of = {}
    for r in odd_docs.collect():
        ids = [*t.encode(r.text or "", add_special_tokens=False).ids, packing.END_ID]
        want[(r.doc_id, len(ids))] += len(ids)
        ids_of.setdefault((r.doc_id, len(ids)), []).append(np.array(ids, "<u4"))
    got, rows = defaultdict(int), packing.pack(odd_docs).collect()
    sequences = defaultdict(list)
    for r in rows:
        got[(r.doc_id, r.doc_tokens)] += r.length
        assert 0 < r.length <= 2048
        assert r.ids_crc32 in {zlib.crc32(i[r.start : r.start + r.length].tobytes()) for i in ids_of[(r.doc_id, r.doc_tokens)]}
        sequences[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for own in sequences.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 2048
    assert 2048 * len(sequences) - sum(got.values()) < 2048 * 3  # under one sequence for each partition


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_assignment(lengths):
    out = packing.assign(lengths, room=64)
    assert len(out) == -(-sum(lengths) // 64) and all(sum(n for _, _, n in s) <= 64 for s in out)
    pieces = defaultdict(list)
    for s in out:
        for item, start, n in s:
            pieces[item].append((start, n))
    for item, n in enumerate(lengths):
        at = 0
        for start, k in sorted(pieces[item]):
            assert start == at
            at += k
        assert at == n


def test_other_columns_do_not_matter(docs):
    """Columns named like those of a result, or like what operators use inside, change nothing."""
    crowded = docs.withColumns({c: docs["n_chars"] for c in ("n_tokens", "ids_sha256", "start", "length", "sequence_id", "offset", "n_edits", "row", "held_out")})
    for run in (word_codec.encode, token_counts.count_tokens, packing.pack):
        plain = run(docs.select("doc_id", "text"))
        assert collected(run(crowded), *plain.columns) == collected(plain, *plain.columns)


def test_empty_tables(empty):
    for run in (word_codec.encode, token_counts.count_tokens, packing.pack):
        assert run(empty).count() == 0
