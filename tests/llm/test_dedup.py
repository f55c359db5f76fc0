"""Exact, near and substring duplicates against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tracklake.llm import exact_dedup, ngram_join, substring_dedup
from tracklake.llm.common import byte_array, hash_spans, words

from .conftest import collected

SPACE = re.compile("[\x20\x09-\x0d]+")


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def split(t):
    return [w for w in SPACE.split(t or "") if w]


@pytest.mark.parametrize("first,growth", [(256, 8), (1, 2), (7, 3)])
def test_exact(docs, rows, first, growth):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    want = []
    for i, t in rows:
        own = groups[lower(t)]
        keep = max((x for x in own if x is not None), default=None)
        want.append((i, keep, len(own), hashlib.sha256(lower(t).encode()).hexdigest()))
    out = exact_dedup.duplicates(docs, first, growth)
    assert collected(out, "doc_id", "keep_id", "group_size", "text_sha256") == sorted(want, key=repr)
    kept = Counter(r.text_sha256 for r in out.where("kept").collect())
    assert set(kept.values()) == {1} and len(kept) == len(groups)


def shingles(t):
    w = split(lower(t))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    low = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        low[find(i)].append(doc)
    least = {k: None if None in v else min(v) for k, v in low.items()}
    return sorted(((doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(rows)), key=repr)


def test_near(docs, rows):
    assert collected(ngram_join.near_groups(docs), "doc_id", "n_shingles", "component_id") == near(rows)


def test_near_in_blocks_and_with_frequent_members(docs, rows, monkeypatch):
    """Small limits: every component is cut into bands and blocks, and many members are ordered last."""
    for name, value in (("BLOCK_CLASSES", 2), ("FREQUENT_IN_TASK", 2), ("FREQUENT_IN_ALL", 2)):
        monkeypatch.setattr(ngram_join, name, value)
    assert collected(ngram_join.near_groups(docs), "doc_id", "n_shingles", "component_id") == near(rows)


@pytest.mark.parametrize("most", [1, 2, 5])
def test_near_with_large_postings(docs, rows, monkeypatch, most):
    """Postings of more than a few classes are cut into tiles, and those into blocks; the others give pairs."""
    monkeypatch.setattr(ngram_join, "LARGE_POSTING", most)
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 2)
    assert collected(ngram_join.near_groups(docs), "doc_id", "n_shingles", "component_id") == near(rows)


def test_near_compares_nothing_along_a_chain(spark, monkeypatch):
    """Texts that only share a line with the next one are one component of candidates, but no tile holds them."""
    line = lambda i: " ".join(f"w{i}x{k}" for k in range(12))
    rows = [(i, " ".join(line(j) for j in (i, i + 1, 1000 + i, 2000 + i))) for i in range(120)] + [(500, line(1) + " " + line(2)), (501, line(1) + " " + line(2) + " end")]
    dealt, links = [], ngram_join._links
    monkeypatch.setattr(ngram_join, "_links", lambda classes, *more, **how: dealt.append(classes.count()) or links(classes, *more, **how))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert collected(ngram_join.near_groups(docs), "doc_id", "n_shingles", "component_id") == near(rows)
    assert dealt == [0, 2]


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 600), st.floats(0.8, 1.0), st.integers(0, 99), st.sampled_from([1, 3, 16, 64]))
def test_postings_give_every_link(n, share, seed, most):
    """Sets that link are given as often as they need to be, or lie in one large run."""
    rng = np.random.default_rng(seed)
    x = rng.choice(10**6, n, replace=False)
    sets = [np.sort(x)] + [np.union1d(x[rng.random(n) < share], rng.choice(10**6, int(n * (1 - share)))) for _ in range(5)]
    sets = [s.astype(np.uint64) for s in sets if len(s)]
    parts = []
    for i, s in enumerate(sets):
        size = np.array([len(s)])
        reach = int((ngram_join.prefix_length(size) + ngram_join.needed(size) - 1)[0])
        assert reach <= len(s)
        parts.append(np.concatenate([s[:reach], np.full(reach, i + 1, np.uint64), (len(s) << 32 | np.arange(reach)).astype(np.uint64)]).tobytes())
    out = ngram_join._postings(pa.table({"postings": pa.array(parts, pa.binary())}), most).to_pylist()
    times = {frozenset((r["u"], r["v"])): r["times"] for r in out if r["times"]}
    runs = defaultdict(set)
    for r in out:
        if not r["times"]:
            runs[r["v"]].add(r["u"])
    for i, s in enumerate(sets):
        for j in range(i):
            both, least = len(np.intersect1d(s, sets[j])), min(len(s), len(sets[j]))
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                wanted = ngram_join.needed(np.array([least]))[0]
                assert times.get(frozenset((i + 1, j + 1)), 0) >= wanted or any({i + 1, j + 1} <= run for run in runs.values())


def test_components_of_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001 + i) for i in range(50)] + [(7, 7)]
    out = ngram_join.components(spark.createDataFrame(edges, "u long, v long"))
    assert collected(out, "node", "root") == sorted([(i, 0) for i in range(201)] + [(1000 + i, 1000) for i in range(51)], key=repr)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.floats(0.5, 1.0))
def test_prefix_is_long_enough(n, share):
    """Two sets that link have a common member in the prefixes of any common order."""
    rng = np.random.default_rng(n)
    x = rng.choice(10**6, n, replace=False)
    y = np.concatenate([x[rng.random(n) < share], rng.choice(np.arange(10**6, 2 * 10**6), int(n * (1 - share)), replace=False)])
    both = len(np.intersect1d(x, y))
    if len(y) and 100 * both >= 80 * (len(x) + len(y) - both):
        head = lambda s: set(np.sort(s)[: ngram_join.prefix_length(np.array([len(s)]))[0]])
        assert head(x) & head(y)


def repeats(rows):
    first = {}
    order = lambda i: -(1 << 63) if i is None else i
    for i, t in rows:
        w = split(t)
        for k in range(len(w) - 12):
            key = tuple(w[k : k + 13])
            first[key] = min(first.get(key, order(i)), order(i))
    out = []
    for i, t in rows:
        w = split(t)
        gone = set()
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < order(i):
                gone |= set(range(k, k + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), kept, hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk,slice_bytes", [(8 << 20, 2 << 20), (900, 300)])
def test_repeats(docs, rows, monkeypatch, chunk, slice_bytes):
    monkeypatch.setattr(substring_dedup, "CHUNK_BYTES", chunk)
    monkeypatch.setattr("tracklake.llm.common.SLICE_BYTES", slice_bytes)
    out = substring_dedup.remove_repeats(docs)
    assert collected(out, "doc_id", "n_words", "n_removed", "kept_text", "kept_sha256") == repeats(rows)


def test_repeats_with_frequent_runs_and_split_buckets(docs, rows, monkeypatch):
    """Many runs are ordered last, and each bucket is worked on in parts; the result is the same."""
    for name, value in (("FREQUENT_IN_COUNT", 2), ("COUNTED", 500), ("PART_WORDS", 40), ("HASHED", 64), ("BUCKETS_PER_PARTITION", 1)):
        monkeypatch.setattr(substring_dedup, name, value)
    out = substring_dedup.remove_repeats(docs)
    assert collected(out, "doc_id", "n_words", "n_removed", "kept_text", "kept_sha256") == repeats(rows)


def test_frequent_runs_are_no_minimisers_beside_rare_ones():
    """A phrase that stands in every window is the minimiser of none that holds another run."""
    import pyarrow as pa

    text = " ".join(f"of the w{k} x{k}" for k in range(40))
    phrase = substring_dedup.hash_runs(hash_spans(*(lambda d: (d, *words(d, np.array([0, len(d)]))[:2]))(np.frombuffer(b"of the", np.uint8))), 2)
    chunk = substring_dedup.Chunk(np.array([1]), pa.array([text]), None, phrase, np.zeros(1, np.uint64))
    assert len(chunk.minimiser) and not (chunk.minimiser >> np.uint64(63)).any()
    only = substring_dedup.Chunk(np.array([1]), pa.array(["of the " * 13]), None, phrase, np.zeros(1, np.uint64))
    assert len(only.count) and only.count.sum() >= 26  # windows of nothing else still have a minimiser


def test_equal_hashes_are_checked_word_by_word(monkeypatch):
    """Windows that share a hash but not their words stay apart."""
    monkeypatch.setattr(substring_dedup, "hash_runs", lambda codes, n: np.zeros(len(codes) - n + 1, np.uint64))
    codes = np.array([1] * 13 + [2] * 13 + [1] * 13)
    order, group = substring_dedup._equal_windows(codes, np.array([0, 13, 26]))
    assert len(set(group[np.isin(order, [0, 2])])) == 1 and len(set(group)) == 2


def test_empty_tables(empty):
    for run in (exact_dedup.duplicates, ngram_join.near_groups, substring_dedup.remove_repeats):
        assert run(empty).count() == 0
    with pytest.raises(ValueError, match="missing columns"):
        exact_dedup.duplicates(empty.drop("text"))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab é\t\n\x0b 　", max_size=30), max_size=8))
def test_words_on_bytes(texts):
    import pyarrow as pa

    data, offsets = byte_array(pa.array(texts, pa.string()))
    starts, ends, first = words(data, offsets)
    found = [[data[s:e].tobytes().decode() for s, e in zip(starts[a:b], ends[a:b], strict=True)] for a, b in zip(first[:-1], first[1:], strict=True)]
    assert found == [split(t) for t in texts]
    hashes = hash_spans(data, starts, ends)
    flat = [w for ws in found for w in ws]
    assert len(set(zip(flat, hashes.tolist(), strict=True))) == len(set(flat)) == len(set(hashes.tolist()))
