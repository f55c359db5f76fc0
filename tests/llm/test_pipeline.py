"""The stages of the pipeline on a small table, and its whole run."""

import re

import corpus_pipeline
from tracklake.llm import language_id

from .test_dedup import lower, near, repeats


def test_stages(spark, tmp_path):
    import random

    rng = random.Random(4)
    voc = "the of and to in is that with over house water time people river stone green light paper".split()
    text = lambda n: " ".join(rng.choice(voc) + rng.choice(["", "s", "ly"]) for _ in range(n))
    base = [text(60) for _ in range(30)]
    passage = text(55)
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100, base[0].upper()), (101, base[1]), (102, base[2] + " tail"), (103, text(20) + " " + passage + " " + text(20)), (104, text(25) + " " + passage), (105, "123 456"), (106, None), (107, "")]
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or ""), 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, kept_id int")
    texts = dict(rows)
    expected = {i: t for i, t in texts.items() if re.search("[a-z]", lower(t))}
    now = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
        if name == "exact_dedup":
            best = {}
            for i, t in expected.items():
                best[lower(t)] = max(best.get(lower(t), i), i)
            expected = {i: expected[i] for i in best.values()}
        elif name == "ngram_join":
            expected = {i: expected[i] for i, _, c in near(list(expected.items())) if i == c}
        elif name == "substring_dedup":
            expected = {i: (kept if gone else expected[i]) for i, _, gone, kept, _ in repeats(list(expected.items()))}
        if name != "packing":
            assert now.columns == docs.columns
            assert {r.doc_id: r.text for r in now.collect()} == expected, name
            assert name != "substring_dedup" or all(r.n_chars == len(r.text) for r in now.collect())
    assert {r.doc_id for r in now.collect()} == set(expected)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "ngram_join", "substring_dedup", "packing"]
    assert language_id.UNDETERMINED == "und"


def test_run_and_empty(spark, tmp_path, empty):
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_rows_without_an_id_of_their_own(spark, tmp_path):
    """Rows of one doc_id, or of none, are told apart: none is lost, multiplied or given another's text."""
    import random
    from collections import Counter

    rng = random.Random(9)
    voc = "the of and to in is that with over house water time people river stone green light paper".split()
    text = lambda n: " ".join(rng.choice(voc) + rng.choice(["", "s", "ly"]) for _ in range(n))
    a, b, c, d, e, passage = text(60), text(60), text(60), text(60), text(60), text(40)
    near_a = a.rsplit(" ", 1)[0] + " other"
    unique = [(None, text(50 + k)) for k in range(10)] + [(7, text(45)), (7, text(46))]
    rows = [*unique, (1, a), (9, a), (1, b), (None, c), (None, c.upper()), (3, d), (3, "12 34"), (4, passage), (5, passage + " " + e), (5, text(30) + " stays")]
    rows += [(9, near_a)]  # of one group, which two rows with its smallest id name
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, row_key int").repartition(3)
    now, seen = docs, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
        assert now.columns == docs.columns
        seen[name] = Counter((r.doc_id, r.text) for r in now.collect())
    want = Counter(rows)
    del want[(3, "12 34")]
    assert seen["language_id"] == want
    want[(1, a)] = 0  # the copy of 9 goes, and the other text of 1 stays
    one_of = lambda found: [t for i, t in found.elements() if i is None and t.lower() == c]
    assert len(one_of(seen["exact_dedup"])) == 1
    other = one_of(want)
    for t in other:
        want[(None, t)] = 0
    want[(None, one_of(seen["exact_dedup"])[0])] = 1
    assert seen["exact_dedup"] == +want
    named = [x for x in seen["ngram_join"] if x[0] == 9]
    assert len(named) == 1 and named[0][1] in (a, near_a)
    want[(9, a)] = want[(9, near_a)] = 0
    want[named[0]] = 1
    assert seen["ngram_join"] == +want
    want[(5, passage + " " + e)] = 0
    want[(5, e)] = 1
    assert seen["substring_dedup"] == +want
