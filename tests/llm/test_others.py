"""Chats, search, language and pages."""

import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tracklake.llm import chat_format, html_text, language_id, topk_search

from .conftest import collected


def test_chats(spark):
    rng = random.Random(2)
    rows = []
    for c in range(60):
        base = rng.randrange(8)
        rows += [(c, k, None if base == 3 and k == 1 else ("user" if k % 2 == 0 else "assistant"), f"text {base} {k}" if rng.random() > 0.05 else None) for k in range(rng.randrange(1, 6))]
    rows += [(None, 0, "user", "lost"), (None, 1, None, None), (70, None, "user", "first"), (70, 0, "user", "next"), (71, 0, "user", "tie b"), (71, 0, "user", "tie a"), (72, 0, "x", "same"), (72, 0, "x", "same")]
    rows += [(80 + k, 0, "user", "hot") for k in range(40)]
    df = spark.createDataFrame([(*r, "extra", 1) for r in rows], "conv_id long, turn int, role string, text string, position string, a int").repartition(5)
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        convs[c].append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    seqs = {c: tuple((x[3], x[5]) for x in sorted(v)) for c, v in convs.items()}
    groups = defaultdict(list)
    for c, s in seqs.items():
        groups[s].append(c)
    want = []
    for s, ids in groups.items():
        if any(len(o) > len(s) and o[: len(s)] == s for o in groups):
            continue
        keep = None if None in ids else min(ids)
        want.append((keep, len(s), len(ids), "\n".join(f"<|im_start|>{r}\n{t}<|im_end|>" for r, t in s)))
    out = chat_format.format_chats(df)
    assert collected(out, "conv_id", "n_turns", "n_logged", "rendered") == sorted(want, key=repr)
    assert chat_format.format_chats(df.where("false")).count() == 0


@pytest.mark.parametrize("block,group", [(32768, 512), (40, 3)])
def test_search(spark, monkeypatch, block, group):
    monkeypatch.setattr(topk_search, "BLOCK_ROWS", block)
    monkeypatch.setattr(topk_search, "QUERY_ROWS", group)
    rng = np.random.default_rng(1)
    rows = [(i, (rng.standard_normal(16) / 4).tolist()) for i in range(400)]
    rows += [(400 + i, rows[50][1]) for i in range(120)]  # ties
    rows += [(600, None), (601, [None] * 16), (602, [math.nan] + [0.0] * 15), (603, [math.inf] * 16), (None, [0.1] * 16), (650, [0.5]), (700, []), (750, [1e9] * 16), (3, rows[3][1])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, block int, vector string").repartition(4)
    usable = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) and abs(x) < topk_search.LARGEST for x in v):
            usable[i] = [math.floor(256 * x) for x in v]
    want = []
    for q, v in usable.items():
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, o, strict=False)), i) for i, o in usable.items() if i != q)
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores[:5])]
    assert collected(topk_search.top_k(df), "query_id", "rank", "vec_id", "score") == sorted(want, key=repr)
    assert topk_search.top_k(df.where("false")).count() == 0
    assert topk_search.top_k(df.where("vec_id in (50, 51)")).count() == 1


def test_search_takes_every_finite_vector(spark):
    """Components of any finite size, and sums that leave 64 bits, against whole numbers."""
    rng = np.random.default_rng(2)
    rows = [(i, (rng.standard_normal(64) * 10.0 ** rng.choice([0, 4, 5])).tolist()) for i in range(300)]
    rows += [(300 + i, [s * 30000.0 / 256] * 64) for i, s in enumerate((1, -1, 1))]
    rows += [(320 + i, [float(s) * 30000] * 64) for i, s in enumerate((1, -1, 1))]
    rows += [(400, [2.0**18] * 64), (401, [-1e9] * 64), (450, [1e300, -1e300] * 32), (451, [1.7e308] + [0.0] * 63), (452, [-1.7e308] * 64), (7, [5e4] * 64), (150, [-3e4] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    whole = [(i, [math.floor(256 * x) if abs(x) < 1e300 else 256 * int(x) for x in v]) for i, v in rows]
    found = {}
    for q, v in whole:
        if q % 50 == 0:
            found.setdefault(q, []).extend((-sum(a * b for a, b in zip(v, o, strict=True)), i) for i, o in whole if i != q)
    want = [(q, k + 1, i, -s if abs(s) < 2**63 else None) for q, scores in found.items() for k, (s, i) in enumerate(sorted(scores)[:5])]
    assert collected(topk_search.top_k(df), "query_id", "rank", "vec_id", "score") == sorted(want, key=repr)


def test_forward_sums_all_segmentations():
    """Against the sum over every way to cut a word."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    known, longest = language_id.pieces(path)
    size = language_id.size_of(path)
    rng = np.random.default_rng(0)
    log_p = np.concatenate([np.log(rng.random((2, size))), np.full((2, 1), language_id.UNKNOWN), np.full((2, 1), -np.inf)], axis=1)
    for word in ("the", "haus", "ñandú", "x", "漢字"):
        part = " " + word

        def ways(at, language, part=part):
            if at == len(part):
                return 1.0
            total = 0.0
            for k in range(1, min(longest, len(part) - at) + 1):
                number = known.get(part[at : at + k], -1)
                if number >= 0:
                    total += math.exp(log_p[language, number]) * ways(at + k, language)
                elif k == 1:
                    total += math.exp(language_id.UNKNOWN) * ways(at + 1, language)
            return total

        alpha = language_id.forward(language_id.lattice([part], path), log_p)
        for language in range(2):
            assert math.isclose(alpha[language, 0, len(part)], math.log(ways(0, language)), rel_tol=1e-9)


@pytest.mark.parametrize("share,scale", [(0.05, 40), (2.0, 40), (0.0, 40), (0.05, 30_000), (0.05, 1)])
def test_index_proves_what_it_leaves_out(monkeypatch, share, scale):
    """Whatever tier a query ends at, no better row is left out, and scores are exact."""
    monkeypatch.setattr(topk_search, "RESCORE_SHARE", share)
    rng = np.random.default_rng(4)
    rows = np.floor(rng.standard_normal((700, 24)) * scale)
    rows[300:340] = rows[5]  # ties
    rows[400] = 0
    queries = np.concatenate([rows[:20], np.zeros((1, 24)), np.floor(rng.standard_normal((10, 24)) * scale * 3)])
    live = rng.random((len(queries), len(rows))) < 0.9
    live[3] = False
    live[4, 3:] = False
    for i, (found, score) in enumerate(topk_search.BlockIndex(rows).search(queries, 5, live)):
        exact = (rows @ queries[i]).astype(int)
        assert (exact[found] == score).all() and live[i, found].all()
        best = sorted((-exact[r], r) for r in np.flatnonzero(live[i]))[:5]
        assert {r for _, r in best} <= set(found.tolist())


def test_many_dimensions_and_large_components(spark):
    """5,000 dimensions, components to 1e9, against whole numbers."""
    rng = np.random.default_rng(6)
    rows = [(i, (rng.standard_normal(5000) * (1e9 if i % 7 == 0 else 1.0)).tolist()) for i in range(40)] + [(50 + i, (rng.standard_normal(5000) * 40).tolist()) for i in range(3)]
    whole = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    want = []
    for q in (0, 50):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], o, strict=True)), i) for i, o in whole.items() if i != q)
        want += [(q, k + 1, i, -s if abs(s) < 2**63 else None) for k, (s, i) in enumerate(scores[:5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    assert collected(topk_search.top_k(df), "query_id", "rank", "vec_id", "score") == sorted(want, key=repr)


def _plain_forward(part, log_p, known, longest):
    """Place by place in logarithms, each word for itself."""
    alpha = np.full((len(log_p), len(part) + 1), -np.inf)
    alpha[:, 0] = 0.0
    for end in range(1, len(part) + 1):
        ways = []
        for k in range(1, min(longest, end) + 1):
            number = known.get(part[end - k : end], -1)
            if number >= 0:
                ways.append(alpha[:, end - k] + log_p[:, number])
            elif k == 1:
                ways.append(alpha[:, end - 1] + language_id.UNKNOWN)
        alpha[:, end] = np.logaddexp.reduce(ways, axis=0)
    return alpha


@pytest.mark.parametrize("places", [1 << 16, 40])
def test_words_of_any_length_are_scored_whole(monkeypatch, places):
    """Many words at once, long ones in blocks, forwards and backwards, against one word at a time."""
    import public_tokenizers

    monkeypatch.setattr(language_id, "PLACES", places)
    path = public_tokenizers.path("piece_bpe_32k.model")
    known, longest = language_id.pieces(path)
    rng = np.random.default_rng(3)
    log_p = np.concatenate([np.log(rng.random((3, len(known))) * 1e-5), np.full((3, 1), language_id.UNKNOWN)], axis=1)
    words = ["a", "house", "geschwindigkeit" * 9, "日本語" * 40, "nai\u0308ve", "ünterthe" * 100, "the" * 300]
    model = language_id.Model(["x", "y", "z"], log_p, path)
    model.word_scores(words)
    for word in words:
        want = _plain_forward(" " + word, log_p, known, longest)[:, -1]
        assert np.allclose(model.scores[model.place[word]], want, rtol=1e-9)
    forth, back = (language_id.Lattice([" " + w for w in words], path, backward=b) for b in (False, True))
    whole = np.arange(len(words)), forth.lengths
    assert np.allclose(language_id.forward(forth, log_p)[:, *whole], language_id.forward(back, log_p)[:, *whole], rtol=1e-9)


def test_words_hold_marks_and_letters_only():
    assert language_id.words_of("Hindi: हिन्दी 2²x cafe\u0301 a_b \u0301q") == ["hindi", "हिन्दी", "²x", "café", "a", "b", "q"]
    assert language_id.words_of(" \t12 _ ...") == []


def test_language(spark):
    rng = random.Random(1)
    voc = {"en": "the of and to in is that with over house water time people".split(), "de": "der die und das nicht mit über haus wasser zeit leute schön".split(), "fr": "le la les et dans avec une maison eau temps gens été".split()}
    rows = [(i, " ".join(rng.choice(voc[lang]) for _ in range(rng.choice([4, 20, 60]))), lang) for i in range(300) for lang in [rng.choice(sorted(voc))]]
    rows += [(1000, None, "en"), (1001, "", "en"), (1002, "12 34 ...", "de"), (1003, "the house", None), (None, "die zeit und das haus", "de"), (1004, "漢字", "en"), (1005, "der die das " * 30_000, None), (7, rows[7][1], rows[7][2])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, held_out int").repartition(3)
    out = {(r.doc_id, r.held_out): r for r in language_id.identify(df).collect()}
    truth = {r[0]: r[2] for r in rows}
    held = [r for (i, _), r in out.items() if r.held_out and i is not None and i < 1000]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for (i, _), r in out.items() if i is not None)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97
    by_id = {i: r for (i, _), r in out.items()}
    assert [by_id[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3 and by_id[1005].lang_pred == "de" and by_id[1003].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in out.values())
    assert language_id.identify(df).count() == len(rows)
    assert language_id.identify(df.where("false")).count() == 0
    assert {r.lang_pred for r in language_id.identify(df.withColumn("lang", df["lang"].substr(9, 1)).where("lang is null")).collect()} == {"und"}


PAGE = """<!DOCTYPE html><html><head><title>Site</title><style>p{{}}</style><script>var a="<p>no</p>";</script></head><body class="has-sidebar">
<header><a href="/">Home</a><p>The best site there is, with a long line of words about itself.</p></header><nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav>
{body}<aside class="sidebar"><h3>Related</h3><p>Read these other long and interesting stories from our pages today.</p></aside>
<div id="comments"><div class="comment"><p>I am a reader and I think this article is wonderful, thank you so much for all of it.</p></div></div>
<form><label>Mail</label><input><button>Go</button></form><footer>&copy; 2024 All rights reserved by the owners of the site.</footer></body></html>"""


@pytest.mark.parametrize(
    "body,text",
    [
        ("<article><h1>A title</h1><p>First   paragraph &amp; more\n text of the article here.</p><p>Short.</p><p>An <a href='x'>in-line link</a> in a sentence of the text.</p></article>", "A title\nFirst paragraph & more text of the article here.\nShort.\nAn in-line link in a sentence of the text."),
        ("<main><p>Only one block of text&nbsp;with a bl<b>ol</b>d part.<br>And a break.</p></main>", "Only one block of text with a blold part. And a break."),
        ("<article><p>Text one is here, and goes on.</p><div class='ad'>Buy this wonderful product now, it is cheap and good for you.</div><p>Text two &#233;t&eacute;.</p></article>", "Text one is here, and goes on.\nText two été."),
        ("<div class='cookie-notice'>We use cookies to make this site better for all of our readers.</div><article><p>Real text.</p>", "Real text."),
        ("<article><table><tr><td>Cell one</td><td>Cell two</td></tr></table><ul><li>Item<li>Other</ul></article>", "Cell one\nCell two\nItem\nOther"),
        ("<div><p>A page without any mark for its article has paragraphs of many words, such as this one right here, which is long.</p><p>And a second paragraph that goes on for quite a number of words as well, so that it is text.</p></div>", "A page without any mark for its article has paragraphs of many words, such as this one right here, which is long.\nAnd a second paragraph that goes on for quite a number of words as well, so that it is text."),
    ],
)
def test_pages(body, text):
    assert html_text.main_text(PAGE.format(body=body)) == text


def test_page_table(spark):
    whole = PAGE.format(body="<article><p>" + "long words " * 30_000 + "</p></article>")
    rows = [(1, "u", None), (2, None, ""), (None, "v", "<p>"), (3, "w", "no markup at all, but a good many words in one line of plain text here"), (4, "x", whole), (4, "x", whole), (5, "y", "<article><p>cut off in a ta")]
    out = html_text.extract(spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string"))
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in out.collect()}
    assert out.count() == len(rows) and all(n == len(t) for t, n in got.values())
    assert got[(1, "u")] == got[(2, None)] == got[(None, "v")] == ("", 0)
    assert got[(4, "x")][1] == 329_999 and got[(5, "y")][0] == "cut off in a ta"
    assert html_text.extract(out.withColumn("html", out["text"]).where("false")).count() == 0


@pytest.mark.parametrize(
    "page",
    [
        "<body><form action='x'><nav><a href='/'>Home</a></nav><article><h1>Title</h1><p>{0}</p></article></form></body>",
        "<body><div class='layout has-sidebar'><article class='post comments-open'><h1>Title</h1><p>{0}</p></article><aside>{1}</aside></div></body>",
        "<body><div class='page with-nav'><main><h1>Title</h1><p>{0}</p></main><div class='comments'><article class='comment'><p>{1}</p></article></div></div></body>",
    ],
)
def test_what_stands_around_an_article_does_not_silence_it(page):
    text = "A paragraph of a good many words that is all the text there is to this article, you see."
    assert html_text.main_text(page.format(text, "Somebody else has written a good many words here.")) == f"Title\n{text}"


def test_nothing_inside_the_article_is_lost():
    links = "".join(f"<p><a href='/{k}'>Link number {k}</a></p>" for k in range(3))
    assert html_text.main_text(f"<body><article><p>One.</p>{links}</article><footer>All rights</footer></body>") == "One.\n" + "\n".join(f"Link number {k}" for k in range(3))
    assert html_text.main_text("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be so.</p></article>") == "Let x=2 be so."


def test_badly_nested_pages_take_time_in_proportion():
    import time

    def seconds(n):
        page = "<article>" + "<div><b><p>word</i>" * n + "</article>"
        begun = time.process_time()
        assert html_text.main_text(page).count("word") == n
        return time.process_time() - begun

    seconds(500)
    assert seconds(16_000) < 24 * seconds(2_000) + 0.5


def test_held_out_blocks():
    """Pages that the table was not made of, as they are and in variants: F1 over blocks, also of a tree without the marks."""
    import pyarrow.parquet as pq

    from . import label_blocks

    x, y = html_text.table()
    marks = [html_text.FEATURES.index(f) for f in ("place", "furniture")]
    bare = x.copy()
    bare[:, marks] = 0
    trees, found = {"all": html_text.tree(), "no marks": html_text.Tree(bare, y)}, defaultdict(lambda: np.zeros(3))
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet")["html"].to_pylist()[100:140]
    for k, html in enumerate(pages):
        for name, page in label_blocks.variants(html, random.Random(1000 + k)):
            rows, labels = (np.array(v) for v in zip(*label_blocks.labelled(page), strict=True))
            for kind, own in trees.items():
                told = own.predict(np.where(np.isin(np.arange(rows.shape[1]), marks), 0, rows) if kind == "no marks" else rows)
                found[kind, name] += [(told & labels).sum(), (told & (1 - labels)).sum(), ((1 - told) & labels).sum()]
    f1 = {k: 2 * a / (2 * a + b + c) for k, (a, b, c) in found.items()}
    assert f1["all", "as it is"] == f1["all", "rich"] == f1["all", "lists in the article"] == f1["all", "rich, in a form with a sidebar"] == 1.0
    assert f1["all", "no marks"] > 0.9 and f1["all", "rich, article not marked"] > 0.9 and f1["no marks", "as it is"] > 0.75


def test_tree_fits_its_table():
    tree = html_text.tree()
    assert tree.predict(np.array([[30, 0, 5, 0, 5, 0, 2, 0, 0], [30, 0, 5, 0, 5, 0, 2, 1, 0]], float)).tolist() == [1, 0]
