"""Makes tracklake/llm/html_blocks.csv: labelled blocks of supplied pages, each page as it is and in variants.

    python -m tests.llm.label_blocks /root/testdata/sf0.01/pages.parquet > tracklake/llm/html_blocks.csv

A supplied page marks its article. Its words get a sign that no page holds, the page is rewritten, and a block is
labelled by whether it holds the sign.
"""

from __future__ import annotations

import csv
import random
import re
import sys
from collections.abc import Iterator

import pyarrow.parquet as pq

from tracklake.llm import html_text

SIGN = "☃"
#: Pages that the table is made of; all others are held out.
PAGES, BLOCKS = 6, 2
_MARKED = re.compile(r"<(article)>(.*?)</article>", re.S)

WORDS = "the a best news all about home world sport weather week contact our read other stories from pages today we use cookies you may like mail letter free rights site one more and of in to terms help shop".split()


def surroundings(rng: random.Random) -> dict[str, str]:
    """What stands around an article, of any size."""
    say = lambda low, high: " ".join(rng.choice(WORDS) for _ in range(rng.randint(low, high)))
    link = lambda: f"<a href='/x'>{say(1, 5)}</a>"
    links = "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(rng.randint(1, 7))) + "</ul>"
    return {
        "links": links,
        "notice": f"<p>{say(4, 25)}</p>",
        "tag_line": f"{link()}<p>{say(2, 16)}</p>",
        "related": f"<h3>{say(1, 3)}</h3><p>{say(5, 30)}</p><p>{link()}</p>",
        "comments": "".join(f"<p>{say(5, 60)}</p>" for _ in range(rng.randint(1, 4))),
        "form": f"<label>{say(1, 3)}</label><input><p>{say(3, 20)}</p><button>{say(1, 1)}</button>",
        "rights": f"<p>{say(3, 15)}</p>{link()}",
        "ad": f"<div class='ad'>{say(4, 25)}</div>",
    }


def signed(html: str) -> str:
    """The page with the sign at each word of its article."""
    inside = lambda m: "<article>" + re.sub(r"(<[^>]*>)|(&[#\w]+;)|([^\s<&]+)", lambda x: x[0] if x[1] or x[2] else x[0] + SIGN, m[2]) + "</article>"
    return _MARKED.sub(inside, html)


def variants(html: str, rng: random.Random) -> Iterator[tuple[str, str]]:
    """(name, page): the page with signs, as it is and rewritten."""
    html = signed(html)
    yield "as it is", html
    article = _MARKED.search(html)[2]
    plain = re.sub(r"<(/?)(?:article|nav|footer|aside|header)\b[^>]*>", r"<\1div>", re.sub(r"<div class=\"?[^>]*>", "<div>", html))
    yield "no marks", plain
    yield "no marks, no headings", re.sub(r"<(/?)h[1-6]>", r"<\1p>", plain)
    x = surroundings(rng)
    around = f"<header>{x['tag_line']}</header><nav>{x['links']}</nav><div class='cookie-notice'>{x['notice']}</div>", f"<aside class='sidebar'>{x['related']}</aside><div id='comments'><div class='comment'>{x['comments']}</div></div><form>{x['form']}</form><footer>{x['rights']}</footer>"
    if rng.random() < 0.5:
        around = f"<nav>{x['links']}</nav>{x['ad']}", f"<footer>{x['rights']}</footer>"
    yield "no marks, other tags", re.sub(r"<(/?)p>", r"<\1div>", plain.replace("<li>", "<p>").replace("</li>", "</p>"))
    yield "rich", f"<body class='has-sidebar'>{around[0]}<article>{article}</article>{around[1]}</body>"
    yield "rich, article not marked", f"<body>{around[0]}<div>{article}</div>{around[1]}</body>"
    yield "rich, in a form with a sidebar", f"<body><form><div class='layout sidebar-right'>{around[0]}<article class='post comments-open'>{article}</article>{around[1]}</div></form></body>"
    yield "in a form, article not marked", f"<body><form><div class='page with-nav'>{around[0]}<div>{article}</div>{around[1]}</div></form></body>"
    yield "links and forms without marks", f"<body><div>{x['links']}</div><div><p>{article}</div><div>{x['links']}</div><div>{x['rights']}</div></body>"
    some = re.findall(rf"[^\s<>&]+{SIGN}", article)[:8]
    listed = "<ul>" + "".join(f"<li>{w}</li>" for w in some[:4]) + "</ul><table><tr>" + "".join(f"<td>{w} {w}</td>" for w in some[4:]) + "</tr></table>"
    yield "lists in the article", f"<body>{around[0]}<article>{article}{listed}</article>{around[1]}</body>"
    yield "lists alone", f"<body>{around[0]}<main>{listed}</main>{around[1]}</body>"
    pieces = re.findall(r"<(?:h1|p)>.*?(?=<(?:h1|p)>|$)", article, re.S)
    for n in (1, 2, 3):
        x = surroundings(rng)
        for name, own in (("first", pieces[:n]), ("last", pieces[-n:]), ("first words", [re.sub(r"((?:[^\s<>]+\s+){3})[^<]*", r"\1", x) for x in pieces[:n]])):
            short = "".join(own)
            yield f"{n} {name}", f"<body>{around[0]}<article>{short}</article>{around[1]}</body>"
            yield f"{n} {name} by class", f"<body>{around[0]}<div class='post-content'>{short}</div>{x['ad']}{around[1]}</body>"
            yield f"{n} {name} alone", f"<body><nav>{x['links']}</nav><main>{short}<p>{some[0]}<br>{some[0]}</p></main>{x['rights']}</body>"
            if name != "first words":
                yield f"{n} {name}, not marked", f"<body>{around[0]}<div>{short}</div>{around[1]}</body>"
    linked = "".join(f"<p><a href='/{k}'>{w}</a></p>" for k, w in enumerate(some[:4]))
    yield "links in the article", f"<body>{around[0]}<article>{article}{linked}{x['ad']}</article>{around[1]}</body>"


def labelled(page: str, most: int | None = None) -> Iterator[tuple[list[float], int]]:
    """Features and label of the blocks of a page with signs; if most, only so many of the article's, from both ends."""
    own = html_text.blocks(page)
    labels = [int(SIGN in b[0]) for b in own]
    at = [k for k, label in enumerate(labels) if label]
    left_out = set(at[most:-most]) if most else set()
    for k, row in enumerate(html_text.describe(own).tolist() if own else []):
        if k not in left_out:
            yield row, labels[k]


def main(path: str) -> None:
    out = csv.writer(sys.stdout, lineterminator="\n")
    out.writerow([*html_text.FEATURES, "article"])
    rows = set()
    for k, html in enumerate(pq.read_table(path)["html"].to_pylist()[:PAGES]):
        for _, page in variants(html, random.Random(k)):
            for row, label in labelled(page, BLOCKS):
                rows.add((*(round(x, 3) for x in row), label))
    out.writerows([f"{x:g}" for x in row] for row in sorted(rows))


if __name__ == "__main__":
    main(sys.argv[1])
