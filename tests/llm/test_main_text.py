"""Main text: the cut against brute force, whole pages against what they
were made of, marks of every kind, odd pages."""

import random
from html import unescape
from itertools import product

import numpy as np
import pytest

from strata.llm import html_blocks as H
from strata.llm import main_text as M
from strata.llm.queries import op13_main_text

SF = "/root/testdata/sf0.01"
P = M.Cut()


def _value(side, cost, edges):
    return sum(c if not s else 0 for s, c in zip(side, cost, strict=True) if c > 0) + sum(-c if s else 0 for s, c in zip(side, cost, strict=True) if c < 0) + sum(w for u, v, w in edges if side[u] != side[v])


@pytest.mark.parametrize("seed", range(60))
def test_cut_is_the_least_one(seed):
    rng = random.Random(seed)
    n, k = rng.randint(1, 7), rng.randint(1, 3)
    cost = [rng.randint(-2000, 2000) for _ in range(n)]
    parents = [rng.randrange(k) for _ in range(n)]
    ups = [-1, *[rng.randrange(i) for i in range(1, k)]]
    edges = [(i - 1, i, 1200 if parents[i] == parents[i - 1] else 300) for i in range(1, n)] + [(i, n + parents[i], 600) for i in range(n)] + [(n + i, n + u, 1000) for i, u in enumerate(ups) if u >= 0]
    every = cost + [0] * k
    best = min(_value(side, every, edges) for side in product((False, True), repeat=n + k))
    got = M.cut(cost, parents, ups, P)
    assert min(_value((*got, *rest), every, edges) for rest in product((False, True), repeat=k)) == best


def test_flow_without_the_settled_nodes():
    """The maximum flow alone, on a graph where nothing settles at first."""
    rng = random.Random(3)
    for _ in range(40):
        n = rng.randint(2, 8)
        cost = {v: rng.choice([-3, -2, -1, 1, 2, 3]) for v in range(n)}
        edges = {v: {} for v in range(n)}
        for u in range(n):
            for v in range(u):
                if rng.random() < 0.6:
                    edges[u][v] = edges[v][u] = rng.randint(1, 4)
        flat = [(u, v, w) for u in range(n) for v, w in edges[u].items() if v < u]
        kept = M._flow(cost, edges)
        value = lambda side: _value(side, [cost[v] for v in range(n)], flat)
        sides = list(product((False, True), repeat=n))
        best = min(map(value, sides))
        assert value([v in kept for v in range(n)]) == best
        assert len(kept) == max(sum(s) for s in sides if value(s) == best)


def test_neighbours_turn_a_doubtful_block():
    odds = [3000, -500, 3000, -3000, 200, -3000]
    assert M.cut(odds, [0, 0, 0, 1, 1, 1], [-1, -1], P) == [True, True, True, False, False, False]


def _expected(html):
    """The test pages' article, cut out of the text."""
    import re
    at, to = html.find("<article>"), html.find("</article>")
    blocks = re.split(r"</?(?:p|h1|article)>", html[at : to if to >= 0 else None])
    return " ".join(t for t in (" ".join(unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks) if t)


def test_given_pages(spark):
    rows = {r.page_id: r for r in op13_main_text(spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(rows) == len(pages) == 250
    for p in pages:
        assert rows[p.page_id].text == _expected(p.html or ""), p.page_id
        assert rows[p.page_id].n_chars == len(rows[p.page_id].text) and rows[p.page_id].url == p.url


LONG = "It was a long way to the village, and the rain had not stopped since the morning; nobody spoke."
NOISE = {
    "menu": '<ul class="main-menu"><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul>',
    "nav": "<nav><a href=/>Home</a> <a href=/x>More</a></nav>",
    "header": '<header><div>The Daily Paper of the Town.</div></header>',
    "footer": "<footer><p>All rights are with the town, and they were so for long years.</p></footer>",
    "sidebar": f'<div class="sideBar sidebar"><h3>Read this too</h3><p>{LONG}</p></div>',
    "aside": f"<aside><p>{LONG}</p></aside>",
    "cookies": '<div id="cookie-consent"><p>We use cookies to give you the best that this site can give.</p><button>Fine</button></div>',
    "advert": '<div class="ad">Buy the new car today, and drive it home tomorrow.</div>',
    "advert span": '<span class="advert">Buy the new car today.</span>',
    "form": '<form action="/s"><label>Your name, please.</label><input name=q><select><option>One</option></select></form>',
    "script": '<script>if (a < b) document.write("<p>No.</p>");</script><style>p > a {}</style><noscript><p>Turn scripts on, please.</p></noscript>',
    "comments": f'<section id="comments"><article class="comment"><p>{LONG}</p></article><article><p>I was there as well, and it was fine.</p></article></section>',
    "hidden": f'<div style="display: none"><p>{LONG}</p></div><p hidden>Not seen by anybody.</p>',
    "markup": "<!-- <p>an old text</p> --><svg><title>x</title><text>Chart</text></svg><template><p>none</p></template>",
}


def _read(html, odds=None):
    prior = M._design() @ np.array([*M.PRIOR_KIND, *M.PRIOR_LINKS, *M.PRIOR_WORDS, *M.PRIOR_ENDS])
    page = H.parse(html)
    odds = np.clip(prior, -4, 4) if odds is None else odds
    cost = [int(round(odds[c] * M.UNIT)) + e * M.UNIT for c, e in zip(page.cells, page.evidence, strict=True)]
    return " ".join(t for t, keep in zip(page.texts, M.cut(cost, page.parents, page.ups, P), strict=True) if keep)


ARTICLE = f"<h1>A long way</h1><p>{LONG}<p>Rain.</p><ul><li>a coat</li><li>a warm <a href=/h>hat</a></li></ul><p>{LONG}</p>"
TEXT = f"A long way {LONG} Rain. a coat a warm hat {LONG}"


@pytest.mark.parametrize("noise", NOISE)
@pytest.mark.parametrize("frame", ["<article>{}</article>", "<main>{}</main>", '<div class="post-content">{}</div>', '<div role="main"><article>{}</article></div>', '<form id="f"><article>{}</article></form>', '<div class="has-sidebar"><article>{}</article></div>', "<div>{}</div>"])
def test_noise_around_an_article(noise, frame):
    body = frame.format(ARTICLE)
    html = f"<!DOCTYPE html><html><head><title>T</title></head><body class='page menu-open'>{NOISE[noise]}{body}{NOISE[noise]}</body></html>"
    assert _read(html) == TEXT


@pytest.mark.parametrize("noise", [n for n in NOISE if n not in ("header", "menu")])
def test_noise_inside_an_article(noise):
    assert _read(f"<article><h1>A long way</h1><p>{LONG}</p>{NOISE[noise]}<p>Rain.</p></article>") == f"A long way {LONG} Rain."


def test_article_header_and_layout_classes():
    assert _read(f"<article><header><h1>Title</h1></header><p>{LONG}</p></article>") == f"Title {LONG}"
    assert _read(f'<div class="page sidebar-left"><article><p>{LONG}</p></article></div>') == LONG
    assert _read(f'<header class="article-header"><h1>Title</h1></header><article><p>{LONG}</p></article>').endswith(LONG)


def test_parsing():
    texts = lambda h: H.parse(h).texts
    assert texts("a &amp; b&nbsp;&lt;i&gt; &#65;&#x42; &copy 5 < 6 &am") == ["a & b <i> AB © 5 < 6 &am"]
    assert texts("<p>fo<b>o</b>bar<br>x\n\t y</p>") == ["foobar x y"]
    assert texts("<p>a<p>b<div>c<li>d<li>e</div>f") == ["a", "b", "c", "d", "e", "f"]
    assert texts("<table><tr><td>a<td>b<tr><th>c</table>") == ["a", "b", "c"]
    assert texts('<p title="a > b" x=\'>\'>c</p><p title=it\'s>d</p>') == ["c", "d"]
    assert texts("<p>a</p><p clas") == texts("<p>a<!-- b") == texts("<p>a<script>b</p>") == ["a"]
    assert texts("<button>x<button>y</button></button>z") == ["z"]
    assert texts("") == texts(" \n ") == texts("<p></p>") == []
    deep = "<div>" * 50_000 + "x" + "</div>" * 50_000 + "</p></b>" * 50_000
    assert texts(deep) == ["x"]


def test_classifier_learns_from_marked_blocks(spark):
    """Pages whose boilerplate is long sentences and whose articles are short
    items: the fitted odds follow them, not the prior."""
    rows = [(i, f"<nav><p>{LONG}</p></nav><article><ul><li>item {i}</li><li>thing</li></ul></article>") for i in range(30)]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    cells = {(r.cell, r.content): r.n for r in M.marked_cells(pages).collect()}
    assert sum(cells.values()) == 90 and len(cells) == 3
    odds = M.fit(pages)
    long, item = H.parse(f"<p>{LONG}</p>").cells[0], H.parse("<li>item 1</li>").cells[0]
    assert odds[long] < 0 < odds[item]


def test_odd_pages(spark):
    rows = [(1, None, "u", 1), (2, "", "u", 1), (3, f"<article><p>{LONG}</p></article>", None, 2), (3, f"<article><p>{LONG}</p></article>", None, 2), (None, f"<p>{LONG}</p>" * 20_000, "u", None), (4, "<nav>a</nav>", "u", 5)]
    pages = spark.createDataFrame(rows, "page_id long, html string, url string, n_chars int")
    got = sorted(((r.page_id or 0, r.text, r.n_chars, r.url) for r in M.extract(pages, M.fit(pages)).collect()), key=str)
    whole = " ".join([LONG] * 20_000)
    assert got == sorted([(1, "", 0, "u"), (2, "", 0, "u"), (3, LONG, len(LONG), None), (3, LONG, len(LONG), None), (0, whole, len(whole), "u"), (4, "", 0, "u")], key=str)
    assert M.extract(pages.limit(0), M.fit(pages.limit(0))).count() == 0
