"""Main text of pages."""

from __future__ import annotations

import re
import time
from html import unescape

import pytest

from encore.llm import pages, queries


def test_query_takes_the_article(spark, sf):
    """On pages whose article has no other containers, the text is all that it holds."""
    rows = queries.QUERIES["op8_pages"](spark, sf).collect()
    html = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    assert len(rows) == len(html)
    for r in rows:
        body = re.search(r"<article>(.*?)</article>", html[r.page_id], re.DOTALL)[1]
        body = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|br|h1)>", " ", body))
        assert r.text == " ".join(unescape(body).split()) and r.n_chars == len(r.text)


PAGE = """<!DOCTYPE html><html><body class="with-sidebar"><div id="cookie-notice">We use cookies</div><header><h1>Site</h1></header>
<div class="menu"><a href=x>Menu</a></div><main><div class="post-{n} content"><h1>Title &amp; more</h1><p>First para
<b>bold</b>text.</p><div class="ad-box">Buy!</div><p>Second<br>line &nbsp; x</p><form>name <input></form>
<section class="comments"><article class=comment><p>{comment}</p></article></section></div></main>
<aside>side</aside><footer>foot</footer><script>var a = "<p>no</p>";</script></body>"""


def test_boilerplate_hosts_and_odd_pages(spark):
    rows = [(i, "https://a.example/x", PAGE.replace("{n}", str(i)).replace("{comment}", "long reader comment " * (1 + 40 * (i == 2))), "t") for i in range(5)]
    rows += [(10, None, "plain <i>te</i>xt &lt;x&gt; &#233;", ""), (11, None, None, ""), (12, "", "", ""), (13, "x", "<p>a<p>b<!-- c --><style>p{}</style>", "")]
    rows += [(14, "https://a.example/y", "<div class=other><p>no such path here</p></div>", ""), (15, "https://b.example", "<div>x" * 3000, "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").selectExpr("*", "1 AS path", "2 AS host", "3 AS points")
    got = {r.page_id: r.text for r in pages.extract(df).collect()}
    assert {got[i] for i in range(5)} == {"Title & more First para boldtext. Second line x"}
    assert got[10] == "plain text <x> é"
    assert (got[11], got[12], got[13], got[14]) == ("", "", "a b", "no such path here")
    assert len(got[15].split()) == 3000
    assert pages.extract(df.limit(0)).count() == 0


def test_votes_beat_a_page_of_its_own(spark):
    """A page whose best container differs is extracted by its host's path."""
    page = "<body><div class=story><p>{a}</p></div><div class=more><p>{b}</p></div></body>"
    rows = [(i, "http://h.example/", page.format(a="main text " * 30, b="other " * 3), "") for i in range(4)]
    rows.append((4, "http://h.example/", page.format(a="short main text", b="much longer other text " * 50), ""))
    got = {r.page_id: r.text for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string, x string")).collect()}
    assert got[4] == "short main text"


def test_odd_markup_takes_linear_time():
    began = time.time()
    for html in ('<a "' * 50_000, "<div>x" * 10_000, "<p title='" * 30_000, "<!--" * 50_000, "<script>" * 30_000, "</div>" * 50_000, "<" * 100_000,
                 "<div>" * 100_000, "<div></p>" * 20_000 + "</section>" * 20_000, "<div></section>" * 50_000, "<button>" * 50_000, "<svg/>" * 50_000):
        pages.main_text(html, None)
    assert time.time() - began < 60


ARTICLE = "<h1>Title</h1><p>The first paragraph of the text.</p><p>The second one.</p>"
TEXT = "Title The first paragraph of the text. The second one."


@pytest.mark.parametrize("html", [
    f'<body><svg viewBox="0 0 1 1" /><main>{ARTICLE}</main></body>',
    f'<body><iframe src="x"/><main>{ARTICLE}</main></body>',
    f"<body><main><button>{ARTICLE}</main></body>",
    f'<body><div class="content has-sidebar">{ARTICLE}<div class="sidebar">links</div></div></body>',
    f'<body><div class="post-content widget-area">{ARTICLE}</div><div class="box"><p>tiny</p></div></body>',
    f'<body><form action="/x"><div class="top-nav">Menu</div><div class="content">{ARTICLE}</div><footer>foot</footer></form></body>',
    f'<body><form><fieldset><div class="content has-sidebar">{ARTICLE}</div></fieldset></form></body>',
])
def test_articles_in_odd_containers(html):
    assert pages.main_text(html, None) == TEXT


def test_words_of_the_text_are_no_layout():
    html = '<body><main><p>Before.</p><div class="side-effects"><p>Rare ones.</p></div><div class="side-bar">Links</div><div class="left-side">More</div></main></body>'
    assert pages.main_text(html, None) == "Before. Rare ones."
    long = "<p>reader says a lot</p>" * 50
    assert pages.main_text(f'<body><main>{ARTICLE}</main><div class="post-comments content">{long}</div></body>', None) == TEXT
    assert pages.main_text("<body><main><p>a</p><select><option>b</select><p>c</p></main></body>", None) == "a c"


def test_deep_containers_have_paths_of_their_own():
    deep = "<div>" * 60
    html = f'<body>{deep}<section class="a"><p>one text here</p></section><section class="b"><p>other</p></section>'
    nodes, _ = pages.parse(html)
    paths = [n.path for n in nodes if n.tag == "section"]
    assert len(set(paths)) == 2 and max(len(n.path) for n in nodes) < 400
    assert pages.main_text(html, paths[1]) == "other"


def test_winners_are_the_counted_votes(spark, sf):
    """The votes of all hosts, counted by hand: most pages, then summed scores, then the path."""
    rows = spark.read.parquet(f"{sf}/pages.parquet").collect()
    odd = "<body><div class=a><p>some words here</p></div><div class=b><p>other words now</p></div></body>"  # equal votes
    rows = [(r.page_id, r.url, r.html) for r in rows] + [(9000 + i, "http://tie.example/", odd if i % 2 else odd.replace("some words here", "x")) for i in range(4)]
    votes: dict = {}
    for _, url, html in rows:
        host = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", url)
        path, points = pages.vote(html)
        n, total = votes.setdefault(host[1].lower() if host else "", {}).get(path, (0, 0.0))
        votes[host[1].lower() if host else ""][path] = (n + 1, total + points)
    winner = {h: max((n, round(total), p) for p, (n, total) in of.items())[2] for h, of in votes.items()}
    got = {r.page_id: r.text for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for page_id, url, html in rows:
        host = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", url)
        assert got[page_id] == pages.main_text(html, winner[host[1].lower() if host else ""])
