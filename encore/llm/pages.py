"""Main text of web pages by the consensus of their host.

Every page scores its containers and votes for the best one's generalised path (tags and classes, digits made alike).
Votes are counted by host in Spark; then each page is extracted again from the containers on its host's winning path, or,
if it has none, from its own best one.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import fresh, map_rows, saved

#: Bytes of the table of hosts up to which it is sent to every task; a larger one is joined by a shuffle.
BROADCAST_BYTES = 64 << 20
#: Paths of containers nested deeper are told by a digest, so that they have a bounded size.
DEPTH = 40
#: The share of a page's text with which a container counts as its content, though it is a form or its classes name what
#: stands aside beside what does not ("content has-sidebar").
MOST = 0.4

# Fixed lists: tags and class words.
_RAW = frozenset("script style textarea title".split())  # up to their end tag all is theirs
_SKIPPED = "script|style|noscript|template|svg|math|iframe|object|canvas|audio|video|title|textarea|select|button|datalist"
_ASIDE_TAGS = frozenset("nav header footer aside form menu dialog head option label input fieldset".split())
_CONTAINERS = frozenset(
    "html body main article section div nav header footer aside form menu dialog head ul ol dl table tbody tr td "
    "details center fieldset blockquote".split()
)
_BLOCKS = _CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 br hr li dt dd pre address figure figcaption th thead tfoot caption summary hgroup search "
    "option label legend title meta link".split()
)
_VOID = frozenset("br hr img input meta link area base col embed source track wbr".split())
_ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar "
    "nav navbar navigation menu breadcrumb breadcrumbs header footer masthead topbar cookie cookies consent notice notices gdpr "
    "popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended "
    "recommendations comment comments disqus replies reply respond discussion widget widgets toolbar pagination pager copyright "
    "disclaimer alert outbrain taboola".split()
)
_ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu form".split())
_SPEECH = frozenset("comment comments disqus replies reply respond discussion".split())
_GOOD_WORDS = frozenset("article content post entry story main body text".split())
_WEIGHTS = {"article": 2.0, "main": 1.6, "section": 1.1, "body": 0.6, "html": 0.3, "": 0.3}

#: "side" is a word of texts too ("side-effects"): alone, or with a word of layouts.
_SIDE = re.compile(r"(?:^|[\s_-])(?:side(?=$|\s|[_-]?(?:bar|col|column|left|right|nav|menu|panel|box|rail)\b)|(?:left|right)[_-]?side\b)")
_CLOSES = {t: re.compile(rf"</{t}\s*>", re.IGNORECASE) for t in _SKIPPED.split("|")}
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_SKIPPED})\b((?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*)>"
    r"|<(/?)([a-zA-Z][\w:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")


class Node:
    """A container: its path, whether it stands aside, and how much text it holds."""

    __slots__ = ("aside", "depth", "links", "maybe", "parent", "path", "score", "tag", "text", "weight", "whole")

    def __init__(self, tag: str, parent: Node | None, names: dict[str, str]) -> None:
        told = f"{names.get('class', '')}".lower()
        classes = sorted(re.sub(r"\d+", "0", told).split())
        step = ".".join([tag, *classes])
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.path = f"{parent.path}/{step}" if parent else step
        if self.depth > DEPTH:
            self.path = hashlib.blake2b(self.path.encode(), digest_size=16).hexdigest()
        told += " " + names.get("id", "").lower()
        words = set(_WORD.findall(told))
        role = names.get("role", "").lower()
        named = bool(words & _ASIDE_WORDS or _SIDE.search(told))
        self.maybe = False  # aside, unless it holds most of the page
        if tag in ("html", "body", ""):
            own = False
        elif tag in ("article", "main"):
            own = bool(words & _SPEECH)
        else:
            own = tag in _ASIDE_TAGS or role in _ASIDE_ROLES or named
            whole_form = tag in ("form", "fieldset") and not named
            self.maybe = not words & _SPEECH and (whole_form or (tag not in _ASIDE_TAGS and role not in _ASIDE_ROLES and bool(words & _GOOD_WORDS)))
        self.aside = own
        self.weight = _WEIGHTS.get(tag, 1.0) * (1.4 if words & _GOOD_WORDS else 1.0) * (1.6 if role == "main" else 1.0)
        self.score = 0.0
        self.text = self.links = self.whole = 0


def parse(html: str) -> tuple[list[Node], list[tuple[Node, str | None]]]:
    """The containers in page order, and the page's runs of text, each with its container; None marks a block's edge.

    Ends without a begin are left out; a container that is never closed ends with the one around it. What is skipped ends
    with its end tag, at once if it closes itself, and if it has no end tag it is only the tag (scripts and other raw
    text: the rest of the page).
    """
    root = Node("", None, {})
    nodes, runs, stack = [root], [], [root]
    at, links = 0, 0
    opened: Counter[str] = Counter()
    endless: set[str] = set()

    def told(upto: int) -> None:
        if upto > at:
            text = html[at:upto]
            runs.append((stack[-1], text))
            n = len(text) if not text.isspace() else 0
            stack[-1].text += n
            if links:
                stack[-1].links += n

    while m := _TOKEN.search(html, at):
        told(m.start())
        at = m.end()
        if m[1]:
            skipped = m[1].lower()
            if skipped not in _RAW and (m[2].endswith("/") or skipped in endless):
                continue
            end = _CLOSES[skipped].search(html, at)
            if not end:
                endless.add(skipped)
            at = end.end() if end else len(html) if skipped in _RAW else at
            continue
        close, tag = m[3], (m[4] or "").lower()
        if not tag:
            continue
        if tag == "a":
            links = 0 if close else 1
        if tag in _BLOCKS:
            runs.append((stack[-1], None))
            links = 0 if tag in _CONTAINERS else links
        if tag in _CONTAINERS:
            if not close:
                names = {k.lower(): a or b or c for k, a, b, c in _NAMES.findall(m[5])} if m[5] else {}
                node = Node(tag, stack[-1], names)
                nodes.append(node)
                stack.append(node)
                opened[tag] += 1
            elif opened[tag]:
                while True:
                    last = stack.pop()
                    opened[last.tag] -= 1
                    if last.tag == tag:
                        break
    told(len(html))
    for node in reversed(nodes):  # what is in a container comes after it
        node.whole += node.text
        if node.parent and (node.maybe or not node.aside):
            node.parent.whole += node.whole
    for node in nodes:
        if node.maybe and node.whole >= MOST * root.whole:
            node.aside = False
        node.aside = node.aside or bool(node.parent and node.parent.aside)
    return nodes, runs


def best(nodes: list[Node]) -> Node:
    """The container with the most text of its own and of what lies just below it, by its kind; links do not count."""
    for node in nodes:
        if not node.aside:
            own = max(0, node.text - 1.5 * node.links)
            up, share = node, 1.0
            for _ in range(3):
                if up is None:
                    break
                up.score += own * share
                up, share = up.parent, share * 0.7
    return max((n for n in nodes if not n.aside), key=lambda n: n.score * n.weight)


def _text(nodes: list[Node], runs: list[tuple[Node, str | None]], tops: set[int]) -> str:
    """The text of the runs in containers ``tops`` or below, without what stands aside."""
    inside: set[int] = set()
    for node in nodes:  # a container comes before those in it
        if not node.aside and (id(node) in tops or id(node.parent) in inside):
            inside.add(id(node))
    out = [" " if text is None else unescape(text) for node, text in runs if id(node) in inside]
    return " ".join("".join(out).split())


def vote(html: str | None) -> tuple[str, float]:
    """The path of a page's best container and its score."""
    top = best(parse(html or "")[0])
    return top.path, float(top.score * top.weight)


def main_text(html: str | None, path: str | None) -> str:
    """The page's text on the host's path; on its own best container's where the path holds none."""
    nodes, runs = parse(html or "")
    tops = {id(n) for n in nodes if n.path == path and not n.aside}
    text = _text(nodes, runs, tops) if tops else ""
    return text or _text(nodes, runs, {id(best(nodes))})


def extract(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Every row of ``pages`` with ``text`` and ``n_chars`` (its code points).

    New columns replace columns of the same names. Null and empty pages, and pages without text, give an empty text. Pages
    without a host (null or relative addresses) vote together. Each page has one vote, whatever its length; copies vote
    too. Equal votes are decided by the paths' summed scores, then by the path. Pages are read twice and never shuffled,
    unless the table of hosts is larger than ``BROADCAST_BYTES``.
    """
    host, path = fresh("host"), fresh("path")
    name = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))

    def make():
        def work(texts):
            votes = [vote(t) for t in texts]
            return {"path": [p for p, _ in votes], "points": [s for _, s in votes]}

        return work

    cast = map_rows(pages.select(name.alias("host"), F.col(html).alias("html")), ["html"], "path string, points double", make).drop("html")
    counted = cast.groupBy("host", "path").agg(F.count("*").alias("n"), F.round(F.sum("points")).alias("points"))
    winners = counted.groupBy("host").agg(F.max_by("path", F.struct("n", "points", "path")).alias("path"))
    winners = saved(winners.select(F.col("host").alias(host), F.col("path").alias(path)), "hosts")
    weight = winners.agg(F.sum(F.length(host) + F.length(path) + 64)).first()[0] or 0
    if weight <= BROADCAST_BYTES:
        winners = F.broadcast(winners)
    joined = pages.withColumn(fresh("key"), name)
    key = joined.columns[-1]
    joined = joined.join(winners, F.col(key) == F.col(host), "left").drop(key, host)

    def again():
        def work(texts, paths):
            out = [main_text(t, p) for t, p in zip(texts, paths, strict=True)]
            return {"text": out, "n_chars": [len(t) for t in out]}

        return work

    return map_rows(joined, [html, path], "text string, n_chars long", again).drop(path)
