"""Main text of HTML by composite text density.

A page is read into a tree (bounded by the page). Menus, headers, footers, asides, scripts, adverts, notices and
reader comments are cut off by element, role or class. Forms, and article and main elements whose class or id names such
a part, may hold the main text: they are cut only if they have less than `SHARE` of the text left outside links, and none
of them if the others would be nearly all of it (`_Tree.cut_small`). For each node left, c characters (without white
space), t tags, lc characters and lt tags inside links give its density

    c / t * log(c / lc * t / lt) to the base ln(c * lc / n + b * c / cb + e),

n being the characters outside links, b and cb the links' and all characters of the body, and counts of 0 taken as 1: text
per tag, less where much of it is linked. A node's density sum adds the densities of its children. The node of the
greatest sum is the core of the text; the least density on the path from it up to the body is the threshold. The text is
the core and, in every other subtree that reaches the threshold, the node of the greatest sum there. Element names only
add to it: the article (or else main) element around a chosen node is taken whole, and with the article around the core
its sibling articles that are not mostly links.

Blocks end at block elements and line breaks; white space inside a block becomes one space, blocks are joined by one
space, character references are decoded. Null, empty and tagless pages give what text they have. Ties go to the node that
begins first.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope.llm.exchange import free_name
from agorascope.llm.ship import ship

# Names of HTML elements by their role, and words of classes that mark what is no main text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math select object canvas audio video".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CUT_TAGS = frozenset("nav footer aside button dialog menu head script style noscript template iframe svg math select textarea object canvas audio video title".split())
CUT_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar tablist".split())
CUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promoted promotion banner cookie cookies consent gdpr "
    "notice notices notification alert sidebar side aside menu menus nav navbar navigation breadcrumb breadcrumbs footer comment comments "
    "commentlist respond reply replies discussion disqus share sharing social related recommended newsletter subscribe subscription signup "
    "popup modal overlay widget widgets toolbar pagination pager masthead topbar login search outbrain taboola".split()
)
KEEP_WORDS = frozenset("content article main post entry body story text wrapper container page layout".split())
ALWAYS_CUT = frozenset("comment comments commentlist respond replies disqus ad ads advert advertisement sidebar cookie".split())
#: A form or a named article below this share of the text is cut; `BESIDE` characters count as text elsewhere, as a few
#: words in a form are no main text. Forms that leave less than `REST` of the text are the page.
SHARE, BESIDE, REST = 1 / 3, 50, 0.1
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|<!\[CDATA\[.*?\]\]>", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_TAG_LOSS = {"li": ("li", ("ul", "ol", "menu")), "tr": ("tr", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
             "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "option": ("option", ("select",))}


class _Tree:
    """Nodes in page order; texts hang on nodes as (place in the page, node, text)."""

    def __init__(self, page: str):
        self.tag, self.parent, self.cut = ["#"], [-1], [False]
        self.pieces: list[tuple[int, str | None]] = []
        self.forms: list[int] = []
        self.named: list[int] = []
        self._read(page)

    def _add(self, tag: str, parent: int, attributes: str) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.cut.append(self.cut[parent] or self._boilerplate(tag, parent, attributes, len(self.tag) - 1))
        return len(self.tag) - 1

    def _boilerplate(self, tag: str, parent: int, attributes: str, node: int) -> bool:
        if tag in CUT_TAGS:
            return True
        if tag == "form":
            self.forms.append(node)
        if tag == "header" and not self._inside(parent, ("article", "main")):
            return True
        if tag in ("html", "body") or not attributes.strip():
            return False
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
        if "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", "")):
            return True
        role = found.get("role", "").lower()
        if role in CUT_ROLES:
            return True
        if tag == "form":
            return False
        if role == "form":
            self.forms.append(node)
        words = set(re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", f"{found.get('class', '')} {found.get('id', '')}").lower()))
        always = bool(words & ALWAYS_CUT and not {"with", "has", "no"} & words)
        if tag in ("article", "main"):
            if always:
                self.named.append(node)
            return False
        return always or bool(words & CUT_WORDS and not words & KEEP_WORDS)

    def cut_small(self, linked: list[bool]) -> None:
        """Cuts the forms and named articles that hold a small share of the text outside links."""
        plain = [0] * len(self.tag)
        for node, text in self.pieces:
            if text and not self.cut[node] and not linked[node]:
                plain[node] += _size(text)
        for i in range(len(plain) - 1, 0, -1):
            plain[self.parent[i]] += plain[i]
        every = plain[0]
        for nodes, rest in ((self.forms, REST * every), (self.named, 0)):
            small = {i for i in nodes if not self.cut[i] and plain[i] < SHARE * (every + BESIDE)}
            off = [False] * len(plain)
            left = every
            for i in range(1, len(plain)):
                off[i] = i in small or off[self.parent[i]]
                left -= plain[i] * (i in small and not off[self.parent[i]])
            if small and left > rest:
                self.cut = [a or b for a, b in zip(self.cut, off, strict=True)]

    def _inside(self, node: int, tags: tuple[str, ...]) -> bool:
        while node > 0:
            if self.tag[node] in tags:
                return True
            node = self.parent[node]
        return False

    def _read(self, page: str) -> None:
        open_nodes, at, lower = [0], 0, None
        pos = 0
        while True:
            m = _TOKEN.search(page, pos)
            text = page[at : m.start() if m else len(page)]
            if text:
                self.pieces.append((open_nodes[-1], html.unescape(text) if "&" in text else text))
            if not m:
                return
            at = pos = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                self._close(open_nodes, tag)
                continue
            if tag in ENDS_P:
                self._close(open_nodes, "p", ("button", "table", "td", "th", "li", "div", "article", "section", "body", "object"))
            if tag in _TAG_LOSS:
                closes, within = _TAG_LOSS[tag]
                for name in closes.split():
                    self._close(open_nodes, name, within)
            node = self._add(tag, open_nodes[-1], m[3])
            if tag in VOID:
                if tag not in INLINE:
                    self.pieces.append((node, None))
                continue
            if tag in RAW:
                lower = page.lower() if lower is None else lower
                end = lower.find(f"</{tag}", pos)
                end = len(page) if end < 0 else end
                after = page.find(">", end)
                at = pos = len(page) if after < 0 else after + 1
                continue
            if not m[3].endswith("/"):
                open_nodes.append(node)
            if tag not in INLINE:
                self.pieces.append((node, None))

    def _close(self, open_nodes: list[int], tag: str, within: tuple[str, ...] = ()) -> None:
        """Closes the nearest open `tag` with all inside it, unless an element of `within` lies between."""
        for k in range(len(open_nodes) - 1, 0, -1):
            name = self.tag[open_nodes[k]]
            if name == tag:
                if tag not in INLINE:
                    self.pieces.append((open_nodes[k], None))
                del open_nodes[k:]
                return
            if name in within:
                return


def _size(text: str) -> int:
    """Characters without white space."""
    return len(text) - sum(map(text.count, " \t\n\r\f"))


def main_text(page: str | None) -> str:
    """The main text of one page."""
    if not isinstance(page, str) or not page:
        return ""
    tree = _Tree(page)
    n = len(tree.tag)
    chars, link_chars, tags, link_tags = np.zeros(n), np.zeros(n), np.ones(n), np.zeros(n)
    linked = [False] * n
    for i in range(1, n):
        linked[i] = tree.tag[i] == "a" or linked[tree.parent[i]]
        link_tags[i] = linked[i]
    if tree.forms or tree.named:
        tree.cut_small(linked)
    for node, text in tree.pieces:
        if text and not tree.cut[node]:
            size = _size(text)
            chars[node] += size
            link_chars[node] += size * linked[node]
    live = [i for i in range(n) if not tree.cut[i]]
    for i in reversed(live[1:]):
        for total in (chars, link_chars, tags, link_tags):
            total[tree.parent[i]] += total[i]
    body = next((i for i in live if tree.tag[i] == "body"), 0)
    b, cb = link_chars[body], max(chars[body], 1.0)
    density, sums = [0.0] * n, [0.0] * n
    for i in live:
        c = chars[i]
        if c:
            lc, lt = max(link_chars[i], 1.0), max(link_tags[i], 1.0)
            base = math.log(c * lc / max(c - link_chars[i], 1.0) + b * c / cb + math.e)
            density[i] = max(c / tags[i] * math.log(max(c / lc * tags[i] / lt, 1.0 + 1e-9)) / math.log(max(base, 1.1)), 0.0)
    for i in live[1:]:
        sums[tree.parent[i]] += density[i]
    if not live:
        return ""
    core = max(live, key=lambda i: (sums[i], -i))
    path, node = [core], core
    while node > 0 and node != body:
        node = tree.parent[node]
        path.append(node)
    kept = _with_articles(tree, live, core, _chosen(tree, live, core, path, density, sums), chars, link_chars)
    inside = [False] * n
    for i in live:
        inside[i] = i in kept or (i > 0 and inside[tree.parent[i]])
    blocks: list[str] = [""]
    parts: list[str] = []
    for node, text in tree.pieces:
        if not inside[node] or tree.cut[node]:
            if text is None or not tree.cut[node]:
                parts, _ = [], blocks.append("".join(parts))
        elif text is None:
            parts, _ = [], blocks.append("".join(parts))
        else:
            parts.append(text)
    blocks.append("".join(parts))
    return " ".join(x for x in (" ".join(b.split()) for b in blocks) if x)


def _chosen(tree: _Tree, live: list[int], core: int, path: list[int], density: list[float], sums: list[float]) -> set[int]:
    threshold = min(density[i] for i in path)
    children: dict[int, list[int]] = {}
    for i in live[1:]:
        children.setdefault(tree.parent[i], []).append(i)
    best = list(range(len(tree.tag)))  # of each subtree, the node of the greatest sum
    for i in reversed(live):
        for c in children.get(i, ()):
            if (sums[best[c]], -best[c]) > (sums[best[i]], -best[i]):
                best[i] = best[c]
    kept, waiting = {core}, [path[-1]]
    while waiting:
        i = waiting.pop()
        if i in kept:
            continue
        if density[i] >= threshold > 0 and i not in path:
            kept.add(best[i])
        waiting += children.get(i, ())
    return kept


def _with_articles(tree: _Tree, live: list[int], core: int, chosen: set[int], chars: np.ndarray, link_chars: np.ndarray) -> set[int]:
    """The chosen nodes, the articles (or else main elements) around them, and the siblings of the article around the core."""
    around = {name: [0] * len(tree.tag) for name in ("article", "main")}  # the nearest one, 0 without
    for name, nearest in around.items():
        for i in live[1:]:
            nearest[i] = i if tree.tag[i] == name else nearest[tree.parent[i]]
    kept = chosen | {h for i in chosen if (h := around["article"][i] or around["main"][i])}
    own = around["article"][core]
    if own:
        kept |= {i for i in live[1:] if tree.tag[i] == "article" and tree.parent[i] == tree.parent[own] and 2 * link_chars[i] <= chars[i]}
    return kept


def main_texts(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """All columns of `pages`, with `main_text` (a column of that name is replaced)."""
    ship(pages.sparkSession)
    pages = pages.drop(*[c for c in pages.columns if c.lower() == "main_text" and c != html_column])

    @F.pandas_udf("string")
    def extract(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in columns:
            yield column.map(main_text, na_action=None)

    return pages.withColumn(free_name(pages, "main_text"), extract(F.col(html_column).cast("string")))
