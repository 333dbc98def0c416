"""HTML pages by configured selectors: search listings and detail galleries.

Selectors are the part of CSS that site configurations use: tags, ``.class``,
``#id``, ``[attr]``, ``[attr=value]``, descendants, ``>``, lists by commas, and
``::text`` or ``::attr(name)`` at the end.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements that end an open one of the same name.
SIBLINGS = frozenset("li p option tr td th dt dd".split())
_SIMPLE = re.compile(r"([\w-]+|\*)|\.([\w-]+)|#([\w-]+)|\[([\w-]+)(?:=[\"']?([^\"'\]]*)[\"']?)?\]")


class Node:
    __slots__ = ("tag", "attrs", "parent", "inside")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent, self.inside = tag, attrs, parent, []

    def below(self) -> Iterator[Node]:
        todo = [x for x in reversed(self.inside) if isinstance(x, Node)]
        while todo:
            yield (x := todo.pop())
            todo += [y for y in reversed(x.inside) if isinstance(y, Node)]


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__()
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        if tag in SIBLINGS and self.at.tag == tag:
            self.at = self.at.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.inside.append(node)
        if tag not in VOID:
            self.at = node

    def handle_endtag(self, tag):
        x = self.at
        while x.parent is not None and x.tag != tag:
            x = x.parent
        if x.parent is not None:
            self.at = x.parent

    def handle_data(self, data):
        self.at.inside.append(data)


def parsed(html: str | None) -> Node:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


def _compound(text: str) -> Callable[[Node], bool]:
    tests = []
    for tag, name, ident, attr, value in _SIMPLE.findall(text):
        if tag and tag != "*":
            tests.append(lambda n, t=tag.lower(): n.tag == t)
        elif name:
            tests.append(lambda n, c=name: c in n.attrs.get("class", "").split())
        elif ident:
            tests.append(lambda n, i=ident: n.attrs.get("id") == i)
        elif attr:
            tests.append(lambda n, a=attr.lower(), v=value, any_=f"[{attr}]" in text: a in n.attrs and (any_ or n.attrs[a] == v))
    return lambda n: n.tag != "" and all(t(n) for t in tests)


class Selector:
    """One selector of a configuration; an empty one finds nothing."""

    def __init__(self, text: str | None):
        self.parts = []  # steps, and what is wanted: None, "text" or an attribute's name in brackets
        for part in filter(None, map(str.strip, (text or "").split(","))):
            steps, _, wanted = part.partition("::")
            path = [(arrow == ">", _compound(s)) for arrow, s in re.findall(r"\s*(>)?\s*([^\s>]+)", steps)]
            self.parts.append((path, re.sub(r"^attr|\s", "", wanted) or None))

    def _fits(self, n: Node, path: list, top: Node) -> bool:
        if not path[-1][1](n):
            return False
        if len(path) == 1:
            return not path[0][0] or n.parent is top
        up = n.parent
        while up is not None and up is not top:
            if self._fits(up, path[:-1], top):
                return True
            if path[-1][0]:
                return False
            up = up.parent
        return False

    def nodes(self, top: Node) -> list[Node]:
        return [n for n in top.below() if any(p and self._fits(n, p, top) for p, _ in self.parts)]

    def values(self, top: Node) -> list[str]:
        out = []
        for n in (top, *top.below()):
            for path, wanted in self.parts:
                if wanted is None or (n is not top if not path else n is top or not self._fits(n, path, top)):
                    continue
                if wanted == "text":
                    out += [x for x in n.inside if isinstance(x, str)]
                elif wanted[1:-1] in n.attrs:
                    out.append(n.attrs[wanted[1:-1]])
        return out

    def first(self, top: Node) -> str | None:
        return next((t for v in self.values(top)[:1] if (t := " ".join(v.split()))), None)


def _each_page(pages: DataFrame, rows: Callable[[int, str, Node], list[tuple]], schema: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [r for i, u, h in b.itertuples(index=False) for r in rows(i, u or "", parsed(h))]
            yield pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInPandas(run, schema)


def search_results(pages: DataFrame, search: dict) -> DataFrame:
    """``page_id, url, pos, link, title, snippet, next_page`` of the entries of listing pages; those without a link go.

    ``search`` has ``listing_selector``, ``link_selector``, ``title_selector``,
    ``snippet_selector`` and ``next_page_selector``. Caps by site and keyword
    (:func:`millrace.operators.ingest.first_n`) and fetching are not done here.
    """
    pick = {k: Selector(search.get(f"{k}_selector")) for k in ("listing", "link", "title", "snippet", "next_page")}

    def rows(i: int, url: str, page: Node) -> list[tuple]:
        after = next(iter(pick["next_page"].values(page)), None)
        out = []
        for n in pick["listing"].nodes(page):
            link = next(iter(pick["link"].values(n)), None)
            if link:
                out.append((i, url, len(out), urljoin(url, link), pick["title"].first(n), pick["snippet"].first(n), after and urljoin(url, after)))
        return out

    return _each_page(pages, rows, "page_id long, url string, pos int, link string, title string, snippet string, next_page string")


def detail_images(pages: DataFrame, detail: dict) -> DataFrame:
    """``page_id, url, images, thumbnails, captions`` of detail pages with images that the filters let through.

    ``detail`` has ``gallery_selector``, ``original_attr``, ``thumbnail_attr``,
    ``caption_attrs`` and ``filters`` (``allow_substrings``, ``deny_substrings``).
    Without an original a thumbnail is taken, and the other way round.
    """
    blocks = Selector(detail.get("gallery_selector"))
    allow, deny = (detail.get("filters", {}).get(k, []) for k in ("allow_substrings", "deny_substrings"))
    said = lambda n, a: " ".join(n.attrs.get(a or "", "").split()) or None

    def rows(i: int, url: str, page: Node) -> list[tuple]:
        images, thumbs, captions = [], [], []
        for n in blocks.nodes(page):
            big, small = (x and urljoin(url, x) for x in (said(n, detail.get("original_attr")), said(n, detail.get("thumbnail_attr"))))
            one = big or small
            if one and (not allow or any(s in one for s in allow)) and not any(s in one for s in deny):
                images.append(one)
                thumbs.append(small or one)
                captions.append(next((c for a in detail.get("caption_attrs", []) if (c := said(n, a))), None))
        return [(i, url, images, thumbs, captions)] if images else []

    return _each_page(pages, rows, "page_id long, url string, images array<string>, thumbnails array<string>, captions array<string>")
