"""Pages walked as trees: what stands near a link, cards, article bodies.

The trees are built by the standard library's parser in Arrow batches; everything that
needs no neighbourhood is a native expression in `parsers`.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import normalize_body

# Elements without content, elements whose text is not read, elements that stand on lines of their own.
EMPTY = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT = frozenset(("script", "style", "noscript"))
OWN_LINE = frozenset("address article aside blockquote br dd div dl dt footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th tr ul".split())


class Node:
    """An element: tag, attributes, parent, and its texts and elements in order."""

    __slots__ = ("tag", "attributes", "parent", "parts")

    def __init__(self, tag: str, attributes: dict[str, str], parent: Node | None):
        self.tag, self.attributes, self.parent, self.parts = tag, attributes, parent, []

    def texts(self, lines: bool = False) -> Iterator[str]:
        """Pieces of visible text in order; with `lines` a break around elements on lines of their own."""
        stack: list = [self]
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                yield x
            elif x.tag not in SILENT:
                own = lines and x.tag in OWN_LINE
                stack.extend(["\n"] * own + x.parts[::-1] + ["\n"] * own)

    def text(self, lines: bool = False) -> str:
        return "".join(self.texts(lines))

    def above(self, steps: int) -> Iterator[Node]:
        node = self.parent
        while node is not None and steps:
            yield node
            node, steps = node.parent, steps - 1


class Page(HTMLParser):
    """All elements of a page in document order; end tags that fit nothing are ignored."""

    def __init__(self, page: str):
        super().__init__(convert_charrefs=True)
        self.root = self.open = Node("", {}, None)
        self.nodes: list[Node] = []
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.open)
        self.open.parts.append(node)
        self.nodes.append(node)
        if tag not in EMPTY:
            self.open = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in EMPTY:
            self.open = self.open.parent

    def handle_endtag(self, tag):
        node = self.open
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.open = node.parent

    def handle_data(self, data):
        self.open.parts.append(data)


def walked(one: Callable[[Page], object], of: T.DataType, none: object) -> Callable[..., Column]:
    """Pandas UDF that applies `one` to the tree of each page; null and empty pages give `none`."""

    @F.pandas_udf(of)
    def walk(pages: pd.Series) -> pd.Series:
        return pd.Series([one(Page(p)) if p else none for p in pages], dtype=object)

    return walk


# How a notice link begins, dates written d/m/y.
_NOTICE = re.compile(r"^\s*([A-Z]{3,5})(\d{4,})\s*[:\-]\s*(.+)$")
_DATE = re.compile(r"(\d{1,2}/\d{1,2}/\d{4})")
_CARD_DATES = (re.compile(r"_(\d{1,2}/\d{1,2}/\d{2,4})_"), re.compile(r"(\d{1,2}/\d{1,2}/\d{2,4})"))


def date_near(node: Node, levels: int = 3) -> str:
    """The first d/m/y date in the text of the nearest of a node's ancestors that has one."""
    for up in node.above(levels):
        found = _DATE.search(up.text()) if up.parent is not None or up.tag == "" else None
        if found:
            return found[1]
    return ""


def _notices(page: Page) -> list[dict]:
    out = []
    for a in page.nodes:
        found = _NOTICE.match(a.text().strip()) if a.tag == "a" else None
        href = a.attributes.get("href", "").strip() if found else ""
        if href and not href.startswith("#"):
            out.append({"ticker": found[1], "title": f"{found[1]}{found[2]}: {found[3].strip()}", "href": href, "pub_date": date_near(a)})
    return out


_NOTICE_ROWS = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("ticker", "title", "href", "pub_date")]))


def notices(payload: Column, base: str) -> Column:
    """ticker, title, url and nearby date of the notice links of a listing; other links are left out."""
    found = walked(_notices, _NOTICE_ROWS, [])(payload)
    return F.transform(found, lambda x: F.struct(
        F.when(F.startswith(x["href"], F.lit("http")), x["href"]).otherwise(F.concat(F.lit(base), x["href"])).alias("url"),
        x["title"].alias("title"), x["ticker"].alias("ticker"), x["pub_date"].alias("pub_date"),
    ))


def _report_cards(page: Page, base: str, label: str) -> list[dict]:
    cards = [up for n in page.nodes if n.tag == "img" and "edocs" in n.attributes.get("src", "") for up in [*n.above(2)][1:2] if up.tag]
    cards += [n.parent for n in page.nodes if n.tag == "a" and n.parent.tag and any(w in n.text().lower() for w in ("tải về", "download"))]
    order, seen, out = {id(n): k for k, n in enumerate(page.nodes)}, set(), []
    for card in cards:
        inside = [n for n in page.nodes[order[id(card)] :] if n.tag == "a" and any(up is card for up in n.above(10**6))]
        for a in inside:
            href = a.attributes.get("href", "")
            if not href or href in seen or not any(w in href.lower() for w in ("edoc", "download")):
                continue
            seen.add(href)
            lines = [x for x in (" ".join(y.split()) for y in card.text(lines=True).split("\n")) if x]
            broker = next((x.split(":")[-1].strip() for x in lines if "nguồn:" in x.lower()), label)
            dates = (p.search(x) for x in lines for p in _CARD_DATES)
            out.append({
                "title": lines[0][:100] if lines else "Unknown Report", "url": base + href if href.startswith("/") else href,
                "pub_date": next((d[1] for d in dates if d), ""), "broker": broker,
            })
            break
    return out


def report_cards(payload: Column, base: str, label: str) -> Column:
    """title, url, date and broker of the report cards of a page; each link once, one link per card."""
    of = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("title", "url", "pub_date", "broker")]))
    return walked(lambda page: _report_cards(page, base, label), of, [])(payload)


#: Where a body stands: tag, attribute, part of its value, tag of its parent; "" asks nothing.
Place = tuple[str, str, str, str]
# Body places per source, and those tried after them.
SOURCE_PLACES: dict[str, tuple[Place, ...]] = {
    "cafef": (("div", "class", "detail-content", ""),),
    "hsc": (("section", "class", "container", "main"), ("main", "", "", "")),
    "vndirect": (("div", "class", "content-single", ""), ("div", "class", "section-content", ""), ("main", "", "", "")),
}
BODY_PLACES: tuple[Place, ...] = (
    ("article", "", "", ""), ("div", "class", "article-body", ""), ("div", "class", "post-content", ""), ("div", "class", "entry-content", ""),
    ("div", "itemprop", "articleBody", ""), ("main", "", "", ""),
)


def _is_at(node: Node, place: Place) -> bool:
    tag, attribute, part, parent = place
    value = node.attributes.get(attribute, "")
    fits = part == value if attribute == "itemprop" else part in value
    return node.tag == tag and (not attribute or fits) and (not parent or node.parent.tag == parent)


def found_body(page: Page, places: tuple[Place, ...], least: int) -> str:
    """Text of the longest element of the first place whose longest has at least `least` characters."""
    for place in places:
        best = max((n.text() for n in page.nodes if _is_at(n, place)), key=len, default="")
        if len(best) >= least:
            return best
    return ""


def html_body(payload: Column, source: str = "", max_chars: int | None = 20_000, least: int = 200) -> Column:
    """Article body of a page: normalised lines of the first fitting place of its source, then of any; "" if there is none.

    Bodies of more than max_chars characters keep both ends around a mark.
    """
    places = (*SOURCE_PLACES.get(source, ()), *BODY_PLACES)
    return normalize_body(walked(lambda page: found_body(page, places, least), T.StringType(), "")(payload), max_chars)
