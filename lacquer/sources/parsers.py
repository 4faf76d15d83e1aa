"""Landed payloads to rows.  Native where Spark has a parser; XML is read in Arrow batches, trees of pages in `pages`."""

from __future__ import annotations

from collections.abc import Callable
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import collapse, strip_html, unescape

EVENT_SCHEMA = (
    "array<struct<EventID:bigint,EventTypeID:bigint,ChannelID:bigint,Code:string,CompanyName:string,Time:string,Name:string,Title:string,Content:string,FileUrl:string>>"
)
PRICE_SCHEMA = "struct<data:array<struct<date:string,open:double,high:double,low:double,close:double,volume:double>>>"


def vendor_events(payload: Column, schema: str = EVENT_SCHEMA) -> Column:
    """Events of a payload [[...]] or [...], with or without a byte order mark; [] if it is no JSON."""
    bare = F.try_parse_json(F.regexp_replace(payload, "^﻿", ""))
    return F.coalesce(F.try_variant_get(bare, "$[0]", schema), F.try_variant_get(bare, "$", schema), F.array().cast(schema))


def price_rows(payload: Column) -> Column:
    """Daily rows of an index payload, dates cut to the day; [] for broken JSON."""
    rows = F.from_json(payload, PRICE_SCHEMA)["data"]
    out = F.transform(rows, lambda r: r.withField("date", F.substring(r["date"], 1, 10)))
    return F.coalesce(out, F.array().cast("array<struct<date:string,open:double,high:double,low:double,close:double,volume:double>>"))


def sentinel_series(lines: Column) -> Column:
    """date, value of a two-column CSV text; a single dot is a missing value."""
    rows = F.split(F.regexp_replace(lines, "﻿", ""), "\r?\n")
    rows = F.filter(F.slice(rows, 2, F.size(rows)), lambda x: F.contains(x, F.lit(",")))
    return F.transform(rows, lambda x: F.struct(
        F.substring(F.substring_index(x, ",", 1), 1, 10).alias("date"), F.nullif(F.trim(F.substring_index(x, ",", -1)), F.lit(".")).try_cast("double").alias("value"),
    ))


def feed_items(payload: Column, linked: str = "") -> Column:
    """Items of an RSS payload that have a link (containing `linked`); malformed feeds give none."""
    items = F.regexp_extract_all(F.coalesce(payload, F.lit("")), F.lit(r"(?s)<item[\s>](.*?)</item>"), F.lit(1))

    def field(item: Column, name: str) -> Column:
        raw = F.regexp_extract(item, rf"(?s)<{name}[^>]*>\s*(?:<!\[CDATA\[(.*?)\]\]>|(.*?))\s*</{name}>", 0)
        inner = F.regexp_replace(F.regexp_replace(raw, rf"(?s)^<{name}[^>]*>\s*(?:<!\[CDATA\[)?|(?:\]\]>)?\s*</{name}>$", ""), r"^\s+|\s+$", "")
        return inner

    out = F.transform(items, lambda i: F.struct(
        field(i, "link").alias("url"), field(i, "title").alias("title"), field(i, "pubDate").alias("pub_date"),
        F.substring(collapse(F.regexp_replace(field(i, "description"), "<[^>]+>", " ")), 1, 500).alias("lead"),
    ))
    return F.filter(out, lambda x: (x["url"] != "") & F.contains(x["url"], F.lit(linked)))


def sitemap_urls(payload: Column) -> Column:
    """loc, lastmod, title of each url of a sitemap shard, character entities resolved."""
    urls = F.regexp_extract_all(F.coalesce(payload, F.lit("")), F.lit(r"(?s)<url>(.*?)</url>"), F.lit(1))
    entities = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&amp;", "&"))

    def part(u: Column, n: str) -> Column:
        inner = F.regexp_extract(u, rf"(?s)<{n}>\s*(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?\s*</{n}>", 1)
        for entity, char in entities:
            inner = F.replace(inner, F.lit(entity), F.lit(char))
        return inner

    return F.transform(urls, lambda u: F.struct(part(u, "loc").alias("url"), F.substring(part(u, "lastmod"), 1, 10).alias("lastmod"), part(u, "image:title").alias("title")))


def shards_between(payload: Column, first: str, last: str, pattern: str = r"(\d{4})-(\d{1,2})\.xml") -> Column:
    """Shard URLs of a sitemap index whose year and month lie between first and last (yyyy-MM), old ones first."""
    locs = F.regexp_extract_all(F.coalesce(payload, F.lit("")), F.lit(r"<loc>\s*([^<]*?)\s*</loc>"), F.lit(1))
    keyed = F.transform(locs, lambda u: F.struct(
        F.concat(F.regexp_extract(u, pattern, 1), F.lit("-"), F.lpad(F.regexp_extract(u, pattern, 2), 2, "0")).alias("month"), u.alias("url"),
    ))
    inside = F.array_sort(F.filter(keyed, lambda s: s["month"].between(first, last)))
    return F.transform(inside, lambda s: s["url"])


def rate_table(payload: Column, code: str) -> Column:
    """(buy, sell): first and last number of the row that names the currency in its first two cells; one number is both."""
    rows = F.regexp_extract_all(F.coalesce(payload, F.lit("")), F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    cells = F.transform(rows, lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)), lambda c: collapse(F.regexp_replace(c, "<[^>]+>", " "))))
    row = F.try_element_at(F.filter(cells, lambda r: F.exists(F.slice(r, 1, 2), lambda c: F.contains(c, F.lit(code)))), F.lit(1))
    digits = F.filter(F.transform(row, lambda c: F.regexp_replace(c, "[, ]", "")), lambda c: c.rlike(r"^\d+(\.\d+)?$"))
    n = F.transform(digits, lambda c: c.try_cast("double"))
    return F.when(F.size(n) > 0, F.struct(F.element_at(n, 1).alias("buy"), F.element_at(n, -1).alias("sell")))


def article_meta(payload: Column) -> Column:
    """title, lead (500 characters) and published (19) of an article page's head."""
    meta = lambda n: F.regexp_extract(payload, rf"""(?is)<meta[^>]+(?:property|name)=["']{n}["'][^>]+content=["']([^"']*)["']""", 1)
    title = F.coalesce(F.nullif(meta("og:title"), F.lit("")), F.regexp_extract(payload, r"(?is)<title[^>]*>(.*?)</title>", 1))
    lead = F.coalesce(F.nullif(meta("og:description"), F.lit("")), meta("description"))
    published = F.substring(F.regexp_extract(payload, r'"datePublished"\s*:\s*"([^"]*)"', 1), 1, 19)
    return F.struct(collapse(unescape(title)).alias("title"), F.substring(unescape(lead), 1, 500).alias("lead"), published.alias("published"))


def breadcrumb_section(payload: Column, allowed: list[str], site: str = "") -> Column:
    """First allowed section that a BreadcrumbList of the page links to, "" if none."""
    blocks = F.regexp_extract_all(F.coalesce(payload, F.lit("")), F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), F.lit(1))
    schema = "struct<`@type`:string,itemListElement:array<struct<item:struct<`@id`:string>>>>"
    crumbs = F.flatten(F.transform(blocks, lambda b: F.when(F.from_json(b, schema)["@type"] == "BreadcrumbList", F.transform(F.from_json(b, schema)["itemListElement"], lambda x: x["item"]["@id"])).otherwise(F.array().cast("array<string>"))))
    slugs = F.transform(crumbs, lambda u: F.regexp_extract(u, rf"{site}/([a-z0-9-]+)\.chn", 1))
    return F.coalesce(F.try_element_at(F.filter(slugs, lambda s: s.isin(*allowed)), F.lit(1)), F.lit(""))


def cards(payload: Column, marker: str, size: int) -> Column:
    """What follows each marker of a listing page, cut to size."""
    parts = F.split(F.coalesce(payload, F.lit("")), marker)
    return F.transform(F.slice(parts, 2, F.size(parts)), lambda c: F.substring(c, 1, size))


#: The notice number keeps ticker and title of a listing link apart.
NOTICE = r"^\s*([A-Z]{3,5})(\d{4,})\s*[:\-]\s*(.+)$"


def notice_links(payload: Column, base: str) -> Column:
    """ticker, title, absolute url of notice links; fragments are skipped."""
    anchors = F.regexp_extract_all(F.coalesce(payload, F.lit("")), F.lit(r"""(?is)(<a\s[^>]*>.*?</a>)"""), F.lit(1))
    out = F.transform(anchors, lambda a: F.struct(
        F.regexp_extract(a, r"""(?is)href\s*=\s*["']([^"']*)["']""", 1).alias("href"), collapse(F.regexp_replace(a, "<[^>]+>", " ")).alias("label"),
    ))
    fit = F.filter(out, lambda x: x["label"].rlike(NOTICE) & ~F.startswith(x["href"], F.lit("#")) & (x["href"] != ""))
    return F.transform(fit, lambda x: F.struct(
        F.regexp_extract(x["label"], NOTICE, 1).alias("ticker"), F.regexp_extract(x["label"], NOTICE, 3).alias("title"),
        F.when(x["href"].rlike("^https?://"), x["href"]).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace(x["href"], "^/+", ""))).alias("url"),
    ))


def rss_items(payload: Column) -> Column:
    """url, title, pub_date and description of the items of a feed that have a link; a feed that is no XML gives none."""
    of = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("url", "title", "pub_date", "description")]))

    def one(feed: str) -> list[dict]:
        try:
            items = ElementTree.fromstring(feed).iter("item")
        except ElementTree.ParseError:
            return []
        at = lambda item, name: (item.findtext(name) or "").strip()
        rows = ({"url": at(i, "link"), "title": at(i, "title"), "pub_date": at(i, "pubDate"), "description": at(i, "description")} for i in items)
        return [r for r in rows if r["url"]]

    @F.pandas_udf(of)
    def parsed(feeds: pd.Series) -> pd.Series:
        return pd.Series([one(x) if x else [] for x in feeds], dtype=object)

    return parsed(payload)


def _cards(payload: Column, marker: str, size: int, fields: dict[str, Callable[[Column], Column]]) -> Column:
    return F.transform(cards(payload, marker, size), lambda c: F.struct(*[f(c).alias(n) for n, f in fields.items()]))


def _inside(pattern: str) -> Callable[[Column], Column]:
    return lambda c: F.regexp_extract(c, pattern, 1)


def _plain(pattern: str) -> Callable[[Column], Column]:
    return lambda c: strip_html(F.regexp_extract(c, pattern, 1))


def bulletin_cards(payload: Column) -> Column:
    """title, url, pub_date and lead of a bulletin listing; a card needs a date and a document to download."""
    found = _cards(payload, "chart__content__item--undetail", 3000, {
        "url": _inside(r'href="(https://[^"]*/analysis-center/report/download/[^"]+)"'), "title": _plain(r'(?s)<a class="titlePost"[^>]*>(.*?)</a>'),
        "pub_date": _inside(r"<span>(\d{2}/\d{2}/\d{4})</span>"), "lead": lambda c: F.substring(_plain(r'(?s)chart__content__item__desc__info">(.*?)</div>')(c), 1, 500),
    })
    return F.filter(found, lambda x: (x["url"] != "") & (x["pub_date"] != ""))


def research_cards(payload: Column) -> Column:
    """title, url, pub_date (d/m/y or "") and lead of a research listing; a card needs a link."""
    day, month, year = _inside(r'date-day">(\d+)</span>'), _inside(r"<sup>/(\d+)</sup>"), _inside(r"Year\s*(\d+)")
    whole = lambda c: F.when((day(c) != "") & (month(c) != "") & (year(c) != ""), F.concat_ws("/", day(c), month(c), year(c))).otherwise("")
    found = _cards(payload, "news-item flex-item", 2500, {
        "url": _inside(r'<h3>\s*<a href="([^"]+)"'), "title": _plain(r"(?s)<h3>\s*<a[^>]*>(.*?)</a>"), "pub_date": whole,
        "lead": lambda c: F.substring(_plain(r"(?s)news-des[^>]*>(.*?)</div>")(c), 1, 500),
    })
    return F.filter(found, lambda x: x["url"] != "")


def detail_links(payload: Column, base: str, path: str) -> Column:
    """Distinct links of a listing under `path`, in order: base, path and the slug of a to z, 0 to 9 and -."""
    slugs = F.regexp_extract_all(F.coalesce(payload, F.lit("")), F.lit(f"{path}([a-z0-9-]+)"), F.lit(1))
    return F.transform(F.array_sort(F.array_distinct(slugs)), lambda s: F.concat(F.lit(base + path), s))
