"""The sources: what each one's payloads look like and which fields they fill.

Every payload table has `payload`; vendor events also have `ticker`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, rules, text
from . import pages, parsers
from .specs import SourceSpec, register

# Sites, categories and feeds of the sources.
SITES = {
    "vietstock": "https://finance.vietstock.vn", "vsdc": "https://vsd.vn", "hsc": "https://www.hsc.com.vn", "cafef": "https://cafef.vn",
}
FEEDS = {
    "vnexpress": "https://vnexpress.net/rss/kinh-doanh.rss",
    "tuoitre": "https://tuoitre.vn/rss/tai-chinh.rss",
    "nld": "https://nld.com.vn/rss/kinh-te.rss",
    "thanhnien": "https://thanhnien.vn/rss/thoi-su.rss",
    "vietnamplus": "https://www.vietnamplus.vn/rss/kinh-te.rss",
}
NOTICE_CATEGORY, BULLETIN_CATEGORY, INSIGHT_CATEGORY = "vsdc_notice", "Bản Tin Thị Trường", "Research Insight"
RESEARCH_CATEGORIES = ("company-note", "sector-note", "strategy-note", "economics-note")


def vendor_rows(payloads: DataFrame) -> DataFrame:
    """Events of a vendor's answer for a ticker; the url is made of ticker and event number."""
    e = payloads.select("ticker", F.explode(parsers.vendor_events(F.col("payload"))).alias("e"))
    name = F.coalesce("e.Name", F.lit(""))
    title = text.first_filled(F.col("e.Title"), F.col("e.Name"))
    return e.select(
        F.concat(F.lit(SITES["vietstock"] + "/"), "ticker", F.lit("/events/"), F.col("e.EventID").cast("string")).alias("url"), title.alias("title"),
        dates.vendor_date(F.coalesce("e.Time", F.lit(""))).alias("publish_time"), F.col("ticker").alias("company_code"), F.col("e.CompanyName").alias("company_name"),
        text.first_filled(text.strip_html(F.col("e.Content")), title).alias("raw_text"), name.alias("category"),
        rules.first_match(F.concat_ws(" ", name, title)).alias("event_type"),
    )


def notice_rows(payloads: DataFrame) -> DataFrame:
    n = payloads.select(F.inline(pages.notices(F.col("payload"), SITES["vsdc"])))
    return n.select("url", "title", F.col("ticker").alias("company_code"), F.col("pub_date").alias("publish_time"), F.col("title").alias("raw_text"), F.lit(NOTICE_CATEGORY).alias("category"))


def feed_rows(name: str):
    """Items of one outlet's feed; no code is known yet, so the event is `other`."""

    def parse(payloads: DataFrame) -> DataFrame:
        i = payloads.select(F.inline(parsers.rss_items(F.col("payload"))))
        iso = F.coalesce(text.blank_to_null(dates.rfc822_date(F.col("pub_date"))), F.col("pub_date"))
        return i.select("url", "title", iso.alias("publish_time"), text.first_filled(F.col("description"), F.col("title")).alias("raw_text"), F.lit(name).alias("category"), F.lit("other").alias("event_type"))

    return parse


def bulletin_rows(payloads: DataFrame) -> DataFrame:
    c = payloads.select(F.inline(parsers.bulletin_cards(F.col("payload"))))
    return c.select("*", F.col("url").alias("pdf_url"), F.lit(BULLETIN_CATEGORY).alias("category"))


def research_rows(payloads: DataFrame) -> DataFrame:
    """Cards of a research listing; the payload table has its `category`."""
    return payloads.select("category", F.inline(parsers.research_cards(F.col("payload"))))


def insight_rows(payloads: DataFrame) -> DataFrame:
    """Details linked by a listing, with the fields of their own page where `page` has been fetched."""
    p = payloads.select(F.explode(parsers.detail_links(F.col("payload"), SITES["hsc"], "/en/research-insights-detail/")).alias("url"), *(["page"] if "page" in payloads.columns else []))
    if "page" not in p.columns:
        return p.select("url", F.lit(INSIGHT_CATEGORY).alias("category"))
    m = p.withColumn("m", parsers.article_meta(F.coalesce("page", F.lit(""))))
    return m.select("url", F.lit(INSIGHT_CATEGORY).alias("category"), "m.title", "m.lead", F.col("m.published").alias("pub_date"), pages.html_body(F.col("page"), "hsc").alias("body"))


def card_rows(payloads: DataFrame) -> DataFrame:
    """Report cards: the report's own broker is its author."""
    c = payloads.select(F.inline(pages.report_cards(F.col("payload"), SITES["vietstock"], "Vietstock")))
    return c.select("title", "url", F.col("url").alias("pdf_url"), "pub_date", F.col("broker").alias("category"))


VENDOR = register(SourceSpec("vietstock", "tier3", vendor_rows))
NOTICES = register(SourceSpec("vsdc", "tier1", notice_rows, members_only=True))
OUTLETS = {n: register(SourceSpec(n, "tier2", feed_rows(n), feed=f)) for n, f in FEEDS.items()}
BULLETINS = register(SourceSpec("ssi", "", bulletin_rows, author="SSI"))
RESEARCH = register(SourceSpec("vndirect", "", research_rows, author="VNDIRECT", language="en"))
INSIGHTS = register(SourceSpec("hsc", "", insight_rows, author="HSC", language="en"))
CARDS = register(SourceSpec("report_cards", "", card_rows))
