"""Queries that parse landed payloads.  The tables hold parsed rows, so each query first
writes the payload a source would have served for a row and then parses it again."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text
from ..session import workspace
from ..sources import parsers, readers, specs
from .records import read

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def _s(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def _escaped(c: str) -> Column:
    """The value as a page holds it; null is empty."""
    value = _s(c)
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        value = F.replace(value, F.lit(char), F.lit(entity))
    return value


_STRIP = "regexp_replace({0}, '^[\\s\\x0b\\x1c-\\x1f\\x85\\p{{Z}}]+|[\\s\\x0b\\x1c-\\x1f\\x85\\p{{Z}}]+$', '', 'g')"
_SQUASH = "trim(regexp_replace({0}, '[\\s\\x1c-\\x1f\\x85\\p{{Z}}]+', ' ', 'g'))"


@query(f"SELECT row_id, url, {_STRIP.format("coalesce(title, '')")} AS title, {_STRIP.format("coalesce(pub_date, '')")} AS pub_date FROM news_articles WHERE {_STRIP.format("coalesce(url, '')")} <> ''")
def feed_items(spark, sf_dir):
    """Items of a feed; the second item of each feed has no link and is left out."""
    item = F.concat(F.lit("<rss><channel><item><title><![CDATA["), _s("title"), F.lit("]]></title><link>"), _s("url"), F.lit("</link><pubDate>"), _s("pub_date"), F.lit("</pubDate></item><item><title>x</title></item></channel></rss>"))
    return read(spark, sf_dir, "news_articles").select("row_id", F.inline(parsers.feed_items(item))).select("row_id", "url", "title", "pub_date")


@query("SELECT row_id, url, substr(coalesce(crawl_time, ''), 1, 10) AS lastmod FROM objective_records WHERE url IS NOT NULL")
def sitemap_urls(spark, sf_dir):
    shard = F.concat(F.lit("<urlset><url>\n <loc>"), F.col("url"), F.lit("</loc><lastmod>"), _s("crawl_time"), F.lit("</lastmod><image:image><image:title>t</image:title></image:image></url></urlset>"))
    rows = read(spark, sf_dir, "objective_records").where("url is not null").select("row_id", F.inline(parsers.sitemap_urls(shard)))
    return rows.select("row_id", "url", "lastmod")


@query("SELECT day, n FROM (SELECT CAST(published_on AS VARCHAR)[1:7] AS day, count(*) AS n FROM documents WHERE published_on IS NOT NULL GROUP BY 1) WHERE day BETWEEN '2025-03' AND '2025-10'")
def shards_in_range(spark, sf_dir):
    """Months whose shard a sitemap index offers within a range."""
    months = read(spark, sf_dir, "documents").where("published_on is not null").groupBy(F.date_format("published_on", "yyyy-M").alias("m")).agg(F.count(F.lit(1)).alias("n"))
    index = F.concat(F.lit("<sitemapindex><sitemap><loc>https://a.example/news-"), F.col("m"), F.lit(".xml</loc></sitemap></sitemapindex>"))
    rows = months.select("n", F.explode(parsers.shards_between(index, "2025-03", "2025-10")).alias("url"))
    month = F.regexp_extract("url", r"(\d{4}-\d{1,2})\.xml", 1)
    return rows.select(F.concat(F.substring(month, 1, 5), F.lpad(F.substring(month, 6, 2), 2, "0")).alias("day"), "n")


@query("SELECT row_id, trim(company_code) AS ticker, " + _SQUASH.format("title") + " AS title FROM objective_records WHERE regexp_full_match(trim(company_code), '[A-Z]{3,5}') AND " + _SQUASH.format("coalesce(title, '')") + " <> ''")
def notice_links(spark, sf_dir):
    """Notices of a listing: number, ticker and title out of link texts with entities; menu links are left out, a notice needs a ticker and a title."""
    label = F.concat(F.trim("company_code"), F.lit("0042: "), _escaped("title"))
    page = F.concat(F.lit('<ul><a href="/menu">menu</a><li><a class="n" href="/ad/'), F.col("row_id"), F.lit('">'), label, F.lit('</a><a href="#">ABC0001: x</a></ul>'))
    rows = read(spark, sf_dir, "objective_records").select("row_id", F.inline(parsers.notice_links(page, "https://a.example")))
    rows = rows.where(F.col("url") == F.concat(F.lit("https://a.example/ad/"), F.col("row_id")))
    return rows.select("row_id", "ticker", text.collapse(text.unescape(F.col("title"))).alias("title"))


@query("SELECT row_id, substr('\"' || coalesce(url, '') || '\">' || coalesce(title, ''), 1, 3000) AS card FROM news_articles")
def listing_cards(spark, sf_dir):
    """Cards of the size that SSI's listings are cut to."""
    page = F.concat(F.lit('<div>x</div><div class="card" href="'), _s("url"), F.lit('">'), _s("title"))
    return read(spark, sf_dir, "news_articles").select("row_id", F.explode(parsers.cards(page, '<div class="card" href=', 3000)).alias("card"))


@query("SELECT row_id, " + _SQUASH.format("coalesce(title, '')") + " AS title, substr(coalesce(lead, ''), 1, 500) AS lead FROM news_articles")
def article_meta(spark, sf_dir):
    """Title and lead of every article, out of pages with entities; null is empty."""
    page = F.concat(F.lit("<head><title>"), _escaped("title"), F.lit('</title><meta name="description" content="'), _escaped("lead"), F.lit('"></head>'))
    return read(spark, sf_dir, "news_articles").select("row_id", parsers.article_meta(page).alias("m")).select("row_id", "m.title", "m.lead")


@query("SELECT row_id, CASE WHEN category IN ('Chứng khoán', 'Ngân hàng') THEN CASE category WHEN 'Chứng khoán' THEN 'stocks' ELSE 'banks' END ELSE '' END AS section FROM news_articles")
def breadcrumb_section(spark, sf_dir):
    slug = F.when(F.col("category") == "Chứng khoán", "stocks").when(F.col("category") == "Ngân hàng", "banks").otherwise("other")
    item = lambda s: F.concat(F.lit('{"item": {"@id": "https://a.example/'), s, F.lit('.chn"}}'))
    page = F.concat(F.lit('<script type="application/ld+json">{"@type": "Org"}</script><script type="application/ld+json">{"@type": "BreadcrumbList", "itemListElement": ['), item(F.lit("home")), F.lit(","), item(slug), F.lit("]}</script>"))
    return read(spark, sf_dir, "news_articles").select("row_id", parsers.breadcrumb_section(page, ["stocks", "banks"], "a.example").alias("section"))


@query("SELECT strftime(date, '%Y-%m-%d') AS day, close, volume FROM index_prices")
def price_payload(spark, sf_dir):
    row = F.to_json(F.array(F.struct(F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit("T00:00:00+07:00")).alias("date"), "close", "volume")))
    payload = F.concat(F.lit('{"data": '), row, F.lit("}"))
    return read(spark, sf_dir, "index_prices").select(F.inline(parsers.price_rows(payload))).select(F.col("date").alias("day"), "close", "volume")


@query("SELECT strftime(date, '%Y-%m-%d') AS day, dxy AS value FROM dxy_rates")
def sentinel_series(spark, sf_dir):
    """A rate series whose missing values are written as a dot."""
    payload = F.concat(F.lit("﻿observation_date,RATE\n"), F.date_format("date", "yyyy-MM-dd"), F.lit(","), F.coalesce(F.col("dxy").cast("string"), F.lit(".")))
    rows = read(spark, sf_dir, "dxy_rates").select(F.inline(parsers.sentinel_series(payload)))
    return rows.select(F.col("date").alias("day"), "value")


@query("SELECT strftime(date, '%Y-%m-%d') AS day, low AS buy, high AS sell FROM index_prices WHERE low IS NOT NULL AND high IS NOT NULL")
def rate_table(spark, sf_dir):
    cell = lambda c: F.concat(F.lit("<td>"), c, F.lit("</td>"))
    amount = lambda c: F.format_number(c, 2)
    page = F.concat(F.lit("<table><tr><td>EUR</td><td>9</td></tr><tr><td>US dollar</td><td>USD</td>"), cell(amount(F.col("low"))), cell(F.lit("-")), cell(amount(F.col("high"))), F.lit("</tr></table>"))
    rates = read(spark, sf_dir, "index_prices").where("low is not null and high is not null").select("date", parsers.rate_table(page, "USD").alias("r"))
    return rates.select(F.date_format("date", "yyyy-MM-dd").alias("day"), "r.buy", "r.sell")


@query("SELECT CAST(row_id AS VARCHAR) AS row_id, coalesce(title, '') AS title, length(coalesce(raw_text, '')) AS chars FROM objective_records")
def csv_scan(spark, sf_dir):
    """Records written as CSV and scanned again: line breaks, quotes and empty values survive."""
    work = workspace(spark, "files")
    out = read(spark, sf_dir, "objective_records").select("row_id", _s("title").alias("title"), _s("raw_text").alias("raw_text"))
    out.write.csv(work, header=True, escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return readers.csv(spark, f"{work}/*.csv").select("row_id", "title", F.length("raw_text").alias("chars"))


@query("SELECT url, min(row_id) AS row_id FROM news_articles WHERE url IS NOT NULL GROUP BY url")
def json_lines_scan(spark, sf_dir):
    """Candidates written as JSON lines with broken ones between; the first of each url stays.

    The lines lie in many files, in row order within and across them.
    """
    work = workspace(spark, "files")
    line = F.to_json(F.struct("row_id", "url"))
    lines = F.explode(F.array(line, F.lit('{"url": broken')))
    read(spark, sf_dir, "news_articles").where("url is not null").orderBy("row_id").select(lines.alias("value")).write.text(work)
    return readers.json_lines(spark, work, "row_id long, url string", "url").select("url", "row_id")


@query("SELECT substr(md5(url), 1, 12) AS key, 'notices' AS source, 'tier1' AS source_tier, count(*) AS n FROM objective_records WHERE url IS NOT NULL GROUP BY ALL")
def source_records(spark, sf_dir):
    """Payload rows through the registry: the sixteen fields, then counted per url."""
    spec = specs.SourceSpec("notices", "tier1", lambda df: df.withColumn("publish_time", _s("publish_time")))
    rows = specs.records_of(spec, read(spark, sf_dir, "objective_records").where("url is not null").select("url", "title", "raw_text", "publish_time", "company_code"), "2026-07-01T00:00:00Z")
    ids = read(spark, sf_dir, "objective_records").where("url is not null").select(specs.ident.document_id(F.lit("notices"), F.col("url")).alias("document_id"), F.substring(F.md5("url"), 1, 12).alias("key")).distinct()
    return rows.groupBy("document_id", "source", "source_tier").agg(F.count(F.lit(1)).alias("n")).join(ids, "document_id").select("key", "source", "source_tier", "n")


@query("SELECT day, coalesce(n, 0) AS n FROM (SELECT strftime(unnest(generate_series(DATE '2024-01-01', DATE '2024-12-01', INTERVAL 1 MONTH)), '%Y-%m') AS day) LEFT JOIN (SELECT CAST(published_on AS VARCHAR)[1:7] AS m, count(*) AS n FROM documents GROUP BY 1) ON m = day")
def window_yield(spark, sf_dir):
    """Documents per month window; windows that yielded nothing are shown with 0."""
    from ..functions import dates

    windows = spark.range(1).select(F.inline(dates.month_windows(F.lit("2024-01-01").cast("date"), F.lit("2024-12-31").cast("date"), 1)))
    counts = read(spark, sf_dir, "documents").groupBy(F.date_format("published_on", "yyyy-MM").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return windows.select(F.date_format("from", "yyyy-MM").alias("day")).join(counts, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


@query("SELECT doc_id, regexp_replace(coalesce(text, ''), '([\\p{L}\\p{N}_])-\\n([\\p{L}\\p{N}_])', '\\1\\2', 'g') AS joined FROM documents")
def dehyphenate(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", text.dehyphenate(_s("text")).alias("joined"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS number FROM events")
def clean_number(spark, sf_dir):
    """Numbers written with thousands separators, and null-like words."""
    written = F.when(F.col("event_id") % 3 == 0, "nan").otherwise(F.format_number("value", 2))
    return read(spark, sf_dir, "events").select("event_id", text.number(written).alias("number"))
