"""Queries on sources: payloads of every row written as a source serves them, then parsed into its records or articles."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, rules, text
from ..session import workspace
from ..sources import archive, outlets, pages, readers, runs, sinks, specs
from .payloads import _STRIP, _escaped, _s
from .records import _SPACE, read

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
CRAWLED = "2026-07-12T02:00:00Z"


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def _flat(records: DataFrame) -> DataFrame:
    """Records with their lists as text, so that all sixteen fields compare."""
    return records.withColumn("attachment_urls", F.to_json("attachment_urls"))


_FORM = lambda c: f"trim(regexp_replace(regexp_replace(lower(nfc_normalize({c})), '<[^>]+>', ' ', 'g'), '{_SPACE}', ' ', 'g'))"
_PLAIN = lambda c: f"trim(regexp_replace(regexp_replace({c}, '<[^>]+>', ' ', 'g'), '{_SPACE}', ' ', 'g'))"
_KIND = lambda c: "CASE " + " ".join(f"WHEN contains(lower({c}), '{w}') THEN '{v}'" for w, v in rules.EVENT_RULES) + " ELSE 'other' END"
_CODE = "regexp_extract(upper(trim(coalesce(company_code, ''))), '^[A-Z]{3,5}$')"


def _record_sql(rows: str, source: str, tier: str) -> str:
    """The sixteen fields over rows of url, publish_time, company_code, company_name, title, raw_text, category, event_type."""
    return f"""SELECT substr(sha1('{source}|' || url), 1, 16) AS document_id, '{source}' AS source, '{tier}' AS source_tier, url, publish_time, '{CRAWLED}' AS crawl_time, company_code, company_name,
title, raw_text, 'vi' AS language, category, event_type, '[]' AS attachment_urls, sha256({_FORM("raw_text")}) AS checksum, '' AS raw_path FROM ({rows})"""


@query(_record_sql(f"""SELECT 'https://finance.vietstock.vn/' || code || '/events/' || row_id AS url, substr(crawl_time, 1, 19) || 'Z' AS publish_time, code AS company_code, coalesce(company_name, '') AS company_name,
  headline AS title, coalesce(nullif({_PLAIN("coalesce(raw_text, '')")}, ''), headline) AS raw_text, section AS category, {_KIND("section || ' ' || headline")} AS event_type FROM (
  SELECT row_id, crawl_time, company_name, raw_text, coalesce(nullif(title, ''), nullif(category, ''), '') AS headline, coalesce(category, '') AS section, {_CODE} AS code FROM objective_records) WHERE code <> ''""", "vietstock", "tier3"))
def vendor_records(spark, sf_dir):
    """Events of every coded record through the vendor's nested answers, one per ticker and event."""
    r = read(spark, sf_dir, "objective_records").withColumn("ticker", F.regexp_extract(F.upper(F.trim(_s("company_code"))), "^[A-Z]{3,5}$", 0)).where("ticker <> ''")
    ms = F.unix_millis(F.try_to_timestamp("crawl_time", F.lit("yyyy-MM-dd'T'HH:mm:ssX")))
    event = F.struct(
        F.col("row_id").alias("EventID"), F.col("title").alias("Title"), F.col("category").alias("Name"), F.col("company_name").alias("CompanyName"),
        F.col("raw_text").alias("Content"), F.concat(F.lit("/Date("), ms.cast("string"), F.lit(")/")).alias("Time"),
    )
    payloads = r.select("ticker", F.concat(F.lit("﻿[["), F.to_json(event), F.lit("]]")).alias("payload"))
    return _flat(specs.records_of(outlets.VENDOR, payloads, CRAWLED))


@query(_record_sql(f"""SELECT 'https://vsd.vn/vi/ad/' || r.row_id AS url, CASE WHEN r.row_id % 3 = 0 THEN '' ELSE strftime(CAST(substr(crawl_time, 1, 10) AS DATE), '%Y-%m-%dT00:00:00Z') END AS publish_time, u.ticker AS company_code, u.company_name,
  u.ticker || '0' || (1000 + r.row_id) || ': ' || t AS title, u.ticker || '0' || (1000 + r.row_id) || ': ' || t AS raw_text, 'vsdc_notice' AS category, {_KIND("u.ticker || '0' || (1000 + r.row_id) || ': ' || t")} AS event_type
  FROM (SELECT *, trim(regexp_replace(coalesce(title, ''), '{_SPACE}', ' ', 'g')) AS t FROM objective_records) r JOIN universe u ON {_CODE} = u.ticker WHERE t <> ''""", "vsdc", "tier1"))
def notice_records(spark, sf_dir):
    """Notices of the members' listing, their date near the link or absent, the member's name from the universe."""
    r = read(spark, sf_dir, "objective_records").withColumn("code", F.regexp_extract(F.upper(F.trim(_s("company_code"))), "^[A-Z]{3,5}$", 0)).where("code <> ''")
    title = text.collapse(_s("title"))
    day = F.date_format(F.substring("crawl_time", 1, 10).cast("date"), "dd/MM/yyyy")
    near = F.when(F.col("row_id") % 3 == 0, "").when(F.col("row_id") % 3 == 1, F.concat(F.lit("<i>"), day, F.lit("</i>"))).otherwise(F.concat(F.lit("<b>x</b> "), day))
    link = F.concat(F.lit('<a href="/vi/ad/'), F.col("row_id").cast("string"), F.lit('">'), "code", F.lit("0"), (F.col("row_id") + 1000).cast("string"), F.lit(": "), "t", F.lit("</a>"))
    rows = r.withColumn("t", title).where("t <> ''").drop("title").withColumnRenamed("t", "title").withColumn("t", _escaped("title"))
    page = F.concat(F.lit('<nav><a href="/vi">menu</a></nav><ul><li><h3>'), link, F.lit('</h3> <a href="#">VNM0001: x</a><p>'), near, F.lit("</p></li></ul>"))
    return _flat(specs.records_of(outlets.NOTICES, rows.select(page.alias("payload")), CRAWLED, read(spark, sf_dir, "universe")))


_UNFIT = "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x{FFFE}\\x{FFFF}]"


@query(_record_sql(f"""SELECT 'https://a.example/' || row_id AS url, coalesce(strftime(TRY_CAST(substr(collected_at, 1, 10) AS DATE) + INTERVAL 5 HOUR, '%Y-%m-%dT%H:%M:%SZ'), '') AS publish_time, '' AS company_code, '' AS company_name, t AS title, coalesce(nullif(l, ''), t) AS raw_text,
  'tuoitre' AS category, 'other' AS event_type FROM (SELECT row_id, collected_at, {_STRIP.format("coalesce(title, '')")} AS t, {_STRIP.format("coalesce(lead, '')")} AS l, coalesce(title, '') || coalesce(lead, '') AS bt FROM news_articles WHERE regexp_full_match(collected_at, '\\d{{4}}-\\d{{2}}-\\d{{2}}T.*')) WHERE NOT regexp_matches(bt, '{_UNFIT}')""", "tuoitre", "tier2"))
def feed_records(spark, sf_dir):
    """Items of an outlet's feed, one feed per article; a feed that is no XML gives nothing, nor does an item without a link."""
    n = read(spark, sf_dir, "news_articles").where(F.col("collected_at").rlike(r"^\d{4}-\d{2}-\d{2}T.*$"))
    day = F.date_format(F.substring("collected_at", 1, 10).try_cast("date"), "EEE, d MMM yyyy")
    date = F.coalesce(F.concat(day, F.lit(" 12:00:00 +0700")), F.lit(""))
    feed = F.concat(
        F.lit("<rss><channel><title>c</title><item><title>"), _escaped("title"), F.lit("</title><link>https://a.example/"), F.col("row_id").cast("string"), F.lit("</link><pubDate>"), date,
        F.lit("</pubDate><description>"), _escaped("lead"), F.lit("</description></item><item><title>no link</title></item></channel></rss>"),
    )
    return _flat(specs.records_of(outlets.OUTLETS["tuoitre"], n.select(feed.alias("payload")), CRAWLED))


def _article_sql(source: str, author: str, given: dict[str, str], rows: str) -> str:
    have = {"id": "substr(md5(url), 1, 12)", "source": f"'{source}'", "author": f"'{author}'", "collected_at": f"'{CRAWLED}'"} | given
    return "SELECT " + ", ".join(f"{have.get(n, chr(39) * 2)} AS {n}" for n in specs.ARTICLE_FIELDS) + f" FROM ({rows})"


_TITLED = f"""SELECT row_id, {_PLAIN("coalesce(title, '')")} AS t, substr({_PLAIN("coalesce(lead, '')")}, 1, 500) AS l FROM news_articles"""


@query(_article_sql("ssi", "SSI", {"title": "t", "category": "'Bản Tin Thị Trường'", "pub_date": "'05/03/2024'", "url": "url", "lead": "l", "pdf_url": "url"},
       f"SELECT *, 'https://x.example/analysis-center/report/download/' || row_id AS url FROM ({_TITLED}) WHERE row_id % 4 <> 0"))
def bulletin_articles(spark, sf_dir):
    """Bulletins of card listings; a card without a document is left out."""
    n = read(spark, sf_dir, "news_articles")
    link = F.when(F.col("row_id") % 4 == 0, "").otherwise(F.concat(F.lit('<a href="https://x.example/analysis-center/report/download/'), F.col("row_id").cast("string"), F.lit('">PDF</a>')))
    page = F.concat(
        F.lit('<p>top</p><div class="chart__content__item--undetail"><span>05/03/2024</span>'), link, F.lit('<a class="titlePost" href="#">'), _s("title"),
        F.lit('</a><div class="chart__content__item__desc__info">'), _s("lead"), F.lit("</div></div>"),
    )
    return specs.articles_of(outlets.BULLETINS, n.select(page.alias("payload")), CRAWLED)


@query(_article_sql("vndirect", "VNDIRECT", {"title": "t", "category": "'company-note'", "pub_date": "CASE WHEN row_id % 5 = 0 THEN '' ELSE '7/11/2025' END", "url": "url", "lead": "l"},
       f"SELECT *, 'https://y.example/en/' || row_id AS url FROM ({_TITLED})"))
def research_articles(spark, sf_dir):
    """Research notes of card listings; the date needs day, month and year."""
    n = read(spark, sf_dir, "news_articles")
    year = F.when(F.col("row_id") % 5 == 0, "").otherwise("<i>Year 2025</i>")
    page = F.concat(
        F.lit('<div class="news-item flex-item"><span class="date-day">7</span><sup>/11</sup>'), year, F.lit('<h3> <a href="https://y.example/en/'), F.col("row_id").cast("string"), F.lit('">'), _s("title"),
        F.lit('</a></h3><div class="news-des x">'), _s("lead"), F.lit("</div></div>"),
    )
    return specs.articles_of(outlets.RESEARCH, n.select(F.lit("company-note").alias("category"), page.alias("payload")), CRAWLED)


_BODY_OF = lambda c: f"""array_to_string(list_filter(list_transform(string_split(replace(replace({c}, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10)),
  lambda x: {_STRIP.format("regexp_replace(x, '[ \\t]+', ' ', 'g')")}), lambda x: x <> '' AND upper(x) NOT IN ('TIN MỚI', 'XEM THÊM', 'ĐỌC THÊM', 'MỚI NHẤT', 'LIÊN QUAN', 'HOT')), chr(10))"""  # noqa: E731
_CUT = lambda b: f"CASE WHEN length({b}) > 20000 THEN left({b}, 10000) || chr(10) || '[…truncated…]' || chr(10) || right({b}, 10000) ELSE {b} END"


@query(f"SELECT doc_id, length(b) AS chars, md5(b) AS body_md5 FROM (SELECT doc_id, {_CUT('n')} AS b FROM (SELECT doc_id, CASE WHEN length(coalesce(text, '')) >= 200 THEN {_BODY_OF('text')} ELSE '' END AS n FROM documents))")
def html_body(spark, sf_dir):
    """Length and hash of the normalised body found in the page around every document, entities resolved; "" under 200 characters."""
    escaped = F.replace(_escaped("text"), F.lit("&amp;"), F.lit("&amp;amp;"))  # bodies are unescaped once as pages and once as texts
    page = F.concat(F.lit('<html><body><nav>menu</nav><main><div class="detail-content"><p>'), escaped, F.lit("</p><script>var x;</script></div></main><aside>Tin khác</aside></body></html>"))
    bodies = read(spark, sf_dir, "documents").select("doc_id", pages.html_body(page, "cafef").alias("body"))
    return bodies.select("doc_id", F.length("body").cast("long").alias("chars"), F.md5("body").alias("body_md5"))


@query(f"""SELECT row_id, 'https://www.hsc.com.vn/en/research-insights-detail/a-' || row_id AS url, 'Research Insight' AS category, trim(regexp_replace(coalesce(title, ''), '{_SPACE}', ' ', 'g')) AS title,
substr(coalesce(lead, ''), 1, 500) AS lead, '2026-01-02T03:04:05' AS pub_date, 'HSC' AS author, CASE WHEN length(coalesce(body, '')) >= 200 THEN length({_CUT(_BODY_OF("body"))}) ELSE 0 END AS body_chars FROM news_articles""")
def insight_articles(spark, sf_dir):
    """Details linked by a listing, with head and body of their own page."""
    escaped = F.replace(_escaped("body"), F.lit("&amp;"), F.lit("&amp;amp;"))
    page = F.concat(
        F.lit("<html><head><title>"), _escaped("title"), F.lit('</title><meta name="description" content="'), _escaped("lead"), F.lit('"><script>{"datePublished": "2026-01-02T03:04:05+07:00"}</script></head><body><main><section class="x container">'),
        escaped, F.lit("</section></main></body></html>"),
    )
    link = F.concat(F.lit('<a href="/en/research-insights-detail/a-'), F.col("row_id").cast("string"), F.lit('">x</a>'))
    n = read(spark, sf_dir, "news_articles").select(F.concat(link, link).alias("payload"), page.alias("page"))
    out = specs.articles_of(outlets.INSIGHTS, n, CRAWLED)
    return out.select(F.regexp_extract("url", r"(\d+)$", 1).cast("long").alias("row_id"), "url", "category", "title", "lead", "pub_date", "author", F.length("body").cast("long").alias("body_chars"))


@query(f"""SELECT '/edocs/' || row_id AS path, coalesce(nullif(left(t, 100), ''), 'Nguồn: ' || b) AS title, CASE WHEN row_id % 3 = 0 THEN '' ELSE '1/02/2024' END AS pub_date, b AS broker
FROM (SELECT row_id, trim(regexp_replace(coalesce(title, ''), '{_SPACE}', ' ', 'g')) AS t, 'b' || (row_id % 7) AS b FROM news_articles)""")
def report_cards(spark, sf_dir):
    """Cards of report pages: first line, link, date and broker; the card of a thumbnail and its download link are one."""
    date = F.when(F.col("row_id") % 3 == 0, "").otherwise("<p>Ngày _1/02/2024_</p>")
    n = read(spark, sf_dir, "news_articles").withColumn("t", text.collapse(_s("title")))
    page = F.concat(
        F.lit('<div class="card"><div><img src="https://s.example/edocs/1.jpg"></div><h4>'), _escaped("t"), F.lit("</h4><p>Nguồn: b"), (F.col("row_id") % 7).cast("string"), F.lit("</p>"), date,
        F.lit('<a href="/menu">xem</a><a href="/edocs/'), F.col("row_id").cast("string"), F.lit('">Tải về</a></div>'),
    )
    rows = n.select(F.inline(pages.report_cards(page, "", "none")))
    return rows.select(F.col("url").alias("path"), "title", "pub_date", "broker")


_DAY = lambda y, d: f"coalesce(strftime(try_strptime(nullif({y}, ''), '%Y-%m-%d'), '%Y-%m-%d'), strftime(try_strptime(nullif({d}, ''), '%d-%m-%Y'), '%Y-%m-%d'))"
_CLOCK = "\\d{1,2}:\\d{1,2}:\\d{1,2}"
_V = "trim(coalesce(pub_date, ''))"


@query(f"""SELECT row_id, {_DAY("y", "d")} AS article_day, {_DAY("y2", "d2")} AS digest_day FROM (SELECT row_id,
coalesce(nullif(regexp_extract(v, '^(\\d{{4}}-\\d{{1,2}}-\\d{{1,2}})(?:T{_CLOCK}(?:Z|[+-]\\d{{2}}:?\\d{{2}}(?::?\\d{{2}})?)?| {_CLOCK})?$', 1), ''), regexp_extract(v, '^(\\d{{4}}-\\d{{2}}-\\d{{2}})', 1)) AS y,
replace(regexp_extract(v, '^(\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}|\\d{{1,2}}-\\d{{1,2}}-\\d{{4}})$', 1), '/', '-') AS d,
regexp_extract(CASE WHEN contains(v, 'T') THEN left(v, 19) ELSE v END, '^(\\d{{4}}-\\d{{1,2}}-\\d{{1,2}})(?:T{_CLOCK})?$', 1) AS y2,
replace(coalesce(nullif(regexp_extract(v, '^(\\d{{1,2}}/\\d{{1,2}}/\\d{{4}})$', 1), ''), regexp_extract(v, '^(\\d{{2}}/\\d{{2}}/\\d{{4}})', 1)), '/', '-') AS d2
FROM (SELECT row_id, {_V} AS v FROM news_articles))""")
def article_days(spark, sf_dir):
    """Days of written times as the articles' filter and as the digest read them."""
    day = lambda f: F.date_format(f(F.col("pub_date")), "yyyy-MM-dd")
    return read(spark, sf_dir, "news_articles").select("row_id", day(dates.article_date).alias("article_day"), day(dates.digest_date).alias("digest_day"))


@query("""WITH n AS (SELECT row_id, url, row_id % 10 = 0 AS gone, regexp_full_match(substr(collected_at, 1, 10), '\\d{4}-\\d{2}-\\d{2}') AND TRY_CAST(substr(collected_at, 1, 10) AS DATE) < DATE '2025-06-01' AS old FROM news_articles WHERE row_id >= 500),
k AS (SELECT *, url IN (SELECT url FROM news_articles WHERE row_id < 500 AND url IS NOT NULL) AS known, row_number() OVER (PARTITION BY url, NOT gone AND coalesce(url, '') <> '' AND NOT coalesce(old, false) ORDER BY row_id) AS n FROM n)
SELECT fate, count(*) AS n FROM (SELECT CASE WHEN gone OR coalesce(url, '') = '' THEN 'fail' WHEN coalesce(old, false) THEN 'out_of_range' WHEN known OR n > 1 THEN 'dup' ELSE 'kept' END AS fate FROM k) GROUP BY fate""")
def crawl_counters(spark, sf_dir):
    """What becomes of the rows of a later run: without identity, out of range, known, kept."""
    news = read(spark, sf_dir, "news_articles").select("row_id", "url", "collected_at")
    rows = news.where("row_id >= 500").withColumn("url", F.when(F.col("row_id") % 10 != 0, F.col("url")))
    day = F.when(F.substring("collected_at", 1, 10).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.substring("collected_at", 1, 10)).try_cast("date")
    fates = specs.with_fates(rows, news.where("row_id < 500"), "url", day, "2025-06-01", None, ["row_id"])
    return fates.groupBy("fate").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT row_id, coalesce(title, '') AS title, CASE WHEN language IS NULL THEN 'vi' ELSE language END AS language, coalesce(nullif(event_type, ''), 'other') AS event_type, coalesce(company_code, '') AS company_code, coalesce(checksum, '') AS checksum FROM objective_records""")
def rehydrated_records(spark, sf_dir):
    """Stored records with their defaults; only vi, other and empty lists are put in."""
    r = read(spark, sf_dir, "objective_records")
    again = specs.rehydrated(r.withColumn("raw_path", F.col("row_id").cast("string")))
    return again.select(F.col("raw_path").cast("long").alias("row_id"), "title", "language", "event_type", "company_code", "checksum")


_FILE = "'01-02-2024_' || replace(trim(regexp_replace(left(trim(coalesce(title, '')), 50), '[^\\p{L}\\p{N} _-]', '', 'g')), ' ', '_')"


@query(f"SELECT row_id, {_FILE} || CASE WHEN row_id % 2 = 0 THEN '__' || row_id ELSE '' END || '.pdf' AS file FROM news_articles")
def document_files(spark, sf_dir):
    """File names of documents: the number in the url keeps two of one title and day apart."""
    url = F.when(F.col("row_id") % 2 == 0, F.concat(F.lit("https://a.example/DownloadEdoc/"), F.col("row_id").cast("string")))
    return read(spark, sf_dir, "news_articles").select("row_id", archive.document_name(_s("title"), F.lit("01/02/2024"), url).alias("file"))


@query(f"""WITH n AS (SELECT row_id, 'u' || row_id AS u, {_FILE} || '.pdf' AS old FROM news_articles), f AS (SELECT DISTINCT old FROM n WHERE row_id % 4 = 0)
SELECT row_id, CASE WHEN row_id % 5 = 0 THEN 'kept.pdf' WHEN old IN (SELECT old FROM f) THEN old ELSE '' END AS pdf_filename,
CASE WHEN row_id % 5 = 0 THEN false ELSE old IN (SELECT old FROM f) END AS has_file FROM n""")
def reconciled_files(spark, sf_dir):
    """Blank file names recovered from files of a former run, and which rows then have their file; small files do not count."""
    n = read(spark, sf_dir, "news_articles").select("row_id", "title", F.lit("01/02/2024").alias("date"), F.concat(F.lit("u"), F.col("row_id").cast("string")).alias("pdf_url"))
    rows = n.withColumn("pdf_filename", F.when(F.col("row_id") % 5 == 0, "kept.pdf").otherwise(""))
    names = text.pdf_filename(_s("title"), F.col("date"))
    files = n.where(F.col("row_id") % 4 == 0).select(names.alias("file"), F.lit(5000).alias("length")).unionByName(n.select(names.alias("file"), F.lit(900).alias("length"))).distinct()
    large = files.where(F.col("length") > archive.LEAST_BYTES)
    out = archive.reconciled(rows, files)
    there = archive.with_local_file(out, large).select("row_id", F.lit(True).alias("has_file"))
    return out.select("row_id", "pdf_filename").join(there, "row_id", "left").withColumn("has_file", F.coalesce("has_file", F.lit(False)))


@query("SELECT row_id, source FROM (SELECT row_id, source, row_number() OVER (PARTITION BY source ORDER BY collected_at DESC NULLS LAST, row_id) AS n FROM news_articles) WHERE n <= 5")
def capped_sources(spark, sf_dir):
    """The five latest collected articles of each source, as a capped run takes."""
    n = read(spark, sf_dir, "news_articles").select("row_id", "source", "collected_at")
    return runs.first_per_source(n, "source", [F.col("collected_at").desc_nulls_last(), F.col("row_id")], 5).select("row_id", "source")


@query("""SELECT source, count(*) AS n, 'records' AS kind FROM objective_records WHERE source <> (SELECT min(source) FROM objective_records) GROUP BY source
UNION ALL SELECT source, count(*), 'companion' FROM objective_records WHERE source = (SELECT min(source) FROM objective_records) GROUP BY source""")
def files_by_pattern(spark, sf_dir):
    """One folder of CSV files per source, scanned by pattern: companions left out by name, then counted alone."""
    r = read(spark, sf_dir, "objective_records").select("row_id", "source", "title")
    base = workspace(spark, "pattern")
    names = sorted(x[0] for x in r.select("source").distinct().collect() if x[0])
    for n in names:  # one write per source, as sources are stored
        rows = r.where(F.col("source") == n).select("row_id", "source", _s("title").alias("title"))
        rows.write.csv(f"{base}/{'news_unenriched_' if n == names[0] else ''}{n}_records.csv", header=True, escape='"', quoteAll=True)
    count = lambda df, kind: df.groupBy("source").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit(kind))
    scanned = readers.csv_files(spark, f"{base}/*_records.csv", exclude="^news_unenriched_")
    return count(scanned, "records").unionByName(count(readers.csv_files(spark, f"{base}/news_unenriched_*.csv"), "companion"))


@query("SELECT strftime(max(date) + 1, '%Y-%m-%d') AS from_day, '2030-01-01' AS to_day FROM index_prices UNION ALL SELECT '2000-01-01', '2030-01-01'")
def series_windows(spark, sf_dir):
    """The window to ask a source for: after the latest stored day, or from the first day if nothing is stored."""
    stored = read(spark, sf_dir, "index_prices").select(F.col("date").cast("string").alias("date"))
    stored = stored.unionByName(spark.createDataFrame([("9999-99-99",), (None,)], "date string"))  # no days, so they do not count
    end = datetime.date(2030, 1, 1)
    spans = [runs.window(stored, "date", end), runs.window(stored.limit(0), "date", end)]
    return spark.createDataFrame([(a.isoformat(), b.isoformat()) for a, b in spans], "from_day string, to_day string")


@query(f"SELECT DISTINCT url, {_STRIP.format("substr(coalesce(collected_at, ''), 1, 10)")} AS lastmod, row_id % 3 AS shard FROM news_articles WHERE url IS NOT NULL")
def stored_candidates(spark, sf_dir):
    """Candidates of sitemap shards kept as a table: a second run parses only what the first did not store."""
    from ..sources import parsers

    path = workspace(spark, "candidates")
    n = read(spark, sf_dir, "news_articles").where("url is not null")
    page = F.concat(F.lit("<urlset><url><loc>"), _escaped("url"), F.lit("</loc><lastmod>"), F.substring(_s("collected_at"), 1, 10), F.lit("</lastmod></url></urlset>"))
    shards = n.select((F.col("row_id") % 3).alias("shard"), page.alias("payload"))
    runs.candidates(spark, shards.where("shard < 2"), path, parsers.sitemap_urls)
    return runs.candidates(spark, shards, path, parsers.sitemap_urls).select("url", "lastmod", "shard").distinct()


@query("SELECT document_id, max(raw_text) AS payload FROM objective_records WHERE document_id IS NOT NULL GROUP BY document_id")
def raw_payloads(spark, sf_dir):
    """Raw payloads stored by document and read again through a JSON snapshot."""
    base = workspace(spark, "raw")
    archive.keep_raw(read(spark, sf_dir, "objective_records"), f"{base}/bronze", content="raw_text")
    archive.write_snapshot(spark.read.parquet(f"{base}/bronze"), f"{base}/snapshot")
    return spark.read.schema("document_id string, payload string").json(f"{base}/snapshot")


@query("""SELECT * FROM (SELECT 'total_records' AS name, CAST(count(*) AS VARCHAR) AS value FROM objective_records UNION ALL SELECT 'tickers_covered', CAST(count(DISTINCT nullif(company_code, '')) AS VARCHAR) FROM objective_records
UNION ALL SELECT 'oldest', min(substr(nullif(crawl_time, ''), 1, 10)) FROM objective_records UNION ALL SELECT 'newest', max(substr(nullif(crawl_time, ''), 1, 10)) FROM objective_records
UNION ALL SELECT 'sources', CAST(count(DISTINCT coalesce(source, '')) AS VARCHAR) FROM objective_records UNION ALL SELECT 'news_corpus', CAST(count(*) AS VARCHAR) FROM news_articles)""")
def dashboard_totals(spark, sf_dir):
    """Figures at the head of the dashboard."""
    r = read(spark, sf_dir, "objective_records").select("source", "company_code", "event_type", F.col("crawl_time").alias("publish_time"))
    s = sinks.dashboard_stats(r, read(spark, sf_dir, "news_articles"))
    rows = [("total_records", s["total_records"]), ("tickers_covered", s["tickers_covered"]), ("oldest", s["date_range"]["oldest"]), ("newest", s["date_range"]["newest"]), ("sources", len(s["by_source"])), ("news_corpus", s["news_corpus"])]
    return spark.createDataFrame([(n, str(v)) for n, v in rows], "name string, value string")
