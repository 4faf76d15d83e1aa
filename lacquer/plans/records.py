"""Queries on records: build, identity, deduplication, sets, parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, ident, rules, text
from ..operators import dedup

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def tagged_records(records: DataFrame, universe: DataFrame) -> DataFrame:
    """records with `verdict`: the first filter that rejects a row, else 'kept'."""
    codes = universe.select(F.upper(F.trim("ticker")).alias("__code"), F.lit(True).alias("__in")).distinct()
    joined = records.withColumn("__code", F.upper(F.trim(F.coalesce("company_code", F.lit(""))))).join(codes, "__code", "left")
    verdict = F.when(~dates.is_canonical_utc(F.col("publish_time")), "utc_rejected").when(F.col("__in").isNull(), "universe_rejected").otherwise("kept")
    return joined.withColumn("verdict", verdict).drop("__code", "__in")


RECORD_SQL = """
WITH t AS (
  SELECT r.*, CASE WHEN NOT coalesce(regexp_full_match(publish_time, '\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}Z'), false) THEN 'utc_rejected'
                   WHEN u.ticker IS NULL THEN 'universe_rejected' ELSE 'kept' END AS verdict
  FROM objective_records r LEFT JOIN universe u ON upper(trim(coalesce(r.company_code, ''))) = upper(trim(u.ticker))
), k AS (
  SELECT *, row_number() OVER (PARTITION BY coalesce(checksum, '') ORDER BY source, row_id) AS n FROM t WHERE verdict = 'kept'
)"""


#: Columns of the built table; nothing else of a record is read or moved.
BUILT = ["row_id", "document_id", "source", "publish_time", "company_code", "title", "checksum"]


def build_records(records: DataFrame, universe: DataFrame, prefer: str = "source", columns: list[str] | None = None) -> DataFrame:
    """Valid records of the universe, one per checksum: by source name, or by tier first.

    The winning rows travel with `columns`, so name only narrow ones (BUILT by default)
    and join texts to the few rows that are kept, by row_id.
    """
    wanted = columns or [c for c in BUILT if c in records.columns]
    ranks = ["source_tier"] if prefer == "tier" else []
    records = records.select(*dict.fromkeys([*wanted, *ranks, "row_id", "source", "publish_time", "company_code", "checksum"]))
    order = [*([F.lower(F.trim(F.coalesce("source_tier", F.lit("~"))))] if prefer == "tier" else []), "source", "row_id"]
    kept = tagged_records(records, universe).where("verdict = 'kept'")
    return dedup.keep_first(kept, [F.coalesce("checksum", F.lit(""))], order).select(*wanted)


@query(RECORD_SQL + " SELECT row_id, document_id, source, publish_time, company_code, title, checksum FROM k WHERE n = 1")
def objective_build(spark, sf_dir):
    """Unified records: valid time, member of the universe, first per checksum, in time order."""
    kept = build_records(read(spark, sf_dir, "objective_records"), read(spark, sf_dir, "universe"))
    return kept.orderBy("publish_time", "source", "company_code", "row_id")


@query(RECORD_SQL + """ SELECT CASE WHEN verdict = 'kept' THEN 'valid' ELSE verdict END AS counter, count(*) AS n FROM t GROUP BY 1
UNION ALL SELECT 'kept', count(*) FROM k WHERE n = 1 UNION ALL SELECT 'deduped', count(*) FROM k WHERE n > 1
UNION ALL SELECT 'read', count(*) FROM objective_records""")
def objective_counters(spark, sf_dir):
    """Counters of the build from one pass: partial counts per verdict and checksum."""
    tagged = tagged_records(read(spark, sf_dir, "objective_records"), read(spark, sf_dir, "universe"))
    by_key = tagged.groupBy("verdict", F.when(F.col("verdict") == "kept", F.coalesce("checksum", F.lit(""))).alias("c")).agg(F.count(F.lit(1)).alias("n"))
    one = by_key.agg(
        F.sum("n").alias("read"), *[F.sum(F.when(F.col("verdict") == v, F.col("n"))).alias(a) for v, a in (("utc_rejected", "utc_rejected"), ("universe_rejected", "universe_rejected"), ("kept", "valid"))],
        F.sum(F.when(F.col("verdict") == "kept", 1)).alias("kept"),
    )
    one = one.withColumn("deduped", F.col("valid") - F.col("kept"))
    names = ["read", "utc_rejected", "universe_rejected", "valid", "kept", "deduped"]
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("counter"), F.col(n).alias("n")) for n in names]))).where("n is not null")


@query("SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY sha256(lower(coalesce(text, ''))) ORDER BY doc_id) AS n FROM documents) WHERE n = 1")
def checksum_dedup_keep_first(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", F.sha2(F.lower(F.coalesce("text", F.lit(""))), 256).alias("h"))
    return dedup.keep_first(docs, ["h"], ["doc_id"]).select("doc_id", "source")


@query("SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY sha256(lower(coalesce(text, ''))) ORDER BY doc_id DESC) AS n FROM documents) WHERE n = 1")
def checksum_dedup_keep_last(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", F.sha2(F.lower(F.coalesce("text", F.lit(""))), 256).alias("h"))
    return dedup.keep_last(docs, ["h"], ["doc_id"]).select("doc_id", "source")


@query("SELECT row_id, url, author FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY CASE WHEN trim(coalesce(author, '')) <> '' THEN 0 ELSE 1 END, row_id) AS n FROM news_articles) WHERE n = 1")
def prefer_populated_dedup(spark, sf_dir):
    """One article per url, one with an author if there is one."""
    return dedup.prefer_filled(read(spark, sf_dir, "news_articles").select("row_id", "url", "author"), ["url"], "author", ["row_id"])


@query("SELECT row_id, url FROM news_articles n WHERE row_id >= 1000 AND NOT EXISTS (SELECT 1 FROM news_articles s WHERE s.row_id < 1000 AND s.url = n.url)")
def incremental_anti_join(spark, sf_dir):
    """Articles of a later batch whose url was not stored by the first."""
    news = read(spark, sf_dir, "news_articles").select("row_id", "url")
    return dedup.unseen(news.where("row_id >= 1000"), news.where("row_id < 1000"), ["url"])


@query("""SELECT row_id, url FROM news_articles n WHERE row_id >= 1000 AND NOT EXISTS (SELECT 1 FROM news_articles s WHERE s.row_id < 1000 AND s.url = n.url)
AND NOT EXISTS (SELECT 1 FROM news_articles s WHERE s.row_id < 1000 AND s.id = n.id)""")
def seen_url_or_id(spark, sf_dir):
    """The same with two keys, either of which makes an article known."""
    news = read(spark, sf_dir, "news_articles").select("row_id", "url", "id")
    return dedup.unseen(news.where("row_id >= 1000"), news.where("row_id < 1000"), ["url", "id"]).select("row_id", "url")


@query("""WITH d AS (SELECT CAST(ts AS DATE) AS day, event_id, value FROM events)
SELECT strftime(day, '%Y-%m-%d') AS day, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY event_id DESC) AS n FROM d
WHERE day > (SELECT max(day) FROM d WHERE day < DATE '2024-01-15') AND day <= DATE '2024-01-25') WHERE n = 1""")
def watermark_upsert(spark, sf_dir):
    """Days after the stored ones, up to an end, the last event of each."""
    days = read(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_id", "value")
    return dedup.above_watermark(days, days.where("day < '2024-01-15'"), "day", ["event_id"], F.lit("2024-01-25").cast("date"))


@query("SELECT row_id, company_code FROM objective_records r WHERE EXISTS (SELECT 1 FROM universe u WHERE upper(trim(r.company_code)) = u.ticker)")
def universe_semi_join(spark, sf_dir):
    """Records of the universe; the stored code is left as it is."""
    codes = read(spark, sf_dir, "universe").select(F.col("ticker").alias("__code"))
    records = read(spark, sf_dir, "objective_records").select("row_id", "company_code")
    return records.join(codes, F.upper(F.trim("company_code")) == F.col("__code"), "left_semi")


@query("SELECT r.row_id, coalesce(u.company_name, '') AS canonical_name FROM objective_records r LEFT JOIN universe u ON upper(trim(r.company_code)) = u.ticker")
def name_lookup_left_join(spark, sf_dir):
    names = read(spark, sf_dir, "universe").select(F.col("ticker").alias("__code"), F.col("company_name").alias("canonical_name"))
    records = read(spark, sf_dir, "objective_records").select("row_id", "company_code")
    joined = records.join(names, F.upper(F.trim("company_code")) == F.col("__code"), "left")
    return joined.select("row_id", F.coalesce("canonical_name", F.lit("")).alias("canonical_name"))


_URL_SQL = """(SELECT row_id, source, lower(site) || CASE WHEN path = '' AND site <> '' THEN '/' ELSE path END || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS canonical FROM (
  SELECT row_id, source, regexp_extract(head, '^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)', 1) AS site,
         regexp_replace(substr(head, length(regexp_extract(head, '^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)', 1)) + 1), '/+$', '') AS path,
         array_to_string(list_transform(list_sort(list_filter(list_transform(string_split(query, '&'),
           lambda p: {'k': lower(url_decode(replace(split_part(p, '=', 1), '+', ' '))), 'v': CASE WHEN contains(p, '=') THEN url_decode(replace(regexp_replace(p, '^[^=]*=', ''), '+', ' ')) ELSE '' END}),
           lambda x: x.v <> '' AND NOT regexp_matches(x.k, '^(gclid|fbclid|ref|ref_src)$') AND NOT regexp_matches(x.k, '^(utm_|mc_)'))),
           lambda x: replace(url_encode(x.k), '%20', '+') || '=' || replace(url_encode(x.v), '%20', '+')), '&') AS q
  FROM (SELECT row_id, source, split_part(u, '?', 1) AS head, regexp_extract(u, '^[^?]*\\?(.*)$', 1) AS query
        FROM (SELECT row_id, source, regexp_replace(trim(coalesce(url, '')), '#.*$', '') AS u FROM {table}))))"""


@query("SELECT row_id, canonical FROM " + _URL_SQL.replace("{table}", "objective_records"))
def canonicalize_url(spark, sf_dir):
    return read(spark, sf_dir, "objective_records").select("row_id", ident.canonicalize_url(F.col("url")).alias("canonical"))


@query("SELECT row_id, canonical FROM " + _URL_SQL.replace("{table}", """(SELECT row_id, source, coalesce(url, 'https://A.example/x/') || '?Tiêu=' || replace(url_encode(coalesce(title, '')), '%20', '+') || '&utm_source=a&a=' || row_id || '&empty=&REF=1&b=%2F~*' AS url FROM news_articles)"""))
def canonicalize_parameters(spark, sf_dir):
    """Urls whose parameters are written with escapes: one writing of each, in order, without blank and tracking ones."""
    title = F.url_encode(F.coalesce("title", F.lit("")))
    url = F.concat(F.coalesce("url", F.lit("https://A.example/x/")), F.lit("?Tiêu="), title, F.lit("&utm_source=a&a="), F.col("row_id").cast("string"), F.lit("&empty=&REF=1&b=%2F~*"))
    return read(spark, sf_dir, "news_articles").select("row_id", ident.canonicalize_url(url).alias("canonical"))


@query("SELECT row_id, substr(sha1(coalesce(source || '|', '') || canonical), 1, 16) AS derived_id FROM " + _URL_SQL.replace("{table}", "objective_records"))
def document_id(spark, sf_dir):
    return read(spark, sf_dir, "objective_records").select("row_id", ident.document_id(F.col("source"), F.col("url")).alias("derived_id"))


@query("SELECT row_id, substr(md5(url), 1, 12) AS derived_id FROM news_articles")
def short_id(spark, sf_dir):
    return read(spark, sf_dir, "news_articles").select("row_id", ident.short_id(F.col("url")).alias("derived_id"))


@query("SELECT row_id, CASE WHEN row_id % 3 = 0 THEN '' ELSE '1882' || lpad(CAST(row_id AS VARCHAR), 14, '0') END AS number FROM news_articles")
def article_number(spark, sf_dir):
    """Numbers that close article urls; shorter ones and other endings give none."""
    long = F.concat(F.lit("1882"), F.lpad(F.col("row_id").cast("string"), 14, "0"))
    url = F.when(F.col("row_id") % 3 == 0, F.concat(F.lit("https://a.example/tin-188"), F.col("row_id").cast("string"), F.lit(".chn"))).otherwise(F.concat(F.lit("https://a.example/tin-moi-"), long, F.lit(".chn?a=1")))
    return read(spark, sf_dir, "news_articles").select("row_id", ident.article_number(url).alias("number"))


_SPACE = "[\\s\\x1c-\\x1f\\x85\\p{Z}]+"
_NORM_SQL = f"trim(regexp_replace(regexp_replace(lower(nfc_normalize(coalesce(raw_text, ''))), '<[^>]+>', ' ', 'g'), '{_SPACE}', ' ', 'g'))"


@query(f"SELECT row_id, {_NORM_SQL} AS normal FROM objective_records")
def checksum_normalize(spark, sf_dir):
    return read(spark, sf_dir, "objective_records").select("row_id", text.checksum_normalize(F.col("raw_text")).alias("normal"))


@query(f"SELECT row_id, sha256({_NORM_SQL}) AS derived FROM objective_records")
def content_checksum(spark, sf_dir):
    return read(spark, sf_dir, "objective_records").select("row_id", ident.compute_checksum(F.col("raw_text")).alias("derived"))


@query(f"SELECT row_id, trim(regexp_replace(regexp_replace(coalesce(raw_text, ''), '<[^>]+>', ' ', 'g'), '{_SPACE}', ' ', 'g')) AS plain FROM objective_records")
def strip_html(spark, sf_dir):
    return read(spark, sf_dir, "objective_records").select("row_id", text.strip_html(F.col("raw_text")).alias("plain"))


@query("""SELECT row_id, body_len, title FROM (SELECT row_id, coalesce(title, '') AS t, length(coalesce(lead, '')) AS body_len,
trim(regexp_replace(coalesce(title, ''), '[\\s\\x1c-\\x1f\\x85\\p{Z}]+', ' ', 'g')) AS title FROM news_articles)""")
def html_title(spark, sf_dir):
    """Title and paragraph of pages rendered from the articles."""
    page = F.concat(F.lit("<html><head><title>\n"), F.coalesce("title", F.lit("")), F.lit("</title></head><body><p>"), F.coalesce("lead", F.lit("")), F.lit("</p></body></html>"))
    pages = read(spark, sf_dir, "news_articles").select("row_id", page.alias("html"))
    lead = F.regexp_extract("html", r"(?s)<p>(.*)</p></body>", 1)
    return pages.select("row_id", F.length(lead).alias("body_len"), text.html_title(F.col("html")).alias("title"))


@query("SELECT DISTINCT source, split_part(url, '/', 4) AS link FROM news_articles WHERE split_part(url, '/', 4) <> ''")
def html_links(spark, sf_dir):
    """Distinct links of the listing pages of each source, over all articles; a page holds 100 row ids at most."""
    slug = F.nullif(F.split_part("url", F.lit("/"), F.lit(4)), F.lit(""))
    anchors = F.concat(F.lit('<li><a class="x" href="'), slug, F.lit('">t</a></li>'))
    news = read(spark, sf_dir, "news_articles").select("source", F.floor(F.col("row_id") / 100).alias("page"), anchors.alias("a"))
    pages = news.groupBy("source", "page").agg(F.array_join(F.collect_list("a"), "\n").alias("html"))
    return pages.select("source", F.explode(text.html_links(F.col("html"))).alias("link")).distinct()


@query("""SELECT doc_id, CASE WHEN length(b) > 1000 THEN left(b, 500) || chr(10) || '[…truncated…]' || chr(10) || right(b, 500) ELSE b END AS body FROM (
SELECT doc_id, array_to_string(list_filter(list_transform(string_split(replace(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10)),
  lambda x: trim(regexp_replace(x, '[ \\t]+', ' ', 'g'))), lambda x: x <> '' AND upper(x) NOT IN ('TIN MỚI', 'XEM THÊM', 'ĐỌC THÊM', 'MỚI NHẤT', 'LIÊN QUAN', 'HOT')), chr(10)) AS b FROM documents)""")
def normalize_body(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", text.normalize_body(F.col("text"), 1000, entities=False).alias("body"))


@query("SELECT row_id, CASE " + " ".join(f"WHEN contains(lower(coalesce(title, '')), '{w}') THEN '{v}'" for w, v in rules.EVENT_RULES) + " ELSE 'other' END AS event FROM objective_records")
def classify_first_match(spark, sf_dir):
    return read(spark, sf_dir, "objective_records").select("row_id", rules.first_match(F.col("title")).alias("event"))


@query("""SELECT row_id, replace(coalesce(pub_date, ''), '/', '-') || '_' || replace(trim(regexp_replace(left(trim(title), 50), '[^\\p{L}\\p{N} _-]', '', 'g')), ' ', '_') || '.pdf' AS file
FROM news_articles WHERE title IS NOT NULL""")
def pdf_filename(spark, sf_dir):
    news = read(spark, sf_dir, "news_articles").where("title is not null")
    return news.select("row_id", text.pdf_filename(F.col("title"), F.coalesce("pub_date", F.lit(""))).alias("file"))


_WORDS = ("cookie", "podcast", "newsletter")


@query("SELECT row_id, CASE " + " ".join(f"WHEN contains(lower(coalesce(body, '')), '{w}') OR contains(lower(coalesce(title, '')), '{w}') THEN '{w}'" for w in _WORDS) + " END AS word FROM news_articles")
def blocking_predicate(spark, sf_dir):
    """First of some words in body or title; words are a parameter."""
    return read(spark, sf_dir, "news_articles").select("row_id", rules.blocking_word(F.col("title"), F.col("body"), _WORDS).alias("word"))


@query("SELECT status, CASE WHEN status = 403 THEN 'blocked' WHEN status = 429 THEN 'throttled' WHEN status >= 500 THEN 'broken' ELSE 'ok' END AS verdict, count(*) AS n FROM (SELECT CASE event_id % 5 WHEN 0 THEN 403 WHEN 1 THEN 429 WHEN 2 THEN 503 ELSE 200 END AS status FROM events) GROUP BY 1, 2")
def status_predicate(spark, sf_dir):
    m = F.col("event_id") % 5
    status = F.when(m == 0, 403).when(m == 1, 429).when(m == 2, 503).otherwise(200)
    return read(spark, sf_dir, "events").select(status.alias("status")).groupBy("status", rules.status_verdict(F.col("status")).alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT row_id, event_type FROM objective_records WHERE event_type IN (" + ", ".join(f"'{e}'" for e in rules.EVENT_TYPES) + ")")
def enum_membership(spark, sf_dir):
    return read(spark, sf_dir, "objective_records").where(F.col("event_type").isin(*rules.EVENT_TYPES)).select("row_id", "event_type")


@query("SELECT o_orderkey FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS d FROM orders) WHERE coalesce(d >= DATE '1996-01-01', true) AND coalesce(d <= DATE '1997-06-30', true)")
def date_range_null_passes(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate").cast("date")).alias("d"))
    return orders.where(dates.in_range(F.col("d"), F.lit("1996-01-01").cast("date"), F.lit("1997-06-30").cast("date"))).select("o_orderkey")


@query("SELECT event_id FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-28' - 7")
def recent_n_days(spark, sf_dir):
    """Events of the last seven days before a given day, without an upper bound."""
    today = F.lit("2024-01-28").cast("date")
    return read(spark, sf_dir, "events").where(F.col("ts").cast("date") >= F.date_sub(today, 7)).select("event_id")


_ISO = "^(\\d{4}-\\d{2}-\\d{2})(?:[T ](\\d{2}:\\d{2})(?::(\\d{2})(?:[.,]\\d{1,9})?)?(Z|[+-]\\d{2}:?\\d{2})?)?$"


@query(f"""WITH v AS (SELECT row_id, trim(coalesce(publish_time, '')) AS v FROM objective_records),
p AS (SELECT row_id, v, regexp_extract(v, '{_ISO}', 1) AS d, regexp_extract(v, '{_ISO}', 2) AS hm, regexp_extract(v, '{_ISO}', 3) AS s, regexp_extract(v, '{_ISO}', 4) AS z,
  regexp_extract(v, '^(\\d{{1,2}}[/-]\\d{{1,2}}[/-]\\d{{4}})$', 1) AS dmy FROM v),
t AS (SELECT *, try_strptime(d || ' ' || CASE WHEN hm = '' THEN '00:00' ELSE hm END || ':' || CASE WHEN s = '' THEN '00' ELSE s END, '%Y-%m-%d %H:%M:%S') AS l,
  try_strptime(replace(dmy, '/', '-'), '%d-%m-%Y') AS dt,
  CASE WHEN z = 'Z' THEN 0 WHEN z <> '' THEN (CASE WHEN z[1] = '-' THEN -1 ELSE 1 END) * (CAST(substr(z, 2, 2) AS INT) * 60 + CAST(right(z, 2) AS INT)) END AS m FROM p)
SELECT row_id, coalesce(CASE WHEN d <> '' THEN strftime(l - to_minutes(coalesce(m, CASE WHEN hour(l) = 0 AND minute(l) = 0 AND second(l) = 0 THEN 0 ELSE 420 END)), '%Y-%m-%dT%H:%M:%SZ') END,
  strftime(dt, '%Y-%m-%dT%H:%M:%SZ'), '') AS utc FROM t""")
def to_utc(spark, sf_dir):
    return read(spark, sf_dir, "objective_records").select("row_id", dates.to_utc(F.col("publish_time")).alias("utc"))


@query("""WITH v AS (SELECT row_id, regexp_extract(trim(coalesce(pub_date, '')), '^(\\d{4}-\\d{1,2}-\\d{1,2})(?:\\D|$)', 1) AS y, replace(regexp_extract(trim(coalesce(pub_date, '')), '^(\\d{1,2}[/-]\\d{1,2}[/-]\\d{4})(?:\\D|$)', 1), '/', '-') AS d FROM news_articles)
SELECT row_id, coalesce(strftime(try_strptime(nullif(y, ''), '%Y-%m-%d'), '%Y-%m-%d'), strftime(try_strptime(nullif(d, ''), '%d-%m-%Y'), '%Y-%m-%d'), '') AS day FROM v""")
def norm_date(spark, sf_dir):
    return read(spark, sf_dir, "news_articles").select("row_id", dates.norm_date(F.col("pub_date")).alias("day"))


@query("""SELECT row_id, strftime(coalesce(try_strptime(nullif(regexp_extract(trim(pub_date), '^(\\d{1,2}/\\d{1,2}/\\d{4})$', 1), ''), '%d/%m/%Y'), try_strptime(nullif(regexp_extract(trim(pub_date), '^(\\d{1,2}/\\d{1,2}/\\d{2})$', 1), ''), '%d/%m/%y')), '%Y-%m-%d') AS day
FROM news_articles""")
def report_date(spark, sf_dir):
    """The day of every article, null where the value is no d/m/y."""
    return read(spark, sf_dir, "news_articles").select("row_id", F.date_format(dates.report_date(F.col("pub_date")), "yyyy-MM-dd").alias("day"))


@query("""SELECT row_id, coalesce(strftime(make_timestamp(CAST(floor(CAST(nullif(regexp_extract(publish_time, '/Date\\((-?\\d+)\\)/', 1), '') AS BIGINT) / 1000) AS BIGINT) * 1000000), '%Y-%m-%dT%H:%M:%SZ'), '') AS utc FROM objective_records""")
def vendor_date(spark, sf_dir):
    return read(spark, sf_dir, "objective_records").select("row_id", dates.vendor_date(F.coalesce("publish_time", F.lit(""))).alias("utc"))


@query("""SELECT row_id, coalesce(strftime(try_strptime(regexp_extract(trim(pub_date), '^(?:[A-Za-z]{3},\\s*)?(\\d{1,2} [A-Za-z]{3} \\d{4} \\d{2}:\\d{2}:\\d{2}) [+-]\\d{4}$', 1), '%d %b %Y %H:%M:%S'), '%Y-%m-%dT%H:%M:%S')
|| regexp_replace(right(trim(pub_date), 5), '(..)$', ':\\1'), '') AS iso FROM news_articles""")
def rfc822_date(spark, sf_dir):
    return read(spark, sf_dir, "news_articles").select("row_id", dates.rfc822_date(F.coalesce("pub_date", F.lit(""))).alias("iso"))


@query("""SELECT strftime(greatest(CAST(d AS DATE), lo), '%Y-%m-%d') AS from_day, strftime(least(CAST(d + INTERVAL 3 MONTH AS DATE) - 1, hi), '%Y-%m-%d') AS to_day
FROM (SELECT unnest(generate_series(date_trunc('month', lo), CAST(hi AS TIMESTAMP), INTERVAL 3 MONTH)) AS d, lo, hi FROM (SELECT CAST(min(o_orderdate) AS DATE) + 3 AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders))""")
def month_windows(spark, sf_dir):
    span = read(spark, sf_dir, "orders").agg(F.date_add(F.min("o_orderdate").cast("date"), 3).alias("lo"), F.max("o_orderdate").cast("date").alias("hi"))
    windows = span.select(F.inline(dates.month_windows(F.col("lo"), F.col("hi"), 3)))
    return windows.select(F.date_format("from", "yyyy-MM-dd").alias("from_day"), F.date_format("to", "yyyy-MM-dd").alias("to_day"))


@query("""SELECT row_id, coalesce(len(CASE WHEN json_valid(attachment_urls) AND json_type(attachment_urls) = 'ARRAY' THEN CAST(attachment_urls AS VARCHAR[]) END), 0) AS n,
coalesce(CASE WHEN json_valid(attachment_urls) AND json_type(attachment_urls) = 'ARRAY' THEN json_extract_string(attachment_urls, '$[0]') END, '') AS first_url
FROM (SELECT row_id, CASE WHEN json_valid(attachment_urls) AND json_type(attachment_urls) = 'ARRAY' THEN attachment_urls ELSE '[]' END AS attachment_urls FROM objective_records)""")
def attachment_json_roundtrip(spark, sf_dir):
    """Lists read, written and read again."""
    again = text.url_list(F.to_json(text.url_list(F.col("attachment_urls"))))
    return read(spark, sf_dir, "objective_records").select("row_id", F.size(again).cast("long").alias("n"), F.coalesce(F.try_element_at(again, F.lit(1)), F.lit("")).alias("first_url"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def events_json_extract(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("long").alias("k"))


@query("SELECT o_custkey AS customer, o_orderkey AS event_id, o_orderstatus AS code FROM orders WHERE o_custkey IS NOT NULL")
def vendor_events_unnest(spark, sf_dir):
    """Events out of nested vendor payloads [[...]] with a byte order mark in front."""
    from ..sources.parsers import vendor_events

    event = F.to_json(F.struct(F.col("o_orderkey").alias("EventID"), F.col("o_orderstatus").alias("Code")))
    payload = F.concat(F.lit("﻿[["), F.array_join(F.collect_list(event), ","), F.lit("]]"))
    landed = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(payload.alias("payload"))
    return landed.select(F.col("o_custkey").alias("customer"), F.inline(vendor_events(F.col("payload")))).select("customer", F.col("EventID").alias("event_id"), F.col("Code").alias("code"))


@query("SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, '' AS note, 'customer' AS origin FROM customer UNION ALL SELECT s_suppkey, s_name, '', '', 'supplier' FROM supplier")
def union_aligned(spark, sf_dir):
    """Tables of different columns under one header, missing ones empty."""
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("origin"))
    s = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.lit("").alias("note"), F.lit("supplier").alias("origin"))
    return c.unionByName(s, allowMissingColumns=True).fillna("", ["segment", "note"])


@query("SELECT row_id, url FROM news_articles UNION ALL SELECT row_id, url FROM objective_records")
def union_all(spark, sf_dir):
    return read(spark, sf_dir, "news_articles").select("row_id", "url").unionByName(read(spark, sf_dir, "objective_records").select("row_id", "url"))


@query("SELECT DISTINCT url FROM news_articles WHERE url IS NOT NULL AND url NOT IN (SELECT url FROM news_articles WHERE trim(coalesce(author, '')) <> '' AND url IS NOT NULL)")
def except_by_key(spark, sf_dir):
    """Urls no fetch of which names an author."""
    news = read(spark, sf_dir, "news_articles").select("url", "author").where("url is not null")
    return news.select("url").distinct().join(news.where(F.trim("author") != "").select("url"), "url", "left_anti")


@query("SELECT row_id, coalesce(nullif(body, ''), nullif(lead, ''), nullif(title, ''), '') AS content FROM news_articles")
def falsy_coalesce(spark, sf_dir):
    return read(spark, sf_dir, "news_articles").select("row_id", text.first_filled(F.col("body"), F.col("lead"), F.col("title")).alias("content"))


def unified_articles(articles: list[tuple[str, DataFrame]]) -> DataFrame:
    """Articles of several origins under one header, one per url by origin order, numbered by date.

    Rows travel with all columns given: leave texts out and join them by origin and row_id afterwards.
    """
    out = None
    for n, (origin, df) in enumerate(articles):
        rows = df.withColumns({"origin_file": F.lit(origin), "__origin": F.lit(n)})
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    out = out.withColumn("date", dates.norm_date(F.col("pub_datetime")))
    kept = dedup.keep_first(out, [F.coalesce("url", F.lit(""))], ["__origin", "row_id"])
    return dedup.sequential_id(kept, ["date", "source", "url", "row_id"], "unified_id", "u%06d")


_UNIFIED = """WITH d AS (SELECT 0 AS o, row_id, source, url, pub_date AS p, coalesce(nullif(body, ''), nullif(lead, ''), '') AS body, 'news' AS origin_file FROM news_articles
UNION ALL SELECT 1, row_id, source, url, publish_time, coalesce(nullif(raw_text, ''), nullif(title, ''), ''), 'records' FROM objective_records),
v AS (SELECT *, regexp_extract(trim(coalesce(p, '')), '^(\\d{4}-\\d{1,2}-\\d{1,2})(?:\\D|$)', 1) AS y, replace(regexp_extract(trim(coalesce(p, '')), '^(\\d{1,2}[/-]\\d{1,2}[/-]\\d{4})(?:\\D|$)', 1), '/', '-') AS dm FROM d),
k AS (SELECT *, coalesce(strftime(try_strptime(nullif(y, ''), '%Y-%m-%d'), '%Y-%m-%d'), strftime(try_strptime(nullif(dm, ''), '%d-%m-%Y'), '%Y-%m-%d'), '') AS date,
  row_number() OVER (PARTITION BY coalesce(url, '') ORDER BY o, row_id) AS n FROM v)
SELECT printf('u%06d', row_number() OVER (ORDER BY date, source, url, row_id)) AS unified_id, row_id, source, date, length(body) AS body_chars, origin_file FROM k WHERE n = 1"""


@query(_UNIFIED)
def articles_unified(spark, sf_dir):
    news = read(spark, sf_dir, "news_articles")
    records = read(spark, sf_dir, "objective_records")
    parts = [
        ("news", news.select("row_id", "source", "url", F.col("pub_date").alias("pub_datetime"), F.length(text.first_filled(F.col("body"), F.col("lead"))).cast("long").alias("body_chars"))),
        ("records", records.select("row_id", "source", "url", F.col("publish_time").alias("pub_datetime"), F.length(text.first_filled(F.col("raw_text"), F.col("title"))).cast("long").alias("body_chars"))),
    ]
    unified = unified_articles(parts)
    return unified.select("unified_id", "row_id", "source", "date", "body_chars", "origin_file")


def patched(df: DataFrame, patch: DataFrame, key: str, column: str) -> DataFrame:
    """df with blanks of a column filled from a patch of one row per key."""
    p = patch.select(F.col(key).alias("__k"), F.col(column).alias("__new"))
    joined = df.join(p, df[key] == F.col("__k"), "left")
    return joined.withColumn(column, F.coalesce(text.blank_to_null(F.col(column)), F.col("__new"))).drop("__k", "__new")


@query("SELECT n.row_id, coalesce(nullif(n.author, ''), m.a) AS author FROM news_articles n LEFT JOIN (SELECT url, max(author) AS a FROM news_articles WHERE author <> '' GROUP BY url) m ON m.url = n.url")
def column_patch(spark, sf_dir):
    """Missing authors filled from other fetches of the same url."""
    news = read(spark, sf_dir, "news_articles").select("row_id", "url", "author")
    known = news.where("author <> ''").groupBy("url").agg(F.max("author").alias("author"))
    return patched(news, known, "url", "author").select("row_id", "author")
