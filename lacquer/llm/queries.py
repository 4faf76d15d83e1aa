"""Queries of the training-data operators, by key, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.instants import with_readings
from . import cutoff, mainbody, mixing, mojibake, nearcopies, packing, repeated, survivors, textform, tokens


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of raw_text and body that are the page's."""
    parts = []
    for tbl, text in (("objective_records", "raw_text"), ("news_articles", "body")):
        found = mainbody.find_page_lines(_table(spark, sf_dir, tbl), "row_id", text, "title", "source")
        parts.append(found.select(F.lit(tbl).alias("tbl"), "row_id", "line_no"))
    return parts[0].unionByName(parts[1])


def p1_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_text and body without the page's lines."""
    parts = []
    for tbl, text in (("objective_records", "raw_text"), ("news_articles", "body")):
        main = mainbody.main_body(_table(spark, sf_dir, tbl), "row_id", text, "title", "source")
        parts.append(main.select(F.lit(tbl).alias("tbl"), "row_id", "main_body"))
    return parts[0].unionByName(parts[1])


def p1_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_text and body as they are read: rendered, without tags and without the page's lines."""
    parts = []
    for tbl, text in (("objective_records", "raw_text"), ("news_articles", "body")):
        main = mainbody.rendered_body(_table(spark, sf_dir, tbl), "row_id", text, "title", "source")
        parts.append(main.select(F.lit(tbl).alias("tbl"), "row_id", "main_text"))
    return parts[0].unionByName(parts[1])


def p1_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages around every document rendered: what is invisible is gone, blocks, items and aligned cells are there."""
    s = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    one_line = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\s\x1c-\x1f\x85\p{Z}]+", " "))
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        one_line = F.replace(one_line, F.lit(char), F.lit(entity))
    page = F.concat(
        F.lit("<html><head><title>x</title><style>p {}</style></head><body><nav><ul><li>Menu</ul></nav><h1>"), s("source"), F.lit('</h1><div style="display: none">Cookie</div><p>'), one_line,
        F.lit("<ul><li>"), s("lang"), F.lit("<li>"), s("doc_kind"), F.lit("</ul><table><tr><th>Mã<th>Số<tr><td>"), s("company_code"), F.lit("<td>"), s("n_chars"),
        F.lit("</table><aside>Tin khác</aside><script>x()</script><footer>f</footer></body></html>"),
    )
    text = mainbody.rendered_text(page)
    return _table(spark, sf_dir, "documents").select("doc_id", text.alias("t")).select("doc_id", F.length("t").cast("long").alias("chars"), F.md5("t").alias("text_md5"))


P1_PAGES_SQL = """
WITH d AS (SELECT doc_id, coalesce(source, '-') AS source, coalesce(lang, '-') AS lang, coalesce(doc_kind, '-') AS kind, coalesce(company_code, '-') AS code, coalesce(CAST(n_chars AS VARCHAR), '-') AS n,
  trim(regexp_replace(coalesce(text, ''), '[\\s\\x1c-\\x1f\\x85\\p{Z}]+', ' ', 'g')) AS line FROM documents),
t AS (SELECT doc_id, source || chr(10) || chr(10) || CASE WHEN line <> '' THEN line || chr(10) || chr(10) ELSE '' END || '• ' || lang || chr(10) || '• ' || kind || chr(10) || chr(10)
  || rpad('Mã', greatest(2, length(code))::INT, ' ') || ' | Số' || chr(10) || rpad(code, greatest(2, length(code))::INT, ' ') || ' | ' || n AS t FROM d)
SELECT doc_id, length(t) AS chars, md5(t) AS text_md5 FROM t
"""


P2_FIELDS = ["title", "company_code", "company_name", "publish_time", "category", "attachment_urls"]


def _record_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long rows of the records that form groups: same checksum, visible text."""
    rules = _table(spark, sf_dir, "source_registry").select("source", F.col("time_zone").alias("__zone"), F.col("date_order").alias("__order"))
    df = _table(spark, sf_dir, "objective_records").where(survivors.not_blank(F.col("checksum")) & survivors.visible(F.col("raw_text")))
    df = df.select("row_id", "checksum", "source", "source_tier", "crawl_time", *P2_FIELDS).join(rules, "source", "left")
    df = with_readings(df, F.col("publish_time"), F.coalesce("__zone", F.lit("UTC")), "__times")
    timed = F.exists("__times", lambda x: F.col("__order").isNull() | (x["form"] == "fixed") | (x["form"] == F.col("__order")))
    urls = survivors.url_count(F.col("attachment_urls"))
    fields = {n: (survivors.not_blank(F.col(n)), F.lit(0)) for n in P2_FIELDS} | {"publish_time": (timed, F.lit(0)), "attachment_urls": (urls > 0, urls)}
    order = F.struct(survivors.tier_rank(F.col("source_tier")).alias("tier"), F.coalesce("crawl_time", F.lit("")).alias("crawled"), (-F.col("row_id")).alias("first"))
    weight = survivors.record_weight(F.col("source_tier"), F.try_to_date(F.substring("crawl_time", 1, 10)), F.lit(P2_NOW).cast("date"))
    return survivors.long_rows(df, F.lower("checksum"), "row_id", weight, order, fields)


#: The day from which ages are counted, a parameter so that results can be repeated.
P2_NOW = "2026-07-01"


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row that supplies each field of each group of records with one checksum."""
    best = survivors.supplying_rows(_record_fields(spark, sf_dir), P2_FIELDS)
    return best.select(F.col("g").alias("checksum"), "field_name", F.col("r").alias("row_id"))


def p2_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per group whose fields won the vote of trust times recency."""
    return survivors.voted_records(_record_fields(spark, sf_dir), P2_FIELDS).withColumnRenamed("g", "checksum")


def p2_untimed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p2_found without publish_time, which SQL can follow."""
    return p2_found(spark, sf_dir).where(F.col("field_name") != "publish_time")


P2_SQL = """
WITH e AS (
  SELECT *, lower(checksum) AS g, lower(trim(coalesce(source_tier, ''))) AS tier,
         CASE WHEN json_valid(attachment_urls) AND json_type(attachment_urls) = 'ARRAY'
              THEN len(list_distinct(list_filter(json_extract_string(attachment_urls, '$[*]'), lambda x: x IS NOT NULL AND trim(x) <> ''))) ELSE 0 END AS urls
  FROM objective_records
  WHERE trim(coalesce(checksum, '')) <> '' AND regexp_matches(regexp_replace(coalesce(raw_text, ''), '<[^>]*>', '', 'g'), '\\S')
), m AS (SELECT g FROM e GROUP BY g HAVING count(*) >= 2),
l AS (
  SELECT e.g, row_id, tier, coalesce(crawl_time, '') AS crawl_time, 0 AS urls, f.field_name, f.value
  FROM e JOIN m USING (g), unnest([{field_name: 'title', value: title}, {field_name: 'company_code', value: company_code},
       {field_name: 'company_name', value: company_name}, {field_name: 'category', value: category}]) AS t(f)
  UNION ALL
  SELECT e.g, row_id, tier, coalesce(crawl_time, ''), urls, 'attachment_urls', CASE WHEN urls > 0 THEN 'x' END FROM e JOIN m USING (g)
), k AS (
  SELECT *, row_number() OVER (PARTITION BY g, field_name ORDER BY urls DESC,
    CASE tier WHEN 'tier1' THEN 1 WHEN 'tier2' THEN 2 WHEN 'tier3' THEN 3 ELSE 4 END, crawl_time DESC, row_id) AS n
  FROM l WHERE trim(coalesce(value, '')) <> ''
)
SELECT g AS checksum, field_name, row_id FROM k WHERE n = 1
"""


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles and leads that were decoded wrongly."""
    return mojibake.find_garbled(_table(spark, sf_dir, "news_articles"), "row_id", ["title", "lead"]).select("row_id", "field_name")


def p3_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same values with their original text, null where bytes were lost."""
    return mojibake.find_garbled(_table(spark, sf_dir, "news_articles"), "row_id", ["title", "lead"])


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are excessive within their source: led to its templates, and of those to the ones without word slots."""
    return repeated.repeated_lines(_table(spark, sf_dir, "news_articles"), "row_id", "source", "body", alike=repeated.ALIKE, same_text=True)


def p4_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies without the lines that are excessive within their source."""
    clean = repeated.without_repeated_lines(_table(spark, sf_dir, "news_articles"), "row_id", "source", "body", alike=repeated.ALIKE, same_text=True)
    return clean.select("row_id", "clean_text")


def p4_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Templates of each source's repeated lines, with slots for digits and for words."""
    return repeated.line_templates(_table(spark, sf_dir, "news_articles"), "source", "body")


P4_SQL = """
WITH l AS (
  SELECT row_id, source, unnest(string_split(body, chr(10))) AS x, generate_subscripts(string_split(body, chr(10)), 1) AS line_no
  FROM news_articles WHERE body IS NOT NULL
), f AS (
  SELECT row_id, source, line_no,
         regexp_replace(trim(regexp_replace(lower(x), '[\\s\\x1c-\\x1f\\x85\\p{Z}]+', ' ', 'g')), '[0-9]+', '0', 'g') AS form
  FROM l
), n AS (SELECT source, count(*) AS total FROM news_articles GROUP BY source),
c AS (SELECT source, form, count(DISTINCT row_id) AS c FROM f WHERE form <> '' GROUP BY source, form)
SELECT f.row_id, CAST(f.line_no AS INT) AS line_no
FROM f JOIN c ON f.source IS NOT DISTINCT FROM c.source AND f.form = c.form
       JOIN n ON f.source IS NOT DISTINCT FROM n.source
WHERE c.c >= 4 AND c.c >= 0.05 * n.total
"""


def _near_copies(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    df, dropper = mainbody.line_dropper(_table(spark, sf_dir, "objective_records"), "row_id", "raw_text", "source", "context")
    return nearcopies.near_copies(df, "row_id", "title", "raw_text", words=3, threshold=0.6, min_words=80, drop_lines=dropper, context="context")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of records that report one disclosure: exact copies and edited versions."""
    return nearcopies.all_pairs(*_near_copies(spark, sf_dir)).select(F.col("id_a").alias("row_id_a"), F.col("id_b").alias("row_id_b"))


def p5_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per record: its class of exact copies and the links of that class."""
    members, links = _near_copies(spark, sf_dir)
    degree = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("links"))
    return members.join(degree, "rep", "left").select(F.col("id").alias("row_id"), F.col("rep").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of objective_records that differ from their consistent form."""
    return textform.find_inconsistent(_table(spark, sf_dir, "objective_records"), "row_id", ["title", "raw_text", "company_name"])


def p7_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title, text and company name of every record in consistent form."""
    fields = ["title", "raw_text", "company_name"]
    return _table(spark, sf_dir, "objective_records").select("row_id", *(textform.consistent_form(f).alias(f) for f in fields))


def _token_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of all documents, computed once."""
    docs = _table(spark, sf_dir, "documents")
    return docs.select("doc_id", "source", tokens.token_count(F.col("text")).alias("tokens")).checkpoint()


def p8_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Container of every document for each capacity."""
    sizes, out = _token_sizes(spark, sf_dir), None
    for spec in _table(spark, sf_dir, "pack_specs").orderBy("spec_id").collect():
        packed = packing.pack(sizes, "doc_id", "tokens", spec["capacity_tokens"]).select(F.lit(spec["spec_id"]).alias("spec_id"), "*")
        out = packed if out is None else out.unionByName(packed)
    return out


def p8_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers of each capacity are."""
    sizes, out = _token_sizes(spark, sf_dir), None
    for spec in _table(spark, sf_dir, "pack_specs").orderBy("spec_id").collect():
        used = packing.usage(packing.pack(sizes, "doc_id", "tokens", spec["capacity_tokens"]), spec["capacity_tokens"])
        used = used.select(F.lit(spec["spec_id"]).alias("spec_id"), F.lit(spec["capacity_tokens"]).alias("capacity"), "*")
        out = used if out is None else out.unionByName(used)
    return out


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the mix and how often each is used."""
    return mixing.mix(_token_sizes(spark, sf_dir), "doc_id", "source", "tokens", _table(spark, sf_dir, "mix_targets"))[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual share of each source."""
    return mixing.mix(_token_sizes(spark, sf_dir), "doc_id", "source", "tokens", _table(spark, sf_dir, "mix_targets"))[1]


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose text stops before its end."""
    scored = cutoff.score_ends(_table(spark, sf_dir, "documents"), "doc_id", "text", "source")
    return scored.where(F.col("score") > 0.5).select("doc_id")


def p10_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of truncated texts per source."""
    return cutoff.truncation_by_source(cutoff.score_ends(_table(spark, sf_dir, "documents"), "doc_id", "text", "source"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_main": p1_main,
    "p1_text": p1_text,
    "p1_pages": p1_pages,
    "p2_found": p2_found,
    "p2_merged": p2_merged,
    "p2_untimed": p2_untimed,
    "p3_found": p3_found,
    "p3_restored": p3_restored,
    "p4_found": p4_found,
    "p4_clean": p4_clean,
    "p4_templates": p4_templates,
    "p5_found": p5_found,
    "p5_classes": p5_classes,
    "p7_found": p7_found,
    "p7_form": p7_form,
    "p8_packed": p8_packed,
    "p8_usage": p8_usage,
    "p9_mix": p9_mix,
    "p9_shares": p9_shares,
    "p10_found": p10_found,
    "p10_sources": p10_sources,
}

ORACLE_SQL: dict[str, str] = {
    "p1_pages": P1_PAGES_SQL,
    "p2_untimed": P2_SQL,
    "p4_found": P4_SQL,
}
