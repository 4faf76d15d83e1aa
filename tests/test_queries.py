"""Every query with SQL, against that SQL; the others run and keep their columns."""

import pytest

from lacquer.plans import outlets, payloads, records, series, streams, times

SETS = (records, payloads, outlets, series, streams, times)
QUERIES = {k: v for s in SETS for k, v in s.QUERIES.items()}
SQL = {k: v for s in SETS for k, v in s.ORACLE_SQL.items()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(name, against_sql):
    against_sql(QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["row_id", "document_id", "source", "publish_time", "company_code", "title", "checksum"]
    assert set(QUERIES) <= set(entry.queries())


def test_html_links_of_all_rows(spark, tmp_path):
    """Links of rows beyond the first 500 come out too, each once per source."""
    rows = [(n, None if n % 50 == 0 else f"s{n % 2}", None if n == 7 else f"https://a.example/page-{n % 900}") for n in range(1200)]
    spark.createDataFrame(rows, "row_id long, source string, url string").write.parquet(f"{tmp_path}/news_articles.parquet")
    got = [tuple(r) for r in records.html_links(spark, str(tmp_path)).select("source", "link").collect()]
    want = {(source, url.split("/")[3]) for _, source, url in rows if url}
    assert len(got) == len(set(got)) and set(got) == want


HARD = ["", None, 'A "quoted" & <b>bold</b> \'x\'', "&amp; stays, &nbsp; too", "1 < 2 > 0", "</title></p></a><script>x()</script>", "plain"]


def test_pages_of_hard_values(spark, tmp_path):
    """Values with markup, entities and quotes, and nulls, come out of the pages as they are."""
    news = [(n, t, u) for n, (t, u) in enumerate((t, u) for t in HARD for u in HARD)]
    spark.createDataFrame(news, "row_id long, title string, lead string").write.parquet(f"{tmp_path}/news_articles.parquet")
    got = {r["row_id"]: (r["title"], r["lead"]) for r in payloads.article_meta(spark, str(tmp_path)).collect()}
    assert got == {n: (t or "", u or "") for n, t, u in news}
    records_ = [(n, "ABC", t) for n, t in enumerate(HARD)] + [(90, None, "x"), (91, "abc", "x")]
    spark.createDataFrame(records_, "row_id long, company_code string, title string").write.parquet(f"{tmp_path}/objective_records.parquet")
    got = {r["row_id"]: (r["ticker"], r["title"]) for r in payloads.notice_links(spark, str(tmp_path)).collect()}
    assert got == {n: ("ABC", t) for n, t in enumerate(HARD) if t}


def test_body_text_of_every_document(spark, tmp_path):
    import hashlib

    docs = [(n, t if t is None else f" {t} " * (300 if n % 2 else 1)) for n, t in enumerate([*HARD, *HARD])]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["chars"], r["body_md5"]) for r in outlets.html_body(spark, str(tmp_path)).collect()}
    bodies = {n: " ".join(t.split()) if t and len(t) >= 200 else "" for n, t in docs}
    assert got == {n: (len(b), hashlib.md5(b.encode()).hexdigest()) for n, b in bodies.items()} and sum(map(bool, bodies.values())) > 3


def test_every_article_has_a_day_and_a_whole_card(spark, tmp_path):
    days = {"05/03/2024": "2024-03-05", " 5/3/24 ": "2024-03-05", "31/02/2024": None, "24/11/2024 10:00": None, "2024-11-24T01:00:00Z": None, "": None, None: None}
    rows = [(n, d, "t" * (n * 700)) for n, d in enumerate(days)]
    spark.createDataFrame(rows, "row_id long, pub_date string, title string").selectExpr("*", "'https://a.example/1' as url").write.parquet(f"{tmp_path}/news_articles.parquet")
    assert {r["row_id"]: r["day"] for r in records.report_date(spark, str(tmp_path)).collect()} == dict(enumerate(days.values()))
    cards = {r["row_id"]: r["card"] for r in payloads.listing_cards(spark, str(tmp_path)).collect()}
    assert cards == {n: ('"https://a.example/1">' + t)[:3000] for n, _, t in rows}


def test_counters_add_up(spark, sf_dir):
    n = {r["counter"]: r["n"] for r in records.objective_counters(spark, sf_dir).collect()}
    assert n["read"] == n["utc_rejected"] + n["universe_rejected"] + n["kept"] + n["deduped"]


def test_withheld_date_orders_are_mostly_found_again(spark):
    rows = times.p6_inferred(spark, "/root/testdata/sf0.01").collect()
    assert sum(bool(r["ok"]) for r in rows) >= 0.97 * len(rows)
