"""Sources, files beside the tables, runs, and what a session must name."""

import datetime as dt
import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from lacquer import session
from lacquer.plans import records
from lacquer.plans.series import macro
from lacquer.sources import archive, outlets, pages, parsers, readers, runs, sinks, specs
from lacquer.streaming import ingest

NOW = "2026-07-12T02:00:00Z"


def payloads(spark, *texts, **columns):
    rows = [(t, *columns.values()) for t in texts]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ["payload", *columns]))


def one(spark, text, parse):
    return spark.createDataFrame([(text,)], "x string").select(parse(F.col("x")).alias("y")).first()["y"]


def test_notices_take_the_nearest_date(spark):
    page = (
        '<div>Ngày 01/01/2020<ul><li><h3><a href="/ad/1">VNM0012: Trả cổ tức</a></h3><span>5/7/2026</span></li>'
        '<li><p><b><i><u><a href="https://b.example/2">ACB0099 - Họp</a></u></i></b></p></li><li><a href="#x">VNM0001: x</a> <a href="">VNM0002: y</a> <a href="/m">Menu</a></li></ul></div>'
    )
    got = [(x["url"], x["title"], x["ticker"], x["pub_date"]) for x in one(spark, page, lambda c: pages.notices(c, "https://a.example"))]
    assert got == [("https://a.example/ad/1", "VNM0012: Trả cổ tức", "VNM", "5/7/2026"), ("https://b.example/2", "ACB0099: Họp", "ACB", "")]
    assert one(spark, None, lambda c: pages.notices(c, "")) == [] and one(spark, "<a href", lambda c: pages.notices(c, "")) == []
    universe = spark.createDataFrame([("VNM", "Sữa")], "ticker string, company_name string")
    rows = specs.records_of(outlets.NOTICES, payloads(spark, page), NOW, universe).collect()
    assert [(r["company_code"], r["company_name"], r["publish_time"], r["event_type"], r["raw_text"]) for r in rows] == [("VNM", "Sữa", "2026-07-05T00:00:00Z", "dividend", "VNM0012: Trả cổ tức")]
    with pytest.raises(ValueError):
        specs.records_of(outlets.NOTICES, payloads(spark, page), NOW)


def test_vendor_events_become_records(spark):
    event = {"EventID": 7, "Title": "", "Name": "Trả cổ tức", "Content": "<p>Cổ tức <b>10%</b></p>", "CompanyName": "Sữa", "Time": "/Date(1784221200000)/", "Extra": 1}
    texts = ["\ufeff" + json.dumps([[event, {"EventID": 8, "Title": "Họp", "Content": None, "Time": "x"}]]), json.dumps([event]), "broken", "{}"]
    rows = specs.records_of(outlets.VENDOR, payloads(spark, *texts, ticker="vnm"), NOW).collect()
    assert len(rows) == 3 and [tuple(r.asDict()) for r in rows[:1]] == [specs.RECORD_FIELDS]
    first = rows[0]
    assert (first["url"], first["publish_time"], first["title"], first["raw_text"], first["company_code"]) == ("https://finance.vietstock.vn/vnm/events/7", "2026-07-16T17:00:00Z", "Trả cổ tức", "Cổ tức 10%", "VNM")
    assert rows[1]["raw_text"] == "Họp" and rows[1]["publish_time"] == "" and first["document_id"] != rows[1]["document_id"]


def test_feeds_are_read_as_xml(spark):
    item = "<item><title> A &amp; B </title><link>https://a.example/1</link><pubDate>Sun, 12 Jul 2026 07:14:25 +0700</pubDate><description></description></item><item><title>x</title></item>"
    rows = specs.records_of(outlets.OUTLETS["nld"], payloads(spark, f"<rss><channel>{item}</channel></rss>", f"<rss>{item}", "", "no feed"), NOW).collect()
    assert [(r["title"], r["publish_time"], r["raw_text"], r["category"], r["event_type"], r["company_code"]) for r in rows] == [("A & B", "2026-07-12T00:14:25Z", "A & B", "nld", "other", "")]
    assert set(outlets.FEEDS) <= set(specs.REGISTRY) and all(s.feed for s in outlets.OUTLETS.values())


def test_listings_become_articles(spark):
    card = lambda pdf: f'chart__content__item--undetail"><span>05/03/2024</span>{pdf}<a class="titlePost" href="#">Bản <b>tin</b></a>'
    page = "top" + card('<a href="https://x.example/analysis-center/report/download/9">') + card("")
    rows = specs.articles_of(outlets.BULLETINS, payloads(spark, page, ""), NOW).collect()
    assert [(r["title"], r["pub_date"], r["author"], r["pdf_url"], r["source"]) for r in rows] == [("Bản tin", "05/03/2024", "SSI", "https://x.example/analysis-center/report/download/9", "ssi")]
    assert tuple(rows[0].asDict()) == specs.ARTICLE_FIELDS and len(rows[0]["id"]) == 12
    long = 'news-item flex-item"><h3>\n<a href="https://y.example/1">T</a></h3>' + "x" * 2600 + '<div class="news-des">late</div>'
    rows = specs.articles_of(outlets.RESEARCH, payloads(spark, long, category="sector-note"), NOW).collect()
    assert [(r["url"], r["title"], r["lead"], r["pub_date"], r["category"]) for r in rows] == [("https://y.example/1", "T", "", "", "sector-note")]
    links = "/en/research-insights-detail/b-2 /en/research-insights-detail/a-1 /en/research-insights-detail/b-2"
    rows = specs.articles_of(outlets.INSIGHTS, payloads(spark, links), NOW).collect()
    assert [r["url"].rsplit("/", 1)[1] for r in rows] == ["a-1", "b-2"]


def test_report_cards(spark):
    page = (
        '<div id=c1><p><img src="/edocs/1.jpg"></p><h4>Báo cáo A</h4><p>Nguồn: KLM</p><i>_3/04/26_ 05/06/2026</i><a href="/edoc/1">xem</a><a href="/edoc/1b">xem</a></div>'
        '<div id=c2><a href="/edoc/1">Tải về</a></div><div id=c3><b></b><a href="https://z.example/download/2">Download</a></div><div><a href="/menu">Tải về</a></div>'
    )
    got = [tuple(x) for x in one(spark, page, lambda c: pages.report_cards(c, "https://a.example", "house"))]
    assert got == [("Báo cáo A", "https://a.example/edoc/1", "3/04/26", "KLM"), ("Download", "https://z.example/download/2", "", "house")]
    assert specs.articles_of(outlets.CARDS, payloads(spark, page), NOW).count() == 2


def test_bodies_of_sources_and_their_limits(spark):
    text = "Câu dài của bài. " * 30
    page = f"<main>menu {'x' * 400}<section class='big container'><p>{text}</p>\n<p>XEM THÊM</p></section></main>"
    assert one(spark, page, lambda c: pages.html_body(c, "hsc")) == text.strip()
    assert one(spark, page, pages.html_body).startswith("menu xxx")
    assert one(spark, "<article>short</article>", pages.html_body) == ""
    cut = one(spark, f"<article>{'y' * 500}z</article>", lambda c: pages.html_body(c, max_chars=100))
    assert cut == "y" * 50 + "\n[…truncated…]\n" + "y" * 49 + "z"
    assert one(spark, f"<article>R&amp;amp;D {'x' * 300}</p></div>", pages.html_body).startswith("R&D ")


def test_fates_add_up_and_are_observed(spark):
    rows = spark.createDataFrame([(1, "a", "2026-01-05"), (2, "a", "2026-01-04"), (3, "b", "2025-12-31"), (4, None, "2026-01-01"), (5, "", None), (6, "c", None), (7, "d", "2026-02-02"), (8, "e", "2026-01-01"), (8, "e", "2026-01-01")], "n int, url string, day string")
    stored = spark.createDataFrame([("d",), (None,)], "url string")
    fates = specs.with_fates(rows, stored, "url", F.col("day").try_cast("date"), "2026-01-01", "2026-03-01", ["n"])
    got, seen = specs.counted(fates)
    kept = sorted(r["url"] for r in got.where("fate = 'kept'").collect())
    assert kept == ["a", "c", "e", "e"] or kept == ["a", "c", "e"]  # rows alike in every column are one and the same
    assert got.groupBy("n").agg(F.max("fate").alias("f")).orderBy("n").collect()[2]["f"] == "out_of_range"
    assert seen.get["fail"] == 2 and sum(seen.get.values()) == 9
    assert specs.with_fates(rows.limit(0), stored).count() == 0


def test_stored_records_come_back_with_defaults(spark):
    df = spark.createDataFrame([("t", '["u"]', None, 1), (None, "[broken", "", 2)], "title string, attachment_urls string, event_type string, n int")
    got = specs.rehydrated(df).collect()
    assert tuple(got[0].asDict()) == specs.RECORD_FIELDS and (got[0]["title"], got[0]["attachment_urls"], got[0]["language"], got[0]["event_type"]) == ("t", ["u"], "vi", "other")
    assert (got[1]["title"], got[1]["attachment_urls"], got[1]["event_type"], got[1]["url"]) == ("", [], "other", "")


def test_ingest_rejects_rows_without_url_and_caps(spark):
    feed = "<rss>" + "".join(f"<item><title>t{n}</title><link>https://a.example/{n}</link><pubDate>Sun, {n} Jul 2026 07:00:00 +0700</pubDate></item>" for n in range(10, 15)) + "</rss>"
    spec, p = outlets.OUTLETS["tuoitre"], payloads(spark, feed)
    stored = specs.records_of(spec, p, NOW).where("title = 't14'")
    assert sorted(r["title"] for r in runs.latest(spec, p, stored, NOW, most=2).collect()) == ["t12", "t13"]
    assert sorted(r["title"] for r in runs.backfill(spec, p, stored, NOW, "2026-07-11", "2026-07-12").collect()) == ["t11", "t12"]
    daily = runs.daily({"one": p, "two": p}, stored.select("url"), lambda df: df.select(F.inline(parsers.rss_items(F.col("payload")))))
    assert sorted((r["url"][-2:], r["section"]) for r in daily.collect()) == [(str(n), "one") for n in range(10, 14)]


def test_documents_beside_the_tables(spark, tmp_path):
    for name, size in (("a.pdf", 2000), ("b.pdf", 10), ("01-02-2024_Tin.pdf", 1500)):
        (tmp_path / name).write_bytes(b"x" * size)
    files = archive.file_names(spark, str(tmp_path), "*.pdf")
    assert {tuple(r) for r in files.collect()} == {("a.pdf", 2000), ("b.pdf", 10), ("01-02-2024_Tin.pdf", 1500)}
    assert archive.file_names(spark, str(tmp_path / "none")).count() == 0
    rows = spark.createDataFrame([("Tin", "01/02/2024", "u1", ""), ("Tin", "01/02/2024", "", None), ("X", "", "u2", " a.pdf "), ("Y", None, "u3", "gone.pdf"), (None, None, None, None)], "title string, date string, pdf_url string, pdf_filename string")
    out = archive.reconciled(rows, files)
    assert sorted((r["pdf_url"] or "", r["pdf_filename"] or "") for r in out.collect()) == [("", ""), ("", ""), ("u1", "01-02-2024_Tin.pdf"), ("u2", " a.pdf "), ("u3", "gone.pdf")]
    assert {r["pdf_url"] for r in archive.with_local_file(out, files).collect()} == {"u1", "u2"}
    assert [r["pdf_url"] for r in archive.outstanding(out, files).collect()] == ["u3"]
    assert [r["value"] for r in archive.failure_lines(archive.outstanding(out, files)).collect()] == ["u3\tY"]
    named = spark.createDataFrame([("T", "1/2/2024", "https://x/DownloadEdoc/55"), ("T", "1/2/2024", None)], "t string, d string, u string")
    assert [r[0] for r in named.select(archive.document_name(F.col("t"), F.col("d"), F.col("u"))).collect()] == ["1-2-2024_T__55.pdf", "1-2-2024_T.pdf"]
    assert [r[0] for r in rows.select(archive.body_key("vietstock", rows)).collect()] == [None, None, "pdf/a.pdf", "pdf/gone.pdf", None]


def test_document_texts_are_cached_but_not_empty_ones(spark, tmp_path):
    for name, text in (("a.pdf", "xin-\nchào  bạn"), ("b.pdf", " "), ("c.pdf", "hỏng"), ("d.pdf", "cũ")):
        (tmp_path / name).write_bytes(text.encode())
    listing = readers.files(spark, str(tmp_path), "*.pdf")

    def extract(data: bytes) -> str:
        if data == "hỏng".encode():
            raise ValueError("no document")
        return data.decode()

    path = {r["path"].rsplit("/", 1)[1]: r["path"] for r in listing.select("path").collect()}
    cache = spark.createDataFrame([(path["d.pdf"], "từ kho")], "path string, body string")
    bodies, kept = archive.document_bodies(listing, cache, extract)
    assert {r["path"].rsplit("/", 1)[1]: r["body"] for r in bodies.collect()} == {"a.pdf": "xinchào bạn", "b.pdf": "", "c.pdf": "", "d.pdf": "từ kho"}
    assert {r["path"].rsplit("/", 1)[1] for r in kept.collect()} == {"a.pdf", "d.pdf"}


def test_raw_payloads_are_kept_once(spark, tmp_path):
    df = spark.createDataFrame([("d1", "x"), ("d1", "x"), ("d2", None), (None, "z")], "document_id string, payload string")
    assert {r["raw_path"].rsplit("/", 1)[1] for r in archive.keep_raw(df, str(tmp_path / "raw")).collect()} == {"d1", "d2"}
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 2


def test_runs_keep_failures_to_themselves():
    def fails():
        raise OSError("down")

    assert runs.run_isolated({"a": lambda: 3, "b": fails, "c": lambda: 0}) == {"a": 3, "b": -1, "c": 0}
    done = []
    order = runs.run_stages({"dashboard": lambda: done.append("dashboard"), "digest": fails, "build_records": lambda: done.append("build"), "vsdc": fails})
    assert done == ["build", "dashboard"] and order.index("vsdc") < order.index("build_records") < order.index("dashboard")
    day = dt.date
    assert runs.page_is_old([day(2024, 1, 1)], day(2024, 2, 1)) and not runs.page_is_old([day(2024, 1, 1), None], day(2024, 2, 1))
    assert not runs.page_is_old([], day(2024, 2, 1)) and not runs.page_is_old([day(2024, 2, 1)], day(2024, 2, 1)) and not runs.page_is_old([day(2024, 1, 1)], None)


def test_windows_caps_and_retries(spark):
    stored = spark.createDataFrame([("2024-01-03T00:00:00Z",), ("2024-13-01",), (None,)], "day string")
    end = dt.date(2024, 2, 1)
    assert runs.window(stored, "day", end) == (dt.date(2024, 1, 4), end) and runs.window(None, "day", end) == (dt.date(2000, 1, 1), end)
    assert runs.window(stored, "day", end, dt.date(2024, 1, 1))[0] == dt.date(2024, 1, 1)
    df = spark.createDataFrame([(s, n) for s in ("a", "b", None) for n in range(200)], "source string, n int")
    assert {(r["source"], r["n"]) for r in runs.first_per_source(df, "source", ["n"], 3).collect()} == {(s, n) for s in ("a", "b", None) for n in range(3)}
    urls = lambda *u: spark.createDataFrame([(x,) for x in u], "url string")
    assert {r["url"] for r in runs.retried(urls("a", "b"), urls("b"), urls("c", "a")).collect()} == {"a", "c"}
    anchor = spark.createDataFrame([(dt.date(2024, 1, 2), 1.0, 1.0, 1.0, 1.0, 1.0)], "date date, open double, high double, low double, close double, volume double")
    empty = spark.createDataFrame([], "date date, dxy double")
    row = macro(anchor, runs.optional(empty), runs.optional(None), None).first()
    assert row["dxy"] is None and row["omo_rate"] is None and row["vni_close"] == 1.0


def test_files_by_pattern_and_lines_in_order(spark, tmp_path):
    for name, row in (("b_records.csv", "2,hai"), ("a_records.csv", '1,"một\nhai"'), ("news_unenriched_x_records.csv", "9,x")):
        (tmp_path / name).write_text("\ufeffn,v\n" + row + "\n", encoding="utf-8")
    got = readers.csv_files(spark, f"{tmp_path}/*_records.csv", "^news_unenriched_").orderBy("src_ord").collect()
    assert [(r["n"], r["v"], r["src_ord"]) for r in got] == [("1", "một\nhai", 0), ("2", "hai", 1)]
    with pytest.raises(FileNotFoundError):
        readers.csv_files(spark, f"{tmp_path}/none*.csv")
    folder = tmp_path / "lines"
    folder.mkdir()
    for n in range(6):  # Spark reads large files first; the first in order is the one of the first file
        (folder / f"{n}.json").write_text('{"url": "u", "n": %d}\nbroken\n{"n": 5}\n' % n + '{"url": "x%d", "n": 0}\n' % n * (n * 500), encoding="utf-8")
    rows = {r["url"]: r["n"] for r in readers.json_lines(spark, str(folder), "url string, n int", "url").collect()}
    assert rows["u"] == 0 and len(rows) == 6


def test_universe_files(spark, tmp_path):
    good = tmp_path / "u.toml"
    good.write_text('[vn30]\nVNM = "Sữa"\nACB = "Á Châu"\n', encoding="utf-8")
    assert {tuple(r) for r in readers.universe(spark, str(good), "vn30").collect()} == {("VNM", "Sữa"), ("ACB", "Á Châu")}
    with pytest.raises(ValueError):
        readers.universe(spark, str(good), "other")
    with pytest.raises(FileNotFoundError):
        readers.universe(spark, str(tmp_path / "none.toml"), "vn30")
    good.write_text('[vn30]\nvnm1x2 = "x"\n', encoding="utf-8")
    with pytest.raises(ValueError):
        readers.universe(spark, str(good), "vn30")


def test_dashboard_sections(spark):
    rows = [("VNM", "vietstock", "dividend", "2026-07-10T00:00:00Z"), ("VNM", "vietstock", "agm", "2026-06-01T00:00:00Z"), ("ACB", "vsdc", "bond_issuance", "2025-01-15T00:00:00Z")]
    df = spark.createDataFrame(rows, "company_code string, source string, event_type string, publish_time string")
    s = sinks.dashboard_stats(df, spark.range(5))
    assert (s["total_records"], s["tickers_covered"], s["by_source"], s["top_tickers"][0], s["news_corpus"]) == (3, 2, {"vietstock": 2, "vsdc": 1}, ("VNM", 2), 5)
    assert s["date_range"] == {"oldest": "2025-01-15", "newest": "2026-07-10"} and s["per_ticker"][0] == {"ticker": "VNM", "count": 2, "latest": "2026-07-10", "types": "agm, dividend"}
    assert s["monthly_counts"] == [("2025-01", 1), ("2026-06", 1), ("2026-07", 1)]
    page = sinks.dashboard("T <x>", s)
    assert "T &lt;x&gt;" in page and "<td>VNM</td><td>2</td>" in page and "2025-01-15 to 2026-07-10" in page
    empty = sinks.dashboard_stats(df.limit(0), spark.range(0))
    assert empty["total_records"] == 0 and empty["date_range"]["oldest"] == "" and "—" in sinks.dashboard("t", empty)


def test_small_reports(spark, tmp_path):
    with pytest.raises(ValueError):
        sinks.stats_text({"t": spark.range(5)}, most=4)
    assert sinks.stats_text({"t": spark.range(2).orderBy("id")}) == "== t\n  0\n  1"
    sinks.append_rows(spark.range(2), str(tmp_path / "t"), ["id", "note"])
    sinks.append_rows(spark.range(1), str(tmp_path / "t"), ["id", "note"])
    assert sorted((r["id"], r["note"]) for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [(0, ""), (0, ""), (1, "")]
    rows = spark.createDataFrame([("s", "2024-01-02", "a\n b"), (None, None, None)], "source string, day string, summary string")
    assert sinks.digest(rows, "D").split("\n")[0] == "# D" and "- 2024-01-02 a b" in sinks.digest(rows, "D")


def test_tables_are_merged_and_replaced(spark, tmp_path):
    path, row = str(tmp_path / "t"), lambda *r: spark.createDataFrame(r, "k string, n int")
    sinks.merge_rows(row(("a", 1), ("b", 1)), path, ["k"], ["n"])
    sinks.merge_rows(row(("b", 2), ("c", 1), ("a", 0)), path, ["k"], ["n"])
    assert sorted((r["k"], r["n"]) for r in sinks.latest(spark, path).collect()) == [("a", 1), ("b", 2), ("c", 1)]
    place, old = str(tmp_path / "p"), str(tmp_path / "old")
    sinks.replace_with_backup(row(("a", 1)), place, old)
    sinks.replace_with_backup(row(("b", 2)), place, old)
    assert [r["k"] for r in spark.read.parquet(place).collect()] == ["b"] and [r["k"] for r in spark.read.parquet(old).collect()] == ["a"]
    with pytest.raises(FileExistsError):
        sinks.replace_with_backup(row(("c", 3)), place, old)


def test_a_store_that_fails_ends_the_batch(spark, tmp_path):
    target = str(tmp_path / "stored")
    batch = spark.createDataFrame([("2024-01-02", 1), ("2024-01-03", 2)], "day string, n int")
    write = ingest.append_above_watermark(spark, target, "day", ["n"])
    write(batch, 0)
    write(batch.unionByName(spark.createDataFrame([("2024-01-04", 3), ("no day", 4)], "day string, n int")), 1)
    write(batch.limit(1), 2)
    assert sorted((r["day"], r["n"]) for r in spark.read.parquet(target).collect()) == [("2024-01-02", 1), ("2024-01-03", 2), ("2024-01-04", 3)]
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception):
        ingest.append_above_watermark(spark, str(broken), "day", ["n"])(batch, 1)


def test_texts_stay_out_of_the_shuffles(spark, sf_dir):
    """The build moves no raw text, the unified table no bodies."""
    plan = lambda q: q(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "raw_text" not in plan(records.objective_build)
    source = spark.read.parquet(f"{sf_dir}/news_articles.parquet").columns
    exchanged = [x for x in plan(records.articles_unified).split("\n") if "Exchange" in x]
    assert "body" in source and not any("body#" in x for x in exchanged)


def test_a_cluster_must_name_its_folder():
    def fake(master, named=None):
        conf = SimpleNamespace(get=lambda k, d=None: named)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, getConf=lambda: conf))

    for master in ("spark://h:7077", "yarn", "k8s://h", "local-cluster[3,2,1024]"):
        with pytest.raises(RuntimeError):
            session.shared_folder(fake(master))
    assert session.shared_folder(fake("yarn", "hdfs:///x/")) == "hdfs:///x"
    assert session.shared_folder(fake("local[4]")) == session.shared_folder(fake("local"))
