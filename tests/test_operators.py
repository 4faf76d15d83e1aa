import datetime as dt
import random

from pyspark.sql import Row
from pyspark.sql import functions as F

from lacquer.operators import dedup, series
from lacquer.operators.timeline import instants
from lacquer.plans.records import build_records, patched, tagged_records
from lacquer.plans.series import FEATURES, macro
from lacquer.sources import pages, parsers, sinks

DAY = [dt.date(2024, 1, d) for d in (2, 3, 4, 5, 8)]


def test_keep_first_does_not_depend_on_row_order(spark):
    rows = [(k, n, f"{k}{n}") for k in ("a", "b", None) for n in range(20)]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k string, n int, v string").repartition(4)
        assert {r["v"] for r in dedup.keep_first(df, ["k"], ["n"]).collect()} == {"a0", "b0", "None0"}
        assert {r["v"] for r in dedup.keep_last(df, ["k"], ["n"]).collect()} == {"a19", "b19", "None19"}


def test_empty_tables(spark):
    df = spark.createDataFrame([], "k string, n int")
    assert dedup.keep_first(df, ["k"], ["n"]).count() == 0
    assert dedup.sequential_id(df, ["n"], "id", "u%06d").count() == 0
    assert series.coverage(df, ["n"]).collect() == [Row(column_name="n", filled=0, percent=0)]


def test_filled_rows_come_first(spark):
    df = spark.createDataFrame([("u", 1, ""), ("u", 2, " "), ("u", 3, "f.pdf"), ("v", 4, None)], "k string, n int, f string")
    assert {r["n"] for r in dedup.prefer_filled(df, ["k"], "f", ["n"]).collect()} == {3, 4}


def test_watermark(spark):
    old = spark.createDataFrame([("2024-01-02",), ("2024-01-03",), ("bad",)], "d string")
    new = spark.createDataFrame([("2024-01-03", 102.0, 1), ("2024-01-04", 103.0, 2), ("2024-01-06", 999.0, 3), ("2024-01-04", 103.1, 4)], "d string, v double, n int")
    got = dedup.above_watermark(new, old, "d", ["n"], F.lit("2024-01-05").cast("date")).collect()
    assert [(r["d"], r["v"]) for r in got] == [("2024-01-04", 103.1)]


def test_unseen_by_either_key(spark):
    new = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "z"), (4, None, None)], "n int, u string, i string")
    seen = spark.createDataFrame([("a", "q"), ("w", "y")], "u string, i string")
    assert {r["n"] for r in dedup.unseen(new, seen, ["u", "i"]).collect()} == {3, 4}


def test_sequential_id_counts_over_partitions(spark):
    df = spark.range(1000).repartition(7).withColumn("o", -F.col("id"))
    got = dedup.sequential_id(df, ["o"], "uid", "u%06d").orderBy("uid").collect()
    assert [r["id"] for r in got] == list(range(999, -1, -1)) and got[0]["uid"] == "u000001" and got[-1]["uid"] == "u001000"


def as_of(spark, right, lag):
    anchor = spark.createDataFrame([(d,) for d in DAY], "date date")
    r = spark.createDataFrame(right, "date date, x double")
    return [row["x"] for row in series.as_of(anchor, r, ["x"], lag).orderBy("date").collect()]


def test_as_of(spark):
    d = lambda n: dt.date(2024, 1, n)
    assert as_of(spark, [(d(2), 1.0), (d(3), None), (d(4), 3.0)], 0) == [1.0, 1.0, 3.0, 3.0, 3.0]
    assert as_of(spark, [(d(2), 10.0)], 1) == [None, 10.0, 10.0, 10.0, 10.0]
    assert as_of(spark, [(d(5), 7.0)], 1) == [None, None, None, None, 7.0]
    # the newest row counts although its value is missing
    assert as_of(spark, [(d(6), 5.0), (d(7), None)], 0)[-1] is None
    assert as_of(spark, [], 0) == [None] * 5


def test_features_have_no_infinities_and_all_columns(spark):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(n), 1.0, 1.0, 1.0, 0.0 if n == 1 else 100.0, 5.0) for n in range(25)]
    anchor = spark.createDataFrame(rows, "date date, open double, high double, low double, close double, volume double")
    out = macro(anchor, None, None, None).orderBy("date").collect()
    assert out[0].asDict().keys() == dict.fromkeys(FEATURES).keys()
    assert out[1]["vni_return_1d"] is None and out[2]["vni_return_1d"] is None and out[3]["vni_return_1d"] == 0
    assert out[24]["vni_volume_zscore"] is None  # no spread
    assert all(r["dxy"] is None for r in out)


def record(spark, rows):
    names = ["row_id", "source", "source_tier", "publish_time", "company_code", "checksum"]
    return spark.createDataFrame([Row(**dict(zip(names, r))) for r in rows])


def test_build(spark):
    rows = [
        (1, "kho", "tier3", "2026-07-08T00:00:00Z", "AAA", "cA"), (2, "kho", "tier3", "2026-07-09T00:00:00Z", "AAA", "S"), (3, "luu", "tier1", "2026-07-10T00:00:00Z", "bbb ", "cB"),
        (4, "luu", "tier1", "2026-07-09T00:00:00Z", "AAA", "S"), (5, "luu", "tier1", "2026-07-10T00:00:00Z", "ZZZ", "cG"), (6, "luu", "tier1", "NOT-UTC", "AAA", "cX"),
    ]
    universe = spark.createDataFrame([("AAA",), ("BBB",)], "ticker string")
    df = record(spark, rows)
    assert sorted(r["row_id"] for r in build_records(df, universe).collect()) == [1, 2, 3]
    assert sorted(r["row_id"] for r in build_records(df, universe, prefer="tier").collect()) == [1, 3, 4]
    verdicts = {r["row_id"]: r["verdict"] for r in tagged_records(df, universe).collect()}
    assert verdicts[5] == "universe_rejected" and verdicts[6] == "utc_rejected"


def test_patch_fills_only_blanks(spark):
    df = spark.createDataFrame([(1, "u", ""), (2, "u", "own"), (3, "w", None)], "n int, url string, body string")
    patch = spark.createDataFrame([("u", "new")], "url string, body string")
    assert {r["n"]: r["body"] for r in patched(df, patch, "url", "body").collect()} == {1: "new", 2: "own", 3: None}


def test_instants_without_a_stated_order_follow_the_chain(spark):
    # a source that writes month first: 6/25 cannot be day first, and the ambiguous ones follow it
    at = [dt.datetime(2024, 6 + n // 28, n % 28 + 1, 10, tzinfo=dt.UTC) for n in range(56)]
    rows = [(n, "s", f"{t.month}/{t.day}/2024 10:00", int(t.timestamp()) + 3600) for n, t in enumerate(at)]
    df = spark.createDataFrame(rows, "k long, s string, v string, c long").repartition(5)
    got = {r["k"]: r["utc_s"] for r in instants(df, "k", "v", F.lit("UTC"), F.lit(None).cast("string"), "s", F.col("c")).collect()}
    want = {n: int(t.timestamp()) for n, t in enumerate(at)}
    assert got == want
    assert instants(df.limit(0), "k", "v", F.lit("UTC"), F.lit(None).cast("string"), "s").count() == 0


def payload(spark, value, function):
    return spark.createDataFrame([(value,)], "v string").select(function(F.col("v")).alias("x")).first()["x"]


def test_vendor_payloads(spark):
    event = '{"EventID": 1, "Code": "AAA"}'
    for text in (f"[[{event}]]", f"[{event}]", f"﻿[[{event}]]"):
        assert [r["EventID"] for r in payload(spark, text, parsers.vendor_events)] == [1]
    assert payload(spark, "{broken", parsers.vendor_events) == []
    prices = payload(spark, '{"data": [{"date": "2024-01-02T00:00:00+07:00", "close": 1.5}]}', parsers.price_rows)
    assert prices[0]["date"] == "2024-01-02" and prices[0]["close"] == 1.5 and payload(spark, "x", parsers.price_rows) == []


def test_feeds_and_pages(spark):
    feed = "<rss><item><title><![CDATA[ Một & hai ]]></title><link>https://a.example/1.chn</link><pubDate>x</pubDate><description><p>D</p></description></item><item><title>no link</title></item></rss>"
    items = payload(spark, feed, parsers.feed_items)
    assert [(i["url"], i["title"]) for i in items] == [("https://a.example/1.chn", "Một & hai")]
    assert payload(spark, "<broken", parsers.feed_items) == []
    index = "".join(f"<loc>https://a.example/news-2024-{m}.xml</loc>" for m in (11, 2, 9))
    assert payload(spark, index, lambda c: parsers.shards_between(c, "2024-03", "2024-12")) == ["https://a.example/news-2024-9.xml", "https://a.example/news-2024-11.xml"]
    table = "<table><tr><td>EUR</td><td>1</td></tr><tr><td>US dollar</td><td>USD</td><td>24,180</td><td>-</td><td>24,550.5</td></tr></table>"
    rate = payload(spark, table, lambda c: parsers.rate_table(c, "USD"))
    assert (rate["buy"], rate["sell"]) == (24180.0, 24550.5) and payload(spark, "<p>", lambda c: parsers.rate_table(c, "USD")) is None
    links = payload(spark, '<a href="/n/1">ABC0001: Tin</a><a href="#">ABC0002: x</a><a href="/m">menu</a>', lambda c: parsers.notice_links(c, "https://a.example"))
    assert [(x["ticker"], x["title"], x["url"]) for x in links] == [("ABC", "Tin", "https://a.example/n/1")]
    assert [p.strip() for p in payload(spark, "x<li>one<li>two", lambda c: parsers.cards(c, "<li>", 10))] == ["one", "two"]
    crumbs = '<script type="application/ld+json">{"@type": "BreadcrumbList", "itemListElement": [{"item": {"@id": "https://a.example/other.chn"}}, {"item": {"@id": "https://a.example/stocks.chn"}}]}</script>'
    assert payload(spark, crumbs, lambda c: parsers.breadcrumb_section(c, ["stocks"])) == "stocks"
    meta = payload(spark, '<title>T &amp; U</title><meta property="og:description" content="D &lt;1"><script>{"datePublished": "2024-01-02T03:04:05+07:00"}</script>', parsers.article_meta)
    assert (meta["title"], meta["lead"], meta["published"]) == ("T & U", "D <1", "2024-01-02T03:04:05")
    page = "<html><nav>menu</nav><article><p>" + "Câu dài. " * 40 + "</p><script>x()</script></article></html>"
    assert payload(spark, page, pages.html_body).startswith("Câu dài.") and "x()" not in payload(spark, page, pages.html_body)
    assert payload(spark, "", pages.html_body) == "" and payload(spark, None, pages.html_body) == ""


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("v1", 1), ("v1", 2)], "version string, n int")
    sinks.write_version(df, str(tmp_path / "gold"), "2024-01-02")
    sinks.write_version(df.limit(1), str(tmp_path / "gold"), "2024-01-03")
    sinks.write_version(df, str(tmp_path / "gold"), "2024-01-03")
    assert sinks.latest(spark, str(tmp_path / "gold")).count() == 2
    path = tmp_path / "out.csv"
    sinks.export_csv(spark.createDataFrame([("a\nb", 'q"'), ("", "ô")], "x string, y string"), str(path))
    assert path.read_bytes().startswith(b"\xef\xbb\xbf")
    from lacquer.sources import readers

    assert [tuple(r) for r in readers.csv(spark, str(path)).collect()] == [("a\nb", 'q"'), ("", "ô")]
    assert readers.csv(spark, str(tmp_path / "none.csv"), columns=["x"]).count() == 0
