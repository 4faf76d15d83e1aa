import datetime as dt
import hashlib
import unicodedata

import pytest
from pyspark.sql import functions as F

from lacquer.functions import dates, ident, rules, text
from lacquer.functions.instants import with_readings


def one(spark, value, function):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(function(F.col("v")).alias("x")).first()["x"]


@pytest.mark.parametrize("value, want", [
    ("2026-07-10T10:00:00+07:00", "2026-07-10T03:00:00Z"), ("2026-07-10T03:00:00Z", "2026-07-10T03:00:00Z"), ("2026-07-10 10:00:00", "2026-07-10T03:00:00Z"),
    ("2026-07-10", "2026-07-10T00:00:00Z"), ("10/07/2026", "2026-07-10T00:00:00Z"), ("2026-07-10 00:00:00", "2026-07-10T00:00:00Z"),
    ("2026-07-10T03:00:00.123Z", "2026-07-10T03:00:00Z"), ("hôm nay", ""), ("31/02/2026", ""), (None, ""), ("", ""), ("2026", ""), ("2026-07", ""),
])
def test_to_utc(spark, value, want):
    assert one(spark, value, dates.to_utc) == want


@pytest.mark.parametrize("value, want", [("2026-07-10T10:00:00+07:00", "2026-07-10"), ("1/2/2026 09:00", "2026-02-01"), ("01-02-2026", "2026-02-01"), ("rác", ""), (None, ""), ("31/02/2026", "")])
def test_norm_date(spark, value, want):
    assert one(spark, value, dates.norm_date) == want


@pytest.mark.parametrize("value, want", [("3/4/24", dt.date(2024, 4, 3)), ("3/4/69", dt.date(1969, 4, 3)), ("3/4/2024", dt.date(2024, 4, 3)), ("4/2024", None)])
def test_report_date(spark, value, want):
    assert one(spark, value, dates.report_date) == want


@pytest.mark.parametrize("value, want", [("/Date(1784221200000)/", "2026-07-16T17:00:00Z"), ("/Date(-1000)/", "1969-12-31T23:59:59Z"), ("x", "")])
def test_vendor_date(spark, value, want):
    assert one(spark, value, dates.vendor_date) == want


def test_rfc822(spark):
    assert one(spark, "Sun, 07 Sep 2025 10:32:25 +0700", dates.rfc822_date) == "2025-09-07T10:32:25+07:00"
    assert one(spark, "07 Sep", dates.rfc822_date) == ""


def test_month_windows_clip_both_ends(spark):
    f = lambda _: dates.month_windows(F.lit("2024-01-15").cast("date"), F.lit("2024-05-10").cast("date"), 2)
    got = [(str(r["from"]), str(r["to"])) for r in one(spark, "", f)]
    assert got == [("2024-01-15", "2024-02-29"), ("2024-03-01", "2024-04-30"), ("2024-05-01", "2024-05-10")]


def test_checksum_of_one_text_in_many_writings(spark):
    base = "Cổ tức 10%"
    variants = [base, unicodedata.normalize("NFD", base), "<p>Cổ tức <b>10%</b></p>", "CỔ TỨC  10%", "Cổ tức\n10%", " cổ tức 10% "]
    got = {one(spark, v, ident.compute_checksum) for v in variants}
    assert got == {hashlib.sha256("cổ tức 10%".encode()).hexdigest()}
    assert one(spark, "Cổ tức 11%", ident.compute_checksum) not in got
    assert one(spark, None, ident.compute_checksum) == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("value, want", [
    ("https://a.example/p?b=2&a=1", "https://a.example/p?a=1&b=2"), ("HTTPS://Site.VN/Path/?x=1#frag", "https://site.vn/Path?x=1"),
    ("https://a.example/?utm_source=x&gclid=1&ref=2&reference=3", "https://a.example/?reference=3"), ("https://a.example", "https://a.example/"),
    ("https://a.example/p?A=%C3%A1+b&e=", "https://a.example/p?a=%C3%A1+b"), ("https://a.example/p?q=a~b*", "https://a.example/p?q=a~b%2A"), ("", ""), (None, ""),
])
def test_canonicalize_url(spark, value, want):
    assert one(spark, value, ident.canonicalize_url) == want


def test_body_lines(spark):
    value = "TIN MỚI\n  Một   câu. \n\n Xem thêm\nHai &amp; ba"
    assert one(spark, value, text.normalize_body) == "Một câu.\nHai & ba"
    short = one(spark, "x" * 50, lambda c: text.normalize_body(c, 20))
    assert short == "x" * 10 + f"\n{text.SHORTENED}\n" + "x" * 10
    assert one(spark, "chứng kho-\nán", text.dehyphenate) == "chứng khoán"


def test_file_names(spark):
    df = spark.createDataFrame([("MWG Khuyến nghị MUA", "01/02/2026"), ("Report: <BID> #1!", "2026-02-01")], "t string, d string")
    got = [r[0] for r in df.select(text.pdf_filename(F.col("t"), F.col("d"))).collect()]
    assert got == ["01-02-2026_MWG_Khuyến_nghị_MUA.pdf", "2026-02-01_Report_BID_1.pdf"]


def test_numbers(spark):
    assert one(spark, "24,340", text.clean_number) == "24340"
    assert one(spark, "nan", text.clean_number) == "" and one(spark, None, text.clean_number) == ""
    assert one(spark, "1 234.5", text.number) == 1234.5 and one(spark, "abc", text.number) is None


@pytest.mark.parametrize("value, want", [
    ("Công bố báo cáo tài chính quý II", "financial_statement"), ("Trả cổ tức bằng tiền", "dividend"), ("Mua lại doanh nghiệp X", "ma"),
    ("Phát hành thêm cổ phiếu tăng vốn điều lệ", "stock_issuance"), ("Khác", "other"), (None, "other"),
])
def test_first_match(spark, value, want):
    assert one(spark, value, rules.first_match) == want


@pytest.mark.parametrize("value, zone, want", [
    ("2:17 PM 11/12/2024", "Asia/Ho_Chi_Minh", {"dmy": "2024-12-11T07:17:00", "mdy": "2024-11-12T07:17:00"}),
    ("Chủ nhật, 31/03/2024, 15:34 (GMT+7)", "UTC", {"dmy": "2024-03-31T08:34:00"}),
    ("2024-11-03 01:30:00", "America/New_York", {"fixed": "2024-11-03T05:30:00"}),
    ("2024-03-10 02:30:00", "America/New_York", {"fixed": "2024-03-10T07:30:00"}),
    ("26 tháng 4, 2024 12:17 SA", "Asia/Ho_Chi_Minh", {"fixed": "2024-04-25T17:17:00"}), ("Nov 21, 2025 7:41 AM AEDT", "UTC", {"fixed": "2025-11-20T20:41:00"}),
    ("12-02-2024", "Asia/Ho_Chi_Minh", {"dmy": "2024-02-12T00:00:00", "mdy": "2024-12-02T00:00:00"}), ("1715313411", "UTC", {"fixed": "2024-05-10T03:56:51"}),
    ("/Date(1744342416143)/", "UTC", {"fixed": "2025-04-11T03:33:36"}), ("20241124T011901Z", "UTC", {"fixed": "2024-11-24T01:19:01"}),
    ("31/02/2025", "UTC", {}), ("yesterday", "UTC", {}), ("2025-13-40T10:00:00Z", "UTC", {}), ("0000-00-00 00:00:00", "UTC", {}), ("", "UTC", {}), (None, "UTC", {}),
    ("13:00 PM 1/1/2024", "UTC", {}), ("x" * 5000, "UTC", {}),
])
def test_readings(spark, value, zone, want):
    df = with_readings(spark.createDataFrame([(value,)], "v string"), F.col("v"), F.lit(zone), "r")
    got = {r["form"]: dt.datetime.fromtimestamp(r["utc_s"], dt.UTC).strftime("%Y-%m-%dT%H:%M:%S") for r in df.first()["r"]}
    assert got == want
