"""Text operators: page lines, consistent form, wrong encodings, repeated lines, cut-off ends."""

import random
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lacquer.llm import cutoff, mainbody, mojibake, queries, repeated, textform

VI = "Ngân hàng Thương mại Cổ phần báo cáo lợi nhuận sau thuế tăng trưởng vượt kế hoạch đề ra của Hội đồng quản trị"


# consistent form


@pytest.mark.parametrize("value, want", [
    ("Νgân hàng TMСΡ Đạі Νgàn Lаm", "Ngân hàng TMCP Đại Ngàn Lam"), (unicodedata.normalize("NFD", VI), VI), ("Ｃôｎｇ ｔｙ　ＣP", "Công ty CP"),
    ("C­ông t‍y CP⁠", "Công ty CP"), ("CV‑LKT", "CV-LKT"), ("Ɖông Ðức", "Đông Đức"), ("Quуết định", "Quyết định"),
    ("𝐍gân", "Ngân"), ("Ⅼam", "Lam"), ("Ꭰông", "Dông"), ("ɴgân", "ngân"), ("Nㅤgân", "Ngân"), ("ꓐa", "Ba"), ("Quý Ⅳ, 25 ℃, № 5", "Quý Ⅳ, 25 ℃, № 5"), ("Μаи", "Маи"), ("ΤΡ. ΗСΜ", "TP. HCM"),
    ("Ёлка", "Ёлка"), ("中文 ABC", "中文 ABC"), ("שלום", "שלום"), ("Зелторг góp vốn", "Зелторг góp vốn"), ("Hệ số β, Δ và Σ", "Hệ số β, Δ và Σ"), ("“a” – ‘b’… \t\n  c", "“a” – ‘b’… \t\n  c"), ("СР", "CP"), ("a ½ b™", "a ½ b™"), ("", ""), (None, None),
])
def test_consistent(value, want):
    assert textform.consistent(value) == want


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_consistent_twice_is_once(value):
    once = textform.consistent(value)
    assert textform.consistent(once) == once and once.count("\n") == value.count("\n")


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=12), max_size=8))
def test_consistent_in_batches(values):
    assert textform.consistent_all(values) == [textform.consistent(v) for v in values]


def test_find_inconsistent_with_clashing_columns(spark):
    df = spark.createDataFrame([(1, "Lаm", "x", 5), (2, None, "", 5), (3, "Lam", "a​b", 5)], "row_id long, title string, v string, p int")
    got = {tuple(r) for r in textform.find_inconsistent(df, "row_id", ["title", "v"]).collect()}
    assert got == {(1, "title"), (3, "v")}
    assert textform.find_inconsistent(df.limit(0), "row_id", ["title"]).count() == 0


# page lines

PAGE = """Trang chủ · Thị trường · Doanh nghiệp
Thị trường
Cập nhật lúc 9:30 - 1/2/2024
Phóng viên: Lam Sa
Công ty báo cáo doanh thu thuần 12 tỷ đồng trong quý.
Kết luận - WXYZ
Doanh thu thuần | 12 | 14
• Ban lãnh đạo cho biết kế hoạch năm không đổi.
Quảng cáo
Quy định mới về cookie buộc công ty phải xin đồng ý.
Tin liên quan
• Cổ phiếu thép nổi sóng vì giá cước
Công ty khác mở rộng nhà máy
© 2024 Báo Lam. Giấy phép số 5/GP"""


def known(fragments=(), sentences=(), headings=()):
    """What would be known of a source."""
    items = [(0, f, mainbody.FRAGMENT) for f in fragments] + [(0, f, mainbody.SENTENCE) for f in sentences] + [(1, h, mainbody.HEADING) for h in headings]
    return mainbody.Kinds((h, mainbody._number(f), kind) for h, f, kind in items)


def test_page_lines():
    kinds = known(["quảng cáo"], ["cập nhật lúc 0:0 - 0/0/0"], ["kết luận"])
    assert mainbody.page_lines(PAGE, "x", kinds) == [1, 2, 3, 4, 9, 11, 12, 13, 14]
    assert mainbody.page_lines("Thông báo về cổ tức theo công văn số 5", None, kinds) == []
    for empty in (None, "", " \n\t"):
        assert mainbody.page_lines(empty, None, kinds) == []
    assert mainbody._line_items("s", "\x01\n\x02\nmột\nhai") == {"một", "hai", "\x02"} and mainbody.page_lines("\x01\n\x02\nmột", "t", kinds) is not None
    assert mainbody.page_lines("Một câu dài. " * 30_000, "t", kinds) == []
    table = "Câu đầu của bài viết dài hơn.\nChỉ tiêu | Năm nay | Năm trước\nDoanh thu | 12 | 14\nCâu cuối của bài viết."
    assert mainbody.page_lines(table, "t") == []  # a bar above a table row is its header


def test_render_keeps_lines_and_hides_what_is_invisible():
    html = "<div><p>Một</p><nav>menu\nmục</nav>\n<ul><li>a<li>b &amp; c</ul>\n<table><tr><td>x</td><td>1</td></tr></table><p>hết"
    got = mainbody.render(html)
    assert [n for n, _, _ in got] == [1, 2, 3, 4]
    assert got[0][2] and got[1][2] and got[2][1].split() == ["•", "a", "•", "b", "&", "c"] and "x | 1" in got[3][1]
    assert mainbody.render("a < b & c") == [(1, "a < b & c", False)]


@pytest.mark.parametrize("page, text", [
    ("<head><title>t</title></head><nav>m<ul><li>x</ul></nav><h1>A &amp; B</h1><p hidden>no</p><p>one<p>two<br>three", "A & B\n\none\n\ntwo\nthree"),
    ("<ul><li>a<li>b<ol><li>deep</ol></ul><p>end", "• a\n• b\n  • deep\n\nend"),
    ("<table><tr><th>long head<th>n<tr><td>x<td>1<tr><td>y<td>22</table>", "long head | n\nx         | 1\ny         | 22"),
    ("a | b\nccc | d\n\n\n1 | 2 | 3\nplain", "a   | b\nccc | d\n\n1 | 2 | 3\nplain"),
    ("<div aria-hidden=true>x</div>\n<p style='visibility:hidden'>y</p>z <i>w</i><!-- c -->", "z w"), ("a < b & c", "a < b & c"), ("", ""), (None, None), ("<p>", ""), ("</p></div>x", "x"),
])
def test_pages_are_rendered_as_they_look(page, text):
    assert mainbody.rendered(page) == text


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<ul>", "<li>", "</ul>", "<table>", "<tr>", "<td>", "</table>", "<div hidden>", "</div>", "a", " b | c", "\n", "\n\n", "&lt;", "<", "<!--", "-->"]), max_size=25))
def test_rendering_never_fails_and_keeps_line_numbers(parts):
    page = "".join(parts)
    assert [n for n, _, _ in mainbody.render(page)] == list(range(1, page.count("\n") + 2))
    out = mainbody.rendered(page)
    assert out is not None and "\n\n\n" not in out


def second_site():
    """Rows of a site in another language: pages with furniture in its own words, and the numbers of the furniture's lines."""
    rng = random.Random(12)
    nouns = "Werk Umsatz Gewinn Auftrag Anteil Kredit Markt Preis Fracht Hafen Strom Stahl Anlage Bilanz Fonds".split()
    verbs = "steigt sinkt bleibt wächst fällt erholt stockt dreht".split()
    sentence = lambda: f"Der {rng.choice(nouns)} {rng.choice(verbs)} um {rng.randrange(1, 99)} Prozent, weil der {rng.choice(nouns)} im {rng.choice(nouns)} {rng.choice(verbs)}."
    teaser = lambda: f"» {rng.choice(nouns)} {rng.choice(verbs)} trotz {rng.choice(nouns)} und {rng.choice(nouns)} im Monat {rng.randrange(1, 12)}"
    rows, want = [], {}
    for k in range(200):
        lines = [("Startseite · Märkte · Meinung · Daten", True), (f"Stand: {rng.randrange(24)}:{rng.randrange(60)} Uhr", True), (sentence() + " " + sentence(), False)]
        for _ in range(rng.randrange(2, 5)):
            lines += [(rng.choice(["Ausblick", "Ausblick: WXYZ", "Zahlen im Überblick - ABCD", "Zahlen im Überblick"]), False)] if rng.random() < 0.5 else []
            lines += [("Anzeige", True)] if rng.random() < 0.4 else []
            lines += [(sentence() + " " + sentence(), False)]
            lines += [("Kennzahl | Heuer | Vorjahr", False), (f"Umsatz | {rng.randrange(99)} | {rng.randrange(99)}", False)] if rng.random() < 0.2 else []
        lines += [("", False), ("Lesen Sie auch", True), (teaser(), True), (teaser(), True), ("Alle Angaben ohne Gewähr, keine Anlageberatung.", True), (f"Nr. {k} | Impressum | Datenschutz", True)]
        rows.append((k, "zweite", f"Titel {k}", "\n".join(x for x, _ in lines)))
        want[k] = {n for n, (_, page) in enumerate(lines, 1) if page}
    return rows, want


def test_a_second_site_in_other_words(spark):
    rows, want = second_site()
    rows += [(1000 + k, f"klein{k}", "t", "Nur ein Satz.") for k in range(500)]  # other sources change nothing
    df = spark.createDataFrame(rows, "row_id long, source string, title string, body string").repartition(5)
    got = {k: set() for k in want}
    for r in mainbody.find_page_lines(df, "row_id", "body", "title", "source").collect():
        got[r["row_id"]].add(r["line_no"])
    both = sum(len(got[k] & want[k]) for k in want)
    assert both >= 0.95 * sum(map(len, want.values())) and both >= 0.95 * sum(len(got[k]) for k in got)
    text = {r["row_id"]: r["main_text"] for r in mainbody.rendered_body(df, "row_id", "body", "title", "source").collect()}
    assert "Impressum" not in text[0] and text[0].startswith("Der ") and text[1000] == "Nur ein Satz."


def test_known_lines_by_join(spark, monkeypatch):
    """More known lines than are sent to tasks: the same lines by a join."""
    rows, _ = second_site()
    rows += [(900, None, "t", rows[0][3]), (901, "zweite", None, None), (902, "zweite", "t", "")]
    df = spark.createDataFrame(rows, "row_id long, source string, title string, body string").withColumn("item", F.lit(1)).withColumn("s", F.lit("x"))
    lines = lambda: sorted(tuple(r) for r in mainbody.find_page_lines(df, "row_id", "body", "title", "source").collect())
    sent = lines()
    bodies = {r["row_id"]: r["main_body"] for r in mainbody.main_body(df, "row_id", "body", "title", "source").collect()}
    assert bodies[901] is None and bodies[902] == "" and "Anzeige" not in bodies[0]
    monkeypatch.setattr(mainbody, "SENT", 1)
    assert lines() == sent and len(sent) > 1000
    again, dropper = mainbody.line_dropper(df, "row_id", "body", "source", "context")
    row = again.where("row_id = 0").first()
    assert dropper(row["body"], row["title"], row["context"]) == [n for k, n in sent if k == 0]
    assert mainbody.find_page_lines(df.limit(0), "row_id", "body", "title", "source").count() == 0


# wrong encodings


@pytest.fixture(scope="module")
def labeller():
    from collections import Counter

    return mojibake.Labeller(Counter((VI + " “x” ’ ® ") * 200))


@pytest.mark.parametrize("pair", [p for p in mojibake.PAIRS if p not in ("gbk", "big5", "lost", "cp1251", "cp850")])
def test_encodings_round_trip(labeller, pair):
    garbled, text, _ = labeller.judge([mojibake.garble(VI, pair)])[0]
    assert garbled and text == VI


def test_partly_lost_and_intact_values(labeller):
    half = "Báo cáo lợi nhuận " + mojibake.garble(VI, "cp1252")
    assert labeller.judge([half])[0][1] == "Báo cáo lợi nhuận " + VI
    assert labeller.judge([mojibake.garble(VI, "lost")])[0][:2] == (True, None)
    assert labeller.judge([mojibake.garble(VI, "gbk")])[0][0]
    clean = [VI, "R&amp;D", "“Quiet” firm’s plan", "Nhãn hiệu Ngàn® mới", "Hơn ½ cổ đông", "Cảng São Velho", "", None, "CHÂU ÂU VÀ BÃO GIÁ: tin", "a" * 20_000]
    assert not any(g for g, _, _ in labeller.judge(clean))


def test_find_garbled(spark):
    rows = [(1, VI, mojibake.garble(VI, "mac_roman")), (2, mojibake.garble(VI, "latin-1"), None), (3, "", "ascii")] + [(n, VI, VI) for n in range(10, 40)]
    df = spark.createDataFrame(rows, "row_id long, title string, lead string").withColumn("v", F.lit(1))
    got = {(r["row_id"], r["field_name"]): r["restored"] for r in mojibake.find_garbled(df, "row_id", ["title", "lead"]).collect()}
    assert got == {(1, "lead"): VI, (2, "title"): VI}


# repeated lines


def brute_repeated(rows, min_rows=4, share=0.05):
    import re
    from collections import defaultdict

    form = lambda x: re.sub("[0-9]+", "0", " ".join(x.lower().split()))
    total, seen = defaultdict(int), defaultdict(set)
    for i, (_, source, text) in enumerate(rows):
        total[source] += 1
        for line in (text or "").split("\n"):
            seen[source, form(line)].add(i)
    return {
        (k, n) for k, source, text in rows for n, line in enumerate((text or "").split("\n"), 1)
        if form(line) and len(seen[source, form(line)]) >= max(min_rows, share * total[source])
    }


def test_repeated_lines_as_by_brute_force(spark):
    rng = random.Random(3)
    lines = [f"dòng {c} số {d} của trang" for c in "abcdefgh" for d in (1, 22)] + ["", "  ", "Chia sẻ  Bài 7"]
    rows = [(k, rng.choice(["s", "s", "s", "t", None]), rng.choice([None, "", "\n".join(rng.choices(lines, k=rng.randrange(1, 5)) + [f"riêng {rng.random()}"])])) for k in range(150)]
    df = spark.createDataFrame(rows, "row_id long, source string, body string").withColumn("n", F.lit(1)).repartition(3)
    got = {tuple(r) for r in repeated.repeated_lines(df, "row_id", "source", "body").collect()}
    assert got == brute_repeated(rows)
    clean = {r["row_id"]: r["clean_text"] for r in repeated.without_repeated_lines(df, "row_id", "source", "body").collect()}
    assert all((clean[k] is None) == (text is None) for k, _, text in rows)
    assert repeated.repeated_lines(df.limit(0), "row_id", "source", "body").count() == 0


def test_repeated_lines_by_join(spark, monkeypatch):
    """More templates than are sent to tasks: the same lines by a join over salted sources."""
    rows = [(k, "s" if k % 3 else None, "\n".join(f"chung {d}" if k % 2 else f"riêng dòng {k}a" for d in "abc") + "\n\nTrang 5") for k in range(60)]
    df = spark.createDataFrame(rows, "row_id long, source string, body string")
    sent = sorted(tuple(r) for r in repeated.repeated_lines(df, "row_id", "source", "body").collect())
    clean = lambda: {r["row_id"]: r["clean_text"] for r in repeated.without_repeated_lines(df, "row_id", "source", "body").collect()}
    whole = clean()
    monkeypatch.setattr(repeated, "SENT", 1)
    assert sorted(tuple(r) for r in repeated.repeated_lines(df, "row_id", "source", "body").collect()) == sent and clean() == whole
    assert set(sent) == brute_repeated(rows) and len(sent) > 100


def test_templates_with_word_slots(spark):
    """A line whose words vary in one place is one template; texts that only begin alike are none."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdeghiklmnopqrstuvxy", k=6))
    names, words = [word() for _ in range(90)], [word() for _ in range(500)]
    rows = []
    for k in range(120):
        own = [" ".join(rng.choices(words, k=8)) for _ in range(3)]
        extra = [f"Theo dõi báo Lam cùng {rng.choice(names)} trên ứng dụng {k}"] if k % 2 else []
        rows.append((k, "s", "\n".join([*own, *extra])))
    rows += [(k, "t", f"Theo dõi báo Lam cùng {word()} trên ứng dụng {k}" if k % 70 == 0 else "") for k in range(1000, 1200)] + [(2000, None, None)]
    df = spark.createDataFrame(rows, "row_id long, source string, body string").repartition(3)
    got = [tuple(r) for r in repeated.line_templates(df, "source", "body", alike=0.6).collect()]
    assert got == [("s", "theo dõi báo lam cùng * trên ứng dụng 0", 60)]
    found = {tuple(r) for r in repeated.repeated_lines(df, "row_id", "source", "body", alike=0.6).collect()}
    assert found == {(k, 4) for k in range(1, 120, 2)}
    assert repeated.repeated_lines(df, "row_id", "source", "body").count() == 0
    assert repeated.line_templates(df.limit(0), "source", "body").count() == 0


def test_p4_rows_come_from_the_tree(spark, tmp_path, monkeypatch):
    """p4_found learns word slots, finds no line that the tree does not lead to a template, and keeps to equal texts."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdeghiklmnopqrstuvxy", k=6))
    lines = lambda k: [f"Theo dõi báo cùng {word()} trên ứng dụng", f"Theo dõi báo cùng {'Lam' if k % 9 else word()} ở {k}  nơi", "* * *", f"* * {word()}", word()]
    rows = [(k, ("s", "t", None)[k % 3], "\n".join(rng.sample(lines(k), 4))) for k in range(120)] + [(200, "s", None), (201, "u", "* * *")]
    spark.createDataFrame(rows, "row_id long, source string, body string").repartition(3).write.parquet(f"{tmp_path}/news_articles.parquet")
    found = lambda: sorted(tuple(r) for r in queries.p4_found(spark, str(tmp_path)).collect())
    learned, real = [], repeated.word_slots
    monkeypatch.setattr(repeated, "word_slots", lambda *a: learned.append(real(*a)) or learned[-1])
    want = sorted(brute_repeated(rows))
    assert found() == want and len(want) > 100
    assert learned and {x for k, s, t in rows if t for x in learned[0].templates(s, t)} >= {("theo dõi báo cùng * trên ứng dụng", 1), ("theo dõi báo cùng lam ở 0 nơi", 0), ("* * *", 0), ("* * *", 1)}
    for sent in (0, 3, 8, 40):  # leaves, constants or templates that are too many to send
        monkeypatch.setattr(repeated, "SENT", sent)
        assert found() == want
    monkeypatch.setattr(repeated, "SENT", 200_000)
    monkeypatch.setattr(repeated, "word_slots", lambda *a: repeated.Slots({}, {}, repeated.DEPTH, repeated.ALIKE))
    assert found() == []


# cut-off ends


def test_held_out_cuts_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where(F.col("text").rlike(r"[^.…][.]\s*$")).select("doc_id", "text", "source")
    cut = F.substring("text", F.lit(1), (F.length("text") * 0.7).cast("int"))
    half = docs.withColumn("was_cut", F.col("doc_id") % 5 == 0)
    half = half.withColumn("text", F.when(F.col("was_cut"), cut).otherwise(F.col("text")))
    inside = ~F.col("text").rlike(r"[.!?…”)|]\s*$|\n[^\n.]{0,60}$|[0-9]\s*$")
    scored = cutoff.score_ends(half, "doc_id", "text", "source").join(half.select("doc_id", "was_cut", inside.alias("inside")), "doc_id").collect()
    true = [r["score"] > 0.5 for r in scored if r["was_cut"] and r["inside"]]
    false = [r["score"] > 0.5 for r in scored if not r["was_cut"]]
    assert sum(true) >= 0.95 * len(true) and sum(false) <= 0.02 * len(false)


def test_ends_of_empty_and_odd_texts(spark):
    rows = [(1, None, "s"), (2, "", None), (3, " \n", "s"), (4, "x" * 50_000, "s"), (5, "Một câu trọn vẹn.", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("score", F.lit(9))
    got = {r["doc_id"]: r["score"] for r in cutoff.score_ends(df, "doc_id", "text", "source").collect()}
    assert got[1] is None and got[2] is None and got[3] is None and got[4] is not None
    assert cutoff.score_ends(df.limit(0), "doc_id", "text", "source").count() == 0
    shares = {r["source"]: r["texts"] for r in cutoff.truncation_by_source(cutoff.score_ends(df, "doc_id", "text", "source")).collect()}
    assert shares == {"s": 4, None: 1}


def test_limits_by_join(spark, monkeypatch):
    """More limits than are sent to tasks: the same scores by joins."""
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice(["giá", "cổ", "phiếu", "tăng", "mạnh"]) for _ in range(n)) + "."
    rows = [(k, (text(60) + text(60))[:200] if k % 3 == 0 else text(30), rng.choice(["s", "t", None])) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("at", F.lit(1)).withColumn("kind", F.lit(1))
    scores = lambda: {r["doc_id"]: r["score"] for r in cutoff.score_ends(df, "doc_id", "text", "source").collect()}
    sent = scores()
    monkeypatch.setattr(cutoff, "SENT", 0)
    again = scores()
    assert len(sent) == 300 and again.keys() == sent.keys() and all(abs(again[k] - sent[k]) < 1e-6 for k in sent)


def test_ends_far_back_are_seen(spark):
    """White space after a text, and a tag that opened long before its end, count as they would close by."""
    rng = random.Random(8)
    sentence = lambda: " ".join(rng.choice(["giá", "cổ", "phiếu", "tăng", "mạnh", "hôm", "nay"]) for _ in range(9)) + ". "
    link = lambda: f'<a href="{"x" * rng.randrange(100, 900)}">tin</a> '
    texts = ["".join(sentence() + link() for _ in range(6)) + sentence() for _ in range(300)]
    cut = "".join(sentence() for _ in range(5)) + "Giá cổ phiếu tăng"
    filler = "x" * 700
    texts += [cut, cut + " \n\u00a0" * 400, f"Tin. <a href={filler}", f"Tin. (a href={filler}", " " * 900]
    df = spark.createDataFrame([(k, t, "s") for k, t in enumerate(texts)], "doc_id long, text string, source string")
    got = {r["doc_id"]: r["score"] for r in cutoff.score_ends(df, "doc_id", "text", "source").collect()}
    assert got[301] is not None and got[301] == got[300] and got[304] is None
    assert got[302] > got[303]
