"""Main body of pages: which lines are the article's own and which are the page's.

Two stages.  A layout-aware renderer (tree builder with implied end tags and
visibility rules) emits all visible text: blocks with their spacing, list marks and
aligned table cells, each visible line tied to the stored line it came from.  Rendering
alone keeps menus and footers, so its lines are then judged by structure and by their
source: a fragment that many rows of the source have, or a sentence that a tenth of them
has, is the page's; bars of short items are menus; sentences, table rows and headings
between them are the article's; fragments that end openly are teasers.  The counts are
over all rows of a source, so they hold for any number of sources and rows.  No list of
wordings is used.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import repeated
from .textform import consistent, consistent_all

# Tag classes of the HTML standard used by the renderer.
HIDDEN = frozenset("head script style template noscript nav footer aside form button select svg iframe".split())
BLOCK = frozenset("p div section article main header h1 h2 h3 h4 h5 h6 ul ol li table tr blockquote pre figure dl dt dd br hr".split())
VOID = frozenset("br hr img input meta link wbr col area base embed source track".split())
#: An opening tag closes an open element of these kinds (implied end tags).
IMPLIED = {
    "p": ("p",), "li": ("li", "p"), "tr": ("td", "th", "tr", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"),
    "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "ul": ("p",), "ol": ("p",), "table": ("p",), "div": ("p",),
    "h1": ("p",), "h2": ("p",), "h3": ("p",), "option": ("option",),
}
#: Elements set off by a blank line.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol table blockquote pre figure dl".split())

_TAG = re.compile(r"<!--.*?(?:-->|$)|<(/?)([A-Za-z][A-Za-z0-9]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_HIDING = re.compile(r"\bhidden\b|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _walk(text: str) -> Iterator[tuple[str, str, bool]]:
    """("text", characters, hidden), ("open", tag, hidden), ("close", tag, hidden) and ("lines", breaks inside a tag, hidden).

    A tree is kept as a stack of open elements; an element closes the ones its tag
    implies closed.  Everything inside an invisible element is hidden.  Unbalanced end
    tags are ignored; an unclosed tag at the end is text.
    """
    stack: list[tuple[str, bool]] = []
    hidden = at = 0

    def close(name: str) -> Iterator[tuple[str, str, bool]]:
        nonlocal hidden
        while stack:
            top, was = stack.pop()
            yield "close", top, hidden > 0
            hidden -= was
            if top == name:
                return

    for m in _TAG.finditer(text):
        if m.start() > at:
            piece = text[at : m.start()]
            yield "text", unescape(piece) if "&" in piece else piece, hidden > 0
        at = m.end()
        if "\n" in m.group():
            yield "lines", "\n" * m.group().count("\n"), hidden > 0
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            if any(tag == name for tag, _ in stack):
                yield from close(name)
            continue
        for implied in IMPLIED.get(name, ()):
            if stack and stack[-1][0] == implied:
                yield from close(implied)
        hide = name in HIDDEN or bool(m[3] and _HIDING.search(m[3]))
        if name not in VOID:
            stack.append((name, hide))
            hidden += hide
        yield "open", name, hidden > 0
    if at < len(text):
        piece = text[at:]
        yield "text", unescape(piece) if "&" in piece else piece, hidden > 0


def render(text: str) -> list[tuple[int, str, bool]]:
    """(line_no, visible text, hidden) for every stored line of a text with tags.

    Cells of one table row on one stored line are joined by " | ", list items get their
    mark; blocks that share a stored line are kept apart by a blank.
    """
    lines: list[list] = [[1, "", False]]
    for what, piece, hidden in _walk(text):
        if what == "open":
            if piece == "li":
                lines[-1][1] += "• "
        elif what == "close":
            if piece in ("td", "th"):
                lines[-1][1] += " | "
            elif piece in BLOCK and lines[-1][1].strip():
                lines[-1][1] += " "
        else:
            for k, part in enumerate(piece.split("\n")):
                if k:
                    lines.append([lines[-1][0] + 1, "", False])
                if part:
                    lines[-1][1] += part
                    lines[-1][2] |= hidden and bool(part.strip())
    return [(n, s.strip(" |") if s.endswith(" | ") else s, h) for n, s, h in lines]


def _cells(line: str) -> list[str]:
    return [x.strip() for x in line.split(" | ")]


def aligned(rows: list[list[str]]) -> list[str]:
    """Table rows with their cells padded to the columns' widths."""
    widths = [max(len(r[i]) if i < len(r) else 0 for r in rows) for i in range(max(map(len, rows), default=0))]
    return [" | ".join(x.ljust(w) for x, w in zip(r, widths)).rstrip() for r in rows]


def rendered(text: str | None, without: frozenset[int] | set[int] = frozenset()) -> str | None:
    """All visible text of a page: block spacing, list marks and aligned table cells preserved.

    Stored line breaks stay.  Paragraphs, headings, lists and tables are set off by one
    blank line, items and rows stand on lines of their own, nested lists are indented,
    and runs of rows with as many cells are aligned, in tables and in plain text alike.
    Stored lines numbered in `without` are left out.  Null stays null.
    """
    if not text:
        return text
    out: list[str | None] = [""]  # None is a wanted blank line
    line, depth, gap, in_row = 1, 0, False, False

    def new_line(spaced: bool = False) -> None:
        nonlocal gap
        gap |= spaced
        if out[-1] != "":
            out.append("")

    def put(s: str, stored: bool = False) -> None:
        nonlocal gap
        if gap and s.strip():
            if len(out) > 1 and out[-2] != "" and out[-2] is not None and out[-1] == "":
                out[-1:] = [None, ""]
            gap = False
        out[-1] += s

    for what, piece, hidden in _walk(text):
        if what in ("text", "lines"):
            for k, part in enumerate(piece.split("\n")):
                if k:
                    line += 1
                    if in_row:
                        continue
                    if out[-1] == "" and len(out) > 1 and out[-2] not in ("", None) and piece.count("\n") > 1:
                        gap = True  # a stored blank line
                    new_line()
                if part and not hidden and line not in without and (part.strip() or out[-1]):
                    put(part if out[-1].strip() else part.lstrip() if out[-1] else part)
        elif hidden:
            continue
        elif what == "open":
            if piece in ("ul", "ol"):
                depth += 1
                new_line(depth == 1)
            elif piece == "li":
                new_line()
                if line not in without:
                    put("  " * max(depth - 1, 0) + "• ")
            elif piece == "tr":
                new_line()
                in_row = True
            elif piece in SPACED:
                new_line(True)
            elif piece in BLOCK and piece not in ("td", "th"):
                new_line()
        elif piece in ("td", "th"):
            if line not in without:
                out[-1] = out[-1].rstrip() + " | "
        elif piece == "tr":
            in_row = False
            out[-1] = out[-1].strip().removesuffix("|").rstrip() if out[-1].strip() != "|" else ""
            new_line()
        elif piece in ("ul", "ol"):
            depth = max(0, depth - 1)
            new_line(depth == 0)
        elif piece in SPACED:
            new_line(True)
        elif piece in BLOCK:
            new_line()
    plain = ["" if x is None else x.rstrip() for x in out]
    done, at = [], 0
    while at < len(plain):  # runs of rows with as many cells
        cells = _cells(plain[at]) if " | " in plain[at] else []
        end = at + 1
        while cells and end < len(plain) and " | " in plain[end] and len(_cells(plain[end])) == len(cells):
            end += 1
        done += aligned([_cells(x) for x in plain[at:end]]) if cells and end > at + 1 else plain[at:end]
        at = end
    kept: list[str] = []
    for x in done:
        if x.strip() == "•":  # an item that holds nothing visible
            continue
        if x.strip() or kept and kept[-1]:
            kept.append(x if x.strip() else "")
    return "\n".join(kept).strip("\n")


_STOPS = frozenset(".!?…")
_BULLET = re.compile(r"^[-•»+*·–>]\s+")
_QUOTE_MOVE = re.compile(r"[A-Z]{3,5} [\d.,]+ [+\-▲▼][\d.,]+%")
_SEPARATOR = re.compile(r"\s*[|·>•/]\s+|\s{2,}|\t+")
_NUMBER = re.compile(r"\d")
_LETTER = re.compile(r"[^\W\d_]")
#: A heading that names its company: "Outlook: WXYZ", "Outlook - WXYZ".
_HEADING_OF = re.compile(r"^([^\W\d_].{2,59}?)\s*[:\-–]\s*[A-Z][A-Z0-9]{2,4}$")
_CODE_FIRST = re.compile(r"^[A-Z]{3,5}\b")
MAX_ITEM_WORDS, MIN_BAR_ITEMS, MAX_HEADING_WORDS = 5, 3, 8
#: Shares of a source's rows from which on a fragment is the page's anywhere or as the first line, a sentence is, and a heading core is known.
FRAGMENT_SHARE, EDGE_SHARE, SENTENCE_SHARE, HEADING_SHARE = 0.03, 0.005, 0.10, 0.001
FRAGMENT_ROWS, HEADING_ROWS = 4, 3
#: Items of all sources that are sent to every task; beyond, lines are joined with them.
#: A source has at most (lines of a row) / HEADING_SHARE of them.
SENT = 200_000
#: Characters and number of the lines whose verdict is remembered for a source.
REMEMBERED, REMEMBERED_LINES = 120, 50_000
#: Kinds of what is known of a source's lines.
FRAGMENT, SENTENCE, HEADING, EDGE = 1, 2, 3, 4


def _core(line: str) -> str | None:
    """What stands before the company of a heading, in lower case."""
    m = _HEADING_OF.match(line)
    if m and not _CODE_FIRST.match(m[1]) and m[1].count(" ") < MAX_HEADING_WORDS:
        return m[1].lower()
    return None


#: What the items of headings begin with, and the item of a row.
_HEADING_ITEM, _ROW_ITEM = "\x01", "\x02"


def _line_items(s: str, text: str) -> set[str]:
    """Forms of the lines of a row and cores of its headings, tags taken out, and an item for the row.

    A row of one line has no page around it and counts for nothing.
    """
    if "<" in text:
        text = _TAG.sub("", text)
    items = {f for f in repeated.line_forms(text) if f > "\x03"}  # neither empty nor like the other items
    if len(items) < 2:
        return set()
    for line in text.split("\n"):
        if len(line) < 90:
            line = line.strip()
            if line[-2:].isalnum() and line[-2:].upper() == line[-2:] and (core := _core(line)):
                items.add(_HEADING_ITEM + core)
    items.add(_ROW_ITEM)
    return items


def _numbered(item: str) -> tuple[int, int]:
    """(0, form), (1, core) or (2, row) of an item."""
    if item[0] == _HEADING_ITEM:
        return 1, _number(item[1:])
    return (2, 0) if item == _ROW_ITEM else (0, _number(item))


def _outline(form: str) -> int:
    """16 bits of a line that show without its form: number of words, first and last character."""
    a, b = ord(form[0]), ord(form[-1])
    return (form.count(" ") & 63) << 10 | ((48 if 48 <= a <= 57 else a) * 31 + (48 if 48 <= b <= 57 else b)) & 1023


def _number(form: str) -> int:
    """Hash of a form that ends in its outline."""
    return repeated.number(form) & ~0xFFFF | _outline(form)


def known_lines(df: DataFrame, text: str, source: str) -> DataFrame:
    """(s, heading, item, kind): forms that are the page's and cores of headings, by source, over all its rows.

    Partial counts per partition are merged; every share is one of the source's own
    rows of several lines, so neither other sources nor the table's size matter.
    """
    schema = pa.schema([("s", pa.string()), ("heading", pa.int32()), ("item", pa.int64()), ("n", pa.int64())])
    counted = repeated.counted_items(df, source, text, schema, ["heading", "item"], _line_items, _numbered)
    counted = counted.where(F.col("n") >= min(FRAGMENT_ROWS, HEADING_ROWS)).checkpoint()  # read twice
    rows = counted.where("heading = 2").select("s", F.col("n").alias("rows"))
    share = F.col("n") / F.col("rows")
    page = F.when(share >= SENTENCE_SHARE, SENTENCE).when(share >= FRAGMENT_SHARE, FRAGMENT).when(share >= EDGE_SHARE, EDGE)
    kind = F.when((F.col("heading") == 0) & (F.col("n") >= FRAGMENT_ROWS), page).when((F.col("heading") == 1) & (share >= HEADING_SHARE), HEADING)
    return counted.join(rows, "s").select("s", "heading", "item", kind.alias("kind")).where("kind is not null")


class Kinds:
    """What is known of one source's lines: {(heading, number): kind}, and the outlines of its forms."""

    __slots__ = ("kinds", "outlines", "judged")

    def __init__(self, items=()):
        self.judged: dict[str, tuple[str, str]] = {}  # short lines come again and again
        self.kinds = {(heading, item): kind for heading, item, kind in items}
        self.outlines = frozenset(item & 0xFFFF for heading, item in self.kinds if not heading)

    def of_line(self, low: str) -> int | None:
        """Kind of a line in lower case and single spaces; most lines are told by their outline."""
        if _outline(low) not in self.outlines:
            return None
        return self.kinds.get((0, _number(repeated.DIGITS.sub("0", low))))

    def is_heading(self, core: str) -> bool:
        return bool(core) and (1, _number(core)) in self.kinds


class Known:
    """Kinds by source, as sent to tasks."""

    def __init__(self, rows: list):
        by_source: dict[str, list] = {}
        for s, *item in rows:
            by_source.setdefault(s, []).append(item)
        self.kinds, self.nothing = {s: Kinds(items) for s, items in by_source.items()}, Kinds()

    def of(self, s: str | None) -> Kinds:
        return self.kinds.get("\x00null" if s is None else s, self.nothing)


def page_lines(text: str | None, title: str | None, kinds: Kinds | None = None, in_form: bool = False) -> list[int]:
    """Numbers of the non-blank lines that are the page's, not the article's.

    kinds: what is known of the source's lines.  Null, empty or blank text: none.  A
    text of one non-blank line is its own text unless that line alone shows it is the
    page's.
    """
    if not text:
        return []
    if not in_form:
        text, title = consistent_all([text, title or ""])
    seen = render(text) if "<" in text else [(n, s, False) for n, s in enumerate(text.split("\n"), 1)]
    rows = [(n, s, h) for n, s, h in seen if s and not s.isspace()]
    if not rows:
        return []
    want = " ".join((title or "").lower().split()).rstrip(".")
    kinds, judged = kinds or Kinds(), []
    remembered = kinds.judged
    for _, raw, hidden in rows:
        known = remembered.get(raw)
        if known is None:
            plain = _plain(raw)
            low = plain.lower()
            known = (low.rstrip("."), _kind(plain, low, raw, kinds))
            if len(raw) < REMEMBERED:
                if len(remembered) > REMEMBERED_LINES:
                    remembered.clear()
                remembered[raw] = known
        judged.append("page" if hidden else "own" if want and known[0] == want else known[1])
    for k in range(len(rows) - 1):  # a bar above a table row of as many cells is its header
        if judged[k] == "bar":
            cells = _plain(rows[k][1]).count(" | ")
            judged[k] = "own" if cells and judged[k + 1] == "own" and _plain(rows[k + 1][1]).count(" | ") == cells else "page"
    judged[-1] = "page" if judged[-1] == "bar" else judged[-1]
    judged = ["page" if x == "edge" and not k else "short" if x == "edge" else x for k, x in enumerate(judged)]
    if len(rows) == 1:
        return [rows[0][0]] if judged[0] == "page" else []
    after, following = "edge", []
    for kind in reversed(judged):  # nearest judged line after each
        following.append(after)
        after = after if kind == "short" else kind
    out, before = [], "edge"
    for k, ((n, *_), kind, after) in enumerate(zip(rows, judged, reversed(following))):
        # open-ended lines are teasers; a short one is a menu item at an edge and a heading before the article's own text
        if kind in ("page", "open") or kind == "short" and not (after == "own" and (before == "own" or k == 0)):
            out.append(n)
        before = before if kind == "short" else kind
    return out


def _plain(line: str) -> str:
    """Single spaces inside, none outside; most lines are so already."""
    if "  " in line or "\t" in line:
        return " ".join(line.split())
    return line.strip()


def _kind(line: str, low: str, raw: str, kinds: Kinds) -> str:
    """page, own, bar (of short items), short (could be a heading), edge (short and known) or open (unfinished, as teasers are)."""
    if ("▲" in line or "▼" in line or "%" in line) and _QUOTE_MOVE.match(line):
        return "page"
    bar = line.find("|")
    if bar > 0 and _NUMBER.search(line, bar) and not _LETTER.search(line, bar):
        return "own"  # a label and cells of numbers
    known = kinds.of_line(low)
    if known == SENTENCE and line[-1] in _STOPS:
        return "page"
    ended = line.rstrip("\"”’')]")[-1:] in _STOPS
    if ended and known != SENTENCE:
        return "own"
    if kinds.is_heading(_core(line) or low.rstrip("?:")):
        return "own"
    if known == SENTENCE or known == FRAGMENT:
        return "bar" if " | " in line else "page"
    words = line.count(" ") + 1
    parts = [p for p in _SEPARATOR.split(raw.strip()) if p]
    if len(parts) >= MIN_BAR_ITEMS and not _NUMBER.search(line) and all(p.count(" ") < MAX_ITEM_WORDS for p in parts):
        return "bar"
    if len(parts) == 2 and "|" in line and words <= MAX_ITEM_WORDS * 2:
        return "bar"
    if _BULLET.match(line) or words > MAX_HEADING_WORDS:
        return "open"
    return "edge" if known == EDGE else "short"


_SCHEMA_LINES = T.ArrayType(T.IntegerType())


def line_judge(known: Known):
    """Pandas UDF (text, title, source) -> numbers of the page's lines."""

    @F.pandas_udf(_SCHEMA_LINES)
    def judge(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for text, title, source in batches:
            text, title = (consistent_all([x or "" for x in s]) for s in (text, title))
            yield pd.Series([page_lines(t, h, known.of(s), in_form=True) for t, h, s in zip(text, title, source)], dtype=object)

    return judge


def known_of(known: DataFrame) -> Known | None:
    """What is sent to tasks, None if there is more of it than SENT."""
    rows = known.take(SENT + 1)
    return Known([tuple(r) for r in rows]) if len(rows) <= SENT else None


def _looked_up(text: str) -> set[tuple[int, int]]:
    """All items that the judge may look up for a text's lines."""
    lines = {_plain(s).lower(): _core(_plain(s)) for _, s, _ in (render(text) if "<" in text else [(0, s, False) for s in text.split("\n")]) if s.strip()}
    out = {(0, _number(repeated.DIGITS.sub("0", low))) for low in lines}
    return out | {(1, _number(core)) for low, of in lines.items() if (core := of or low.rstrip("?:"))}


def _marked(df: DataFrame, key: str, text: str, source: str, known: DataFrame) -> DataFrame:
    """(__k, __kinds): the known items of each row's own lines by a join, salted within sources."""
    of = T.ArrayType(T.StructType([T.StructField("heading", T.IntegerType()), T.StructField("item", T.LongType())]))
    items = F.pandas_udf(lambda t: t.map(lambda x: sorted(_looked_up(consistent(x))) if x else []), of)
    rows = df.select(F.col(key).alias("__k"), repeated.source_of(source).alias("s"), F.explode(items(F.col(text).cast("string"))).alias("i")).select("__k", "s", "i.*")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("__k"), F.lit(repeated.SALTS)))
    spread = known.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(repeated.SALTS - 1).cast("long"))))
    return rows.join(spread, ["s", "heading", "item", "salt"]).groupBy("__k").agg(F.collect_list(F.struct("heading", "item", "kind")).alias("__kinds"))


def with_page_lines(df: DataFrame, key: str, text: str, title: str, source: str, out: str) -> DataFrame:
    """df with `out`: numbers of the lines of `text` that are the page's.

    What is known of the sources' lines is sent to the tasks up to SENT items; beyond,
    each row is joined with what is known of its own lines (key must be unique then).
    """
    known = known_lines(df, text, source).checkpoint()
    sent = known_of(known)
    columns = [F.col(text).cast("string"), F.col(title).cast("string")]
    if sent is not None:
        return df.withColumn(out, line_judge(sent)(*columns, F.col(source).cast("string")))

    @F.pandas_udf(_SCHEMA_LINES)
    def judge(texts: pd.Series, titles: pd.Series, kinds: pd.Series) -> pd.Series:
        return pd.Series([page_lines(t, h, _kinds_of(k)) for t, h, k in zip(texts, titles, kinds)], dtype=object)

    marked = df.join(_marked(df, key, text, source, known), df[key] == F.col("__k"), "left")
    return marked.withColumn(out, judge(*columns, "__kinds")).drop("__k", "__kinds")


def line_dropper(df: DataFrame, key: str, text: str, source: str, context: str = "__context"):
    """(df with `context`, dropper(text in consistent form, title, context)) for operators that leave the page's lines out."""
    known = known_lines(df, text, source).checkpoint()
    sent = known_of(known)
    if sent is not None:
        return df.withColumn(context, F.col(source).cast("string")), lambda t, h, s: page_lines(t, h, sent.of(s), in_form=True)
    marked = df.join(_marked(df, key, text, source, known), df[key] == F.col("__k"), "left").drop("__k").withColumnRenamed("__kinds", context)
    return marked, lambda t, h, kinds: page_lines(t, h, _kinds_of(kinds), in_form=True)


def _kinds_of(rows) -> Kinds:
    return Kinds(() if rows is None else ((x["heading"], x["item"], x["kind"]) for x in rows))


def find_page_lines(df: DataFrame, key: str, text: str, title: str, source: str) -> DataFrame:
    """(key, line_no) of each non-blank line that is the page's."""
    return with_page_lines(df, key, text, title, source, "__page").select(F.col(key), F.explode("__page").alias("line_no"))


def main_body(df: DataFrame, key: str, text: str, title: str, source: str, out: str = "main_body") -> DataFrame:
    """df with `out`: the text without the page's lines (other lines as stored).

    A null text stays null.  A column of df named `out` is replaced.
    """
    lines = F.split(F.col(text).cast("string"), "\n", -1)
    kept = F.filter(F.transform(lines, lambda x, i: F.struct((i + 1).alias("n"), x.alias("x"))), lambda s: ~F.array_contains(F.col("__page"), s["n"]))
    marked = with_page_lines(df, key, text, title, source, "__page")
    return marked.withColumn(out, F.when(F.col(text).isNotNull(), F.array_join(F.transform(kept, lambda s: s["x"]), "\n"))).drop("__page")


@F.pandas_udf(T.StringType())
def _rendered_udf(texts: pd.Series, without: pd.Series) -> pd.Series:
    return pd.Series([rendered(t, set() if w is None else {int(n) for n in w}) for t, w in zip(texts, without)], dtype=object)


def rendered_text(column: Column | str, without: Column | None = None) -> Column:
    """Visible text of a page, without the stored lines numbered in `without`."""
    c = F.col(column) if isinstance(column, str) else column
    return _rendered_udf(c.cast("string"), F.array().cast("array<int>") if without is None else without)


def rendered_body(df: DataFrame, key: str, text: str, title: str, source: str, out: str = "main_text") -> DataFrame:
    """df with `out`: the main body as it is read, rendered without tags and without the page's lines."""
    marked = with_page_lines(df, key, text, title, source, "__page")
    return marked.withColumn(out, rendered_text(text, F.col("__page"))).drop("__page")
