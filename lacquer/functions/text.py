"""Text expressions.  Native throughout, but for composition (NFC) and character entities."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space as Unicode sees it; Java's \s alone is ASCII.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]+"
# Widget lines that are no text, the mark of a shortened body.
WIDGET_LINES = ("TIN MỚI", "XEM THÊM", "ĐỌC THÊM", "MỚI NHẤT", "LIÊN QUAN", "HOT")
SHORTENED = "[…truncated…]"


@F.pandas_udf(T.StringType())
def _nfc(v: pd.Series) -> pd.Series:
    return v.map(lambda s: s if s.isascii() else unicodedata.normalize("NFC", s), na_action="ignore")


@F.pandas_udf(T.StringType())
def _unescape(v: pd.Series) -> pd.Series:
    return v.map(lambda s: html.unescape(s) if "&" in s else s, na_action="ignore")


def nfc(c: Column) -> Column:
    return _nfc(c.cast("string"))


def unescape(c: Column) -> Column:
    """Character entities resolved; rows without an ampersand keep their value."""
    return _unescape(c.cast("string"))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_filled(*columns: Column) -> Column:
    """First column that is neither null nor "", else ""."""
    return F.coalesce(*[blank_to_null(c) for c in columns], F.lit(""))


def collapse(c: Column) -> Column:
    """White space runs as one space, none outside."""
    return F.trim(F.regexp_replace(c, SPACE, " "))


def strip_html(c: Column) -> Column:
    """Tags become spaces; letter case is kept; null becomes ""."""
    return collapse(F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]+>", " "))


def checksum_normalize(c: Column, compose: bool = True) -> Column:
    """The form that content hashes are taken of: composed, lower case, no tags, single spaces."""
    base = F.coalesce(c.cast("string"), F.lit(""))
    return strip_html(F.lower(nfc(base) if compose else base))


def normalize_body(c: Column, max_chars: int | None = None, entities: bool = True) -> Column:
    """Lines without outer and repeated spaces, without blank and widget lines.

    Longer results keep the halves of max_chars at either end around SHORTENED.
    """
    text = unescape(c) if entities else c
    lines = F.split(F.coalesce(text, F.lit("")), r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]")
    lines = F.transform(lines, lambda x: F.regexp_replace(F.regexp_replace(x, r"[ \t]+", " "), r"^[\s\x1c-\x1f\x85\p{Z}]+|[\s\x1c-\x1f\x85\p{Z}]+$", ""))
    kept = F.filter(lines, lambda x: (x != "") & ~F.upper(x).isin(*WIDGET_LINES))
    out = F.array_join(kept, "\n")
    if not max_chars:
        return out
    half = max_chars // 2
    return F.when(F.length(out) > max_chars, F.concat(F.substring(out, 1, half), F.lit(f"\n{SHORTENED}\n"), F.right(out, F.lit(half)))).otherwise(out)


def dehyphenate(c: Column) -> Column:
    """Words broken over two lines are joined."""
    return F.regexp_replace(c, r"(?U)(\w)-\n(\w)", "$1$2")


def pdf_filename(title: Column, date: Column) -> Column:
    """{date}_{title}.pdf of the first fifty characters, letters, digits, spaces, - and _ kept."""
    kept = F.regexp_replace(F.substring(F.trim(title), 1, 50), r"[^\p{L}\p{N} _-]", "")
    return F.concat(F.replace(date, F.lit("/"), F.lit("-")), F.lit("_"), F.replace(F.trim(kept), F.lit(" "), F.lit("_")), F.lit(".pdf"))


def clean_number(c: Column) -> Column:
    """Digits of a written number; null, nan and the like become ""."""
    bare = F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), "[, ]", "")
    return F.when(F.lower(bare).isin("nan", "none", "null", "na", "."), "").otherwise(bare)


def number(c: Column) -> Column:
    return clean_number(c).try_cast("double")


def url_list(c: Column) -> Column:
    """A JSON list as array of strings; anything else is an empty array."""
    return F.coalesce(F.from_json(c, "array<string>"), F.array().cast("array<string>"))


def html_title(c: Column) -> Column:
    return collapse(F.regexp_extract(c, r"(?is)<title[^>]*>(.*?)</title>", 1))


def html_links(c: Column) -> Column:
    """Distinct link targets in order of their text."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"']+)["']"""), F.lit(1))))
