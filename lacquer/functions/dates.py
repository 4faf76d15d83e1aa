"""Dates and instants of the record layers; every format is guarded before it is parsed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CANONICAL_UTC = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z\z"
#: Clock of the collecting site, in hours from UTC.
SITE_HOURS = 7


def is_canonical_utc(c: Column) -> Column:
    """Shape only, the whole value."""
    return F.coalesce(c.rlike(CANONICAL_UTC), F.lit(False))


def _ntz(year: Column, month: Column, day: Column, hour: Column, minute: Column, second: Column) -> Column:
    return F.try_make_timestamp_ntz(*[x.try_cast("int") for x in (year, month, day, hour, minute, second)])


def _text(t: Column) -> Column:
    return F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def to_utc(c: Column, site_hours: int = SITE_HOURS) -> Column:
    """Canonical UTC text of an ISO or day-first value, "" for anything else.

    With an offset the offset counts; without, site time; a bare date or midnight is
    midnight UTC of that date.  Fractions are dropped.
    """
    v = F.trim(F.coalesce(c, F.lit("")))
    iso = r"^(\d{4})-(\d{2})-(\d{2})(?:[T ](\d{2}):(\d{2})(?::(\d{2})(?:[.,]\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?)?$"
    dmy = r"^(\d{1,2})[/-](\d{1,2})[/-](\d{4})$"
    p = F.split(F.regexp_replace(v, iso, "$1;$2;$3;$4;$5;$6;$7"), ";", -1)
    zero = lambda i: F.when(p[i] == "", "0").otherwise(p[i])
    local = _ntz(p[0], p[1], p[2], zero(3), zero(4), zero(5))
    sign = F.when(F.startswith(p[6], F.lit("-")), -1).otherwise(1)
    digits = F.regexp_replace(p[6], "[^0-9]", "")
    written = F.when(p[6] == "Z", 0).when(p[6] != "", sign * (F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int")))
    midnight = (zero(3).try_cast("int") == 0) & (zero(4).try_cast("int") == 0) & (zero(5).try_cast("int") == 0)
    minutes = F.coalesce(written, F.when(midnight, 0).otherwise(site_hours * 60))
    d = F.split(F.regexp_replace(v, dmy, "$1;$2;$3"), ";", -1)
    dated = _ntz(d[2], d[1], d[0], F.lit(0), F.lit(0), F.lit(0))
    return F.coalesce(F.when(v.rlike(iso), _text(local - F.make_dt_interval(F.lit(0), F.lit(0), minutes))), F.when(v.rlike(dmy), _text(dated)), F.lit(""))


def vendor_date(c: Column) -> Column:
    """/Date(milliseconds)/ as canonical UTC text, else ""."""
    ms = F.regexp_extract(c, r"/Date\((-?\d+)\)/", 1).try_cast("bigint")
    s = F.floor(ms / 1000)
    day = F.date_from_unix_date(F.floor(s / 86400).cast("int"))
    rest = F.pmod(s, F.lit(86400)).cast("int")
    two = lambda x: F.lpad(F.floor(x).cast("string"), 2, "0")
    return F.coalesce(F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T"), two(rest / 3600), F.lit(":"), two(rest % 3600 / 60), F.lit(":"), two(rest % 60), F.lit("Z")), F.lit(""))


def rfc822_date(c: Column) -> Column:
    """Local date and time of an RFC-822 value with its offset, as ISO text, else ""."""
    pattern = r"^(?:[A-Za-z]{3},\s*)?(\d{1,2}) ([A-Za-z]{3}) (\d{4}) (\d{2}):(\d{2}):(\d{2}) ([+-]\d{2})(\d{2})$"
    p = F.split(F.regexp_replace(F.trim(c), pattern, "$1;$2;$3;$4;$5;$6;$7:$8"), ";", -1)
    month = (F.instr(F.lit("janfebmaraprmayjunjulaugsepoctnovdec"), F.lower(p[1])) + 2) / 3
    t = F.try_make_timestamp_ntz(p[2].try_cast("int"), month.cast("int"), p[0].try_cast("int"), p[3].try_cast("int"), p[4].try_cast("int"), p[5].try_cast("int"))
    return F.coalesce(F.when(c.rlike(pattern), F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"), p[6])), F.lit(""))


def written_date(c: Column) -> Column:
    """Date of a value that starts with y-m-d, d/m/y or d-m-y; null otherwise, no shift of zones."""
    v = F.trim(F.coalesce(c, F.lit("")))
    ymd = F.split(F.regexp_extract(v, r"^(\d{4}-\d{1,2}-\d{1,2})(?!\d)", 1), "-")
    dmy = F.split(F.regexp_replace(F.regexp_extract(v, r"^(\d{1,2}[/-]\d{1,2}[/-]\d{4})(?!\d)", 1), "/", "-"), "-")
    make = lambda y, m, d: _ntz(y, m, d, F.lit(0), F.lit(0), F.lit(0)).cast("date")
    at = lambda a, i: F.get(a, F.lit(i))
    return F.coalesce(make(at(ymd, 0), at(ymd, 1), at(ymd, 2)), make(at(dmy, 2), at(dmy, 1), at(dmy, 0)))


def norm_date(c: Column) -> Column:
    """written_date as text, "" where there is none."""
    return F.coalesce(F.date_format(written_date(c), "yyyy-MM-dd"), F.lit(""))


def report_date(c: Column) -> Column:
    """d/m/y with a year of four or two digits; two digits up to 68 are 20xx, later ones 19xx."""
    p = F.split(F.regexp_extract(F.trim(c), r"^(\d{1,2}/\d{1,2}/(?:\d{4}|\d{2}))$", 1), "/")
    at = lambda i: F.get(p, F.lit(i))
    y = at(2).try_cast("int")
    year = F.when(F.length(at(2)) == 4, y).when(y <= 68, y + 2000).otherwise(y + 1900)
    return F.try_make_timestamp_ntz(year, at(1).try_cast("int"), at(0).try_cast("int"), F.lit(0), F.lit(0), F.lit(0)).cast("date")


def month_windows(start: Column, end: Column, months: int) -> Column:
    """Array of (from, to): month-aligned windows of that many months, the ends clipped."""
    firsts = F.sequence(F.trunc(start, "month"), end, F.make_ym_interval(F.lit(0), F.lit(months)))
    return F.transform(firsts, lambda d: F.struct(F.greatest(d, start).alias("from"), F.least(F.date_add(F.add_months(d, months), -1), end).alias("to")))


def in_range(d: Column, start: Column, end: Column) -> Column:
    """Inclusive; a null date passes."""
    return F.coalesce(d >= start, F.lit(True)) & F.coalesce(d <= end, F.lit(True))


def article_date(c: Column) -> Column:
    """Date of an article's written time: ISO with or without time and offset, d/m/y, d-m-y; null otherwise.

    The date is the written one, no zone is applied.  A value that begins with
    yyyy-mm-dd is dated by that, whatever follows.
    """
    v = F.trim(F.coalesce(c.cast("string"), F.lit("")))
    clock = r"\d{1,2}:\d{1,2}:\d{1,2}"
    iso = rf"^(\d{{4}}-\d{{1,2}}-\d{{1,2}})(?:T{clock}(?:Z|[+-]\d{{2}}:?\d{{2}}(?::?\d{{2}})?)?| {clock})?$"
    ymd = F.coalesce(F.nullif(F.regexp_extract(v, iso, 1), F.lit("")), F.regexp_extract(v, r"^(\d{4}-\d{2}-\d{2})", 1))
    dmy = F.replace(F.regexp_extract(v, r"^(\d{1,2}/\d{1,2}/\d{4}|\d{1,2}-\d{1,2}-\d{4})$", 1), F.lit("/"), F.lit("-"))
    return F.coalesce(_date_of(ymd, 0, 1, 2), _date_of(dmy, 2, 1, 0))


def digest_date(c: Column) -> Column:
    """Date of an article as the digest reads it: yyyy-mm-dd with or without a T time, or a value that begins with dd/mm/yyyy."""
    v = F.trim(F.coalesce(c.cast("string"), F.lit("")))
    v = F.when(F.contains(v, F.lit("T")), F.substring(v, 1, 19)).otherwise(v)
    ymd = F.regexp_extract(v, r"^(\d{4}-\d{1,2}-\d{1,2})(?:T\d{1,2}:\d{1,2}:\d{1,2})?$", 1)
    dmy = F.coalesce(F.nullif(F.regexp_extract(v, r"^(\d{1,2}/\d{1,2}/\d{4})$", 1), F.lit("")), F.regexp_extract(v, r"^(\d{2}/\d{2}/\d{4})", 1))
    return F.coalesce(_date_of(ymd, 0, 1, 2), _date_of(F.replace(dmy, F.lit("/"), F.lit("-")), 2, 1, 0))


def _date_of(text: Column, year: int, month: int, day: int) -> Column:
    parts = F.split(text, "-")
    at = lambda i: F.get(parts, F.lit(i))
    return _ntz(at(year), at(month), at(day), F.lit(0), F.lit(0), F.lit(0)).cast("date")
