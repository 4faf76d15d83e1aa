"""All valid readings of a written time, as native expressions.

A value is matched once per shape; the match is rewritten to one delimited string, so
no group is extracted twice.  Nothing depends on the session's time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# English month names, zone abbreviations in hours from UTC.
MONTHS = "january february march april may june july august september october november december".split()
ZONE_HOURS = {
    "Z": 0, "UTC": 0, "GMT": 0, "WET": 0, "BST": 1, "CET": 1, "CEST": 2, "EET": 2, "EEST": 3, "MSK": 3, "IST": 5.5, "ICT": 7, "WIB": 7, "SGT": 8,
    "HKT": 8, "AWST": 8, "JST": 9, "KST": 9, "AEST": 10, "AEDT": 11, "NZST": 12, "NZDT": 13, "EST": -5, "EDT": -4, "CST": -6, "CDT": -5,
    "MST": -7, "MDT": -6, "PST": -8, "PDT": -7,
}
CANONICAL = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"

_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,]\d{1,9})?)?(?:\s*(AM|PM|SA|CH|am|pm))?"
_ZONE = r"(?:\s*\(?((?:GMT|UTC)?\s*[+-]\d{1,2}(?::?\d{2})?|[A-Z]{1,5})\)?)?"
_DAY = r"(?:\p{L}+(?:\s[\p{L}\d]+)?,\s*)?"
#: kind, pattern, rewriting to "kind;a;b;c;hour;minute;second;half;zone"
_SHAPES = (
    ("Y", rf"^(\d{{4}})([-/.])(\d{{1,2}})\2(\d{{1,2}})(?:(?:T|,?\s+){_TIME}{_ZONE})?$", "Y;$1;$3;$4;$5;$6;$7;$8;$9"),
    ("N", rf"^{_DAY}(?:{_TIME},?\s+)?(\d{{1,2}})([-/.])(\d{{1,2}})\6(\d{{4}}|\d{{2}})(?:,?\s+{_TIME}{_ZONE})?$", "N;$5;$7;$8;$1$9;$2$10;$3$11;$4$12;$13"),
    ("Y", r"^(\d{4})(\d{2})(\d{2})(?:T?(\d{2})(\d{2})(\d{2})(?:[.,]\d+)?(Z|[+-]\d{2}:?\d{2})?)?$", "Y;$1;$2;$3;$4;$5;$6;;$7"),
    ("D", rf"^{_DAY}(\d{{1,2}})\s+([A-Za-z]{{3,9}})\.?,?\s+(\d{{4}})(?:,?\s+{_TIME}{_ZONE})?$", "D;$1;$2;$3;$4;$5;$6;$7;$8"),
    ("D", rf"^{_DAY}([A-Za-z]{{3,9}})\.?\s+(\d{{1,2}}),?\s+(\d{{4}})(?:,?\s+{_TIME}{_ZONE})?$", "D;$2;$1;$3;$4;$5;$6;$7;$8"),
    ("V", rf"^{_DAY}(?:ngày\s+)?(\d{{1,2}})\s+tháng\s+(\d{{1,2}}),?\s+(?:năm\s+)?(\d{{4}})(?:,?\s+{_TIME}{_ZONE})?$", "V;$1;$2;$3;$4;$5;$6;$7;$8"),
)
_EPOCH = r"^(?:/Date\((-?\d+)(?:[+-]\d{4})?\)/|(\d{10})(?:\.\d+)?|(\d{13})|(\d{16})|(\d{19}))$"
READINGS = "array<struct<form:string,utc_s:bigint>>"


def _int(c: Column) -> Column:
    return c.try_cast("int")


def _seconds(t: Column) -> Column:
    """Seconds since 1970 of a zone-less timestamp."""
    return F.unix_date(t.cast("date")).cast("long") * 86400 + F.hour(t) * 3600 + F.minute(t) * 60 + F.floor(F.second(t))


def _zone_offset(zone: Column, digits: Column) -> Column:
    """Seconds east of UTC of a written zone; null for an unknown one."""
    hours, minutes = _int(digits[1]), F.coalesce(_int(digits[2]), F.lit(0))
    numeric = (hours * 3600 + minutes * 60) * F.when(digits[0] == "-", -1).otherwise(1)
    named = F.create_map(*[F.lit(x) for k, h in ZONE_HOURS.items() for x in (k, int(h * 3600))])
    return F.when(F.size(digits) == 3, F.when((hours <= 15) & (minutes < 60), numeric)).otherwise(F.try_element_at(named, zone))


def with_readings(df: DataFrame, value: Column, zone: Column, out: str) -> DataFrame:
    """df with `out`: every valid reading of a text value, as array<struct<form, utc_s>>.

    form is 'fixed', 'dmy' or 'mdy'.  A value without a zone is in `zone` (an IANA
    name), except that a bare date or midnight stands for 00:00:00 UTC of that date.
    Of a local time that occurs twice the first is meant; two-digit years are 20xx;
    fractions are dropped.  Null, blank, relative and impossible values have no
    reading (an empty array).

    Works in steps, each a projection that the next refers to more than once, so that
    the optimiser keeps them apart and nothing is matched twice.
    """
    f = {n: f"__{out}_{n}" for n in ("v", "z", "m", "p", "f", "l", "a")}
    c = {n: F.col(x) for n, x in f.items()}
    p = c["p"]
    month = F.create_map(*[F.lit(x) for i, n in enumerate(MONTHS, 1) for k in sorted({n, n[:3]} | ({"sept"} if i == 9 else set())) for x in (k, i)])
    df = df.withColumns({f["v"]: F.trim(value), f["z"]: zone})
    shaped = F.coalesce(
        F.when(c["v"].rlike(_EPOCH), F.regexp_replace(c["v"], _EPOCH, "E;$1;$2;$3;$4;$5;;;")),
        *[F.when(c["v"].rlike(shape), F.regexp_replace(c["v"], shape, to)) for _, shape, to in _SHAPES],
    )
    df = df.withColumn(f["m"], shaped).withColumn(f["p"], F.split(c["m"], ";", -1))
    kind, third, half = p[0], p[3], p[7]
    h12 = _int(p[4])
    hour = F.when(half == "", h12).when(h12.between(1, 12), h12 % 12 + F.when(half.isin("PM", "pm", "CH"), 12).otherwise(0))
    dated = p[4] == ""
    seconds = F.when(p[6] == "", 0).otherwise(_int(p[6]))
    df = df.withColumn(f["f"], F.when(kind != "E", F.struct(
        kind.alias("kind"),
        F.when(kind == "Y", _int(p[1])).when(F.length(third) == 2, _int(third) + 2000).otherwise(_int(third)).alias("y"),
        F.when(kind == "D", F.try_element_at(month, F.lower(p[2]))).otherwise(_int(p[2])).alias("m"),
        F.when(kind == "Y", _int(third)).otherwise(_int(p[1])).alias("d"),
        F.when(dated, 0).otherwise(hour).alias("h"), F.when(dated, 0).otherwise(_int(p[5])).alias("mi"),
        F.when(dated, 0).when(seconds < 60, seconds).alias("s"), p[8].alias("zone"),
        F.split(F.regexp_replace(p[8], r"^(?:GMT|UTC)?\s*([+-])(\d{1,2}):?(\d{2})?$", "$1;$2;$3"), ";").alias("digits"),
    )))
    g = lambda n: c["f"][n]
    local = lambda m, d: F.try_make_timestamp_ntz(g("y"), m, d, g("h"), g("mi"), g("s"))
    df = df.withColumn(f["l"], F.struct(
        local(g("m"), g("d")).alias("one"), F.when(g("kind") == "N", local(g("d"), g("m"))).alias("two"),
        (g("zone") != "").alias("zoned"), _zone_offset(g("zone"), g("digits")).alias("offset"),
        ((g("h") == 0) & (g("mi") == 0) & (g("s") == 0)).alias("midnight"),
    ))
    x = lambda n: c["l"][n]

    def utc(local: Column) -> Column:
        return (
            F.when(x("zoned"), _seconds(local) - x("offset"))
            .when(x("midnight"), _seconds(local))
            .otherwise(_seconds(F.convert_timezone(c["z"], F.lit("UTC"), local)))
        )

    unit = lambda i, per: F.when(p[i] != "", F.floor(p[i].try_cast("decimal(20,0)") / per).cast("long"))
    counted = F.coalesce(unit(1, 1000), unit(2, 1), unit(3, 1000), unit(4, 1000000), unit(5, 1000000000))
    df = df.withColumn(f["a"], F.struct(
        F.when(kind == "E", counted).when(x("one").isNotNull(), utc(x("one"))).alias("one"), F.when(x("two").isNotNull(), utc(x("two"))).alias("two"),
    ))
    reading = lambda form, t: F.when(t.isNotNull(), F.struct(form.alias("form"), t.alias("utc_s")))
    both = F.array(reading(F.when(kind == "N", "dmy").otherwise("fixed"), c["a"]["one"]), reading(F.lit("mdy"), c["a"]["two"]))
    # a row id is not deterministic: a filter on the result stays above and is not
    # rewritten in terms of all the steps; filter other columns before calling this
    barrier = F.monotonically_increasing_id() >= 0
    return df.withColumn(out, F.when(barrier, F.array_compact(both).cast(READINGS))).drop(*f.values())


def canonical(utc_s: Column) -> Column:
    """YYYY-MM-DDTHH:MM:SSZ of seconds since 1970."""
    day = F.date_from_unix_date(F.floor(utc_s / 86400).cast("int"))
    rest = F.pmod(utc_s, F.lit(86400))
    two = lambda x: F.lpad(F.floor(x).cast("string"), 2, "0")
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T"), two(rest / 3600), F.lit(":"), two(rest % 3600 / 60), F.lit(":"), two(rest % 60), F.lit("Z"))
