"""Daily series: as-of alignment onto a calendar, forward fill, rolling features.

Every function takes the partition keys of the series, so many series run side by
side; a single series (no keys) is sorted in one task, as the calendar's length bounds it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def by_date(keys: list[str], date: str = "date") -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(date) if keys else Window.partitionBy(F.lit(0)).orderBy(date)


def daily(df: DataFrame, date: str, values: list[str], order: list[Column | str], keys: list[str] | None = None) -> DataFrame:
    """A typed series: rows without a date dropped, first row per date, values as numbers."""
    from .dedup import keep_first

    typed = df.withColumn(date, F.col(date).try_cast("date")).where(F.col(date).isNotNull())
    first = keep_first(typed, [*(keys or []), date], order)
    return first.select(*(keys or []), date, *[F.col(v).try_cast("double").alias(v) for v in values])


def as_of(anchor: DataFrame, right: DataFrame, values: list[str], lag_days: int = 0, keys: list[str] | None = None, date: str = "date", fill: bool = True) -> DataFrame:
    """anchor with the values of the latest right row of at most its date less lag_days.

    The newest row counts even where a value of it is null; `fill` then carries values
    forward from anchor to anchor.  right must have one row per key and date.
    """
    return as_of_many(anchor, [(right, values, lag_days)], keys, date, fill)


def as_of_many(anchor: DataFrame, rights: list[tuple[DataFrame, list[str], int]], keys: list[str] | None = None, date: str = "date", fill: bool = True) -> DataFrame:
    """as_of with several series of (rows, values, lag in days), each with its own lag.

    One shuffle and one sort: all sides are one stream, the right rows first on equal
    dates, and each series is carried along by itself.
    """
    if not rights:
        return anchor
    keys = keys or []
    held = [right.select(F.struct(*[F.col(v).alias(v) for v in values])).schema[0].dataType for right, values, _ in rights]
    none = [F.lit(None).cast(kind).alias(f"__held{i}") for i, kind in enumerate(held)]
    row = F.lit(None).cast(anchor.select(F.struct("*")).schema[0].dataType).alias("__row")
    stream = anchor.select(*keys, date, *none, F.lit(1).alias("__side"), F.struct(*[F.col(c) for c in anchor.columns]).alias("__row"))
    for i, (right, values, lag_days) in enumerate(rights):
        own = F.struct(*[F.col(v).alias(v) for v in values]).alias(f"__held{i}")
        stream = stream.unionByName(right.select(*keys, F.date_add(date, lag_days).alias(date), *none[:i], own, *none[i + 1 :], F.lit(0).alias("__side"), row))
    base = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    w = base.orderBy(date, "__side").rowsBetween(Window.unboundedPreceding, 0)
    met = stream.withColumns({f"__held{i}": F.last(f"__held{i}", ignorenulls=True).over(w) for i in range(len(rights))}).where("__side = 1")
    wanted = [(i, v) for i, (_, values, _) in enumerate(rights) for v in values]
    out = met.select(*[F.col("__row")[c].alias(c) for c in anchor.columns], *[F.col(f"__held{i}")[v].alias(v) for i, v in wanted])
    return forward_fill(out, [v for _, v in wanted], keys, date) if fill else out


def forward_fill(df: DataFrame, columns: list[str], keys: list[str] | None = None, date: str = "date") -> DataFrame:
    w = by_date(keys or [], date).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def log_return(c: Column, k: int, w: WindowSpec) -> Column:
    """ln(c / c k rows before); null where either is missing or not positive."""
    return F.ln(F.try_divide(c, F.lag(c, k).over(w)))


def pct_change(c: Column, w: WindowSpec) -> Column:
    return F.try_divide(c, F.lag(c).over(w)) - 1


def rolling(c: Column, n: int, w: WindowSpec, what) -> Column:
    """An aggregate over n rows, null unless all n are there."""
    frame = w.rowsBetween(-(n - 1), 0)
    return F.when(F.count(c).over(frame) == n, what(c).over(frame))


def z_score(c: Column, n: int, w: WindowSpec) -> Column:
    return F.try_divide(c - rolling(c, n, w, F.avg), rolling(c, n, w, F.stddev_samp))


def coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, filled, percent): rows with a value, whole percents, 0 of an empty table."""
    counts = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(c).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled")) for c in columns])
    long = counts.select("__rows", F.inline(rows))
    return long.select("column_name", "filled", F.when(F.col("__rows") > 0, F.floor(F.col("filled") * 100 / F.col("__rows"))).otherwise(0).cast("long").alias("percent"))
