"""Which of several rows with one key stays, always by an explicit order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str | Column], order: list[Column | str]) -> DataFrame:
    """The first row of each key in the given order; a null key is a key like any other.

    One row per key survives the map side of the shuffle: the smallest order with its
    row, so a key that a third of all rows share meets as one row per partition.  Rows
    travel with all their columns: select narrow ones and join texts afterwards.
    """
    columns = df.columns
    names = [f"__key{i}" for i in range(len(keys))]
    ranked = df.select(
        *[(F.col(k) if isinstance(k, str) else k).alias(n) for k, n in zip(keys, names)],
        F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"o{i}") for i, o in enumerate(order)]).alias("__order"),
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("__row"),
    )
    best = ranked.groupBy(*names).agg(F.min_by("__row", "__order").alias("__row"))
    return best.select(*[F.col("__row")[c].alias(c) for c in columns])


def descending(c: Column | str) -> Column:
    """A number, date or boolean so that its largest value comes first in keep_first."""
    c = F.col(c) if isinstance(c, str) else c
    return -c.cast("double")


def keep_last(df: DataFrame, keys: list[str | Column], order: list[Column | str]) -> DataFrame:
    """The last row of each key in the given order."""
    columns = df.columns
    names = [f"__key{i}" for i in range(len(keys))]
    ranked = df.select(
        *[(F.col(k) if isinstance(k, str) else k).alias(n) for k, n in zip(keys, names)],
        F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"o{i}") for i, o in enumerate(order)]).alias("__order"),
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("__row"),
    )
    best = ranked.groupBy(*names).agg(F.max_by("__row", "__order").alias("__row"))
    return best.select(*[F.col("__row")[c].alias(c) for c in columns])


def prefer_filled(df: DataFrame, keys: list[str | Column], field: str, order: list[Column | str]) -> DataFrame:
    """keep_first, but rows with a non-blank field come before the others."""
    filled = F.length(F.trim(F.coalesce(F.col(field).cast("string"), F.lit("")))) > 0
    return keep_first(df, keys, [F.when(filled, 0).otherwise(1), *order])


def unseen(new: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new whose key (any of the keys, one by one) is not among the seen."""
    out = new
    for k in keys:
        out = out.join(seen.select(k).where(F.col(k).isNotNull()).distinct(), k, "left_anti").select(*new.columns)
    return out


def above_watermark(incoming: DataFrame, existing: DataFrame, date: str, order: list[Column | str], until: Column | None = None) -> DataFrame:
    """Rows to append: later than the latest stored date, one per date (the last in order).

    Dates that are none are ignored; rows at or before the watermark are late and dropped.
    """
    mark = existing.agg(F.max(F.col(date).try_cast("date")).alias("__mark"))
    fresh = incoming.crossJoin(F.broadcast(mark)).where(F.col(date).try_cast("date").isNotNull())
    fresh = fresh.where(F.col("__mark").isNull() | (F.col(date).try_cast("date") > F.col("__mark"))).drop("__mark")
    if until is not None:
        fresh = fresh.where(F.col(date).try_cast("date") <= until)
    return keep_last(fresh, [date], order)


def sequential_id(df: DataFrame, order: list[Column | str], out: str, form: str) -> DataFrame:
    """Rows numbered from 1 in a total order, without a window over one partition.

    A range sort, a count per partition, and each partition adds what comes before it.
    """
    ordered = df.orderBy(*order).withColumn("__part", F.spark_partition_id()).withColumn("__mono", F.monotonically_increasing_id()).checkpoint()
    counts = ordered.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__mono").alias("__from"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("__part", "__from", before.alias("__before"))  # one row per partition
    numbered = ordered.join(F.broadcast(offsets), "__part")
    n = F.col("__mono") - F.col("__from") + F.col("__before") + 1
    return numbered.select(F.format_string(form, n).alias(out), *df.columns)
