"""Runs over sources: windows, caps, failures kept to their source, the order of the day."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date, timedelta
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import dedup
from ..session import exists
from . import specs

#: Where a series begins that nothing is stored of.
FIRST_DAY = date(2000, 1, 1)
# The stages of a day and what each one waits for.
STAGES: dict[str, tuple[str, ...]] = {
    "cafef": (), "ssi": (), "hsc": (), "vndirect": (), "report_cards": (), "merge_articles": ("cafef", "ssi", "hsc", "vndirect", "report_cards"),
    "digest": ("merge_articles",), "vsdc": (), "vietstock": (), "vnexpress": (), "tuoitre": (), "nld": (), "thanhnien": (), "vietnamplus": (),
    "build_records": ("vsdc", "vietstock", "vnexpress", "tuoitre", "nld", "thanhnien", "vietnamplus"), "dashboard": ("build_records",),
}


def window(stored: DataFrame | None, day: str, end: date, start: date | None = None) -> tuple[date, date]:
    """(from, to) to ask a source for: from `start`, else the day after the latest stored valid day, else FIRST_DAY."""
    if start is None and stored is not None:
        latest = stored.agg(F.max(F.substring(F.col(day).cast("string"), 1, 10).try_cast("date"))).first()[0]
        start = latest + timedelta(days=1) if latest else None
    return start or FIRST_DAY, end


def run_isolated(jobs: dict[str, Callable[[], int]]) -> dict[str, int]:
    """New rows per job; a job that fails counts -1 and leaves the others alone."""
    out = {}
    for name, job in jobs.items():
        try:
            out[name] = job()
        except Exception as e:  # whatever it is, it is this source's
            print(f"[{name}] {type(e).__name__}: {e}")
            out[name] = -1
    return out


def run_stages(stages: dict[str, Callable[[], object]], waits: dict[str, tuple[str, ...]] = STAGES) -> list[str]:
    """Runs the stages that are given, each after those it waits for; a failed stage does not stop the rest.  The order run."""
    order = [s for s in TopologicalSorter({k: v for k, v in waits.items()}).static_order() if s in stages]
    run_isolated({s: (lambda s=s: stages[s]() and 0 or 0) for s in order})
    return order


def first_per_source(df: DataFrame, source: str, order: list[Column | str], most: int) -> DataFrame:
    """At most `most` rows per source in the given order, a run's cap.

    Each of many parts of a source gives its own first rows, so no source is ranked in one task.
    """
    parts = Window.partitionBy(source, F.pmod(F.xxhash64(*[c for c in df.columns]), F.lit(64))).orderBy(*order)
    near = df.withColumn("__n", F.row_number().over(parts)).where(F.col("__n") <= most)
    return near.withColumn("__n", F.row_number().over(Window.partitionBy(source).orderBy(*order))).where(F.col("__n") <= most).drop("__n")


def page_is_old(days: Iterable[date | None], start: date | None) -> bool:
    """Whether a listing page ends the walk: it has items, all are dated and all lie before the start."""
    days = list(days)
    return bool(start and days) and all(d is not None and d < start for d in days)


def latest(spec: specs.SourceSpec, payloads: DataFrame, stored: DataFrame, crawled_at: str, most: int | None = None, universe: DataFrame | None = None) -> DataFrame:
    """New records of the first pages, whatever their date."""
    return specs.ingest(spec, payloads, stored, crawled_at, most=most, universe=universe)


def backfill(spec: specs.SourceSpec, payloads: DataFrame, stored: DataFrame, crawled_at: str, start: str, end: str, universe: DataFrame | None = None) -> DataFrame:
    """New records of a range of days, undated ones included."""
    return specs.ingest(spec, payloads, stored, crawled_at, start, end, universe=universe)


def daily(feeds: dict[str, DataFrame], stored: DataFrame, parse: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """New articles of several sections' feeds, each url once, of the section named first."""
    out = None
    for n, (section, payloads) in enumerate(feeds.items()):
        rows = parse(payloads).withColumns({"section": F.lit(section), "__n": F.lit(n)})
        out = rows if out is None else out.unionByName(rows)
    return dedup.keep_first(dedup.unseen(out.where("url <> ''"), stored, ["url"]), ["url"], ["__n"]).drop("__n")


def candidates(spark: SparkSession, shards: DataFrame, path: str, parse: Callable[[Column], Column]) -> DataFrame:
    """Candidates of sitemap shards (shard, payload), kept under `path`: a shard stored before is not parsed again."""
    if exists(spark, path):
        shards = shards.join(spark.read.parquet(path).select("shard").distinct(), "shard", "left_anti")
    shards.select("shard", F.inline(parse(F.col("payload")))).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def optional(df: DataFrame | None) -> DataFrame | None:
    """None for a missing or empty table, so that its columns come out empty."""
    return None if df is None or df.isEmpty() else df


def retried(failed: DataFrame, done: DataFrame, tried: DataFrame, key: str = "url") -> DataFrame:
    """Documents to try again: failed ones of old and new runs that have not come since; one row per key."""
    both = failed.select(key).unionByName(tried.select(key)).distinct()
    return both.join(done.select(key).distinct(), key, "left_anti")
