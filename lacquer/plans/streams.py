"""Queries that run a stream over landed files until all are read."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from ..session import workspace
from ..streaming import ingest
from .records import read


def stream_dedup_available_now(spark, sf_dir):
    """Urls of all articles, each once, through stateful deduplication."""
    work = workspace(spark, "stream")
    schema = read(spark, sf_dir, "news_articles").schema
    # the parent folder with a name filter: a file stream reads folders
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").load(_folder(spark, sf_dir, work))
    ingest.run_available(ingest.new_only(stream.select("url"), ["url"]), f"{work}/out", f"{work}/state")
    return spark.read.parquet(f"{work}/out")


def _folder(spark, sf_dir: str, work: str) -> str:
    """Articles landed as a folder of files, as a collector would leave them."""
    read(spark, sf_dir, "news_articles").write.parquet(f"{work}/landing")
    return f"{work}/landing"


def stream_window_counts(spark, sf_dir):
    """Events per type and day through a watermarked stream, in the order of time."""
    work = workspace(spark, "stream")
    events = read(spark, sf_dir, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"))
    last = events.agg(F.max("ts")).first()[0]
    closing = spark.createDataFrame([("", last + timedelta(days=3))], events.schema) if last else events.limit(0)  # ends the last day's window
    events.write.parquet(f"{work}/landing/day=1")
    stream = lambda: ingest.landed(spark, f"{work}/landing/*", events.schema)
    counts = ingest.counted_by_window(stream(), "ts", ["event_type"], "1 day", "2 days")
    flat = counts.select("event_type", F.date_format("window.start", "yyyy-MM-dd").alias("day"), "n")
    ingest.run_available(flat, f"{work}/out", f"{work}/state")
    closing.write.parquet(f"{work}/landing/day=2")
    ingest.run_available(flat, f"{work}/out", f"{work}/state")
    return spark.read.parquet(f"{work}/out").where("event_type <> ''")


def stream_watermark_append(spark, sf_dir):
    """Index days stored batch by batch: days at or before the latest stored one are late and dropped, the last row of a day is kept."""
    work = workspace(spark, "stream")
    prices = read(spark, sf_dir, "index_prices").where("date is not null").select(F.date_format("date", "yyyy-MM-dd").alias("date"), "close", F.coalesce("collected_at", F.lit("")).alias("collected_at"))
    store = ingest.append_above_watermark(spark, f"{work}/stored", "date", ["collected_at", F.coalesce("close", F.lit(-1.0))])
    early = F.col("date") < "2024-01-01"
    for batch_id, batch in enumerate((prices.where(early), prices, prices)):  # the second brings the first again, the third is late as a whole
        store(batch, batch_id)
    return spark.read.parquet(f"{work}/stored").select("date", "close")


QUERIES = {"stream_dedup_available_now": stream_dedup_available_now, "stream_window_counts": stream_window_counts, "stream_watermark_append": stream_watermark_append}
ORACLE_SQL = {
    "stream_dedup_available_now": "SELECT DISTINCT url FROM news_articles",
    "stream_window_counts": "SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events WHERE event_type <> '' GROUP BY 1, 2",
    "stream_watermark_append": "SELECT date, close FROM (SELECT strftime(date, '%Y-%m-%d') AS date, close, row_number() OVER (PARTITION BY date ORDER BY coalesce(collected_at, '') DESC, coalesce(close, -1) DESC) AS n FROM index_prices WHERE date IS NOT NULL) WHERE n = 1",
}
