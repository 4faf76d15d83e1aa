"""Queries on written times."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.instants import CANONICAL
from ..operators.timeline import instants

FIELDS = (("objective_records", "publish_time"), ("news_articles", "pub_date"), ("news_articles", "collected_at"))
COLLECTOR_ZONE, COLLECTOR_ORDER = "Asia/Ho_Chi_Minh", "dmy"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with_clock_rules(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The table with its source's zone and date order (a dimension of one row per source)."""
    rules = _read(spark, sf_dir, "source_registry").select("source", F.col("time_zone").alias("__zone"), F.col("date_order").alias("__order"))
    return _read(spark, sf_dir, table).join(rules, "source", "left")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instant of each written time that is not canonical already."""
    out = None
    for table, field in FIELDS:
        df = _with_clock_rules(spark, sf_dir, table).where(F.col(field).isNotNull() & ~F.col(field).rlike(CANONICAL))
        own = field == "collected_at"
        zone = F.lit(COLLECTOR_ZONE) if own else F.coalesce("__zone", F.lit("UTC"))
        order = F.lit(COLLECTOR_ORDER) if own else F.col("__order")
        found = instants(df, "row_id", field, zone, order, "source")
        found = found.select(F.lit(table).alias("tbl"), "row_id", F.lit(field).alias("field_name"), "utc_s")
        out = found if out is None else out.unionByName(found)
    return out


def p6_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """publish_time with every source's date order withheld: Viterbi along each source.

    ok tells whether the path found the same instant as the stated order does.
    """
    df = _with_clock_rules(spark, sf_dir, "objective_records").where(F.col("publish_time").isNotNull())
    zone = F.coalesce("__zone", F.lit("UTC"))
    seen = F.unix_timestamp(F.try_to_timestamp(F.concat(F.substring("crawl_time", 1, 19), F.lit("+00:00")), F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")))
    told = instants(df, "row_id", "publish_time", zone, F.col("__order"), "source").withColumnRenamed("utc_s", "told_s")
    chained = instants(df, "row_id", "publish_time", zone, F.lit(None).cast("string"), "source", seen)
    return chained.join(told, "row_id", "left").select("row_id", "utc_s", (F.col("utc_s") == F.col("told_s")).alias("ok"))


QUERIES = {"p6_found": p6_found, "p6_inferred": p6_inferred}
ORACLE_SQL: dict[str, str] = {}
