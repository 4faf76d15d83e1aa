"""Queries on daily series and on counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import dedup
from ..operators import series as S
from ..session import workspace
from ..sources import sinks
from .records import read

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

# Columns of the series and of the feature table, in their order.
INDEX, RATES, POLICY = ["open", "high", "low", "close", "volume"], ["dxy"], ["refinancing_rate", "discount_rate", "omo_rate"]
FEATURES = [
    "date", "vni_open", "vni_high", "vni_low", "vni_close", "vni_volume", "vni_return_1d", "vni_return_5d", "vni_volume_zscore", "dxy", "dxy_return_1d",
    "usd_vnd_sell", "usd_vnd_buy", "usd_vnd_central", "usd_vnd_change_1d", "usd_vnd_volatility_5d", "refinancing_rate", "discount_rate", "omo_rate",
]


def query(sql: str | None = None, dated: bool = False):
    """Registers a query; `dated` ones give their date column as text in both languages."""

    def register(f):
        QUERIES[f.__name__] = (lambda spark, sf_dir: f(spark, sf_dir).withColumn("date", F.date_format("date", "yyyy-MM-dd"))) if dated else f
        if sql:
            ORACLE_SQL[f.__name__] = f"SELECT * REPLACE (strftime(date, '%Y-%m-%d') AS date) FROM ({sql})" if dated else sql
        return f

    return register


def index_daily(spark, sf_dir) -> DataFrame:
    return S.daily(read(spark, sf_dir, "index_prices"), "date", INDEX, ["collected_at", F.coalesce("close", F.lit(0.0)), "source"])


def dxy_daily(spark, sf_dir) -> DataFrame:
    return S.daily(read(spark, sf_dir, "dxy_rates"), "date", RATES, ["collected_at", F.coalesce("dxy", F.lit(0.0))])


def policy_daily(spark, sf_dir) -> DataFrame:
    p = read(spark, sf_dir, "policy_rates").withColumnRenamed("effective_date", "date")
    return S.daily(p, "date", POLICY, [F.coalesce("refinancing_rate", F.lit(0.0)), "source"])


def fx_daily(spark, sf_dir) -> DataFrame:
    """A stand-in for exchange rates: highest shipped price per day as sell, lowest as buy, every fifth day a central rate."""
    line = read(spark, sf_dir, "lineitem").groupBy(F.col("l_shipdate").cast("date").alias("d")).agg(
        F.max("l_extendedprice").alias("usd_vnd_sell"), F.min("l_extendedprice").alias("usd_vnd_buy")
    )
    shifted = line.withColumn("date", F.date_add("d", 9496))
    central = F.when(F.dayofmonth("date") % 5 == 0, F.col("usd_vnd_sell") + 1)
    return shifted.select("date", "usd_vnd_sell", "usd_vnd_buy", central.alias("usd_vnd_central"))


def macro(anchor: DataFrame, dxy: DataFrame | None, fx: DataFrame | None, policy: DataFrame | None, dxy_lag: int = 1) -> DataFrame:
    """The feature table on the anchor's calendar; a missing source gives empty columns.

    Rates published a day late are lagged, so that no day sees its own future.
    """
    out = anchor.select("date", *[F.col(c).alias(f"vni_{c}") for c in INDEX])
    rights = [(r, [c for c in r.columns if c != "date"], lag) for r, lag in ((dxy, dxy_lag), (fx, 0), (policy, 0)) if r is not None]
    out = S.as_of_many(out, rights)
    for c in FEATURES:
        if c not in out.columns and c in (*RATES, *POLICY, "usd_vnd_sell", "usd_vnd_buy", "usd_vnd_central"):
            out = out.withColumn(c, F.lit(None).cast("double"))
    w = S.by_date([])
    rate = F.coalesce("usd_vnd_central", "usd_vnd_sell")
    out = out.withColumns({
        "vni_return_1d": S.log_return(F.col("vni_close"), 1, w), "vni_return_5d": S.log_return(F.col("vni_close"), 5, w),
        "vni_volume_zscore": S.z_score(F.col("vni_volume"), 20, w), "dxy_return_1d": S.pct_change(F.col("dxy"), w),
        "usd_vnd_change_1d": S.pct_change(rate, w),
    })
    out = out.withColumn("usd_vnd_volatility_5d", S.rolling(F.col("usd_vnd_change_1d"), 5, w, F.stddev_samp))
    return out.select(*FEATURES)


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# The macro CTEs in SQL; names i, x, f, p are index, dxy, fx, policy.
_CTE = """WITH i AS (SELECT date, open, high, low, close, volume FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY collected_at NULLS FIRST, coalesce(close, 0), source) AS n FROM index_prices WHERE date IS NOT NULL) WHERE n = 1),
x AS (SELECT date, dxy FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY collected_at NULLS FIRST, coalesce(dxy, 0)) AS n FROM dxy_rates WHERE date IS NOT NULL) WHERE n = 1),
p AS (SELECT effective_date AS date, refinancing_rate, discount_rate, omo_rate FROM (SELECT *, row_number() OVER (PARTITION BY effective_date ORDER BY coalesce(refinancing_rate, 0), source) AS n FROM policy_rates WHERE effective_date IS NOT NULL) WHERE n = 1),
f AS (SELECT d + 9496 AS date, sell, buy, CASE WHEN day(d + 9496) % 5 = 0 THEN sell + 1 END AS central FROM (SELECT CAST(l_shipdate AS DATE) AS d, max(l_extendedprice) AS sell, min(l_extendedprice) AS buy FROM lineitem GROUP BY 1)),
a AS (SELECT i.*, x.dxy AS dxy0, f.sell AS sell0, f.buy AS buy0, f.central AS central0, p.refinancing_rate AS r0, p.discount_rate AS d0, p.omo_rate AS o0 FROM i
  ASOF LEFT JOIN (SELECT date + 1 AS date, dxy FROM x) x ON i.date >= x.date ASOF LEFT JOIN f ON i.date >= f.date ASOF LEFT JOIN p ON i.date >= p.date),
g AS (SELECT date, open, high, low, close, volume,
  last_value(dxy0 IGNORE NULLS) OVER w AS dxy, last_value(sell0 IGNORE NULLS) OVER w AS sell, last_value(buy0 IGNORE NULLS) OVER w AS buy, last_value(central0 IGNORE NULLS) OVER w AS central,
  last_value(r0 IGNORE NULLS) OVER w AS refinancing_rate, last_value(d0 IGNORE NULLS) OVER w AS discount_rate, last_value(o0 IGNORE NULLS) OVER w AS omo_rate
  FROM a WINDOW w AS (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
h AS (SELECT *, ln(CASE WHEN close / nullif(lag(close) OVER (ORDER BY date), 0) > 0 THEN close / nullif(lag(close) OVER (ORDER BY date), 0) END) AS r1,
  ln(CASE WHEN close / nullif(lag(close, 5) OVER (ORDER BY date), 0) > 0 THEN close / nullif(lag(close, 5) OVER (ORDER BY date), 0) END) AS r5,
  CASE WHEN count(volume) OVER v = 20 THEN (volume - avg(volume) OVER v) / nullif(stddev_samp(volume) OVER v, 0) END AS z,
  dxy / nullif(lag(dxy) OVER (ORDER BY date), 0) - 1 AS dxy_return_1d, coalesce(central, sell) / nullif(lag(coalesce(central, sell)) OVER (ORDER BY date), 0) - 1 AS ch
  FROM g WINDOW v AS (ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
m AS (SELECT *, CASE WHEN count(ch) OVER u = 5 THEN stddev_samp(ch) OVER u END AS vol5 FROM h WINDOW u AS (ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
"""
_R = lambda c, n=None: f"round({c}, 6) AS {n or c}"


def _macro_table(spark, sf_dir) -> DataFrame:
    return macro(index_daily(spark, sf_dir), dxy_daily(spark, sf_dir), fx_daily(spark, sf_dir), policy_daily(spark, sf_dir))


@query(_CTE + "SELECT date, " + ", ".join([
    _R("open", "vni_open"), _R("high", "vni_high"), _R("low", "vni_low"), _R("close", "vni_close"), _R("volume", "vni_volume"), _R("r1", "vni_return_1d"), _R("r5", "vni_return_5d"),
    _R("z", "vni_volume_zscore"), _R("dxy"), _R("dxy_return_1d"), _R("sell", "usd_vnd_sell"), _R("buy", "usd_vnd_buy"), _R("central", "usd_vnd_central"), _R("ch", "usd_vnd_change_1d"),
    _R("vol5", "usd_vnd_volatility_5d"), _R("refinancing_rate"), _R("discount_rate"), _R("omo_rate"),
]) + " FROM m", dated=True)
def macro_features(spark, sf_dir):
    """Nineteen columns on the index calendar: prices, lagged and filled rates, returns, z-score, volatility."""
    return rounded(_macro_table(spark, sf_dir))


@query(_CTE + "SELECT c AS column_name, filled, CAST(filled * 100 // n AS BIGINT) AS percent FROM (SELECT count(*) AS n, count(dxy) AS dxy, count(omo_rate) AS omo, count(z) AS z, count(vol5) AS v FROM m), LATERAL (SELECT unnest(['dxy', 'omo_rate', 'vni_volume_zscore', 'usd_vnd_volatility_5d']) AS c, unnest([dxy, omo, z, v]) AS filled)")
def feature_coverage(spark, sf_dir):
    return S.coverage(_macro_table(spark, sf_dir), ["dxy", "omo_rate", "vni_volume_zscore", "usd_vnd_volatility_5d"])


@query(_CTE + "SELECT i.date, p.refinancing_rate, p.omo_rate FROM i ASOF LEFT JOIN p ON i.date >= p.date", dated=True)
def asof_lag0(spark, sf_dir):
    """Policy rates in force on each trading day, nulls of the newest decision kept."""
    return S.as_of(index_daily(spark, sf_dir).select("date"), policy_daily(spark, sf_dir), ["refinancing_rate", "omo_rate"], 0, fill=False)


@query(_CTE + "SELECT date, dxy FROM g", dated=True)
def asof_lag1_ffill(spark, sf_dir):
    return S.as_of(index_daily(spark, sf_dir).select("date"), dxy_daily(spark, sf_dir), ["dxy"], 1)


@query("""WITH d AS (SELECT event_type AS series, CAST(ts AS DATE) AS date, min(value) AS low FROM events GROUP BY 1, 2), r AS (SELECT event_type AS series, CAST(ts AS DATE) AS date, max(value) AS high FROM events WHERE hour(ts) = 3 GROUP BY 1, 2)
SELECT d.series, d.date, d.low, r.high FROM d ASOF LEFT JOIN r ON d.series = r.series AND d.date >= r.date + 2""", dated=True)
def asof_many_series(spark, sf_dir):
    """The same join for many series side by side."""
    e = read(spark, sf_dir, "events").select(F.col("event_type").alias("series"), F.col("ts").cast("date").alias("date"), F.hour("ts").alias("h"), "value")
    left = e.groupBy("series", "date").agg(F.min("value").alias("low"))
    right = e.where("h = 3").groupBy("series", "date").agg(F.max("value").alias("high"))
    return S.as_of(left, right, ["high"], 2, ["series"], fill=False)


def _per_type(spark, sf_dir) -> DataFrame:
    e = read(spark, sf_dir, "events").groupBy(F.col("event_type").alias("series"), F.col("ts").cast("date").alias("date"))
    return e.agg(F.max("value").alias("v"), F.count(F.lit(1)).cast("double").alias("n"))


_PER = "WITH e AS (SELECT event_type AS series, CAST(ts AS DATE) AS date, max(value) AS v, CAST(count(*) AS DOUBLE) AS n FROM events GROUP BY 1, 2) "


@query(_PER + "SELECT series, date, round(ln(CASE WHEN v / nullif(lag(v) OVER w, 0) > 0 THEN v / nullif(lag(v) OVER w, 0) END), 6) AS r1, round(ln(CASE WHEN v / nullif(lag(v, 5) OVER w, 0) > 0 THEN v / nullif(lag(v, 5) OVER w, 0) END), 6) AS r5 FROM e WINDOW w AS (PARTITION BY series ORDER BY date)", dated=True)
def log_returns(spark, sf_dir):
    w = S.by_date(["series"])
    return rounded(_per_type(spark, sf_dir).select("series", "date", S.log_return(F.col("v"), 1, w).alias("r1"), S.log_return(F.col("v"), 5, w).alias("r5")))


@query(_PER + "SELECT series, date, round(CASE WHEN count(n) OVER w = 20 THEN (n - avg(n) OVER w) / nullif(stddev_samp(n) OVER w, 0) END, 6) AS z FROM e WINDOW w AS (PARTITION BY series ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)", dated=True)
def volume_zscore20(spark, sf_dir):
    return rounded(_per_type(spark, sf_dir).select("series", "date", S.z_score(F.col("n"), 20, S.by_date(["series"])).alias("z")))


@query(_PER + "SELECT series, date, round(v / nullif(lag(v) OVER (PARTITION BY series ORDER BY date), 0) - 1, 6) AS change FROM e", dated=True)
def pct_change(spark, sf_dir):
    return rounded(_per_type(spark, sf_dir).select("series", "date", S.pct_change(F.col("v"), S.by_date(["series"])).alias("change")))


@query(_PER + ", c AS (SELECT series, date, v / nullif(lag(v) OVER (PARTITION BY series ORDER BY date), 0) - 1 AS ch FROM e) SELECT series, date, round(CASE WHEN count(ch) OVER w = 5 THEN stddev_samp(ch) OVER w END, 6) AS spread FROM c WINDOW w AS (PARTITION BY series ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)", dated=True)
def rolling_std5(spark, sf_dir):
    w = S.by_date(["series"])
    changed = _per_type(spark, sf_dir).select("series", "date", S.pct_change(F.col("v"), w).alias("ch"))
    return rounded(changed.select("series", "date", S.rolling(F.col("ch"), 5, w, F.stddev_samp).alias("spread")))


@query(_CTE + "SELECT date, round(coalesce(central, sell), 6) AS rate FROM f", dated=True)
def fx_preference(spark, sf_dir):
    return rounded(fx_daily(spark, sf_dir).select("date", F.coalesce("usd_vnd_central", "usd_vnd_sell").alias("rate")))


def _count(table: str, column: str, expression: str | None = None):
    e = expression or f"coalesce({column}, '')"
    return f"SELECT {e} AS key, count(*) AS n FROM {table} GROUP BY 1"


@query(_count("documents", "source"))
def counts_by_source(spark, sf_dir):
    return read(spark, sf_dir, "documents").groupBy(F.coalesce("source", F.lit("")).alias("key")).agg(F.count(F.lit(1)).alias("n"))


@query(_count("objective_records", "event_type"))
def counts_by_event(spark, sf_dir):
    return read(spark, sf_dir, "objective_records").groupBy(F.coalesce("event_type", F.lit("")).alias("key")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT substr(crawl_time, 1, 7) AS key, count(*) AS n FROM objective_records WHERE coalesce(substr(crawl_time, 1, 7), '') <> '' GROUP BY 1")
def counts_by_month(spark, sf_dir):
    month = F.substring("crawl_time", 1, 7)
    return read(spark, sf_dir, "objective_records").where(month != "").groupBy(month.alias("key")).agg(F.count(F.lit(1)).alias("n")).orderBy("key")


@query("SELECT coalesce(CAST(year(published_on) AS VARCHAR), '') AS key, count(*) AS n FROM documents GROUP BY 1")
def counts_by_year(spark, sf_dir):
    return read(spark, sf_dir, "documents").groupBy(F.coalesce(F.year("published_on").cast("string"), F.lit("")).alias("key")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT company_code, count(*) AS n, max(substr(crawl_time, 1, 10)) AS latest, string_agg(DISTINCT nullif(event_type, ''), ', ' ORDER BY nullif(event_type, '')) AS types
FROM objective_records WHERE coalesce(company_code, '') <> '' GROUP BY 1""")
def per_ticker_summary(spark, sf_dir):
    """Count, latest day and sorted distinct event types per code, most first, of equals the one seen first; partial sets before the shuffle."""
    r = read(spark, sf_dir, "objective_records").where(F.coalesce("company_code", F.lit("")) != "")
    types = F.array_join(F.array_sort(F.collect_set(F.nullif(F.col("event_type"), F.lit("")))), ", ")
    out = r.groupBy("company_code").agg(F.min("row_id").alias("first"), F.count(F.lit(1)).alias("n"), F.max(F.substring("crawl_time", 1, 10)).alias("latest"), types.alias("types"))
    return out.withColumn("types", F.nullif(F.col("types"), F.lit(""))).orderBy(F.desc("n"), "first").drop("first")


@query("SELECT user_id, n FROM (SELECT user_id, count(*) AS n, min(event_id) AS first FROM events GROUP BY 1 ORDER BY n DESC, first LIMIT 10)")
def top10_first_seen_ties(spark, sf_dir):
    """Ten most frequent users; of equals the one seen first."""
    counted = read(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first"))
    return counted.orderBy(F.desc("n"), "first").limit(10).select("user_id", "n")


@query("SELECT strftime(min(published_on), '%Y-%m-%d') AS first_day, strftime(max(published_on), '%Y-%m-%d') AS last_day FROM documents")
def date_bounds(spark, sf_dir):
    d = read(spark, sf_dir, "documents").agg(F.min("published_on").alias("a"), F.max("published_on").alias("b"))
    return d.select(F.date_format("a", "yyyy-MM-dd").alias("first_day"), F.date_format("b", "yyyy-MM-dd").alias("last_day"))


@query("SELECT count(DISTINCT r.company_code) AS covered, count(DISTINCT r.source) AS sources, (SELECT count(*) FROM universe) AS members FROM objective_records r JOIN universe u ON r.company_code = u.ticker")
def distinct_coverage(spark, sf_dir):
    u = read(spark, sf_dir, "universe").select(F.col("ticker").alias("company_code"))
    r = read(spark, sf_dir, "objective_records").join(u, "company_code", "left_semi")
    return r.agg(F.countDistinct("company_code").alias("covered"), F.countDistinct("source").alias("sources")).crossJoin(u.agg(F.count(F.lit(1)).alias("members")))


@query("SELECT source, strftime(published_on, '%Y-%m-%d') AS day, doc_id, substr(coalesce(text, ''), 1, 140) AS summary FROM documents WHERE published_on >= DATE '2026-06-01' - 30")
def digest_rows(spark, sf_dir):
    """Documents of the last thirty days before a given day, the newest first."""
    today = F.lit("2026-06-01").cast("date")
    d = read(spark, sf_dir, "documents").where(F.col("published_on") >= F.date_sub(today, 30))
    return d.orderBy(F.desc("published_on"), "doc_id").select("source", F.date_format("published_on", "yyyy-MM-dd").alias("day"), "doc_id", F.substring(F.coalesce("text", F.lit("")), 1, 140).alias("summary"))


@query("SELECT row_id, source, substr(crawl_time, 1, 7) AS version FROM objective_records WHERE substr(crawl_time, 1, 7) = (SELECT max(substr(crawl_time, 1, 7)) FROM objective_records)")
def latest_version(spark, sf_dir):
    """Records written as one version per month; the latest version is looked up and only its partition read."""
    path = workspace(spark, "versions")
    month = F.substring("crawl_time", 1, 7)
    read(spark, sf_dir, "objective_records").where(month.isNotNull()).select("row_id", "source", month.alias("version")).write.partitionBy("version").parquet(path)
    return sinks.latest(spark, path).select("row_id", "source", F.col("version").cast("string").alias("version"))


@query("""SELECT source, count(*) AS n, count(*) FILTER (trim(coalesce(body, '')) <> '') AS with_body, count(*) FILTER (trim(coalesce(body, '')) <> '') * 100 // count(*) AS percent FROM news_articles GROUP BY 1""")
def body_coverage(spark, sf_dir):
    filled = F.count_if(F.trim(F.coalesce("body", F.lit(""))) != "")
    out = read(spark, sf_dir, "news_articles").groupBy("source").agg(F.count(F.lit(1)).alias("n"), filled.alias("with_body"))
    return out.withColumn("percent", F.floor(F.col("with_body") * 100 / F.col("n")))


@query("""SELECT date, close FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY collected_at DESC NULLS LAST, close DESC NULLS LAST) AS n FROM index_prices) WHERE n = 1""", dated=True)
def keep_last_per_date(spark, sf_dir):
    """The latest collected close of each day."""
    p = read(spark, sf_dir, "index_prices").select("date", "close", "collected_at")
    return dedup.keep_last(p, ["date"], [F.coalesce("collected_at", F.lit("")), F.coalesce("close", F.lit(-1.0))]).select("date", "close")
