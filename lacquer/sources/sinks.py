"""Versioned tables, single-file exports and small reports."""

from __future__ import annotations

import csv
import json
import os
from html import escape
from string import Template

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import exists, listed, move


def write_version(df: DataFrame, path: str, version: str) -> None:
    """df as one version of a table; writing a version again replaces it."""
    df.drop("version").write.mode("overwrite").parquet(f"{path}/version={version}")


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The highest version of a table; only its partition is read."""
    table = spark.read.parquet(path)
    top = table.agg(F.max(F.col("version").cast("string"))).first()[0]
    return table.where(F.col("version").cast("string") == top)


def append_rows(df: DataFrame, path: str, columns: list[str]) -> None:
    """Appends exactly the columns, missing ones as ""."""
    have = {c: F.col(c) for c in df.columns}
    df.select(*[have.get(c, F.lit("")).alias(c) for c in columns]).write.mode("append").parquet(path)


def merge_rows(df: DataFrame, path: str, keys: list[str], order: list[str]) -> None:
    """Stored rows and new ones, the last in `order` per key, written as the table's next version.

    Readers of the former version are not disturbed, and a run that fails leaves it in place.
    """
    from ..operators.dedup import keep_last

    spark = df.sparkSession
    stored = latest(spark, path).drop("version") if exists(spark, path) else df.limit(0)
    number = max([int(p.rsplit("=", 1)[1]) for p in listed(spark, f"{path}/version=*")], default=0) + 1
    write_version(keep_last(stored.unionByName(df, allowMissingColumns=True), keys, order), path, f"{number:08d}")


def replace_with_backup(df: DataFrame, path: str, backup: str) -> None:
    """Writes df beside the table, moves the table to `backup` and df into its place.  The backup must not exist yet."""
    spark = df.sparkSession
    if exists(spark, backup):
        raise FileExistsError(backup)
    fresh = f"{path.rstrip('/')}.new"
    df.write.mode("overwrite").parquet(fresh)
    if exists(spark, path):
        move(spark, path, backup)
    move(spark, fresh, path)


def export_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a byte order mark, written beside and then moved into place.

    Rows pass through the driver one partition at a time; arrays are written as JSON.
    """
    flat = df.select(*[F.to_json(c).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in df.dtypes])
    temporary = f"{path}.tmp"
    with open(temporary, "w", encoding="utf-8-sig", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(flat.columns)
        for row in flat.toLocalIterator():
            writer.writerow(["" if v is None else v for v in row])
    os.replace(temporary, path)


def stats_text(counts: dict[str, DataFrame], most: int = 10_000) -> str:
    """Small result tables as lines of text; a table of more than `most` rows is refused."""
    out = []
    for title, df in counts.items():
        rows = df.take(most + 1)
        if len(rows) > most:
            raise ValueError(f"{title} has more than {most} rows")
        out.append(f"== {title}")
        out += ["  " + " | ".join(str(v) for v in r) for r in rows]
    return "\n".join(out)


#: Groups that a dashboard shows at most; more are refused, as a page cannot hold them.
SHOWN = 50_000


def dashboard_stats(records: DataFrame, companions: DataFrame, universe_size: int = 30) -> dict:
    """Figures of the dashboard from one count per source, event, code and day.

    Codes come by count, of equals the one that is first by name; blank codes count
    only among the most frequent.  companions are counted, not shown.
    """
    text = lambda n: F.coalesce(F.col(n).cast("string"), F.lit(""))
    base = records.select(*[text(n).alias(n) for n in ("source", "event_type", "company_code")], F.substring(text("publish_time"), 1, 10).alias("day"))

    def counts(*keys: str) -> dict:
        rows = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).take(SHOWN + 1)
        if len(rows) > SHOWN:
            raise ValueError(f"more than {SHOWN} groups of {keys}")
        return {r[0] if len(keys) == 1 else tuple(r)[:-1]: r["n"] for r in rows}

    latest = {r["company_code"]: r for r in base.where("company_code <> ''").groupBy("company_code").agg(
        F.count(F.lit(1)).alias("n"), F.max("day").alias("latest"), F.array_sort(F.collect_set(F.nullif(F.col("event_type"), F.lit("")))).alias("types")
    ).take(SHOWN)}
    by_code, days = counts("company_code"), base.where("day <> ''").agg(F.min("day"), F.max("day"), F.count(F.lit(1))).first()
    monthly = {r[0]: r[1] for r in base.groupBy(F.substring("day", 1, 7).alias("m")).agg(F.count(F.lit(1)).alias("n")).take(SHOWN) if r[0]}
    by_source = counts("source")
    return {
        "total_records": sum(by_source.values()), "tickers_covered": len(latest), "universe_total": universe_size,
        "date_range": {"oldest": days[0] or "", "newest": days[1] or ""}, "by_source": by_source, "by_event_type": counts("event_type"),
        "top_tickers": sorted(by_code.items(), key=lambda x: (-x[1], x[0]))[:10], "monthly_counts": sorted(monthly.items()), "news_corpus": companions.count(),
        "per_ticker": [{"ticker": k, "count": r["n"], "latest": r["latest"], "types": ", ".join(r["types"])} for k, r in sorted(latest.items(), key=lambda x: (-x[1]["n"], x[0]))],
    }


PAGE = Template("""<!doctype html><meta charset=utf-8><title>$title</title><h1>$title</h1>
<p>$total_records records of $tickers_covered of $universe_total codes from $sources sources, $oldest to $newest; $news_corpus companion articles.</p>
<h2>By source</h2>$by_source<h2>By event</h2>$by_event_type<h2>By month</h2>$monthly_counts<h2>Most frequent</h2>$top_tickers
<h2>By code</h2>$per_ticker<p>$generated</p><script type="application/json" id=stats>$data</script>""")


def _html_table(rows) -> str:
    return "<table>" + "".join("<tr>" + "".join(f"<td>{escape(str(v))}</td>" for v in r) + "</tr>" for r in rows) + "</table>"


def dashboard(title: str, stats: dict, generated: str = "") -> str:
    """A page with the sections of dashboard_stats, and the figures embedded as JSON."""
    data = json.dumps(stats, ensure_ascii=False, default=str).replace("</", "<\\/")
    by_count = lambda d: _html_table(sorted(d.items(), key=lambda x: (-x[1], x[0])))
    return PAGE.substitute(
        title=escape(title), data=data, generated=escape(generated), sources=len(stats["by_source"]), **{n: stats[n] for n in ("total_records", "tickers_covered", "universe_total", "news_corpus")},
        oldest=escape(stats["date_range"]["oldest"] or "—"), newest=escape(stats["date_range"]["newest"] or "—"), by_source=by_count(stats["by_source"]), by_event_type=by_count(stats["by_event_type"]),
        monthly_counts=_html_table(stats["monthly_counts"]), top_tickers=_html_table(stats["top_tickers"]), per_ticker=_html_table(r.values() for r in stats["per_ticker"]),
    )


def digest(rows: DataFrame, title: str) -> str:
    """Markdown of recent rows (source, day, summary), one section per source."""
    out, current = [f"# {title}"], None
    for r in rows.orderBy("source", F.desc("day")).toLocalIterator():
        if r["source"] != current:
            current = r["source"]
            out.append(f"\n## {current or '(none)'}")
        out.append(f"- {r['day'] or ''} {' '.join((r['summary'] or '').split())}")
    return "\n".join(out)
