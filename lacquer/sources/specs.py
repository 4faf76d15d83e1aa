"""How each source's landed payloads become records or articles."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import dates, ident, rules, text
from ..operators import dedup

# Fields of a record and of an article, in their order.
RECORD_FIELDS = (
    "document_id", "source", "source_tier", "url", "publish_time", "crawl_time", "company_code", "company_name",
    "title", "raw_text", "language", "category", "event_type", "attachment_urls", "checksum", "raw_path",
)
ARTICLE_FIELDS = ("id", "source", "title", "category", "pub_date", "url", "author", "lead", "pdf_url", "pdf_filename", "collected_at", "body")


@dataclass(frozen=True)
class SourceSpec:
    """A source's name and tier, its parser (payloads to listing rows) and which rows it keeps.

    keep_listed looks at what the listing says, before an article is fetched; keep at
    the parsed row.  members_only keeps codes of the universe and takes their names
    from it.
    """

    name: str
    tier: str
    parse: Callable[[DataFrame], DataFrame]
    keep: Column | None = None
    language: str = "vi"
    keep_listed: Column | None = None
    members_only: bool = False
    author: str = ""
    feed: str = ""


REGISTRY: dict[str, SourceSpec] = {}


def register(spec: SourceSpec) -> SourceSpec:
    REGISTRY[spec.name] = spec
    return spec


def _listed(spec: SourceSpec, payloads: DataFrame, universe: DataFrame | None) -> DataFrame:
    rows = spec.parse(payloads)
    for rule in (spec.keep_listed, spec.keep):
        if rule is not None:
            rows = rows.where(rule)
    if spec.members_only:
        if universe is None:
            raise ValueError(f"{spec.name} keeps members only and needs the universe")
        names = universe.select(F.upper(F.trim("ticker")).alias("__code"), F.col("company_name").alias("__name"))
        rows = rows.join(names, F.upper(F.trim("company_code")) == F.col("__code")).withColumn("company_name", F.col("__name")).drop("__code", "__name")
    return rows


def records_of(spec: SourceSpec, payloads: DataFrame, crawled_at: str, universe: DataFrame | None = None) -> DataFrame:
    """Records in the fixed order of sixteen fields; the parser gives url, title and what else it has."""
    rows = _listed(spec, payloads, universe)
    have = set(rows.columns)
    field = lambda n, default="": F.coalesce(F.col(n), F.lit(default)) if n in have else F.lit(default)
    body = text.first_filled(field("raw_text"), field("title"))
    kind = F.col("event_type") if "event_type" in have else rules.first_match(field("title"))
    urls = F.col("attachment_urls") if "attachment_urls" in have else F.array().cast("array<string>")
    return rows.select(
        ident.document_id(F.lit(spec.name), field("url")).alias("document_id"), F.lit(spec.name).alias("source"), F.lit(spec.tier).alias("source_tier"),
        ident.canonicalize_url(field("url")).alias("url"), dates.to_utc(field("publish_time")).alias("publish_time"), F.lit(crawled_at).alias("crawl_time"),
        F.upper(F.trim(field("company_code"))).alias("company_code"), field("company_name").alias("company_name"), field("title").alias("title"),
        body.alias("raw_text"), F.lit(spec.language).alias("language"), field("category").alias("category"), kind.alias("event_type"),
        urls.alias("attachment_urls"), ident.compute_checksum(body).alias("checksum"), field("raw_path").alias("raw_path"),
    )


def articles_of(spec: SourceSpec, payloads: DataFrame, collected_at: str) -> DataFrame:
    """Articles in the fixed order of twelve fields; what the parser does not give is ""."""
    rows = _listed(spec, payloads, None)
    have = set(rows.columns)
    given = {"id": ident.short_id(F.col("url")), "source": F.lit(spec.name), "author": F.lit(spec.author), "collected_at": F.lit(collected_at)}
    return rows.select(*[given.get(n, F.coalesce(F.col(n), F.lit("")) if n in have else F.lit("")).alias(n) for n in ARTICLE_FIELDS])


def rehydrated(rows: DataFrame) -> DataFrame:
    """Records out of their stored text form: every field there, attachment lists as arrays.

    A missing or null field is "", but for language (vi) and event_type (other, also
    where it is ""); a list that is no JSON list is empty.  Other columns are dropped.
    """
    have = set(rows.columns)

    def field(name: str) -> Column:
        value = F.col(name).cast("string") if name in have else F.lit(None).cast("string")
        if name == "attachment_urls":
            return text.url_list(value)
        if name == "event_type":
            return F.coalesce(text.blank_to_null(value), F.lit("other"))
        return F.coalesce(value, F.lit("vi" if name == "language" else ""))

    return rows.select(*[field(n).alias(n) for n in RECORD_FIELDS])


#: What becomes of a listed row.
FATES = ("kept", "dup", "fail", "out_of_range")


def with_fates(rows: DataFrame, stored: DataFrame, key: str = "url", date: Column | None = None, start: str | None = None, end: str | None = None, order: list[str] | None = None) -> DataFrame:
    """rows with `fate`: fail without a key, out_of_range by date (no date passes), dup if stored or a later copy, else kept.

    The first copy in `order` (key first by default) is kept.
    """
    inside = F.lit(True)
    if start:
        inside = inside & F.coalesce(date >= F.lit(start).cast("date"), F.lit(True))
    if end:
        inside = inside & F.coalesce(date <= F.lit(end).cast("date"), F.lit(True))
    known = stored.select(F.col(key).alias("__known")).where("__known is not null").distinct().withColumn("__stored", F.lit(True))
    has_key = F.coalesce(F.col(key) != "", F.lit(False))
    ranked = rows.withColumn("__row", F.xxhash64(*rows.columns)).withColumn("__can", has_key & inside)
    rank = F.struct(*(order or []), "__row")
    first = ranked.where("__can").groupBy(F.col(key).alias("__k")).agg(F.min(rank).alias("__first"))
    joined = ranked.join(known, F.col(key) == F.col("__known"), "left").join(first, F.col(key) == F.col("__k"), "left")
    fate = F.when(~has_key, "fail").when(~inside, "out_of_range").when(F.col("__stored"), "dup").when(rank == F.col("__first"), "kept").otherwise("dup")
    return joined.withColumn("fate", fate).drop("__known", "__stored", "__k", "__first", "__row", "__can")


def counted(rows: DataFrame, name: str = "fates") -> tuple[DataFrame, Observation]:
    """rows as they are, and the counts per fate, known once an action has run over them."""
    seen = Observation(name)
    return rows.observe(seen, *[F.count_if(F.col("fate") == f).alias(f) for f in FATES]), seen


def ingest(
    spec: SourceSpec, payloads: DataFrame, stored: DataFrame, crawled_at: str, start: str | None = None, end: str | None = None,
    most: int | None = None, universe: DataFrame | None = None,
) -> DataFrame:
    """New records of a source: with an identity, in the date range, not stored yet, one per document.

    Records without a date pass the range, as undated notices do; `most` keeps the
    latest so many, as a run with a cap does.
    """
    rows = records_of(spec, payloads, crawled_at, universe).where("url <> ''")
    day = F.substring("publish_time", 1, 10).try_cast("date")
    if start:
        rows = rows.where(F.coalesce(day >= F.lit(start).cast("date"), F.lit(True)))
    if end:
        rows = rows.where(F.coalesce(day <= F.lit(end).cast("date"), F.lit(True)))
    new = dedup.keep_first(dedup.unseen(rows, stored, ["document_id"]), ["document_id"], ["publish_time", "url"])
    return new.orderBy(F.desc("publish_time"), "document_id").limit(most) if most else new
