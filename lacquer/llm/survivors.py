"""Best representative of each group of duplicates, field by field.

Method: fields are unpivoted to long rows; each usable row votes for its normalised
value with its source's trust times the decay of its age; votes are summed per value,
winners taken by max_by and pivoted back.  Votes are sums and winners maxima, so both
are combined before the shuffle and a group of any size meets in a few small rows.

Where a strict order of preference must decide, its ranks are the weights: each rank
outweighs all lower ones together (as powers of two do), so the sum of a value's votes
compares as the largest of them, and that is how it is summed (`strict`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Trust per tier, and days in which a value's weight halves.
TRUST = {"tier1": 1.0, "tier2": 0.6, "tier3": 0.4, "": 0.2}
HALF_LIFE_DAYS = 180.0
#: Votes are whole numbers, so that their sums do not depend on the order of adding.
VOTE_UNIT = 1_000_000


def not_blank(c: Column) -> Column:
    return F.coalesce(c.rlike(r"[^\s\x1c-\x1f\x85\p{Z}]"), F.lit(False))


def plain_tier(c: Column) -> Column:
    return F.lower(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))


def tier_rank(c: Column) -> Column:
    """3, 2, 1 for tier1..tier3, 0 for blank or anything else."""
    t = plain_tier(c)
    return F.when(t == "tier1", 3).when(t == "tier2", 2).when(t == "tier3", 1).otherwise(0)


def url_count(c: Column) -> Column:
    """Distinct non-blank strings of a JSON list; null if the text is no valid JSON list."""
    items = F.when(c.rlike(r"(?s)^\s*\[.*\]\s*$"), F.from_json(c, "array<string>"))
    return F.when(items.isNotNull(), F.size(F.array_distinct(F.filter(items, not_blank))))


def visible(text: Column) -> Column:
    """Whether a text is not blank once tags are taken out."""
    return not_blank(F.regexp_replace(text, "<[^>]*>", ""))


def long_rows(df: DataFrame, group: Column, row: str, weight: Column, order: Column, fields: dict[str, tuple[Column, Column]]) -> DataFrame:
    """One row per record and field: g, r, weight, o, field_name, value, usable, more.

    `fields` maps a name to (usable, more): only usable values compete; `more` is a
    count that goes before `order` (a null counts as 0).
    """
    structs = [
        F.struct(
            F.lit(n).alias("field_name"), F.col(n).cast("string").alias("value"),
            F.coalesce(ok, F.lit(False)).alias("usable"), F.coalesce(more.cast("long"), F.lit(0).cast("long")).alias("more"),
        )
        for n, (ok, more) in fields.items()
    ]
    wide = df.select(group.alias("g"), F.col(row).alias("r"), weight.alias("weight"), order.alias("o"), F.array(*structs).alias("fs"))
    return wide.select("g", "r", "weight", "o", F.inline("fs"))


def voted_values(long: DataFrame, min_rows: int = 2, strict: bool = False, written: bool = True) -> DataFrame:
    """(g, field_name, r and, if `written`, value): the value with the most votes and the row that supplies it.

    Values agree if they agree trimmed and in lower case; they meet by two hashes of that
    form.  The row, and with it the written form, is the best-ranked one (`more`, then
    `o`) that holds the winning value; equal votes go to that rank, which cannot tie if
    it ends in a unique key.  Fields without a usable value give no row, nor do groups
    of fewer than min_rows rows; a null group is a group.
    """
    form = F.lower(F.trim("value"))
    rank = F.struct("more", "o")
    # strict: a vote outweighs all below it together, so a sum of votes compares as its largest
    votes = F.max(rank) if strict else F.sum(F.round(F.col("weight") * VOTE_UNIT).cast("long"))
    hashes = [F.when(F.col("usable"), F.xxhash64(*salt, form)).alias(n) for n, salt in (("h1", []), ("h2", [F.lit(1)]))]
    supplier = F.struct("r", "value") if written else F.struct("r")
    by_value = long.groupBy("g", "field_name", *hashes).agg(
        F.count(F.lit(1)).alias("n"), votes.alias("votes"), F.max_by(supplier, rank).alias("kept"), F.max(rank).alias("rank")
    )
    won = F.when(F.col("h1").isNotNull(), F.struct("votes", "rank"))
    winner = by_value.groupBy("g", "field_name").agg(F.sum("n").alias("n"), F.max_by("kept", won).alias("kept"), F.max(won).alias("top"))
    return winner.where((F.col("n") >= min_rows) & F.col("top").isNotNull()).select("g", "field_name", "kept.*")


def voted_records(long: DataFrame, fields: list[str], min_rows: int = 2, strict: bool = False) -> DataFrame:
    """One record per group: g and, per field, the winning value, null where no row has a usable one."""
    votes = voted_values(long, min_rows, strict)
    return votes.groupBy("g").agg(*[F.max(F.when(F.col("field_name") == n, F.col("value"))).alias(n) for n in fields])


def supplying_rows(long: DataFrame, fields: list[str], min_rows: int = 2) -> DataFrame:
    """(g, field_name, r): the row that supplies each field of the record a strict vote builds.

    The record is built first, one row per group with the supplier of each field, and
    read off field by field.
    """
    votes = voted_values(long, min_rows, strict=True, written=False)
    records = votes.groupBy("g").agg(*[F.max(F.when(F.col("field_name") == n, F.col("r"))).alias(f"r{i}") for i, n in enumerate(fields)])
    named = F.array(*[F.struct(F.lit(n).alias("field_name"), F.col(f"r{i}").alias("r")) for i, n in enumerate(fields)])
    return records.select("g", F.inline(named)).where("r is not null")


def record_weight(tier: Column, crawled: Column, now: Column, half_life: float = HALF_LIFE_DAYS) -> Column:
    """Source trust times recency decay; an unknown age counts as one half-life."""
    trust = F.create_map(*[F.lit(x) for kv in TRUST.items() for x in kv])
    age = F.greatest(F.datediff(now, crawled), F.lit(0))
    return F.coalesce(F.try_element_at(trust, plain_tier(tier)), F.lit(TRUST[""])) * F.pow(F.lit(0.5), F.coalesce(age / F.lit(half_life), F.lit(1.0)))
