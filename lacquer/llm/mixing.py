"""Mixing sources to target shares of the tokens.

Method: hash-threshold histograms.  Every document has a fixed hash; tokens are summed
by source and hash bucket, the bucket in which a source's budget ends is found, only
that bucket is split further, and documents are taken by comparing their hash with the
threshold.  Nothing is sorted, and a larger budget takes a superset of a smaller one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the hash, and bits that one histogram resolves.
HASH_BITS, STEP_BITS = 48, 12


def budgets(available: dict[str, int], targets: dict[str, tuple[float, int]]) -> dict[str, int]:
    """Tokens per source for the largest mix that no source's repeats fall short of.

    A source with a positive share and no tokens forces an empty mix.
    """
    limits = [available.get(s, 0) * max(r, 0) / share for s, (share, r) in targets.items() if share > 0]
    total = min(limits, default=0.0)
    return {s: int(total * share) for s, (share, _) in targets.items()}


def mix(docs: DataFrame, key: str, source: str, size: str, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(chosen, report).

    chosen: (key, source, tokens, copies), copies from 1 to the source's max_repeats.
    report: (source, target_share, actual_share, tokens, documents, most_repeats).
    A source gets its budget to within one document of the boundary hash.  Documents of
    other or null sources, and documents without tokens, are not chosen.  targets has
    source, target_share, max_repeats, one row per source (a bounded dimension).
    """
    wanted = {r["source"]: (float(r["target_share"] or 0), int(r["max_repeats"] or 0)) for r in targets.select("source", "target_share", "max_repeats").collect() if r["source"] is not None}
    spark = docs.sparkSession
    h = F.shiftrightunsigned(F.xxhash64(F.col(key)), 64 - HASH_BITS)
    base = docs.select(F.col(key).alias("k"), F.col(source).cast("string").alias("s"), F.col(size).cast("long").alias("n"), h.alias("h"))
    base = base.where(F.col("s").isin(list(wanted)) & (F.col("n") > 0)) if wanted else base.where(F.lit(False))

    # first histogram over all rows; later ones only over the boundary buckets
    rest: dict[str, int] = {}
    whole: dict[str, int] = {}
    prefix: dict[str, int] = {}
    shift = HASH_BITS - STEP_BITS
    sums = base.groupBy("s", F.shiftright("h", shift).alias("b")).agg(F.sum("n").alias("n")).collect()
    available: dict[str, int] = {}
    for r in sums:
        available[r["s"]] = available.get(r["s"], 0) + r["n"]
    for s, need in budgets(available, wanted).items():
        have = available.get(s, 0)
        whole[s] = min(need // have, wanted[s][1]) if have else 0
        rest[s] = need - whole[s] * have if have and whole[s] < wanted[s][1] else 0
    while True:
        by_source: dict[str, list[tuple[int, int]]] = {}
        for r in sums:
            by_source.setdefault(r["s"], []).append((r["b"], r["n"]))
        for s, rows in by_source.items():
            prefix[s] = prefix.get(s, 0) << STEP_BITS
            for b, n in sorted(rows):
                if n > rest.get(s, 0):
                    # the last document is taken if that comes nearer to the budget
                    prefix[s] = b + (shift == 0 and n - rest.get(s, 0) < rest.get(s, 0))
                    break
                rest[s] -= n
                prefix[s] = b + 1
        if shift == 0 or not prefix:
            break
        edge = F.create_map(*[F.lit(x) for s, p in prefix.items() for x in (s, p)])
        inside = base.where(F.shiftright("h", shift) == F.try_element_at(edge, F.col("s")))
        shift -= STEP_BITS
        sums = inside.groupBy("s", F.shiftright("h", shift).alias("b")).agg(F.sum("n").alias("n")).collect()
        for s in prefix:
            if not any(r["s"] == s for r in sums):  # the budget ends on a bucket border
                sums.append({"s": s, "b": prefix[s] << STEP_BITS, "n": rest.get(s, 0) + 1})
    plan = [(s, whole.get(s, 0), prefix.get(s, 0), wanted[s][0]) for s in wanted]
    table = F.broadcast(spark.createDataFrame(plan, "s string, whole long, edge long, share double"))
    copies = F.col("whole") + F.when(F.col("h") < F.col("edge"), 1).otherwise(0)
    chosen = base.join(table, "s").select("k", "s", "n", copies.cast("int").alias("copies")).where("copies > 0")
    got = chosen.groupBy("s").agg(F.sum(F.col("n") * F.col("copies")).alias("tokens"), F.count(F.lit(1)).alias("documents"), F.max("copies").alias("most_repeats"))
    everything = got.agg(F.sum("tokens").alias("all"))
    report = table.join(got, "s", "left").crossJoin(F.broadcast(everything)).select(
        F.col("s").alias("source"), F.col("share").alias("target_share"),
        F.round(F.coalesce(F.col("tokens") / F.col("all"), F.lit(0.0)), 6).alias("actual_share"),
        F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"),
    )
    return chosen.select(F.col("k").alias(key), F.col("s").alias("source"), F.col("n").alias("tokens"), "copies"), report
