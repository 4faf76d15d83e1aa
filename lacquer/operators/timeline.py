"""Mixed written times to instants: all readings per value, the best path per source.

A value whose readings are narrowed to one by a stated date order is settled.  In
sources without a stated order the readings are states of a chain in the source's
record order, and Viterbi picks the path with the fewest order switches and backward
jumps.  The chain of a large source is cut at range-partition borders: each partition
gives a 2 x 2 cost table between its borders, the driver joins those few tables, and
every partition then solves its own stretch between fixed ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.instants import with_readings

FORMS = ("dmy", "mdy")
NEVER = float("inf")
#: Cost of another date order than the row before, of a jump back in time, and of a
#: reading later than the row's own clock, and the slack of the last two in seconds.
SWITCH_COST, BACK_COST, FUTURE_COST, SLACK_S = 3.0, 1.0, 2.0, 2 * 86400


def _times(form: list, utc: list) -> list[float | None]:
    """Instant under dmy and under mdy; a fixed reading is the same under both."""
    out: list[float | None] = [None, None]
    for f, t in zip(form, utc):
        for s in (0, 1) if f == "fixed" else (FORMS.index(f),):
            out[s] = t
    return out


def _own(times: list, clock: float | None) -> list[float]:
    any_at_all = any(t is not None for t in times)
    return [
        (NEVER if t is None else FUTURE_COST if clock is not None and t > clock + SLACK_S else 0.0) if any_at_all else 0.0
        for t in times
    ]


def _step(before: list, s0: int, times: list, s1: int) -> float:
    cost = SWITCH_COST * (s0 != s1)
    a, b = before[s0], times[s1]
    if a is not None and b is not None and b < a - SLACK_S:
        cost += BACK_COST
    return cost


def _rows(part: pd.DataFrame) -> Iterator[tuple]:
    for src, form, utc, clock in zip(part["source"], part["form"], part["utc"], part["clock"]):
        yield src, _times(list(form), list(utc)), None if pd.isna(clock) else float(clock)


def _stretches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per source met in this partition: cost[s][t] from its first to its last row, and both ends' times."""
    out, current = [], None

    def close() -> None:
        src, first, table, last = current
        out.append((pid, src, *[x for r in table for x in r], *first, *last))

    pid = -1
    for part in batches:
        if len(part):
            pid = int(part["pid"].iloc[0])
        for src, times, clock in _rows(part):
            own = _own(times, clock)
            if current is None or current[0] != src:
                if current is not None:
                    close()
                current = (src, times, [[own[0], NEVER], [NEVER, own[1]]], times)
                continue
            _, first, table, before = current
            nxt = [[min(table[i][s] + _step(before, s, times, t) for s in (0, 1)) + own[t] for t in (0, 1)] for i in (0, 1)]
            if all(t is None for t in times):
                times = before
            current = (src, first, nxt, times)
    if current is not None:
        close()
    names = ["pid", "source", "c00", "c01", "c10", "c11", "f0", "f1", "l0", "l1"]
    yield pd.DataFrame(out, columns=names).astype({n: "float64" for n in names[2:]})


def _border_states(tables: list) -> dict[tuple[int, str], tuple[int, int]]:
    """(pid, source) -> states of its first and last row, over the whole chain of the source."""
    chains: dict[str, list] = {}
    for r in sorted(tables, key=lambda r: r["pid"]):
        chains.setdefault(r["source"], []).append(r)
    none = lambda x: None if x is None or x != x else x
    fixed = {}
    for src, chain in chains.items():
        best, back = [0.0, 0.0], []
        before = None
        for r in chain:
            first, last = [none(r["f0"]), none(r["f1"])], [none(r["l0"]), none(r["l1"])]
            cost = [[r["c00"], r["c01"]], [r["c10"], r["c11"]]]
            step = [[0.0 if before is None else _step(before, s, first, t) for t in (0, 1)] for s in (0, 1)]
            came = [min((best[s] + step[s][i] + cost[i][t], s, i) for s in (0, 1) for i in (0, 1)) for t in (0, 1)]
            back.append([(s, i) for _, s, i in came])
            best, before = [c for c, _, _ in came], last
        t = 0 if best[0] <= best[1] else 1
        for r, b in zip(reversed(chain), reversed(back)):
            s, i = b[t]
            fixed[(r["pid"], src)] = (i, t)
            t = s
    return fixed


def _solver(fixed: dict[tuple[int, str], tuple[int, int]]):
    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        run: list = []

        def path() -> list[int]:
            ends = fixed.get((run[0][0], run[0][1]))
            best = [0.0, 0.0] if ends is None else [NEVER if s != ends[0] else 0.0 for s in (0, 1)]
            own = _own(run[0][3], run[0][4])
            best = [best[s] + own[s] for s in (0, 1)]
            back, before = [], run[0][3]
            for _, _, _, times, clock in run[1:]:
                own = _own(times, clock)
                came = [min((best[s] + _step(before, s, times, t), s) for s in (0, 1)) for t in (0, 1)]
                back.append([s for _, s in came])
                best = [came[t][0] + own[t] for t in (0, 1)]
                if any(t is not None for t in times):
                    before = times
            t = ends[1] if ends is not None else (0 if best[0] <= best[1] else 1)
            states = [t]
            for b in reversed(back):
                t = b[t]
                states.append(t)
            return states[::-1]

        def flush() -> pd.DataFrame:
            chosen = [(k, times[s]) for (_, _, k, times, _), s in zip(run, path()) if times[s] is not None]
            run.clear()
            return pd.DataFrame(chosen, columns=["k", "utc_s"]).astype({"k": "int64", "utc_s": "int64"})

        for part in batches:
            for (src, times, clock), pid, k in zip(_rows(part), part["pid"], part["k"]):
                if run and run[0][1] != src:
                    yield flush()
                run.append((pid, src, k, times, clock))
        if run:
            yield flush()

    return solve


def _by_chain(open_: DataFrame) -> DataFrame:
    """(k, utc_s) along the best path; open_ has k, source, ord, clock, r (readings)."""
    parts = max(1, int(open_.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = open_.select(
        "k", F.coalesce("source", F.lit("")).alias("source"), "ord", F.col("clock").cast("double").alias("clock"),
        F.transform("r", lambda x: x["form"]).alias("form"), F.transform("r", lambda x: x["utc_s"]).alias("utc"),
    ).repartitionByRange(parts, "source", "ord", "k").sortWithinPartitions("source", "ord", "k")
    ordered = ordered.withColumn("pid", F.spark_partition_id()).checkpoint()
    tables = ordered.mapInPandas(_stretches, "pid int, source string, c00 double, c01 double, c10 double, c11 double, f0 double, f1 double, l0 double, l1 double")
    # only a source that crosses a border needs fixed ends: at most two per partition
    edges = tables.groupBy("source").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("source")
    fixed = _border_states(tables.join(edges, "source").collect())
    return ordered.mapInPandas(_solver(fixed), "k long, utc_s long")


def instants(df: DataFrame, key: str, value: str, zone: Column, order: Column, source: str | None = None, clock: Column | None = None) -> DataFrame:
    """(key, utc_s) of each value that names a time; key must be a unique bigint.

    `order` is 'dmy' or 'mdy' where the source's date order is stated and null where it
    is not; the latter are chosen along their source's chain in order of `clock`
    (seconds; without it, of key).  Values without a reading give no row.
    """
    read = df.select(
        F.col(key).cast("long").alias("k"), F.col(value).cast("string").alias("v"), zone.alias("z"), order.alias("o"),
        (F.col(source).cast("string") if source else F.lit("")).alias("source"),
        (clock if clock is not None else F.lit(None)).cast("long").alias("clock"),
    )
    stated = with_readings(read.where(F.col("o").isNotNull()), F.col("v"), F.col("z"), "r")
    fits = F.filter("r", lambda x: (x["form"] == "fixed") | (x["form"] == F.col("o")))
    settled = stated.select("k", F.inline(fits)).select("k", "utc_s")
    unsettled = read.where(F.col("o").isNull())
    if not unsettled.isEmpty():
        chained = with_readings(unsettled, F.col("v"), F.col("z"), "r").where(F.size("r") > 0).withColumn("ord", F.coalesce("clock", F.col("k")))
        settled = settled.unionByName(_by_chain(chained))
    return settled.select(F.col("k").alias(key), "utc_s")
