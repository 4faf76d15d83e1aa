"""Filling fixed-capacity containers with texts of varying length.

Method: the global histogram of lengths (at most `capacity` rows, whatever the number
of texts) goes to the driver.  Dynamic programming over the whole histogram chooses the
length buckets of least padding, and token-budget batches form inside each bucket.  In
a second step the batches that are not full, and as many full ones of the shortest
buckets as save containers, are taken apart and packed best-fit decreasing.  The plan is
a short list of slot intervals per length; each text finds its container by its rank
among texts of its length, so nothing is sorted globally and no text is moved twice.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Buckets of the dynamic programme, ranking salts, steps in which full batches are tried apart.
BUCKETS, SALTS, STEPS = 32, 64, 16
#: A batch is full if its room is at most this share of the capacity.
ROOM = 1 / 256


def length_buckets(histogram: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """Upper bounds of at most `buckets` length buckets with the least total padding.

    Exact over all distinct lengths.  The padding of a bucket from boundary i to j is
    top[j] * (n[j] - n[i]) - (w[j] - w[i]): for each i a line in top[j], with slopes that
    fall as i grows, so the best i is walked along the lower hull and a round takes time
    in proportion to the lengths.  An empty histogram has no buckets.
    """
    lengths = sorted(histogram)
    if not lengths:
        return []
    n, w = [0], [0]
    for x in lengths:
        n.append(n[-1] + histogram[x])
        w.append(w[-1] + x * histogram[x])
    size = len(lengths)
    best = [0] + [lengths[j - 1] * n[j] - w[j] for j in range(1, size + 1)]  # one bucket
    came = []
    for _ in range(min(buckets, size) - 1):
        hull: list[int] = []  # boundaries i whose line is lowest somewhere
        line = [best[i] + w[i] for i in range(size + 1)]  # at slope -n[i]
        head, after, back = 0, best[:], [-1] * (size + 1)
        for j in range(2, size + 1):
            i = j - 1
            while len(hull) - head >= 2:  # the last line is needless if the new one passes it first
                p, q = hull[-2], hull[-1]
                if (line[i] - line[p]) * (n[q] - n[p]) <= (line[q] - line[p]) * (n[i] - n[p]):
                    hull.pop()
                else:
                    break
            hull.append(i)
            x = lengths[j - 1]
            while len(hull) - head >= 2 and line[hull[head + 1]] - x * n[hull[head + 1]] <= line[hull[head]] - x * n[hull[head]]:
                head += 1
            i = hull[head]
            padding = x * n[j] - w[j] + line[i] - x * n[i]
            if padding < after[j]:
                after[j], back[j] = padding, i
        came.append(back)
        best = after
    ends, j = [], size
    for back in reversed(came):
        if back[j] >= 0:
            ends.append(j)
            j = back[j]
    return sorted(lengths[e - 1] for e in [*ends, j])


#: Alike containers: how many, what each holds as nested (length, rest), and the room left in each.
Batch = tuple[int, tuple, int]


def fill(histogram: dict[int, int], capacity: int) -> list[Batch]:
    """Best-fit decreasing over a histogram, alike containers filled together.

    The work depends on the distinct lengths, not on the number of texts.
    """
    rooms: list[int] = []  # distinct rooms left, ascending
    groups: dict[int, list[tuple[int, tuple]]] = defaultdict(list)

    def leave(room: int, number: int, content: tuple) -> None:
        if not groups[room]:
            insort(rooms, room)
        groups[room].append((number, content))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            i = bisect_left(rooms, length)
            if i == len(rooms):
                break
            room = rooms[i]
            number, content = groups[room].pop()
            if not groups[room]:
                rooms.pop(i)
            use = min(left, number)
            left -= use
            if number > use:
                leave(room, number - use, content)
            leave(room - length, use, (length, content))
        each = capacity // length
        for many, number in ((each, left // each), (left % each, 1)):  # new containers of this length alone
            if many and number:
                content: tuple = ()
                for _ in range(many):
                    content = (length, content)
                leave(capacity - many * length, number, content)
    return [(number, content, room) for room, held in groups.items() for number, content in held]


def lengths_of(batches: list[Batch]) -> Counter:
    """Histogram of what the batches hold."""
    out: Counter = Counter()
    for number, content, _ in batches:
        while content:
            out[content[0]] += number
            content = content[1]
    return out


def bucket_batches(histogram: dict[int, int], capacity: int, ends: list[int]) -> list[list[Batch]]:
    """First step: batches of the token budget formed inside each bucket alone, shortest bucket first."""
    edges = [0, *ends]
    return [fill({x: c for x, c in histogram.items() if low < x <= high}, capacity) for low, high in zip(edges, edges[1:])]


def plan_containers(histogram: dict[int, int], capacity: int, ends: list[int] | None = None) -> tuple[list[tuple[int, int, int, int]], int]:
    """(slots, containers): slots are (length, first rank, number, first container).

    The texts of one length with ranks first..first+number-1 go to consecutive
    containers.  `ends` are the buckets, by default those of least padding.
    """
    buckets = bucket_batches(histogram, capacity, length_buckets(histogram) if ends is None else ends)
    batches = [b for bucket in buckets for b in bucket]
    full, open_ = ([b for b in batches if (b[2] <= capacity * ROOM) == is_full] for is_full in (True, False))
    rest, total = lengths_of(open_), sum(b[0] for b in full)
    best = None
    tried = sorted({total * k // STEPS for k in range(STEPS + 1)})
    for apart in tried:  # all apart is best-fit decreasing over everything, so the plan is never behind it
        pool, kept, left = Counter(rest), [], apart
        for number, content, room in full:  # shortest bucket first
            use = min(left, number)
            left -= use
            if use:
                pool.update(lengths_of([(use, content, room)]))
            if number > use:
                kept.append((number - use, content, room))
        packed = kept + fill(pool, capacity)
        containers = sum(b[0] for b in packed)
        if best is None or containers < best[0]:
            best = (containers, packed)
    taken: dict[int, int] = defaultdict(int)
    slots, opened = [], 0
    for number, content, _ in best[1]:
        while content:
            length, content = content
            slots.append((length, taken[length], number, opened))
            taken[length] += number
        opened += number
    return slots, opened


def pack(sizes: DataFrame, key: str, size: str, capacity: int) -> DataFrame:
    """(container, key, part, tokens): every text of at least one token in a container.

    A text that exceeds the capacity is cut into full containers and a remainder
    (part 0, 1, ...); any other text is one part.  key must be unique.  Null and zero
    sizes take no room and give no row.
    """
    base = sizes.select(F.col(key).alias("k"), F.col(size).cast("long").alias("n")).where("n > 0")
    parts = F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / capacity).cast("int") - 1))
    pieces = base.select("k", "n", parts.alias("part"))
    pieces = pieces.select("k", "part", F.least(F.lit(capacity), F.col("n") - F.col("part") * F.lit(capacity)).cast("int").alias("len"))
    pieces = pieces.withColumn("salt", F.pmod(F.xxhash64("k", "part"), F.lit(SALTS)).cast("int"))
    counts = pieces.groupBy("len", "salt").agg(F.count(F.lit(1)).alias("c"))
    histogram: dict[int, int] = {r["len"]: r["c"] for r in counts.groupBy("len").agg(F.sum("c").alias("c")).collect()}
    slots, _ = plan_containers(histogram, capacity)
    before = F.sum("c").over(Window.partitionBy("len").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("len", "salt", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("len", "salt").orderBy("k", "part")) - 1
    ranked = pieces.withColumn("within", within).join(offsets, ["len", "salt"]).withColumn("rank", F.col("within") + F.col("before"))
    table: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for length in histogram:
        table[length] = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    by_length: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for length, first, _, container in slots:
        by_length[length].append((first, container))
    for length, pairs in by_length.items():
        pairs.sort()
        table[length] = (np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64))

    @F.pandas_udf(T.LongType())
    def container_of(length: pd.Series, rank: pd.Series) -> pd.Series:
        out = np.zeros(len(length), np.int64)
        lengths, ranks = length.to_numpy(), rank.to_numpy()
        for n in np.unique(lengths):
            at = np.flatnonzero(lengths == n)
            firsts, containers = table[int(n)]
            i = np.searchsorted(firsts, ranks[at], "right") - 1
            out[at] = containers[i] + (ranks[at] - firsts[i])
        return pd.Series(out)

    return ranked.select(container_of("len", "rank").alias("container"), F.col("k").alias(key), "part", F.col("len").alias("tokens"))


def usage(packed: DataFrame, capacity: int) -> DataFrame:
    """One row: containers, tokens, share of the room that is used, fewest containers possible."""
    t = packed.agg(F.coalesce(F.max("container") + 1, F.lit(0)).alias("containers"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"))
    room = F.col("containers") * capacity
    return t.select("containers", "tokens", F.when(room > 0, F.round(F.col("tokens") / room, 6)).alias("used"), F.ceil(F.col("tokens") / capacity).alias("fewest"))
