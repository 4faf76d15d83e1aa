"""Operators on whole sets: survivors, near copies, packing, mixing; and the SQL checks."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lacquer.llm import mixing, nearcopies, packing, queries, survivors
from lacquer.llm.tokens import token_count


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(name, against_sql):
    against_sql(queries.QUERIES[name], queries.ORACLE_SQL[name])


@pytest.mark.parametrize("name", ["p1_found", "p1_text", "p2_found", "p2_merged", "p3_found", "p7_found", "p8_usage", "p9_shares", "p10_sources"])
def test_runs(name, spark, sf_dir):
    assert queries.QUERIES[name](spark, sf_dir).count() > 0


def test_whole_tables_in_clean_form(spark, sf_dir):
    """p1_main, p4_clean and p7_form: a row per record, without just what the found queries list."""
    table = lambda t: {r["row_id"]: r for r in spark.read.parquet(f"{sf_dir}/{t}.parquet").collect()}
    news, records = table("news_articles"), table("objective_records")

    def without(text, drop):
        return None if text is None else "\n".join(x for n, x in enumerate(text.split("\n"), 1) if n not in drop)

    lines = Counter()
    for r in queries.p1_found(spark, sf_dir).collect():
        lines[r["tbl"], r["row_id"], r["line_no"]] += 1
    got = {(r["tbl"], r["row_id"]): r["main_body"] for r in queries.p1_main(spark, sf_dir).collect()}
    texts = {("news_articles", k): r["body"] for k, r in news.items()} | {("objective_records", k): r["raw_text"] for k, r in records.items()}
    drop = {k: {n for *at, n in lines if tuple(at) == k} for k in texts}
    assert lines and got == {k: without(t, drop[k]) for k, t in texts.items()}
    found = {(r["row_id"], r["line_no"]) for r in queries.p4_found(spark, sf_dir).collect()}
    got = {r["row_id"]: r["clean_text"] for r in queries.p4_clean(spark, sf_dir).collect()}
    assert found and got == {k: without(r["body"], {n for i, n in found if i == k}) for k, r in news.items()}
    found = {(r["row_id"], r["field_name"]) for r in queries.p7_found(spark, sf_dir).collect()}
    got = {r["row_id"]: r for r in queries.p7_form(spark, sf_dir).collect()}
    fields = ("title", "raw_text", "company_name")
    assert found == {(k, f) for k, r in records.items() for f in fields if got[k][f] != r[f]} and set(got) == set(records)


# survivors


def test_votes_and_order(spark):
    rows = [
        (1, "c", "tier2", "A ", "[]"), (2, "c", "tier2", "a", '["u"]'), (3, "c", "tier1", "B", '["u","u"," "]'), (4, "c", None, "", '["u","w"]'),
        (5, "d", "tier1", "alone", "x"), (6, None, "tier1", "n", "{"), (7, None, "tier1", "n", "[1"),
    ]
    df = spark.createDataFrame(rows, "row_id long, g string, tier string, name string, urls string").withColumn("value", F.lit(0)).withColumn("n", F.lit(0))
    urls = survivors.url_count(F.col("urls"))
    fields = {"name": (survivors.not_blank(F.col("name")), F.lit(0)), "urls": (urls > 0, urls)}
    order = F.struct(survivors.tier_rank(F.col("tier")).alias("t"), (-F.col("row_id")).alias("i"))
    weight = survivors.record_weight(F.col("tier"), F.lit(None).cast("date"), F.lit("2026-01-01").cast("date"))
    long = survivors.long_rows(df, F.col("g"), "row_id", weight, order, fields)
    best = {(r["g"], r["field_name"]): r["r"] for r in survivors.supplying_rows(long, ["name", "urls"]).collect()}
    assert best == {("c", "name"): 3, ("c", "urls"): 4, (None, "name"): 6}
    merged = {r["g"]: (r["name"], r["urls"]) for r in survivors.voted_records(long, ["name", "urls"]).collect()}
    assert merged["c"][0] == "A " and merged[None] == ("n", None)  # two of tier2 outvote one of tier1
    strict = {r["g"]: (r["name"], r["urls"]) for r in survivors.voted_records(long, ["name", "urls"], strict=True).collect()}
    assert strict["c"] == ("B", '["u","w"]') and strict[None] == ("n", None)
    assert survivors.supplying_rows(long.limit(0), ["name"]).count() == 0


# near copies


def shingles(title, text, k):
    w = re.findall(r"[^\W_]+", f"{title or ''}\n{re.sub('<[^>]*>', ' ', text or '')}".lower())
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def test_near_copies_as_by_brute_force(spark):
    rng = random.Random(5)
    words = [f"từ{i}" for i in range(300)]
    rows = []
    for group in range(40):
        base = rng.choices(words, k=rng.randrange(30, 160))
        for version in range(rng.randrange(1, 6)):
            w = list(base)
            for _ in range(rng.randrange(0, 6) if version else 0):
                w[rng.randrange(len(w))] = rng.choice(words)
            rows.append((len(rows), None if group % 7 == 0 else " ".join(w[:5]), ("<p>" if version % 2 else "") + " ".join(w[5:])))
    rows += [(1000, None, None), (1001, "", ""), (1002, "một", None)]
    df = spark.createDataFrame(rows, "row_id long, title string, text string").withColumn("id", F.lit(1)).repartition(3)
    members, links = nearcopies.near_copies(df, "row_id", "title", "text", words=3, threshold=0.6)
    got = {tuple(r) for r in nearcopies.all_pairs(members, links).collect()}
    sets = {k: shingles(t, x, 3) for k, t, x in rows}
    known = sorted(k for k in sets if sets[k])
    want = {(a, b) for i, a in enumerate(known) for b in known[i + 1 :] if len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b])}
    assert got <= want and len(got) >= 0.98 * len(want)
    assert 1000 not in {r["id"] for r in members.collect()}
    members, links = nearcopies.near_copies(df.limit(0), "row_id", "title", "text")
    assert members.count() == 0 and links.count() == 0


def test_recall_on_records(spark):
    """Against brute force over all pairs of the smallest tables."""
    sf_dir = "/root/testdata/sf0.001"
    df = spark.read.parquet(f"{sf_dir}/objective_records.parquet")
    from lacquer.llm import mainbody

    df, drop = mainbody.line_dropper(df, "row_id", "raw_text", "source", "context")
    sets = {}
    for r in df.select("row_id", "title", "raw_text", "context").collect():
        w = nearcopies.words_of(r["title"], r["raw_text"], drop, r["context"])
        if len(w) >= 80:
            sets[r["row_id"]] = frozenset(zip(w, w[1:], w[2:]))
    known = sorted(sets)
    want = {(a, b) for i, a in enumerate(known) for b in known[i + 1 :] if len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b])}
    got = {tuple(r) for r in queries.p5_found(spark, sf_dir).collect()}
    assert len(got & want) >= 0.97 * len(want) and len(got - want) <= 0.01 * len(want)


def test_regions_over_batches_and_borders():
    """Every pair of a region comes out as a pair or within the blocks given out, wherever batches end."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.RandomState(1)
    key = np.sort(rng.choice([5, 6, (1 << 16) + 1, (1 << 16) + 2, 7 << 16, 9 << 16, (9 << 16) + 3], 900, p=[0.5, 0.2, 0.005, 0.005, 0.09, 0.1, 0.1]))
    ids = rng.permutation(900)
    batch = pa.RecordBatch.from_pydict({"key": pa.array(key), "id": pa.array(ids), "sketch": pa.array([bytes(nearcopies.SKETCH)] * 900)})
    inside = {(min(a, b), max(a, b)) for k in set(key) for a in ids[key == k] for b in ids[key == k] if a != b}
    small = [p for p in set(key >> 16) if (key >> 16 == p).sum() <= nearcopies.SMALL]
    inside |= {(min(a, b), max(a, b)) for p in small for a in ids[key >> 16 == p] for b in ids[key >> 16 == p] if a != b}
    for held, most, cut in ((1 << 18, 2048, 300), (200, 40, 60), (1, 7, 33)):
        batches = iter([batch.slice(at, cut) for at in range(0, 900, cut)])
        pairs, blocks = set(), {}
        for out in nearcopies._regions(30, most, held)(batches):
            for r in out.to_pylist():
                if r["block"] is None:
                    pairs.add((r["a"], r["b"]))
                else:
                    blocks.setdefault(r["key"], []).append(np.frombuffer(r["block"]["ids"], np.int64))
                    assert r["rows"] == len(blocks[r["key"]][-1]) <= most
        for k, parts in blocks.items():
            x = np.concatenate(parts)
            if k >= 0 or len(x) <= nearcopies.SMALL:
                pairs |= {(min(a, b), max(a, b)) for a in x for b in x if a != b}
        assert pairs == inside


def crowd(n, size, keep, seed=3):
    """n shingle sets, each a share `keep` of one template and else its own; (values, starts), and which shingles are kept."""
    import numpy as np

    rng = np.random.RandomState(seed)
    base = rng.randint(0, 2**63, size, np.uint64)
    kept = rng.rand(n, size) < keep
    new = rng.randint(0, 2**63, (n, size), np.uint64)
    values = np.sort(np.where(kept, base, new) * np.uint64(0x9E3779B97F4A7C15), axis=1)
    return values.ravel(), np.arange(n + 1) * size, kept


def signed_rows(spark, values, starts):
    keys, sketches = nearcopies.signatures(values, starts)
    return spark.createDataFrame([(i, keys[i].tolist(), bytearray(sketches[i].tobytes())) for i in range(len(starts) - 1)], "id long, keys array<long>, sketch binary")


@pytest.mark.parametrize("n, jaccard", [(100, 0.625), (100, 0.68), (400, 0.8), (1500, 0.68), (2500, 0.625)])
def test_recall_among_records_of_one_template(spark, n, jaccard):
    """All pairs of a crowd at about one similarity: as many are found in thousands as in a hundred."""
    import numpy as np

    values, starts, kept = crowd(n, 160, (2 * jaccard / (1 + jaccard)) ** 0.5)
    pairs = nearcopies.forest_candidates(signed_rows(spark, values, starts), 0.6).toPandas()
    found = np.zeros((n, n), bool)
    found[pairs["a"], pairs["b"]] = True
    assert len(pairs) == found.sum() and (pairs["a"] < pairs["b"]).all()
    both = kept.astype(np.float32) @ kept.T.astype(np.float32)
    true = np.triu(both / (320 - both) >= 0.6, 1)
    assert true.sum() > 0.3 * n * (n - 1) / 2 and (found & true).sum() >= 0.98 * true.sum()


def test_no_task_holds_a_crowd(spark, monkeypatch):
    """A region of thousands comes out of the sorted rows as bounded blocks, from several partitions."""
    values, starts, _ = crowd(3000, 150, 1.0)
    rows = signed_rows(spark, values, starts).select(F.explode("keys").alias("key"), "id", "sketch").repartitionByRange(8, "key", "id").sortWithinPartitions("key")
    met = rows.mapInArrow(nearcopies._regions(30, nearcopies.BLOCK, nearcopies.HELD_ROWS), nearcopies._MET_SQL).where("key >= 0").select("key", "rows", F.spark_partition_id().alias("p"))
    got = met.collect()
    assert max(r["rows"] for r in got) <= nearcopies.BLOCK and sum(r["rows"] for r in got) == 3000 * nearcopies.TREES and len({r["p"] for r in got}) == 8


def test_unrelated_long_sets_share_nothing():
    """Distinct shingles stay distinct in the check, over sets of many thousand."""
    import numpy as np

    rng = np.random.RandomState(6)
    a, b = (rng.randint(0, 2**63, 20_000, np.uint64) * np.uint64(2) for _ in range(2))
    assert nearcopies._jaccard(nearcopies._packed(a), nearcopies._packed(b)) == 0
    assert len(nearcopies._unpacked(nearcopies._packed(a))) == len(a)


def test_no_wanted_text_is_left_out(spark, monkeypatch):
    """The bitmap keeps every wanted id, however full it is."""
    df, wanted = spark.range(20_000).withColumn("part", F.lit("x")), spark.range(0, 20_000, 7)
    kept = nearcopies._mostly_in(df, wanted)
    assert kept.columns == df.columns and kept.count() < 3_200 and kept.join(wanted, "id", "left_semi").count() == wanted.count()
    monkeypatch.setattr(nearcopies, "FILTER_BITS", 6)
    assert nearcopies._mostly_in(df, wanted).join(wanted, "id", "left_semi").count() == wanted.count()
    assert nearcopies._mostly_in(df, wanted.limit(0)).count() == 0


def test_shared_values_are_counted(spark):
    values, starts, _ = crowd(40, 100, 0.8)
    keys, sketches = nearcopies.signatures(values, starts)
    s = signed_rows(spark, values, starts)
    pairs = s.select(*[F.col(c).alias(f"{c}_a") for c in s.columns]).join(s.select(*[F.col(c).alias(f"{c}_b") for c in s.columns]), F.col("id_a") < F.col("id_b"))
    got = pairs.select("id_a", "id_b", nearcopies.shared_values("keys_a", "sketch_a", "keys_b", "sketch_b").alias("n")).collect()
    part = lambda i, d: keys[i] >> (16 * d) & 0xFFFF
    assert len(got) == 780 and all(r["n"] == sum((part(r["id_a"], d) == part(r["id_b"], d)).sum() for d in range(nearcopies.DEPTH)) + (sketches[r["id_a"]] == sketches[r["id_b"]]).sum() for r in got)


def test_large_regions_are_compared_in_blocks(spark, monkeypatch):
    """The same pairs whether a task compares a region or its blocks are spread."""
    values, starts, _ = crowd(300, 60, 0.9, seed=4)
    reps = signed_rows(spark, values, starts)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        found = []
        for block in (2048, 16, 5):
            monkeypatch.setattr(nearcopies, "BLOCK", block)
            found.append(sorted(tuple(r) for r in nearcopies.forest_candidates(reps, 0.6).collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(found[0]) > 10_000 and found[0] == found[1] == found[2]


# packing and mixing


@pytest.mark.parametrize("capacity", [64, 1000])
def test_packing(spark, capacity):
    rng = random.Random(1)
    sizes = [int(rng.lognormvariate(4, 1)) for _ in range(3000)] + [0, None, 5 * capacity, 5 * capacity + 1] + [capacity // 2 + 1] * 1500
    df = spark.createDataFrame(list(enumerate(sizes)), "doc_id long, tokens int").withColumn("n", F.lit(1)).withColumn("len", F.lit(1))
    rows = packing.pack(df, "doc_id", "tokens", capacity).collect()
    used, parts = Counter(), Counter()
    for r in rows:
        used[r["container"]] += r["tokens"]
        parts[r["doc_id"]] += r["tokens"]
    assert max(used.values()) <= capacity and set(used) == set(range(len(used)))
    assert parts == Counter({k: n for k, n in enumerate(sizes) if n})
    assert len({(r["doc_id"], r["part"]) for r in rows}) == len(rows) == sum(-(-n // capacity) for n in sizes if n)
    best = max(sum(n for n in sizes if n) / capacity, sum(r["tokens"] * 2 > capacity for r in rows))  # two of these never share one
    assert len(used) <= 1.06 * best + 2
    assert packing.pack(df.limit(0), "doc_id", "tokens", capacity).count() == 0


def test_buckets_have_least_padding():
    import itertools

    histogram = {3: 10, 4: 1, 9: 5, 10: 7, 30: 2, 31: 1, 50: 4}
    padding = lambda ends: sum(c * (min(e for e in ends if e >= x) - x) for x, c in histogram.items())
    for k in (1, 2, 3, 4):
        best = min(padding((*e, 50)) for e in itertools.combinations(sorted(histogram)[:-1], k - 1))
        got = packing.length_buckets(histogram, k)
        assert len(got) <= k and padding(got) == best
    assert packing.length_buckets({}) == []


def test_buckets_of_many_lengths():
    """As exact over thousands of lengths as the plain quadratic programme."""
    import numpy as np

    rng = np.random.RandomState(2)
    histogram = {int(x): int(c) for x, c in zip(rng.choice(np.arange(1, 4000), 700, replace=False), rng.randint(1, 90, 700))}
    x = np.array(sorted(histogram))
    n, w = np.cumsum([0, *(histogram[v] for v in x)]), np.cumsum([0, *(histogram[v] * v for v in x)])
    best = np.array([0, *(x * n[1:] - w[1:])], float)
    for k in (2, 3, 4, 5):
        best = np.array([0, *(min(best[i] + x[j - 1] * (n[j] - n[i]) - (w[j] - w[i]) for i in range(j)) for j in range(1, len(x) + 1))])
        ends = np.array(packing.length_buckets(histogram, k))
        assert len(ends) == k and sum(histogram[v] * (ends[np.searchsorted(ends, v)] - v) for v in x) == best[-1]


def test_buckets_decide_the_batches():
    """First-step batches keep to their bucket; other buckets give another plan; the second step is never behind best-fit decreasing."""
    rng = random.Random(4)
    histogram = Counter(min(1000, int(rng.lognormvariate(5, 1)) + 1) for _ in range(20_000))
    ends = packing.length_buckets(histogram)
    for low, high, batches in zip([0, *ends], ends, packing.bucket_batches(histogram, 1000, ends)):
        assert all(low < x <= high for x in packing.lengths_of(batches)) and all(0 <= room < 1000 for _, _, room in batches)
    plan, containers = packing.plan_containers(histogram, 1000)
    assert packing.plan_containers(histogram, 1000, ends[3::4])[0] != plan != packing.plan_containers(histogram, 1000, [1000])[0]
    assert containers <= sum(b[0] for b in packing.fill(histogram, 1000))
    held = Counter()
    for length, _, number, _ in plan:
        held[length] += number
    assert held == histogram


def test_mixing(spark):
    rng = random.Random(2)
    rows = [(k, rng.choices(["big", "small", "other", None], [8, 1, 1, 1])[0], rng.choice([0, 1, 5, 50, 200])) for k in range(20_000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, tokens int").withColumn("k", F.lit(1)).withColumn("h", F.lit(1))
    targets = spark.createDataFrame([("big", 0.7, 2), ("small", 0.3, 3)], "source string, target_share double, max_repeats int")
    chosen, report = mixing.mix(df, "doc_id", "source", "tokens", targets)
    got = {r["source"]: r for r in report.collect()}
    assert abs(got["small"]["actual_share"] - 0.3) < 0.002 and abs(got["big"]["actual_share"] - 0.7) < 0.002
    assert got["small"]["most_repeats"] == 3 and got["big"]["most_repeats"] <= 2
    total = sum(r["tokens"] * r["copies"] for r in chosen.collect())
    assert total == got["small"]["tokens"] + got["big"]["tokens"]
    assert mixing.mix(df.limit(0), "doc_id", "source", "tokens", targets)[0].count() == 0
    assert mixing.mix(df, "doc_id", "source", "tokens", targets.limit(0))[0].count() == 0


def test_token_counts(spark):
    df = spark.createDataFrame([("Xin chào",), ("",), (None,), ("a" * 250_000,)], "t string")
    n = [r[0] for r in df.select(token_count(F.col("t"))).collect()]
    assert n[0] > 0 and n[1] == n[2] == 0 and n[3] > 1000
