"""Near-duplicate records by an LSH forest over word shingles.

Method: every distinct text gets min-hash values; a tree is one order of them, with
values of its own.  Rows are range-partitioned and sorted by tree and signature, so the
neighbours of a row are those with the longest common prefix.  How deep a prefix must
agree depends on the region: two values where few rows share them, three elsewhere.
All rows of a region are compared, however many; a region that is large, or that a
partition's border may cut, is given out in blocks, and its pairs of blocks are spread
over tasks.  So neither recall nor the longest task depends on a region's size.
Neighbours whose short sketches agree enough become candidates; they are looked at once
more by all their min-hash values and then checked on their shingle sets.

Going deeper than three values in large regions would not do: a pair of Jaccard 0.6
shares five values of a tree with probability 0.08, so some 90 trees would be needed
for the recall of 20, and rows of a crowd that are 0.5 alike would meet as often.

Exact copies meet first: texts with one shingle set are one class, and only class
representatives enter the forest.  Between representatives there is one row per link.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textform import consistent_all

#: Trees of the forest, min-hash values of 16 bits that a tree's key has, bytes of the sketch.
TREES, DEPTH, SKETCH = 20, 3, 40
#: Rows up to which two shared values make a region, rows compared at a time, rows of a
#: region that one task compares, and sorted rows held at a time.
SMALL, PART, BLOCK, HELD_ROWS = 16, 256, 2048, 1 << 18
#: Bits of the bitmap that keeps texts without candidates out of the last shuffle: 4 MB.
FILTER_BITS = 25
#: Title, text and the drop_lines context of a record -> numbers of lines left out.
Dropper = Callable[[str, "str | None", object], list[int]]
WORDS, THRESHOLD, MIN_WORDS = 5, 0.8, 1
_WORD = re.compile(r"\w+")
_TAG = re.compile(r"<[^>]*>")
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xBF58476D1CE4E5B9)]
_SEEDS = np.random.RandomState(7).randint(1, 2**32 - 1, size=TREES * DEPTH + SKETCH, dtype=np.uint64).astype(np.uint32) | np.uint32(1)


def own_text(title: str, text: str, drop_lines: Dropper, context: object = None) -> str:
    """Title and text, both in consistent form, in lower case, without the page's lines, then without tags."""
    dropped = set(drop_lines(text, title, context))
    body = "\n".join(x for n, x in enumerate(text.split("\n"), 1) if n not in dropped) if dropped else text
    if "<" in body:
        body = _TAG.sub(" ", body)
    return f"{title}\n{body}".lower()


def words_of(title: str | None, text: str | None, drop_lines: Dropper, context: object = None) -> list[str]:
    """The words of a record: runs of letters and digits."""
    return _WORD.findall(own_text(*consistent_all([title or "", text or ""]), drop_lines, context).replace("_", " "))


_LETTER = np.zeros(0x110000, bool)
_LETTER[:0x40000] = [chr(c).isalnum() for c in range(0x40000)]
_POWERS = np.cumprod(np.full(4096, _MIX[0], np.uint64))


def word_numbers(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, sizes): a 64-bit number for each word of the texts, and words per text.

    Words are found and hashed in whole batches: a polynomial over the characters of
    each run of letters and digits.  The numbers are the same in every process.
    """
    sizes = np.zeros(len(texts), np.int64)
    codes = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = _LETTER[codes]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edges = np.concatenate([[0], edges])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), sizes
    where = np.flatnonzero(inside)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(where)) - np.repeat(first, lengths)
    mixed = (codes[where].astype(np.uint64) + _MIX[1]) * _MIX[2]
    mixed ^= mixed >> np.uint64(31)
    numbers = np.add.reduceat(mixed * _POWERS[place % len(_POWERS)], first)
    numbers ^= numbers >> np.uint64(32)
    borders = np.cumsum([len(t) + 1 for t in texts])
    sizes += np.bincount(np.searchsorted(borders, starts, "right"), minlength=len(texts))[: len(texts)]
    return numbers * _MIX[3], sizes


def shingle_sets(numbers: np.ndarray, sizes: np.ndarray, words: int, min_words: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(values, starts): sorted distinct shingles of each text, one after the other.

    A text of fewer words than a shingle is one shingle; one of fewer than min_words
    has none.
    """
    short = np.flatnonzero((sizes < words) & (sizes > 0))
    h = np.zeros(len(numbers), np.uint64)
    for i in range(words):
        ahead = np.zeros(len(numbers), np.uint64)
        ahead[: max(len(numbers) - i, 0)] = numbers[i:]
        h = (h ^ (ahead + _MIX[1])) * _MIX[0]
        h ^= h >> np.uint64(29)
    h *= _MIX[3]
    h ^= h >> np.uint64(32)
    at = np.cumsum(sizes) - sizes
    for k in short:  # what follows is another text's
        own = np.uint64(0)
        for x in [*numbers[at[k] : at[k] + sizes[k]], *[np.uint64(0)] * (words - sizes[k])]:
            own = (own ^ (x + _MIX[1])) * _MIX[0]
            own ^= own >> np.uint64(29)
        own *= _MIX[3]
        h[at[k]] = own ^ (own >> np.uint64(32))
    sets = []
    for a, n in zip(at, sizes):
        x = np.sort(h[a : a + (max(n - words + 1, 1) if n >= max(min_words, 1) else 0)])
        sets.append(x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x)
    return np.concatenate([np.zeros(0, np.uint64), *sets]), np.cumsum([0, *map(len, sets)])


def signatures(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, sketches) per set: per tree a key of its number and its min-hash values, and a byte per value of the sketch."""
    n = len(starts) - 1
    low = np.zeros((n, len(_SEEDS)), np.uint32)
    short = (values >> np.uint64(32)).astype(np.uint32)
    for at in range(0, n, 256):  # a block's numbers stay in the cache
        to = min(at + 256, n)
        a, b = starts[at], starts[to]
        filled = np.flatnonzero(starts[at + 1 : to + 1] > starts[at:to])
        if not len(filled):
            continue
        cuts, x = starts[at:to][filled] - a, short[a:b]
        for k, seed in enumerate(_SEEDS):  # shingles are hashed already, so a product orders them at random
            low[at + filled, k] = np.minimum.reduceat(x * seed, cuts)
    low ^= low >> np.uint32(16)
    low *= np.uint32(0x85EBCA6B)
    top = (low >> np.uint32(16)).astype(np.int64)
    keys = np.repeat(np.arange(TREES, dtype=np.int64)[None], n, 0)
    for d in range(DEPTH):
        keys = keys << 16 | top[:, d : TREES * DEPTH : DEPTH]
    return keys, (top[:, TREES * DEPTH :] & 0xFF).astype(np.uint8)


_SIGNED = T.StructType([T.StructField("cls", T.BinaryType()), T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("sketch", T.BinaryType())])


#: Records whose words are held at a time.
HELD = 400


def _slices(columns: tuple[pd.Series, ...], drop_lines: Dropper, words: int, min_words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Shingle sets of a batch of titles, texts and contexts, some hundred records at a time."""
    for at in range(0, len(columns[0]), HELD):
        title, text = (consistent_all([x or "" for x in s[at : at + HELD]]) for s in columns[:2])
        texts = [own_text(h, x, drop_lines, c) for h, x, c in zip(title, text, columns[2][at : at + HELD])]
        yield shingle_sets(*word_numbers(texts), words, min_words)


def _signer(words: int, min_words: int, drop_lines: Dropper):
    @F.pandas_udf(_SIGNED)
    def sign(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for columns in batches:
            out = []
            for values, starts in _slices(columns, drop_lines, words, min_words):
                keys, sketches = signatures(values, starts)
                out += [(hashlib.md5(values[a:b].tobytes()).digest(), keys[i], sketches[i].tobytes()) if b > a else (None, None, None) for i, (a, b) in enumerate(zip(starts, starts[1:]))]
            yield pd.DataFrame(out, columns=["cls", "keys", "sketch"])

    return sign


def _packer(words: int, drop_lines: Dropper):
    @F.pandas_udf(T.BinaryType())
    def pack(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for columns in batches:
            yield pd.Series([_packed(v[a:b]) for v, s in _slices(columns, drop_lines, words, 1) for a, b in zip(s, s[1:])], dtype=object)

    return pack


def _packed(shingles: np.ndarray) -> bytes:
    """Shingles in 40 bits each: two of a pair's fall together once in some 40,000 pairs of 5,000 shingles."""
    top = np.unique(shingles >> np.uint64(24))
    return np.ascontiguousarray(top.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return wide.view("<u8").ravel()


def _jaccard(a: bytes, b: bytes) -> float:
    x, y = _unpacked(a), _unpacked(b)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([_jaccard(x, y) for x, y in zip(a, b)], dtype="float64")


def least_agreement(threshold: float, values: int = SKETCH) -> int:
    """How many of so many min-hash values a pair at the threshold shares but for one in two thousand."""
    return max(1, int(values * threshold - 3.3 * (values * threshold * (1 - threshold)) ** 0.5))


@F.pandas_udf(T.IntegerType())
def shared_values(keys_a: pd.Series, sketch_a: pd.Series, keys_b: pd.Series, sketch_b: pd.Series) -> pd.Series:
    """Equal min-hash values of two signatures, of the trees and of the sketch."""
    if not len(keys_a):
        return pd.Series([], dtype="int32")
    x, y = (np.stack(k.to_numpy()).astype(np.int64).view(np.uint16).reshape(len(k), TREES, 4)[:, :, :DEPTH] for k in (keys_a, keys_b))
    u, v = (np.frombuffer(b"".join(s), np.uint8).reshape(len(s), SKETCH) for s in (sketch_a, sketch_b))
    return pd.Series((x == y).sum((1, 2)) + (u == v).sum(1)).astype("int32")


def _alike(ids: np.ndarray, sketches: np.ndarray, others: np.ndarray | None, more: np.ndarray | None, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(smaller, larger) ids of pairs whose sketches agree enough, within a block or between two."""
    one = np.ascontiguousarray(sketches.T)
    two = one if others is None else np.ascontiguousarray(more.T)
    for at in range(0, one.shape[1], PART):  # parts bound the memory of the comparison
        for to in range(at if others is None else 0, two.shape[1], PART):
            x, y = one[:, at : at + PART, None], two[:, None, to : to + PART]
            same = np.zeros((x.shape[1], y.shape[2]), np.uint8)
            for k in range(SKETCH):
                same += (x[k] == y[k]).view(np.uint8)
            i, j = np.nonzero(same >= least)
            i, j = i + at, j + to
            if others is None:
                i, j = i[keep := i < j], j[keep]
            a, b = ids[i], (ids if others is None else others)[j]
            yield np.minimum(a, b), np.maximum(a, b)


#: Pairs, or blocks of regions to be compared with the region's other blocks: the key (below 0 for a prefix of two values), a number within it, rows.
_MET = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64()), ("no", pa.int64()), ("rows", pa.int32()), ("block", pa.struct([("ids", pa.binary()), ("sketches", pa.binary())]))])
_MET_SQL = "a long, b long, key long, no long, rows int, block struct<ids: binary, sketches: binary>"
_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _met(out: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    return np.unique(np.stack([np.concatenate([x[i] for x in out]) for i in (0, 1)], 1), axis=0) if out else np.zeros((0, 2), np.int64)


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of one value."""
    edges = np.flatnonzero(key[1:] != key[:-1]) + 1
    return np.concatenate([[0], edges]), np.concatenate([edges, [len(key)]])


def _regions(least: int, most: int, held: int):
    """Candidates among rows sorted by key, `held` rows at a time.

    Whole regions are compared at once.  The first and the last region of what is held
    may go on elsewhere, so they are given out in blocks, as regions of more than `most`
    rows are; so are small runs of two shared values there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32 if TaskContext.get() else 0

        def blocks(key: int, ids: np.ndarray, sketch: np.ndarray) -> Iterator[dict]:
            nonlocal number
            for at in range(0, len(ids), most):
                part = ids[at : at + most]
                yield {"key": int(key), "no": number, "rows": len(part), "block": {"ids": part.tobytes(), "sketches": sketch[at : at + most].tobytes()}}
                number += 1

        def compared(key: np.ndarray, ids: np.ndarray, sketch: np.ndarray) -> Iterator[pa.RecordBatch]:
            out, given = [], []
            starts, ends = _runs(key)
            starts2, ends2 = _runs(key >> 16)
            few = np.repeat(ends2 - starts2 <= SMALL, ends2 - starts2)
            inner = np.repeat((starts2 > 0) & (ends2 < len(key)), ends2 - starts2)
            end = np.repeat(ends, ends - starts)
            size = end - np.repeat(starts, ends - starts)
            # rows of the region that follow: of the run of two values where that is small, else of three
            unit = np.where(few & inner, np.repeat(ends2, ends2 - starts2), np.where(size <= SMALL, end, 0))
            unit[: ends[0]] = unit[starts[-1] :] = 0  # the outer regions are given out
            rest = unit - np.arange(len(key)) - 1
            for ahead in range(1, SMALL):  # all small regions at once
                i = np.flatnonzero(rest >= ahead)
                i = i[(sketch[i] == sketch[i + ahead]).sum(1) >= least]
                out.append((np.minimum(ids[i], ids[i + ahead]), np.maximum(ids[i], ids[i + ahead])))
            for k in sorted({0, len(starts) - 1, *np.flatnonzero(ends - starts > SMALL)}):
                a, b = starts[k], ends[k]
                if k in (0, len(starts) - 1) or b - a > most:
                    given += blocks(key[a], ids[a:b], sketch[a:b])
                else:
                    out += _alike(ids[a:b], sketch[a:b], None, None, least)
            for k in {0, len(starts2) - 1}:
                a, b = starts2[k], min(ends2[k], starts2[k] + SMALL + 1)
                given += blocks(-1 - int(key[a] >> 16), ids[a:b], sketch[a:b])
            if len(met := _met(out)):
                yield pa.RecordBatch.from_arrays([pa.array(met[:, 0]), pa.array(met[:, 1]), *(pa.nulls(len(met), f.type) for f in [*_MET][2:])], schema=_MET)
            for at in range(0, len(given), 64):
                yield pa.RecordBatch.from_pylist(given[at : at + 64], _MET)

        kept: list[list[np.ndarray]] = []
        for batch in batches:
            if len(batch):
                sketch = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8).reshape(len(batch), SKETCH)
                kept.append([*(batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("key", "id")), sketch])
            if sum(len(x[0]) for x in kept) >= held:
                yield from compared(*map(np.concatenate, zip(*kept)))
                kept = []
        if kept:
            yield from compared(*map(np.concatenate, zip(*kept)))

    return run


def _between(least: int):
    """Candidates of block pairs; a block alone is compared with itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def opened(block: dict) -> tuple[np.ndarray, np.ndarray]:
            return np.frombuffer(block["ids"], np.int64), np.frombuffer(block["sketches"], np.uint8).reshape(-1, SKETCH)

        for batch in batches:
            for row in batch.to_pylist():
                more = opened(row["other"]) if row["other"] else (None, None)
                pairs = _met(list(_alike(*opened(row["one"]), *more, least)))
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=_PAIR)

    return run


def forest_candidates(reps: DataFrame, threshold: float) -> DataFrame:
    """(a, b), a < b: pairs of representatives that meet in some tree; reps has id, keys, sketch."""
    least = least_agreement(threshold)
    rows = reps.select(F.explode("keys").alias("key"), "id", "sketch")
    ordered = rows.repartitionByRange("key", "id").sortWithinPartitions("key")
    met = ordered.mapInArrow(_regions(least, BLOCK, HELD_ROWS), _MET_SQL).checkpoint()
    near = met.where("block is null").select("a", "b")
    # A block goes to the pair it forms with each block of its region, so a region is spread over as many tasks as it has block pairs.
    blocks = met.where("block is not null").select("key", "no", "rows", "block")
    of_key = Window.partitionBy("key")
    places = blocks.select(
        "key", "no", (F.row_number().over(of_key.orderBy("no")) - 1).alias("i"), F.count(F.lit(1)).over(of_key).alias("many"), F.sum("rows").over(of_key).alias("total")
    ).where(F.col("key").between(0, 1 << 62) | (F.col("total") <= SMALL))
    placed = blocks.select("key", "no", "block").join(places, ["key", "no"]).select("key", "block", "i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("many") - 1)).alias("to"))
    cells = placed.groupBy("key", F.least("i", "to").alias("x"), F.greatest("i", "to").alias("y")).agg(F.array_agg("block").alias("both"))
    cells = cells.select(F.col("both")[0].alias("one"), F.try_element_at("both", F.lit(2)).alias("other"))
    return near.unionByName(cells.mapInArrow(_between(least), "a long, b long")).distinct()


def _mostly_in(df: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of df whose id is wanted, and some others, before their texts are shuffled.

    The ids' hashes are marked in a bitmap of 2^FILTER_BITS bits, which is what is
    broadcast whatever the number of ids: the more there are, the fewer rows are left
    out, and no wanted one ever is.
    """
    bit = F.pmod(F.xxhash64("id"), F.lit(1 << FILTER_BITS))
    part, position = F.bitmap_bucket_number(bit), F.bitmap_bit_position(bit)
    bitmaps = wanted.select(part.alias("__of"), position.alias("__in")).groupBy("__of").agg(F.bitmap_construct_agg("__in").alias("__bits"))
    byte = F.conv(F.hex(F.substring(F.col("__bits"), F.shiftright("__at", 3).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    marked = df.withColumns({"__part": part, "__at": position}).join(F.broadcast(bitmaps), F.col("__part") == F.col("__of"))
    return marked.where(F.getbit(byte, (F.col("__at") % 8).cast("int")) == 1).select(*df.columns)


def near_copies(
    df: DataFrame, key: str, title: str, text: str, words: int = WORDS, threshold: float = THRESHOLD, min_words: int = MIN_WORDS,
    drop_lines: Dropper = lambda text, title, context: [], context: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(members, links).

    members: (id, rep), one row per record of at least min_words words; copies of one
    shingle set share the smallest id as rep.  links: (a, b, similarity) between
    representatives whose shingle sets have a Jaccard similarity of at least threshold.
    Null titles and texts count as empty; key must be a unique bigint; `context` names
    the column that drop_lines gets beside text and title; other columns are not read.
    """
    base = df.select(F.col(key).cast("long").alias("id"), F.col(title).cast("string").alias("title"), F.col(text).cast("string").alias("text"), (F.col(context) if context else F.lit(None).cast("string")).alias("context"))
    # fewer characters than that cannot hold so many words
    long_enough = F.coalesce(F.length("title"), F.lit(0)) + F.coalesce(F.length("text"), F.lit(0)) >= 2 * min_words - 2
    signed = base.where(long_enough).select("id", _signer(words, min_words, drop_lines)("title", "text", "context").alias("s")).select("id", "s.cls", "s.keys", "s.sketch")
    signed = signed.where("cls is not null").checkpoint()
    classes = signed.groupBy("cls").agg(F.min(F.struct("id", "keys", "sketch")).alias("r")).select("cls", "r.id", "r.keys", "r.sketch")
    members = signed.select("id", "cls").join(classes.select("cls", F.col("id").alias("rep")), "cls").select("id", "rep")
    met = forest_candidates(classes.select("id", "keys", "sketch"), threshold)
    for side in ("a", "b"):
        met = met.join(classes.select(F.col("id").alias(side), F.col("keys").alias(f"keys_{side}"), F.col("sketch").alias(f"sketch_{side}")), side)
    alike = shared_values("keys_a", "sketch_a", "keys_b", "sketch_b") >= least_agreement(threshold, TREES * DEPTH + SKETCH)
    pairs = met.where(alike).select("a", "b").checkpoint()
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = _mostly_in(base, wanted).join(wanted, "id", "left_semi").select("id", _packer(words, drop_lines)("title", "text", "context").alias("set"))
    one = sets.select(F.col("id").alias("a"), F.col("set").alias("set_a"))
    other = sets.select(F.col("id").alias("b"), F.col("set").alias("set_b"))
    both = pairs.join(one, "a").join(other, "b").select("a", "b", similarity("set_a", "set_b").alias("similarity"))
    return members, both.where(F.col("similarity") >= threshold)


def all_pairs(members: DataFrame, links: DataFrame) -> DataFrame:
    """(id_a, id_b), id_a < id_b: every pair of records, copies of one class and linked classes."""
    m = lambda i: members.select(F.col("id").alias(f"id_{i}"), F.col("rep").alias(f"rep_{i}"))
    copies = m("a").join(m("b"), (F.col("rep_a") == F.col("rep_b")) & (F.col("id_a") < F.col("id_b"))).select("id_a", "id_b")
    linked = links.select("a", "b").join(m("a"), F.col("a") == F.col("rep_a")).join(m("b"), F.col("b") == F.col("rep_b"))
    linked = linked.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))
    return copies.unionByName(linked)
