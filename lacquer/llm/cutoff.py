"""Texts that stop before their end.

Method: intact texts are cut artificially, at their source's own limits or anywhere,
with and without a mark of omission; hashed logistic regression is trained on closing
characters, closing words, the closing line and length-to-limit features, and scores
every record.  Limits and closing lines are counted over all records in one pass; only
the training rows are a bounded sample (TRAIN_ROWS).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import repeated

#: Documented bound of the training sample, feature space, end of the text looked at by features.
TRAIN_ROWS, DIMENSIONS, TAIL = 12_000, 1 << 18, 600
#: A length is a limit of its source if that share of the source's texts has it.
LIMIT_SHARE, LIMIT_ROWS = 0.01, 4
#: Limits that are sent to every task (a source has at most 2 / LIMIT_SHARE); beyond, rows are joined with theirs.
SENT = 200_000
#: A closing line is common if that many texts end with its template.
COMMON_ROWS, COMMON_SHARE = 5, 3e-4
_OMISSION = re.compile(r"\s*(?:\[\s*(?:…|\.{3})\s*\]|\(\s*(?:…|\.{3})\s*\)|…|\.{3,})\s*$")
_ENDED = re.compile(r"[.!?…][\"”’»)\]]*$")
_SENTENCE = re.compile(r"(?<=[.!?…])[\"”’»)\]]*\s+")
_WORD = re.compile(r"[^\W_]+|[^\w\s]")
#: A last line that is one bracket, as credits are.
_BRACKETED = re.compile(r"^[(\[][^()\[\]]{3,80}[)\]]$")
_OPEN_TAG = re.compile(r"<[A-Za-z/!][^<>]*$")
_OPEN_ENTITY = re.compile(r"&(?:#?\w{0,8})$")

#: The steps from a line to its template.
_STEPS = tuple((re.compile(p, flags), to) for p, flags, to in (
    (r"https?://\S+", 0, "U"), (r"[0-9]+(?:[.,][0-9]+)*", 0, "0"), (r"\b[A-Z]{3,5}\b", re.A, "T"), (r"\s+", 0, " "),
))


def template(line: str) -> str:
    for pattern, to in _STEPS:
        line = pattern.sub(to, line)
    return line.strip()


def features(tail: str, limit: int, common: bool, whole_line: str, tag: bool) -> list[int]:
    """Hashed features of an end of text; limit: 0 none, 1 a byte limit, 2 a character limit of the source.

    whole_line is the last line and tag whether a tag is open, both of the whole text.
    """
    text = tail.rstrip()
    mark = _OMISSION.search(text)
    bare = text[: mark.start()].rstrip() if mark else text
    line = whole_line.strip()
    bracketed = not mark and bool(_BRACKETED.match(line))
    if bracketed:  # whose credit it is does not matter
        common, line = True, line[0] + line[1:].split(" ", 1)[0] + line[-1]
    fragment = _SENTENCE.split(bare.rsplit("\n", 1)[-1].strip())[-1]
    words = [] if bracketed else [w.lower() for w in _WORD.findall(template(fragment))]
    last = bare[-1:] if bare else ""
    kind = "letter" if last.isalpha() else "digit" if last.isdigit() else "lost" if last == "�" else last
    ended = bool(_ENDED.search(bare))
    own = "common" if common else "rare"
    shape = "bracketed" if bracketed else "digit." if re.search(r"\d\.$", bare) else "ended" if ended else kind
    names = [
        "bias", f"end {shape}", f"mark {bool(mark)}", f"limit {limit}", f"line {own}", f"{shape} {own}", f"{shape} mark {bool(mark)}",
        f"limit {limit} {shape}", f"mark {bool(mark)} {own}", f"words {min(len(words), 12)} {ended}", f"w1 {' '.join(words[-1:])}",
        f"w2 {' '.join(words[-2:])}", f"start {' '.join(words[:2])} {ended}", f"template {template(line) if common else ''}",
        f"tag {tag}", f"entity {bool(_OPEN_ENTITY.search(bare))}",
    ]
    return [zlib.crc32(n.encode()) % DIMENSIONS for n in names]


def _lengths(df: DataFrame, text: str, source: str) -> DataFrame:
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return df.withColumns({"__s": repeated.source_of(source), "__t": t, "__chars": F.length(t), "__bytes": F.octet_length(t)})


#: What is counted of a text: rows, lengths in bytes in steps of four (a cut inside a
#: character moves the length by up to three bytes), lengths in characters, closing templates.
_ROWS, _BYTES, _CHARS, _CLOSING = 0, 1, 2, 3


def _end_items(s: str, text: str) -> set[tuple[int, int]]:
    items = {(_ROWS, 0), (_CHARS, len(text)), (_BYTES, len(text.encode()) // 4)}
    if closing := template(text.rstrip().rsplit("\n", 1)[-1]):
        items.add((_CLOSING, repeated.number(closing)))
    return items


def end_counts(df: DataFrame, text: str, source: str) -> DataFrame:
    """(s, kind, at, n) over all texts that are not empty, in one pass; partial counts are merged."""
    schema = pa.schema([("s", pa.string()), ("kind", pa.int32()), ("at", pa.int64()), ("n", pa.int64())])
    return repeated.counted_items(df, source, text, schema, ["kind", "at"], _end_items, lambda x: x)


def source_limits(counts: DataFrame) -> DataFrame:
    """(s, kind, at): lengths at which a source's texts pile up: kind 2 in characters, 1 in bytes.  A source has at most 1/LIMIT_SHARE of each."""
    total = counts.where(F.col("kind") == _ROWS).select("s", F.col("n").alias("rows"))
    lengths = counts.where(F.col("kind").isin(_BYTES, _CHARS) & (F.col("n") >= LIMIT_ROWS)).join(total, "s")
    return lengths.where(F.col("n") >= F.col("rows") * LIMIT_SHARE).select("s", "kind", "at")


def common_closings(counts: DataFrame) -> tuple[int, frozenset[int]]:
    """(texts, hashes of templates of last lines that at least COMMON_ROWS and COMMON_SHARE of all texts end with).

    At most 1 / COMMON_SHARE templates.
    """
    texts = counts.where(F.col("kind") == _ROWS).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    closing = counts.where(F.col("kind") == _CLOSING).groupBy("at").agg(F.sum("n").alias("n"))
    return texts, frozenset(r["at"] for r in closing.where(F.col("n") >= max(COMMON_ROWS, texts * COMMON_SHARE)).collect())


#: What str.rstrip() takes off.
_BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def _stripped(text: Column) -> Column:
    return F.rtrim(text, F.lit(_BLANKS))


def _tag_open(text: Column) -> Column:
    """_OPEN_TAG over a whole text."""
    after = F.substring_index(text, "<", -1)
    return F.contains(text, F.lit("<")) & after.rlike("^[A-Za-z/!]") & ~F.contains(after, F.lit(">"))


def _end_features(text: str, limit: int, common: bool) -> list[int]:
    """features() of a whole text, without white space after it."""
    return features(text[-TAIL:], limit, common, text.rsplit("\n", 1)[-1], bool(_OPEN_TAG.search(text)))


def _cuts(limits: dict[str, list[tuple[int, int]]], common: frozenset[int]):
    """Rows of (k, label, features): each intact text as it is and cut."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            out = []
            for key, src, text in zip(part["k"], part["s"], part["t"]):
                rng = np.random.RandomState(zlib.crc32(str(key).encode()))
                known = limits.get(src, [])
                stripped = text.rstrip()
                final = stripped.rsplit("\n", 1)[-1].strip()
                closing = repeated.number(template(final)) in common or bool(_BRACKETED.match(final) and not _OMISSION.search(final))
                at = _at_limit(text, known)
                if not stripped or (at and not _ENDED.search(stripped)) or not (closing or _ENDED.search(stripped)) or _OMISSION.search(stripped) and not closing:
                    continue  # not known to be intact
                out.append((key, 0, _end_features(stripped, at, closing)))
                for _ in range(2):
                    fitting = [(k, x) for k, x in known if (x if k == 2 else x * 4) < len(text) - 1]
                    if fitting and rng.rand() < 0.5:
                        k, x = fitting[rng.randint(len(fitting))]
                        cut = text[:x] if k == 2 else text.encode()[: x * 4 + 2].decode("utf-8", "replace")
                    else:
                        k, cut = 0, text[: rng.randint(max(1, len(text) // 3), len(text) + 1)]
                    bare = cut.rstrip()
                    if not bare or bare == stripped:
                        continue
                    inside = bool(_ENDED.search(bare)) and not (re.search(r"\d\.$", bare) and text[len(bare) : len(bare) + 1].isdigit())
                    closed = repeated.number(template(bare.rsplit("\n", 1)[-1])) in common
                    if closed and not _ENDED.search(bare):
                        continue
                    marked = "" if rng.rand() < 0.7 or inside else (" […]", "…", " (...)", "...", " …")[rng.randint(5)]
                    ended_line = (bare + marked).rsplit("\n", 1)[-1]
                    out.append((key, 0 if inside else 1, _end_features(bare + marked, k, repeated.number(template(ended_line)) in common)))
            yield pd.DataFrame(out, columns=["k", "label", "f"])

    return make


def _at_limit(text: str, known: list[tuple[int, int]]) -> int:
    n = len(text)
    if any(k == 2 and x == n for k, x in known):
        return 2
    b = len(text.encode()) // 4
    return 1 if any(k == 1 and x == b for k, x in known) else 0


def train(rows: pd.DataFrame, epochs: int = 12, rate: float = 0.4, decay: float = 1e-6) -> np.ndarray:
    """Weights by AdaGrad over fixed-size batches in a fixed order; no rows give a weight of zero everywhere."""
    weights, seen = np.zeros(DIMENSIONS, np.float32), np.full(DIMENSIONS, 1e-6, np.float32)
    if rows.empty:
        return weights
    x, y = np.array(rows["f"].tolist(), np.int64), rows["label"].to_numpy(np.float32)
    balance = np.where(y == 1, 0.5 / max(y.mean(), 1e-3), 0.5 / max(1 - y.mean(), 1e-3)).astype(np.float32)
    rng = np.random.RandomState(5)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), 64):
            i = order[at : at + 64]
            p = 1 / (1 + np.exp(-weights[x[i]].sum(1)))
            g = np.repeat(((p - y[i]) * balance[i])[:, None], x.shape[1], 1) + decay * weights[x[i]]
            np.add.at(seen, x[i], g**2)
            np.add.at(weights, x[i], -rate * g / np.sqrt(seen[x[i]]))
    return weights


def score_ends(df: DataFrame, key: str, text: str, source: str, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(key, source, score): probability that each text stops before its end.

    Null and blank texts score null.  key must be unique for a repeatable sample; the
    sample is the rows of small key hash, about train_rows; the statistics see all rows.
    """
    counts = end_counts(df, text, source).checkpoint()
    texts, closings = common_closings(counts)
    limits = source_limits(counts)
    sample = _lengths(df, text, source).select(F.col(key).cast("string").alias("k"), F.col("__s").alias("s"), F.col("__t").alias("t"))
    # a hash threshold takes about train_rows rows wherever they lie: no sort, no task that merges
    share = min(1.0, train_rows / max(texts, 1))
    sample = sample.where(F.pmod(F.xxhash64("k"), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = limits.take(SENT + 1)
    sent = len(rows) <= SENT
    if not sent:  # the training rows need the limits of their own sources only
        rows = limits.join(sample.select("s").distinct(), "s", "left_semi").collect()
    known: dict[str, list[tuple[int, int]]] = {}
    for r in rows:
        known.setdefault(r["s"], []).append((r["kind"], r["at"]))
    for v in known.values():
        v.sort()
    cut = sample.mapInPandas(_cuts(known, closings), "k string, label int, f array<int>").toPandas()
    weights = train(cut.sort_values(["k", "label"], kind="stable").reset_index(drop=True))
    known = {s: frozenset(v) for s, v in known.items()} if sent else {}

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for tail, last, tags, src, chars, size, at in batches:
            out = []
            for t, line, tag, s, n, b, limit in zip(tail, last, tags, src, chars, size, at):
                if not t:
                    out.append(None)
                    continue
                if sent:
                    of = known.get(s, ())
                    limit = _CHARS if (_CHARS, n) in of else _BYTES if (_BYTES, b // 4) in of else 0
                f = features(t, int(limit), repeated.number(template(line)) in closings, line, bool(tag))
                out.append(float(1 / (1 + np.exp(-weights[f].sum()))))
            yield pd.Series(out, dtype="float64")

    n = _lengths(df, text, source).withColumns({"__end": _stripped(F.col("__t")), "__limit": F.lit(0)})
    if not sent:
        for kind, at in ((_BYTES, F.floor(F.col("__bytes") / 4)), (_CHARS, F.col("__chars"))):
            mine = limits.where(F.col("kind") == kind).select(F.col("s").alias("__ls"), F.col("at").alias("__at"))
            n = n.join(mine, (F.col("__s") == F.col("__ls")) & (at == F.col("__at")), "left").withColumn("__limit", F.when(F.col("__at").isNotNull(), kind).otherwise(F.col("__limit"))).drop("__ls", "__at")
    tail, line = F.right(F.col("__end"), F.lit(TAIL)), F.substring_index("__end", "\n", -1)
    return n.select(F.col(key), F.col(source).alias("source"), score(tail, line, _tag_open(F.col("__end")), "__s", "__chars", "__bytes", "__limit").alias("score"))


def truncation_by_source(scored: DataFrame, least: float = 0.5) -> DataFrame:
    """Per source: texts, truncated texts and their share; a null source is a group."""
    cut = F.sum(F.when(F.col("score") > least, 1).otherwise(0))
    return scored.groupBy("source").agg(F.count(F.lit(1)).alias("texts"), cut.alias("truncated"), F.round(cut / F.count(F.lit(1)), 6).alias("share"))
