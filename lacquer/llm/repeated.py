"""Lines repeated across the documents of one source.

Method: lines run down a fixed-depth token tree: number of tokens, then the first
tokens; digit runs are slots, written 0.  Every partition grows trees of its own, a row
counting an item once, and the trees are merged by adding counts, so the largest source
needs no special care.  A tree is grown level by level over all rows: first leaves; then,
in leaves that enough rows reach, tokens by position: one that enough rows have there is
a constant, any other becomes the word slot "*"; then the templates so made.  A template
is one if at least a share `alike` of its tokens is constant; those that enough rows have
are kept, and a line is found if the tree leads it to a kept template.

Each leaf and each constant of a template covers at least the rows of the template, so
none is missed.  A template without word slots is the text of its lines: its rows are
those that have this very text, which is the rule of SQL for p4_found (`same_text`).
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest

#: Token levels of the tree below the number of tokens.
DEPTH = 2
#: Least share of constants among the tokens of a template with word slots.
ALIKE = 0.6
#: Forms that one tree holds before it is given out.
HELD = 200_000
#: Leaves, constants and templates sent to every task; beyond, forms are counted whole and lines are joined with them
#: over SALTS parts of each source.  A source has at most (lines, or tokens, of a row) / min_share of them.
SENT, SALTS = 200_000, 32
#: Forms whose template a task remembers.
REMEMBERED = 50_000
WHITE = r"[\s\x1c-\x1f\x85\p{Z}]+"
DIGITS = re.compile("[0-9]+")
#: White space other than the plain space and the line break; most texts have none.
_ODD_WHITE = tuple(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")


def line_form(line: Column) -> Column:
    """Lower case, white space runs as one space, outer space dropped, digit runs as one 0."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), WHITE, " "), "[0-9]+", "0"))


def line_forms(text: str) -> list[str]:
    """The same form of every line of a text; "" for blank lines."""
    lines = DIGITS.sub("0", text.lower()).split("\n")
    if "  " in text or any(map(text.__contains__, _ODD_WHITE)):
        return [" ".join(x.split()) for x in lines]
    return [x.strip() for x in lines]


def number(s: str) -> int:
    """A signed 64-bit hash."""
    n = xxh3_64_intdigest(s)
    return n - (1 << 64) if n >> 63 else n


def leaf_path(form: str, depth: int) -> str:
    """The way a form goes: its number of tokens and its first `depth` tokens."""
    return " ".join([str(form.count(" ") + 1), *form.split(" ", depth)[:depth]])


def leaf_of(form: str, depth: int) -> int:
    """The leaf a form reaches: hash of its way."""
    return number(leaf_path(form, depth))


def source_of(source: str) -> Column:
    return F.coalesce(F.col(source).cast("string"), F.lit("\x00null"))


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[str, str]]:
    for s, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        if t:
            yield s, t


def counted_items(df: DataFrame, source: str, text: str, schema: pa.Schema, names: list[str], items: Callable, rows: Callable) -> DataFrame:
    """(s, *names, n): rows per source that have an item, summed over the trees of all partitions.

    items(s, text) are the items of one row; rows(item) are an item's columns.
    """

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[str, Counter] = defaultdict(Counter)

        def given_out() -> Iterator[pa.RecordBatch]:
            for s, tree in trees.items():
                if not tree:
                    continue
                columns = [*zip(*map(rows, tree))]
                yield pa.RecordBatch.from_arrays([pa.array([s] * len(tree), pa.string()), *(pa.array(c, schema.field(i + 1).type) for i, c in enumerate(columns)), pa.array(tree.values(), pa.int64())], schema=schema)
            trees.clear()

        for batch in batches:
            for s, t in _texts(batch):
                trees[s].update(items(s, t))
            if sum(map(len, trees.values())) > HELD:
                yield from given_out()
        yield from given_out()

    types = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string"}
    grown = df.select(source_of(source).alias("s"), F.col(text).cast("string").alias("t")).mapInArrow(grow, ", ".join(f"{f.name} {types[f.type]}" for f in schema))
    return grown.groupBy("s", *names).agg(F.sum("n").alias("n"))


def _schema(**fields: pa.DataType) -> pa.Schema:
    return pa.schema([("s", pa.string()), *fields.items(), ("n", pa.int64())])


def leaves_of_sources(df: DataFrame, source: str, text: str, depth: int = DEPTH) -> DataFrame:
    """(s, leaf, n): rows of a source that reach a leaf."""
    items = lambda s, t: {leaf_path(f, depth) for f in line_forms(t) if f}
    return counted_items(df, source, text, _schema(leaf=pa.int64()), ["leaf"], items, lambda path: (number(path),))


def rows_of_sources(df: DataFrame, source: str) -> DataFrame:
    """(s, rows): all rows of a source count, blank ones too."""
    return df.groupBy(source_of(source).alias("s")).agg(F.count(F.lit(1)).alias("rows")).checkpoint()


def _enough(counted: DataFrame, rows: DataFrame, min_rows: int, min_share: float) -> DataFrame:
    """What enough rows of its source have."""
    return counted.join(rows, "s").where(F.col("n") >= F.greatest(F.lit(float(min_rows)), F.col("rows") * F.lit(min_share) - 1e-9)).drop("rows")


def with_slots(form: str, leaf: int, constants: set, alike: float) -> tuple[str, int] | None:
    """The template of a form in a leaf and its number of word slots, None if too few of its tokens are constants."""
    tokens, slots = form.split(" "), 0
    for i, w in enumerate(tokens):
        if (leaf, i, number(w)) not in constants:
            tokens[i], slots = "*", slots + 1
    return (" ".join(tokens), slots) if slots <= (1 - alike) * len(tokens) + 1e-9 else None


def _sets(rows: list, *names: str) -> dict[str, set]:
    out: dict[str, set] = defaultdict(set)
    for r in rows:
        out[r["s"]].add(tuple(r[n] for n in names) if len(names) > 1 else r[names[0]])
    return dict(out)


class TooMany(ValueError):
    """More leaves, constants or templates than are sent to tasks."""


def _few(df: DataFrame, what: str) -> list:
    """Rows for the driver, refused beyond SENT."""
    rows = df.take(SENT + 1)
    if len(rows) > SENT:
        raise TooMany(f"more than {SENT} {what}; raise min_share or min_rows")
    return rows


class Slots:
    """Word slots of the leaves that enough rows reach: leaves, and constants (leaf, position, token) by source."""

    def __init__(self, leaves: dict[str, set], constants: dict[str, set], depth: int, alike: float):
        self.leaves, self.constants, self.depth, self.alike = leaves, constants, depth, alike
        self.remembered: dict[tuple[str, str], tuple[str, int] | None] = {}

    def template(self, s: str, form: str) -> tuple[str, int] | None:
        """The template the tree leads a form to and its number of word slots, None if to none."""
        leaves = self.leaves.get(s)
        if not leaves or (leaf := leaf_of(form, self.depth)) not in leaves:
            return None
        known = self.remembered
        if (s, form) not in known:
            if len(known) >= REMEMBERED:
                known.clear()
            known[s, form] = with_slots(form, leaf, self.constants.get(s, frozenset()), self.alike)
        return known[s, form]

    def templates(self, s: str, text: str) -> set[tuple[str, int]]:
        """The templates of a row's lines."""
        return {x for f in set(line_forms(text)) if f and (x := self.template(s, f))}


def word_slots(df: DataFrame, source: str, text: str, rows: DataFrame, min_rows: int, min_share: float, depth: int, alike: float) -> Slots:
    """Slots from two counts over all rows: leaves, then tokens by position in the leaves that are full enough."""
    full = _enough(leaves_of_sources(df, source, text, depth), rows, min_rows, min_share)
    leaves = _sets(_few(full, "leaves"), "leaf")

    def tokens(s: str, t: str) -> set:
        own, out = leaves.get(s, ()), set()
        for f in set(line_forms(t)) if own else ():
            if f and (leaf := leaf_of(f, depth)) in own:
                out.update((leaf, i, w) for i, w in enumerate(f.split(" ")))
        return out

    counted = counted_items(df, source, text, _schema(leaf=pa.int64(), at=pa.int32(), token=pa.int64()), ["leaf", "at", "token"], tokens, lambda x: (x[0], x[1], number(x[2])))
    return Slots(leaves, _sets(_few(_enough(counted, rows, min_rows, min_share), "constant tokens"), "leaf", "at", "token"), depth, alike)


def line_templates(df: DataFrame, source: str, text: str, min_rows: int = 4, min_share: float = 0.05, alike: float = ALIKE, depth: int = DEPTH) -> DataFrame:
    """(source, template, rows): templates that enough rows of a source have, with slots "0" for digits and "*" for words.

    A row counts a template once.  A null source gives null.
    """
    rows = rows_of_sources(df, source)
    slots = word_slots(df, source, text, rows, min_rows, min_share, depth, alike)
    items = lambda s, t: {x for x, _ in slots.templates(s, t)}
    counted = counted_items(df, source, text, _schema(template=pa.string()), ["template"], items, lambda x: (x,))
    kept = _enough(counted, rows, min_rows, min_share)
    return kept.select(F.nullif(F.col("s"), F.lit("\x00null")).alias("source"), "template", F.col("n").alias("rows"))


def _marker(slots: Slots | None, kept: dict[str, set]):
    """Lines that are led to a kept template (hash, word slots); without slots every form is its own template."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def mark(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        @lru_cache(100_000)
        def hit(s: str, form: str) -> bool:
            x = slots.template(s, form) if slots else (form, 0)
            return x is not None and (number(x[0]), x[1]) in kept[s]

        for sources, texts in batches:
            out = [[n for n, f in enumerate(line_forms(t), 1) if f and hit(s, f)] if t and s in kept else [] for s, t in zip(sources, texts)]
            yield pd.Series(out, dtype=object)

    return mark


def _joined(df: DataFrame, key: str, source: str, text: str, forms: DataFrame) -> DataFrame:
    """(key, line_no) by a join, for more templates than are sent to tasks; every source is spread over SALTS parts."""
    forms_udf = F.pandas_udf(lambda t: t.map(lambda x: [number(f) if f else None for f in line_forms(x)] if x else []), T.ArrayType(T.LongType()))
    lines = df.select(F.col(key).alias("k"), source_of(source).alias("s"), F.posexplode(forms_udf(F.col(text).cast("string"))).alias("n", "form")).where("form is not null")
    lines = lines.withColumn("salt", F.pmod(F.xxhash64("k", "n"), F.lit(SALTS)))
    spread = forms.select("s", "form", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    return lines.join(spread, ["s", "form", "salt"], "left_semi").select(F.col("k").alias(key), (F.col("n") + 1).alias("line_no"))


def repeated_line_numbers(df: DataFrame, source: str, text: str, min_rows: int = 4, min_share: float = 0.05, alike: float = 1.0, depth: int = DEPTH, same_text: bool = False) -> Column | DataFrame:
    """Column of array<int>: the repeated lines of each row; beyond SENT templates the (s, form) table to join with."""
    rows = rows_of_sources(df, source)
    worded = alike < 1 and not same_text
    try:
        slots = word_slots(df, source, text, rows, min_rows, min_share, depth, alike)
    except TooMany:  # a tree too large to send leaves out no text that enough rows have: they are counted without it
        if worded:
            raise
        slots = None
    items = lambda s, t: slots.templates(s, t) if slots else {(f, 0) for f in line_forms(t) if f}
    counted = counted_items(df, source, text, _schema(form=pa.int64(), slots=pa.int32()), ["form", "slots"], items, lambda x: (number(x[0]), x[1]))
    kept = _enough(counted, rows, min_rows, min_share).select("s", "form", "slots")
    kept = (kept if worded else kept.where(F.col("slots") == 0)).checkpoint()
    try:
        sent = _few(kept, "templates")
    except TooMany:
        if worded:
            raise
        return kept.select("s", "form")
    return _marker(slots, _sets(sent, "form", "slots"))(source_of(source), F.col(text).cast("string"))


def repeated_lines(df: DataFrame, key: str, source: str, text: str, **limits) -> DataFrame:
    """(key, line_no) of each line whose template occurs in at least min_rows (4) rows of its
    source and at least min_share (0.05) of all rows of that source.  With `alike` at 1 or
    `same_text` these are the lines whose whole form does; with `alike` below 1 alone also
    those whose template has word slots.

    Rows with null or blank text count as rows.  A null source is a source of its own.
    Rows that repeat a key count once each.  Blank lines are never found.  An empty
    table gives no row; other columns of df are not read.
    """
    numbers = repeated_line_numbers(df, source, text, **limits)
    if isinstance(numbers, DataFrame):
        return _joined(df, key, source, text, numbers)
    return df.select(F.col(key), F.explode(numbers).alias("line_no"))


def without_repeated_lines(df: DataFrame, key: str, source: str, text: str, out: str = "clean_text", **limits) -> DataFrame:
    """df with `out`: the text without its source's repeated lines; key must be unique.

    A null text stays null; a column of df named `out` is replaced.
    """
    numbers = repeated_line_numbers(df, source, text, **limits)
    if isinstance(numbers, DataFrame):
        found = _joined(df, key, source, text, numbers).groupBy(F.col(key).alias("__k")).agg(F.collect_set("line_no").alias("__drop"))
        df = df.join(found, df[key] == F.col("__k"), "left").drop("__k")
    else:
        df = df.withColumn("__drop", numbers)
    lines = F.transform(F.split(F.col(text).cast("string"), "\n", -1), lambda x, i: F.struct((i + 1).alias("n"), x.alias("x")))
    kept = F.filter(lines, lambda s: ~F.coalesce(F.array_contains(F.col("__drop"), s["n"]), F.lit(False)))
    return df.withColumn(out, F.when(F.col(text).isNotNull(), F.array_join(F.transform(kept, lambda s: s["x"]), "\n"))).drop("__drop")
