"""Text decoded with the wrong character encoding: found and, where possible, undone.

Method: a hidden Markov model over the characters of a value, with one clean state and
one state per encoding pair.  The clean state's character probabilities are counted
over all clean-looking values of the columns; a pair's are those same characters sent
through the pair, so no garbled example is needed.  Viterbi labels every character;
each labelled span is put through the inverse of its state's pair.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters of Vietnamese beyond ASCII, lower case.
VIETNAMESE = "àáảãạăằắẳẵặâầấẩẫậèéẻẽẹêềếểễệìíỉĩịòóỏõọôồốổỗộơờớởỡợùúủũụưừứửữựỳýỷỹỵđ"
#: Punctuation and symbols that occur in text as it is meant.
TYPOGRAPHIC = "‘’“”–—…•·«»©®™°½¼¾²³±×€"
# The 8-bit TCVN3 letters in the order of VIETNAMESE, and its capitals.
TCVN3_LOWER = dict(zip(VIETNAMESE, "µ¸¶·¹¨»¾¼½Æ©ÇÊÈÉËÌÐÎÏÑªÒÕÓÔÖ×ÝØÜÞßãáâä«åèæçé¬êíëìîïóñòô­õøö÷ùúýûüþ®"))
TCVN3_UPPER = dict(zip("ĂÂĐÊÔƠƯ", "¡¢§£¤¥¦"))
#: Encodings that UTF-8 bytes were read as; the last are read twice.
READ_AS = ("cp1252", "latin-1", "cp1258", "mac_roman", "cp437", "cp850", "cp1251", "gbk", "big5", "cp1252+cp1252", "latin-1+latin-1", "cp1252+latin-1")
SWITCH, UNSEEN, SPREAD = 3.5, -15.0, 1e-6
#: Log-probability of an untabulated double-byte character in the double-byte states.
RARE_DOUBLE_BYTE = -12.0
REPLACEMENT = "�"
#: Characters of values labelled together, which bounds the memory of the paths.
TOGETHER = 1 << 20


def _read(data: bytes, encoding: str) -> str:
    """Bytes in an encoding; a byte it has no character for becomes the control of that number."""
    if encoding in ("gbk", "big5"):
        return data.decode(encoding, "replace")
    out = []
    for b in data:
        try:
            out.append(bytes([b]).decode(encoding))
        except UnicodeDecodeError:
            out.append(chr(b))
    return "".join(out)


def _write(text: str, encoding: str) -> bytes:
    out = bytearray()
    for c in text:
        try:
            out += c.encode(encoding)
        except UnicodeEncodeError:
            if ord(c) > 255:
                raise
            out.append(ord(c))
    return bytes(out)


def garble(text: str, pair: str) -> str:
    """The text as it looks after its encoding pair."""
    if pair == "tcvn3":
        return "".join(TCVN3_LOWER.get(c) or TCVN3_UPPER.get(c) or TCVN3_LOWER.get(c.lower(), c) for c in text)
    if pair == "lost":
        return "".join(c if c.isascii() else REPLACEMENT * len(c.encode()) for c in text)
    if pair in ("gbk", "big5"):
        return _read(text.encode(), pair)
    return reduce(lambda t, e: _read(t.encode(), e), pair.split("+"), text)


def ungarble(span: str, pair: str) -> str | None:
    """The span through the inverse of its pair; None if bytes were lost."""
    try:
        if pair == "lost":
            return None
        if pair == "tcvn3":
            back = {v: k for k, v in TCVN3_LOWER.items()} | {v: k for k, v in TCVN3_UPPER.items()}
            return "".join(back.get(c, c) for c in span)
        return reduce(lambda t, e: _write(t, e).decode("utf-8"), reversed(pair.split("+")), span)
    except (UnicodeDecodeError, UnicodeEncodeError):
        return None


PAIRS = (*READ_AS, "tcvn3", "lost")
_CLEAN = frozenset(VIETNAMESE + VIETNAMESE.upper() + TYPOGRAPHIC) | {chr(i) for i in range(32, 127)} | set("\t\n\r")
#: For the JVM: a value of clean characters only needs no labelling.
DOUBTFUL = f"[^\\x00-\\x7f{VIETNAMESE}{VIETNAMESE.upper()}]"


def character_counts(df: DataFrame, columns: list[str]) -> dict[str, int]:
    """Counts of the clean alphabet over all values made of it alone (bounded by the alphabet)."""
    alphabet = _CLEAN

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for column in batch.columns:
                values = [v for v in column.to_pylist() if v]
                for v in values:
                    if v.isascii() or alphabet.issuperset(v):
                        total.update(v)
        yield pa.RecordBatch.from_pydict({"c": pa.array(list(total), pa.string()), "n": pa.array(list(total.values()), pa.int64())})

    counted = df.select(*[F.col(c).cast("string").alias(f"v{i}") for i, c in enumerate(columns)]).mapInArrow(count, "c string, n long")
    return {r["c"]: r["n"] for r in counted.groupBy("c").agg(F.sum("n").alias("n")).collect()}


class Labeller:
    """Viterbi over values; states are 'clean' and PAIRS."""

    def __init__(self, counts: dict[str, int]):
        base = {c: counts.get(c, 0) for c in _CLEAN}
        floor = max(1.0, sum(base.values()) * SPREAD)
        # a capital is at least a fiftieth as likely as its small letter: whole titles are set in capitals
        base = {c: max(n, base.get(c.lower(), 0) / 50) + floor for c, n in base.items()}
        tables = [base]
        for pair in PAIRS:
            seen: dict[str, float] = {}
            for c, n in base.items():
                for g in garble(c, pair):
                    seen[g] = seen.get(g, 0.0) + n
            if pair in ("gbk", "big5"):  # double bytes also pair across letters
                seen = self._pairs_of_letters(base, pair)
            tables.append(seen)
        chars = sorted(set().union(*tables))
        self.index = {c: i for i, c in enumerate(chars)}
        self.emit = np.full((len(chars) + 1, len(tables)), UNSEEN)
        for s, table in enumerate(tables):
            total = sum(table.values())
            for c, n in table.items():
                self.emit[self.index[c], s] = np.log(n / total)
        self.emit[-1] = UNSEEN
        self.emit[-1, 0] = UNSEEN - 2
        for s, pair in enumerate(PAIRS, 1):
            if pair in ("gbk", "big5"):
                self.emit[-1, s] = RARE_DOUBLE_BYTE

    @staticmethod
    def _pairs_of_letters(base: dict[str, float], pair: str) -> dict[str, float]:
        letters = [c for c, n in sorted(base.items(), key=lambda x: (-x[1], x[0])) if c.isalpha() or c == " " or not c.isascii()]
        total, seen = sum(base[c] for c in letters), {}
        for a in letters:
            for b in letters:
                if a.isascii() and b.isascii():
                    continue
                for g in garble("a" + a + b + "a", pair)[1:-1]:
                    seen[g] = seen.get(g, 0.0) + base[a] * base[b] / total
        for c, n in base.items():
            if c.isascii():
                seen[c] = seen.get(c, 0.0) + n
        return seen

    def paths(self, values: list[str]) -> list[np.ndarray]:
        """State of every character of every value."""
        out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(values)
        order = sorted(range(len(values)), key=lambda i: len(values[i]))
        unknown, index = len(self.index), self.index
        at = 0
        while at < len(order):
            many = 256
            while many > 1 and many * len(values[order[min(at + many, len(order)) - 1]]) > TOGETHER:
                many //= 2
            ids = order[at : at + many]
            at += many
            longest = len(values[ids[-1]])
            if not longest:
                continue
            codes = np.full((len(ids), longest), -2, np.int32)
            for r, i in enumerate(ids):
                codes[r, : len(values[i])] = [index.get(c, unknown) for c in values[i]]
            states = self.emit.shape[1]
            best = np.zeros((len(ids), states))
            best[:, 1:] -= SWITCH
            came = np.zeros((longest, len(ids), states), np.int8)
            stay = np.arange(states, dtype=np.int8)
            for t in range(longest):
                if t:
                    top = best.argmax(1)
                    jump = best[np.arange(len(ids)), top][:, None] - SWITCH
                    came[t] = np.where(jump > best, top[:, None].astype(np.int8), stay)
                    best = np.maximum(best, jump)
                live = codes[:, t] != -2
                best = best + np.where(live[:, None], self.emit[codes[:, t]], 0.0)
                if not live.all():
                    came[t][~live] = stay
            state = best.argmax(1).astype(np.int8)
            path = np.zeros((len(ids), longest), np.int8)
            rows = np.arange(len(ids))
            for t in range(longest - 1, -1, -1):
                path[:, t] = state
                state = came[t][rows, state]
            for r, i in enumerate(ids):
                out[i] = path[r, : len(values[i])]
        return out

    def spans(self, value: str, path: np.ndarray) -> list[tuple[int, int, str]]:
        """(start, end, pair) of each labelled run, ASCII edges taken off."""
        found, n, k = [], len(value), 0
        while k < n:
            if not path[k]:
                k += 1
                continue
            end = k
            while end < n and path[end] == path[k]:
                end += 1
            a, b = k, end
            while a < b and value[a].isascii():
                a += 1
            while b > a and value[b - 1].isascii():
                b -= 1
            if a < b:  # a garbled letter's first half may look clean
                while a > (found[-1][1] if found else 0) and not value[a - 1].isascii():
                    a -= 1
                while b < n and not value[b].isascii():
                    b += 1
                found.append((a, b, PAIRS[path[k] - 1]))
            k = max(end, b)
        return found

    def judge(self, values: list[str | None], again: int = 2) -> list[tuple[bool, str | None, str | None]]:
        """(garbled, restored text or None where it cannot be, pairs) per value.

        A restored text is judged again, for what was read wrongly more than once.
        """
        known = [i for i, v in enumerate(values) if v]
        out: list[tuple[bool, str | None, str | None]] = [(False, v, None) for v in values]
        for i, path in zip(known, self.paths([values[i] for i in known])):
            value = values[i]
            spans = self.spans(value, path)
            if not spans:
                continue
            text, whole, kinds = value, True, []
            for a, b, pair in reversed(spans):
                back = restore_span(value[a:b], pair)
                if back is None and _OLD_CAPITAL.search(value[max(0, a - 1) : b + 1]):
                    back, pair = (ungarble(value[a:b], "tcvn3"), True), "tcvn3"
                if back is None:
                    continue
                kinds.append(pair)
                whole &= back[1]
                text = text[:a] + back[0] + text[b:]
            if kinds:
                out[i] = (True, text if whole else None, ",".join(dict.fromkeys(reversed(kinds))))
        back = [i for i in known if out[i][0] and out[i][1] and again]
        for i, (more, text, pairs) in zip(back, self.judge([out[i][1] for i in back], again - 1) if back else []):
            if more:
                out[i] = (True, text, ",".join(dict.fromkeys([*out[i][2].split(","), *pairs.split(",")])))
        return out


_OLD_CAPITAL = re.compile("[¡¢£¤¥¦§](?=[^\\W\\d_])|(?<=[^\\W\\d_])[¡¢£¤¥¦§]")
_RUN = re.compile(r"[^\x00-\x7f]+")
_LETTERS = frozenset(c for c in _CLEAN if not c.isascii())


def restore_span(span: str, pair: str) -> tuple[str, bool] | None:
    """(text, whether all of it came back); None if no pair makes sense of the span.

    The span's own pair first, as a whole; then each non-ASCII run by itself, with the
    other pairs tried after it.  A run counts only if it turns into letters.
    """
    if pair == "lost":
        return (span, False) if REPLACEMENT in span else None
    if pair == "tcvn3":
        return ungarble(span, pair) or span, True
    back = ungarble(span, pair)
    if back is not None and back != span and _CLEAN.issuperset(back):
        return back, True
    some, whole, out, at = False, True, [], 0
    for m in _RUN.finditer(span):
        out.append(span[at : m.start()])
        at, run, best = m.end(), m.group(), None
        for p in (pair, *(x for x in READ_AS if x != pair)):
            back = ungarble(run, p)
            if back is not None and _LETTERS.intersection(back) and _CLEAN.issuperset(back):
                best = back
                break
        if best is None:
            whole = whole and _LETTERS.issuperset(run)
            some = some or _partly(run, pair)
            out.append(run)
        else:
            some = True
            out.append(best)
    out.append(span[at:])
    return ("".join(out), whole) if some else None


def _partly(run: str, pair: str) -> bool:
    """Whether part of a run still decodes to letters (its ends may be cut or lost)."""
    try:
        data = run.encode(pair, "ignore") if "+" not in pair else b""
    except LookupError:
        data = b""
    for at in range(min(3, len(data))):
        if len(_LETTERS.intersection(data[at:].decode("utf-8", "ignore"))) and not _LETTERS.issuperset(run):
            return True
    return False


_RESULT = T.StructType([T.StructField("garbled", T.BooleanType()), T.StructField("restored", T.StringType()), T.StructField("pairs", T.StringType())])


def labeller_udf(counts: dict[str, int]) -> Callable:
    @F.pandas_udf(_RESULT)
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = Labeller(counts)
        for v in batches:
            yield pd.DataFrame(model.judge([x if isinstance(x, str) else None for x in v]), columns=["garbled", "restored", "pairs"])

    return label


def find_garbled(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, field_name, restored, pairs) of each wrongly decoded value.

    restored is the whole value with its garbled spans undone, null where bytes were
    lost.  Nulls, "" and values of plain letters only are never garbled.  Values are
    judged whole, however long.  Only doubtful values (native regex) reach Python.
    """
    label = labeller_udf(character_counts(df, columns))
    fields = F.explode(F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).cast("string").alias("v")) for c in columns]))
    long = df.select(F.col(key), fields.alias("f")).select(key, "f.field_name", "f.v").where(F.col("v").rlike(DOUBTFUL))
    judged = long.withColumn("j", label("v"))
    return judged.where("j.garbled").select(key, "field_name", "j.restored", "j.pairs")
