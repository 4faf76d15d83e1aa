"""One consistent form for text that looks the same but is stored differently.

Method: each word is resolved to the set of scripts in which all its letters can be
written; mixed-script and whole-script confusable words take the one spelling that
set allows.  What remains (width, marks, spaces, hyphens, invisible characters) is
normalised around it.  Letter case, line breaks, tabs, repeated spaces, quotation
marks and dashes are left as they are.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters of other scripts drawn like a Latin letter, from the public confusables of the Unicode standard.
LATIN_FOR_CYRILLIC = dict(zip("АВЕКМНОРСТУХІЈЅԚԜҮӀѴԌԍаеорсухіјѕԛԝһԁӏүѵ", "ABEKMHOPCTYXIJSQWYIVGGaeopcyxijsqwhdlyv"))
LATIN_FOR_GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοιυνακρϲϳ", "ABEZHIKMNOPTYXoiuvakpcj"))
LATIN_FOR_ARMENIAN = dict(zip("օոսցհզյԼՕՍՏ", "onughqjLOUS"))
LATIN_FOR_CHEROKEE = dict(zip("ᎠᎡᎢᎥᎪᎫᎬᎳᎷᎻᎽᏀᏂᏃᏏᏒᏔᏕᏙᏚᏞᏟᏢᏦᏧᏳᏴ", "DRTiAJEWMHYGhZbRWSVSLCPKdGB"))
LATIN_FOR_LISU = dict(zip("ꓐꓑꓒꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPdDTGKJCZFMNLSRVHWXYAEIOU"))
LATIN_FOR_COPTIC = dict(zip("ⲎⲒⲔⲘⲚⲞⲢⲤⲦⲨⲬⲟⲣⲥ", "HIKMNOPCTYXopc"))
#: Latin letters drawn like the Vietnamese d with stroke, and other Latin doubles.
LATIN_FOR_LATIN = {"Ð": "Đ", "Ɖ": "Đ", "ð": "đ", "ɖ": "đ", "ı": "i", "ɑ": "a", "ɡ": "g", "ſ": "s", "ĸ": "k"}
#: Greek letters that are read as symbols when they stand alone.
GREEK_SYMBOLS = frozenset("ιυνακρο")
HYPHENS = "\u2010\u2011\ufe63\uff0d"

# What is not seen, spaces other than the plain one, forms of other width, ligatures and compatibility singles.
INVISIBLE = (
    "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164"
    "\ufe00-\ufe0f\ufeff\uffa0\ufff9-\ufffb\U000e0000-\U000e0fff"
)
SPACES = "\u00a0\u1680\u2000-\u200a\u202f\u205f\u3000"
WIDE = "\uff01-\uffee"
DOUBLES = "\u2126\u212a\u212b\ufb00-\ufb4f"
#: Letters of mathematics: always the plain letter.
MATH = "\U0001d400-\U0001d6a3"
#: Letter-like symbols and Roman numerals: a letter only inside a word.
LETTERLIKE = "\u2100-\u214f\u2160-\u217f"

_INVISIBLE = re.compile(f"[{INVISIBLE}]+")
_SPACES = re.compile(f"[{SPACES}]")
_HYPHENS = re.compile(f"[{HYPHENS}]")
_WIDTH = re.compile(f"[{WIDE}{DOUBLES}{MATH}]+")
_LETTERLIKE = re.compile(f"(?<=[^\\W\\d_])[{LETTERLIKE}]+|[{LETTERLIKE}]+(?=[^\\W\\d_])")


def _script(c: str) -> str:
    """Script of a letter, as its name says it: LATIN, CYRILLIC, GREEK, HEBREW, CJK ..."""
    return unicodedata.name(c, "?").split(" ", 1)[0]


def _doubles() -> dict[str, dict[str, str]]:
    """Per script the letters of it that letters of any script can be taken for.

    Beside the fixed pairs: small capitals by their names, and letters with marks whose
    base has a double that takes the same marks.
    """
    latin = LATIN_FOR_CYRILLIC | LATIN_FOR_GREEK | LATIN_FOR_ARMENIAN | LATIN_FOR_CHEROKEE | LATIN_FOR_LISU | LATIN_FOR_COPTIC
    latin |= {c.lower(): x.lower() for c, x in LATIN_FOR_CHEROKEE.items()}
    for n in [*range(0x0180, 0x02B0), *range(0x1D00, 0x1D30), *range(0xA720, 0xA800)]:
        _, small, letter = unicodedata.name(chr(n), "").partition("LATIN LETTER SMALL CAPITAL ")
        if small and len(letter) == 1:
            latin[chr(n)] = letter.lower()
    back = {script: {x: c for c, x in pairs.items()} for script, pairs in (("CYRILLIC", LATIN_FOR_CYRILLIC), ("GREEK", LATIN_FOR_GREEK))}
    for script, pairs in (("LATIN", latin), *back.items()):
        for n in [*range(0x00C0, 0x0530), *range(0x1F00, 0x2000)]:
            base, *marks = unicodedata.normalize("NFD", chr(n))
            if marks and chr(n) not in pairs and base in pairs:
                whole = unicodedata.normalize("NFC", pairs[base] + "".join(marks))
                if len(whole) == 1:
                    pairs[chr(n)] = whole
    for pairs in back.values():  # a letter of a third script is taken for its Latin double's double
        pairs |= {c: pairs[x] for c, x in latin.items() if x in pairs and c not in pairs}
    return {"LATIN": latin, **back}


_DOUBLES_OF = _doubles()
_TO_LATIN = _DOUBLES_OF["LATIN"]
#: Letters that may have to be spelled otherwise.
_FOREIGN = re.compile("[" + "".join(sorted({*_TO_LATIN, *LATIN_FOR_LATIN})) + "Ͱ-ϿЀ-ԯԱ-և]")


MARKS = "\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff"
#: A word: letters, each with the marks set on it.
_WORD = re.compile(f"(?:[^\\W\\d_][{MARKS}]*)+")
_MARK = re.compile(f"[{MARKS}]")


#: Blocks with combining marks and with characters that have another composed form; the rest is in the classes.
_BLOCKS = (range(0x300, 0x1100), range(0x1350, 0x1360), range(0x1700, 0x2400), range(0x2ADC, 0x3100), range(0xA66F, 0xABF0), range(0xF900, 0xFE30), range(0x101FD, 0x1E960), range(0x2F800, 0x2FA20))


def _suspect_table() -> np.ndarray:
    """Characters that may make a value differ from its form: marks, what has another composed form, and the classes above."""
    table = np.zeros(0x110000, bool)
    for first, last in re.findall(r"(.)(?:-(.))?", INVISIBLE + SPACES + HYPHENS + WIDE + DOUBLES + MATH + LETTERLIKE + "Ͱ-ϿЀ-ԯԱ-և", re.S):
        table[ord(first) : ord(last or first) + 1] = True
    for block in _BLOCKS:
        for n in block:
            table[n] |= unicodedata.combining(chr(n)) > 0 or not unicodedata.is_normalized("NFC", chr(n))
    table[[ord(c) for c in (*_TO_LATIN, *LATIN_FOR_LATIN)]] = True
    return table


_TABLE = _suspect_table()


def _suspects(values: list[str]) -> list[int]:
    """Which values have a suspect character: one look-up per character of all of them."""
    codes = np.frombuffer("\n".join(values).encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.flatnonzero(_TABLE[codes])
    if not len(at):
        return []
    ends = np.cumsum([len(v) + 1 for v in values])
    return np.unique(np.searchsorted(ends, at, "right")).tolist()


def _spelling(word: str) -> str:
    """The word in the one script all its letters can be written in, Latin first."""
    word = "".join(LATIN_FOR_LATIN.get(c, c) for c in word)
    scripts = {_script(c) for c in word}
    if len(scripts) == 1 and "LATIN" not in scripts:  # whole-script: only if every letter has a Latin double
        if scripts == {"GREEK"} and (len(word) == 1 and word in GREEK_SYMBOLS or any(c.islower() and c != "ο" for c in word)):
            return word
        return "".join(_TO_LATIN[c] for c in word) if all(c in _TO_LATIN for c in word) else word
    for script, table in _DOUBLES_OF.items():
        # small capitals are Latin letters with a double in their own script
        if all(c in table or _script(c) == script for c in word):
            return "".join(table.get(c, c) if script == "LATIN" or _script(c) != script else c for c in word)
    return word


def _respell(match: re.Match) -> str:
    """Spells the letters of a word and puts its marks back where they were."""
    word = match.group()
    if not _FOREIGN.search(word):
        return word
    if not _MARK.search(word):
        return _spelling(word)
    spelled = iter(_spelling(_MARK.sub("", word)))
    return unicodedata.normalize("NFC", "".join(c if _MARK.match(c) else next(spelled) for c in word))


def _class(of: str) -> frozenset[str]:
    """The characters of a class."""
    spans = re.findall(r"(.)(?:-(.))?", of, re.S)
    return frozenset(chr(n) for first, last in spans for n in range(ord(first), ord(last or first) + 1))


#: Characters by what is done with them, so that a value goes only through the steps it needs.
_STEPS = tuple(_class(c) for c in (INVISIBLE, SPACES, HYPHENS, WIDE + DOUBLES + MATH, LETTERLIKE))
_SPECIAL = frozenset().union(*_STEPS)


def _formed(value: str) -> str:
    v, special = value, _SPECIAL.intersection(value)
    if special:
        invisible, spaces, hyphens, width, letterlike = (not special.isdisjoint(c) for c in _STEPS)
        v = _INVISIBLE.sub("", v) if invisible else v
        v = _SPACES.sub(" ", v) if spaces else v
        v = _HYPHENS.sub("-", v) if hyphens else v
        v = _WIDTH.sub(lambda m: unicodedata.normalize("NFKC", m.group()), v) if width else v
        v = unicodedata.normalize("NFC", v)
        if letterlike:
            v = _LETTERLIKE.sub(lambda m: x if len(x := unicodedata.normalize("NFKC", m.group())) == len(m.group()) and x.isalpha() else m.group(), v)
    else:
        v = unicodedata.normalize("NFC", v)
    return _WORD.sub(_respell, v) if _FOREIGN.search(v) else v


def consistent(value: str | None) -> str | None:
    """Null stays null, "" stays ""; a value without suspect characters is returned as it is."""
    if value is None or value.isascii() or not _suspects([value]):
        return value
    return _formed(value)


def consistent_all(values: list[str]) -> list[str]:
    """consistent() of many values, looked through at once."""
    out = list(values)
    for i in _suspects(out):
        out[i] = _formed(out[i])
    return out


@F.pandas_udf(T.StringType())
def _consistent_udf(v: pd.Series) -> pd.Series:
    given = v.notna()
    out = v.astype(object).where(given, None)
    out[given] = consistent_all(v[given].tolist())
    return out


@F.pandas_udf(T.BooleanType())
def _differs(v: pd.Series) -> pd.Series:
    values = [x if isinstance(x, str) else "" for x in v]
    out = np.zeros(len(values), bool)
    for i in _suspects(values):
        out[i] = _formed(values[i]) != values[i]
    return pd.Series(out)


def consistent_form(column: Column | str) -> Column:
    """Column in its consistent form."""
    c = F.col(column) if isinstance(column, str) else column
    return _consistent_udf(c.cast("string"))


def find_inconsistent(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field_name) of every value that differs from its consistent form.

    Nulls and "" never differ.  Rows repeat only if keys do; other columns of df,
    whatever their names, are not touched.  Characters are looked through in whole
    batches, and only values with a suspect one are put into their form.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("v")) for f in fields]))
    long = df.select(F.col(key), pairs.alias("p")).select(key, "p.field_name", "p.v")
    return long.where("v <> ''").where(_differs("v")).select(key, "field_name")
