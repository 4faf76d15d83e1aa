"""Scans of landed files."""

from __future__ import annotations

import re
import tomllib
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import dedup
from ..session import exists, listed


def csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A CSV with header as strings, "" for empty; a missing file is an empty table of `columns`.

    A byte order mark is dropped, quoted line breaks and doubled quotes are read right.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns or ["value"]]))
    df = spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=False)
    for c in columns or []:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(""))
    return df.fillna("")


def csv_files(spark: SparkSession, pattern: str, exclude: str | None = None) -> DataFrame:
    """All files of a pattern in name order, with src_ord and row_ord; those matching `exclude` are left out."""
    out = None
    for n, path in enumerate(p for p in listed(spark, pattern) if not (exclude and re.search(exclude, p.rsplit("/", 1)[-1]))):
        one = csv(spark, path).withColumns({"src_ord": F.lit(n), "row_ord": F.monotonically_increasing_id()})
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    if out is None:
        raise FileNotFoundError(pattern)
    return out.fillna("")


def json_lines(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """JSON lines without the broken ones; of equal keys the first in file order."""
    df = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    # Spark packs files and parts of files by size; within a part rows keep their order
    place = {"__file": F.col("_metadata.file_path"), "__part": F.col("_metadata.file_block_start"), "__n": F.monotonically_increasing_id()}
    df = df.select("*", *[c.alias(n) for n, c in place.items()]).where(F.col(key).isNotNull())
    return dedup.keep_first(df, [key], [*place]).drop(*place)


def universe(spark: SparkSession, path: str, table: str) -> DataFrame:
    """ticker, company_name of a TOML table; a missing file or table and bad tickers raise."""
    entries = tomllib.loads(Path(path).read_text(encoding="utf-8")).get(table)
    if not entries:
        raise ValueError(f"no table [{table}] in {path}")
    bad = [t for t in entries if not re.fullmatch(r"[A-Z0-9]{3,5}", t)]
    if bad:
        raise ValueError(f"bad tickers: {bad}")
    return spark.createDataFrame(list(entries.items()), "ticker string, company_name string")


def files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Path, length and bytes of the files of a folder."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "length", "content")


def pdf_texts(listing: DataFrame, extract=None, max_chars: int = 30_000) -> DataFrame:
    """path, body of PDF files; `extract(bytes) -> str` defaults to PyMuPDF where it is installed.

    A file that cannot be read has the body "".
    """
    if extract is None:
        try:
            import pymupdf
        except ImportError as e:
            raise RuntimeError("no PDF library here; pass extract") from e

        def extract(data: bytes) -> str:
            with pymupdf.open(stream=data, filetype="pdf") as doc:
                return "\n".join(page.get_text() for page in doc)

    from ..functions.text import dehyphenate, normalize_body

    def one(data: bytes | None) -> str:
        try:
            return extract(data) or "" if data else ""
        except Exception:
            return ""

    def bodies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            yield pd.DataFrame({"path": files["path"], "text": [one(x) for x in files["content"]]})

    texts = listing.select("path", "content").mapInPandas(bodies, "path string, text string")
    return texts.select("path", normalize_body(dehyphenate(F.col("text")), max_chars).alias("body"))
