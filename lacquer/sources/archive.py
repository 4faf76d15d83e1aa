"""Files beside the tables: raw payloads, snapshots, documents on disk and what failed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ident, text
from ..session import exists
from . import readers

#: Files of at most so many bytes are no documents.
LEAST_BYTES = 1000


def keep_raw(payloads: DataFrame, path: str, key: str = "document_id", content: str = "payload") -> DataFrame:
    """Stores the payloads by document and gives (document_id, raw_path); one copy per document.

    The store is a table: a document's payload is found by its id, whatever its number.
    """
    rows = payloads.select(F.col(key).alias("document_id"), F.col(content).alias("payload")).where("document_id is not null")
    rows = rows.groupBy("document_id").agg(F.max("payload").alias("payload"))
    rows.write.mode("append").parquet(path)
    return rows.select("document_id", F.concat(F.lit(path.rstrip("/") + "/"), "document_id").alias("raw_path"))


def write_snapshot(df: DataFrame, path: str) -> None:
    """A table as JSON lines, replaced as a whole."""
    df.write.mode("overwrite").json(path)


def file_names(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """file, length of the files of a folder; an absent folder is empty."""
    if not exists(spark, path):
        return spark.createDataFrame([], "file string, length long")
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return listing.select(F.url_decode(F.element_at(F.split("path", "/"), -1)).alias("file"), "length")


def with_local_file(rows: DataFrame, files: DataFrame, name: str = "pdf_filename") -> DataFrame:
    """Rows whose named file is there; blank names are not."""
    names = files.select(F.col("file").alias("__file")).distinct()
    return rows.where(F.trim(F.coalesce(name, F.lit(""))) != "").join(names, F.trim(name) == F.col("__file"), "left_semi")


def document_name(title: Column, date: Column, url: Column) -> Column:
    """{date}_{title}__{number}.pdf where the url names a document number, else {date}_{title}.pdf."""
    base = text.pdf_filename(title, date)
    number = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?i)downloadedoc/(\d+)", 1)
    return F.when(number == "", base).otherwise(F.concat(F.regexp_replace(base, r"\.pdf$", ""), F.lit("__"), number, F.lit(".pdf")))


def reconciled(rows: DataFrame, files: DataFrame) -> DataFrame:
    """rows (title, date, pdf_url, pdf_filename) with blank file names filled where the old name is there and large enough."""
    large = files.where(F.col("length") > LEAST_BYTES).select(F.col("file").alias("__old")).distinct()
    blank = (F.trim(F.coalesce("pdf_filename", F.lit(""))) == "") & (F.trim(F.coalesce("pdf_url", F.lit(""))) != "")
    old = F.when(blank, text.pdf_filename(F.coalesce("title", F.lit("")), F.coalesce("date", F.lit(""))))
    joined = rows.withColumn("__name", old).join(large, F.col("__name") == F.col("__old"), "left")
    return joined.withColumn("pdf_filename", F.coalesce("__old", "pdf_filename")).drop("__name", "__old")


def outstanding(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Rows with a document url and no file yet: what a run has to fetch."""
    names = files.select(F.col("file").alias("__file")).distinct()
    wanted = rows.where(F.trim(F.coalesce("pdf_url", F.lit(""))) != "")
    return wanted.join(names, F.trim(F.coalesce("pdf_filename", F.lit(""))) == F.col("__file"), "left_anti")


def failure_lines(rows: DataFrame) -> DataFrame:
    """value: url, tab, the first 60 characters of the title, per document that could not be fetched."""
    return rows.select(F.concat(F.trim(F.coalesce("pdf_url", F.lit(""))), F.lit("\t"), F.substring(F.coalesce("title", F.lit("")), 1, 60)).alias("value"))


def document_bodies(listing: DataFrame, cache: DataFrame, extract=None, max_chars: int = 30_000) -> tuple[DataFrame, DataFrame]:
    """(bodies, cache): (path, body) of all files, and the cache with what was new.

    A cached file is not read again; a file without text is not cached, so it is tried again.
    """
    known = cache.select("path", "body")
    fresh = readers.pdf_texts(listing.join(known.select("path"), "path", "left_anti"), extract, max_chars)
    kept = known.unionByName(fresh.where("body <> ''"))
    return listing.select("path").join(known.unionByName(fresh), "path", "left"), kept


def body_key(source: str, rows: DataFrame) -> Column:
    """Path of a row's document under the data folder: by file name, or by id where the source names files so."""
    if source == "ssi":
        return F.concat(F.lit("pdf_ssi/"), ident.short_id(F.col("url")) if "id" not in rows.columns else F.col("id"), F.lit(".pdf"))
    return F.when(F.trim(F.coalesce("pdf_filename", F.lit(""))) != "", F.concat(F.lit("pdf/"), F.trim("pdf_filename")))
