"""Identities: canonical URLs and hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import checksum_normalize

# Query keys that say how a reader came, and beginnings of such keys.
TRACKING_KEYS = ("gclid", "fbclid", "ref", "ref_src")
TRACKING_PREFIXES = ("utm_", "mc_")


def _decode(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), c)


def _encode(c: Column) -> Column:
    return F.replace(F.replace(F.url_encode(c), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def canonicalize_url(url: Column) -> Column:
    """One spelling per page: scheme and host in lower case, no fragment, no closing
    slash, query without blank and tracking parameters, keys in lower case, sorted."""
    u = F.regexp_replace(F.trim(F.coalesce(url, F.lit(""))), "#.*$", "")
    head = F.regexp_extract(u, r"^([^?]*)", 1)
    query = F.regexp_extract(u, r"^[^?]*\?(.*)$", 1)
    site = F.regexp_extract(head, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)", 1)
    path = F.regexp_replace(F.substr(head, F.length(site) + 1), "/+$", "")
    path = F.when((path == "") & (site != ""), "/").otherwise(path)
    pairs = F.transform(F.split(query, "&"), lambda p: F.struct(
        F.lower(_decode(F.substring_index(p, "=", 1))).alias("k"),
        F.when(F.contains(p, F.lit("=")), _decode(F.regexp_replace(p, "^[^=]*=", ""))).otherwise("").alias("v"),
    ))
    tracking = lambda p: p["k"].isin(*TRACKING_KEYS) | F.reduce(
        F.array(*[F.startswith(p["k"], F.lit(x)) for x in TRACKING_PREFIXES]), F.lit(False), lambda a, b: a | b
    )
    kept = F.array_sort(F.filter(pairs, lambda p: (p["v"] != "") & ~tracking(p)))
    text = F.array_join(F.transform(kept, lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"]))), "&")
    return F.concat(F.lower(site), path, F.when(text != "", F.concat(F.lit("?"), text)).otherwise(""))


def compute_checksum(text: Column, compose: bool = True) -> Column:
    return F.sha2(checksum_normalize(text, compose), 256)


def document_id(source: Column, url: Column) -> Column:
    return F.substring(F.sha1(F.concat_ws("|", source, canonicalize_url(url))), 1, 16)


def short_id(url: Column) -> Column:
    return F.substring(F.md5(url), 1, 12)


def article_number(url: Column) -> Column:
    """Number of 17 to 20 digits before the closing .chn, else ""."""
    return F.regexp_extract(url, r"-(\d{17,20})\.chn(?:[?#]|$)", 1)
