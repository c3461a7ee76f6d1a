"""Canonical URL tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteloom.functions import urls


def canonicalise(df: DataFrame, url: str = "url", **options) -> DataFrame:
    """Add the parts of a URL column, its canonical form, host key, extension and file name.

    ``options`` are those of :func:`siteloom.functions.urls.canonical`.
    """
    parts = urls.split(url)
    return df.select(
        "*",
        parts.scheme.alias("scheme"),
        parts.authority.alias("authority"),
        parts.path.alias("path"),
        parts.query.alias("query"),
        parts.fragment.alias("fragment"),
        urls.canonical(url, **options).alias("canonical_url"),
        urls.host_key(url).alias("host"),
        urls.extension(url).alias("ext"),
        urls.file_name(url).alias("filename"),
    )


def collapse(df: DataFrame, page_id: str = "page_id", by: str = "canonical_url") -> DataFrame:
    """One row per canonical URL with the number of pages behind it and the first of them."""
    return df.groupBy(by).agg(F.count("*").alias("n_pages"), F.min(page_id).alias("first_page_id"))


def distinct_urls(df: DataFrame, by: str = "canonical_url") -> DataFrame:
    """The set of canonical URLs."""
    return df.select(by).distinct()
