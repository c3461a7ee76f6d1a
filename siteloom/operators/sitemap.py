"""Sitemap texts as tables of locations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteloom.functions import urls
from siteloom.functions.html import decode_entities
from siteloom.session import materialise

LOCATION = r"(?is)<loc(?:\s[^>]*)?>\s*(?:<!\[CDATA\[)?\s*(.*?)\s*(?:\]\]>)?\s*</loc\s*>"


def locations(sitemaps: DataFrame) -> DataFrame:
    """``(sitemap_url, pos, loc)`` for every location of every sitemap text.

    Works on malformed XML, where an XML parser would fail the job.
    """
    found = sitemaps.select(
        F.col("url").alias("sitemap_url"),
        F.posexplode(F.regexp_extract_all("content", F.lit(LOCATION), F.lit(1))).alias("pos", "loc"),
    )
    return found.withColumn("loc", decode_entities(F.col("loc"))).where(F.col("loc") != "")


def is_nested(url: Column | str) -> Column:
    """Does a location look like another sitemap?"""
    path = urls.bare_path(url)
    return path.endswith(".xml") & F.contains(path, F.lit("sitemap"))


def closures(locs: DataFrame, entries: DataFrame, max_depth: int | None = None) -> DataFrame:
    """``(entry, sitemap_url)``: the sitemaps that each entry leads to, itself included.

    ``locs`` holds ``(sitemap_url, url, nested)``, ``entries`` ``(entry)``. Followed level by level until none is
    new, so cycles end; ``max_depth`` bounds the number of levels.
    """
    inner = materialise(locs.where("nested").select("sitemap_url", "url"))
    last = materialise(entries.select("entry", F.col("entry").alias("sitemap_url")).distinct())
    reached, depth = last, 1
    while max_depth is None or depth < max_depth:
        following = last.join(inner, "sitemap_url").select("entry", F.col("url").alias("sitemap_url")).distinct()
        last = materialise(following.join(reached, ["entry", "sitemap_url"], "left_anti"))
        if last.isEmpty():
            break
        reached, depth = reached.unionByName(last), depth + 1
    return reached


def expand(sitemaps: DataFrame, roots: DataFrame, max_depth: int | None = None) -> DataFrame:
    """``(root_url, url)``: the distinct page URLs that each root sitemap leads to.

    ``max_depth`` bounds the number of levels. A nested sitemap whose text is not stored gives no URLs.
    ``roots`` needs ``url``. The nested sitemaps that roots name (the entries) are followed once each, however many
    roots name them, and their pages are then joined to the roots.
    """
    locs = materialise(
        locations(sitemaps).select("sitemap_url", F.col("loc").alias("url")).distinct()
        .withColumn("nested", is_nested("url"))
    )
    asked = roots.select(F.col("url").alias("root_url")).distinct()
    if max_depth is not None and max_depth < 1:
        return asked.limit(0).select("root_url", F.col("root_url").alias("url"))
    first = materialise(asked.join(locs.withColumnRenamed("sitemap_url", "root_url"), "root_url"))
    own = first.where(~F.col("nested")).select("root_url", "url")
    named = first.where("nested").select("root_url", F.col("url").alias("entry"))
    if max_depth == 1 or named.isEmpty():
        return own.distinct()
    reached = closures(locs, named.select("entry"), None if max_depth is None else max_depth - 1)
    leaves = locs.where(~F.col("nested")).select("sitemap_url", "url")
    pages = materialise(reached.join(leaves, "sitemap_url").select("entry", "url").distinct())
    return named.join(pages, "entry").select("root_url", "url").unionByName(own).distinct()


def frontier_urls(links: DataFrame, sitemap_urls: DataFrame, **canonical) -> DataFrame:
    """``canonical_url`` of page links and sitemap URLs together, each once."""
    listed = sitemap_urls.select(urls.canonical("url", **canonical).alias("canonical_url"))
    return links.select("canonical_url").unionByName(listed).distinct()
