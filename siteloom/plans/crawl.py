"""A whole crawl over stored pages: extraction, filters and breadth-first expansion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteloom.functions import urls
from siteloom.operators import extract, frontier, robots as R, sitemap as S
from siteloom.operators.dedup import followed_links

# Two readings of the URL rules: what a crawl does, and what its report describes.
PRESETS = {
    "code": {"base": "page", "encode": False, "drop_fragment": False},
    "report": {"base": "document", "encode": True, "drop_fragment": True},
}


def link_edges(
    pages: DataFrame,
    *,
    preset: str = "code",
    domains: list[str] | None = None,
    robots: DataFrame | None = None,
    duplicates: DataFrame | None = None,
    scripts: bool = False,
    engine: str = "native",
) -> DataFrame:
    """Distinct ``(src, dst)`` of canonical URLs that a crawl may follow.

    Links of duplicate pages, links to other domains and links that robots rules
    forbid are left out where the inputs are given.
    """
    found = extract.links(pages, engine=engine, scripts=scripts, **PRESETS[preset])
    if duplicates is not None:
        found = followed_links(found, duplicates)
    if domains is not None:
        found = extract.allowed(found, domains)
    options = {name: value for name, value in PRESETS[preset].items() if name != "base"}
    sources = pages.select("page_id", urls.canonical("url", **options).alias("src"))
    edges = found.join(sources, "page_id").select("src", F.col("canonical_url").alias("dst")).distinct()
    return edges if robots is None else R.permitted(edges, robots, url="dst")


def sitemap_links(robots: DataFrame, sitemaps: DataFrame, hosts: DataFrame) -> DataFrame:
    """``(host, dst)``: the page URLs that each host's sitemap leads to. ``hosts`` needs ``(host, scheme)``."""
    chosen = R.sitemap_choice(hosts, robots, sitemaps).where(F.col("url").isNotNull())
    listed = S.expand(sitemaps, chosen.select("url"))
    roots = chosen.select("host", F.col("url").alias("root_url"))
    return roots.join(listed, "root_url").select("host", urls.canonical("url").alias("dst")).distinct()


def stored_crawl(
    pages: DataFrame,
    seeds: DataFrame,
    *,
    robots: DataFrame | None = None,
    sitemaps: DataFrame | None = None,
    max_level: int | None = None,
    max_pages: int | None = None,
    **edges,
) -> DataFrame:
    """``(url, level)`` of a crawl from the seeds; ``edges`` goes to :func:`link_edges`."""
    host_links = None
    if robots is not None and sitemaps is not None:
        seen = pages.select(urls.authority("url").alias("host"), urls.scheme("url").alias("scheme"))
        hosts = seen.groupBy("host").agg(F.min("scheme").alias("scheme"))
        host_links = sitemap_links(robots, sitemaps, hosts)
    followed = link_edges(pages, robots=robots, **edges)
    start = seeds.select(urls.canonical("url").alias("url"))
    if robots is not None:
        start = R.permitted(start, robots)
    return frontier.bfs(start, followed, max_level=max_level, max_pages=max_pages, host_links=host_links)
