"""Breadth-first expansion, sharding and politeness over a stored corpus."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siteloom.functions import urls
from siteloom.operators import robots as R
from siteloom.operators.ordering import previous_in_group, rank_in_group
from siteloom.operators.skew import MIN_ROWS, hot_keys
from siteloom.session import checkpoint_dir, materialise
from siteloom.sources.keyed import BATCH, KeyTable, buckets_for

def next_level(frontier: DataFrame, links: DataFrame, visited: DataFrame) -> DataFrame:
    """URLs that the frontier links to and that were not visited: ``(url)``.

    ``links`` holds ``(src, dst)``, each of the others ``(url)``.
    """
    reached = frontier.select(F.col("url").alias("src")).join(links, "src")
    return reached.select(F.col("dst").alias("url")).distinct().join(visited.select("url"), "url", "left_anti")


def bfs(
    seeds: DataFrame,
    links: DataFrame,
    *,
    max_level: int | None = None,
    max_pages: int | None = None,
    host_links: DataFrame | None = None,
    hot_rows: int = MIN_ROWS,
) -> DataFrame:
    """``(url, level)`` of all URLs visited from the seeds, level by level.

    ``max_level`` is the number of levels to visit (None: until no URL is new); None is no
    page limit for ``max_pages`` as well.
    A level that would take the total above ``max_pages`` keeps its first URLs
    in text order and the rest is not visited; the levels go on from there.

    ``host_links(host, dst)`` are followed once, when a host is first reached:
    the URLs of its sitemap.

    The links are written once, bucketed by source, and what is visited level by level into a table bucketed alike by
    URL. So a level's URLs meet their links and its targets the visited ones where those lie: only the
    targets are shuffled. Sources with very many links (hubs) lie apart, as no bucket should hold one whole.
    """
    spark = links.sparkSession
    edges = materialise(links.select("src", "dst").where(F.col("dst").isNotNull()))
    hubs = hot_keys(edges, "src", min_rows=hot_rows)
    folder = f"{checkpoint_dir(spark)}/siteloom/{uuid.uuid4().hex}"
    buckets = buckets_for(spark, edges.count())
    by_source = KeyTable(spark, f"{folder}/links", "src string, dst string", "src", buckets)
    visited = KeyTable(spark, f"{folder}/visited", "url string", "url", buckets)
    hosts = None if host_links is None else KeyTable(spark, f"{folder}/hosts", "host string", "host", buckets)
    tables = [table for table in (by_source, visited, hosts) if table is not None]
    try:
        of_hubs = None
        if hubs is not None:
            named = hubs.select(F.col("_hot").alias("src"))
            of_hubs = materialise(edges.join(named, "src", "left_semi"))
            edges = edges.join(named, "src", "left_anti")
        by_source.write(edges, 0)
        if host_links is not None:
            host_links = materialise(host_links.select("host", "dst"))
        total, level = 0, 0
        visited.write(seeds.select("url").distinct(), 0)
        while max_level is None or level < max_level:
            size = visited.at(level).count()
            if max_pages is not None and total + size > max_pages:
                first = rank_in_group(visited.at(level), [], ["url"]).where(F.col("rank") <= max_pages - total)
                visited.write(materialise(first.select("url")), level)
                size = max_pages - total
            if size == 0:
                break
            total += size
            level += 1
            if max_level is not None and level == max_level:
                break
            targets = _host_targets(visited, hosts, host_links, level)
            visited.write_dealt(next_urls(visited, by_source, of_hubs, targets, level), level, append=True)
        return materialise(visited.read(level).select("url", F.col(BATCH).cast("int").alias("level")))
    finally:
        for table in tables:
            table.detach()


def _host_targets(visited: KeyTable, hosts: KeyTable | None, host_links: DataFrame | None, level: int) -> DataFrame | None:
    """``(dst)`` of the hosts that the last level reached first; they are noted as known."""
    if hosts is None:
        return None
    seen = visited.at(level - 1).select(urls.authority("url").alias("host")).where(F.col("host").isNotNull())
    dealt = seen.repartition(hosts.buckets, "host").distinct()
    hosts.write_dealt(dealt.join(hosts.read(level - 1).select("host"), "host", "left_anti"), level - 1, append=True)
    return hosts.at(level - 1).join(host_links, "host").select("dst")


def next_urls(visited: KeyTable, by_source: KeyTable, of_hubs: DataFrame | None, more: DataFrame | None, level: int) -> DataFrame:
    """URLs that the level before ``level`` links to and no earlier one has, dealt as ``visited`` is."""
    sources = visited.at(level - 1).select(F.col("url").alias("src"))
    reached = sources.join(by_source.read(), "src").select("dst")
    if of_hubs is not None:
        reached = reached.unionByName(of_hubs.join(sources, "src").select("dst"))
    if more is not None:
        reached = reached.unionByName(more)
    new = reached.select(F.col("dst").alias("url")).repartition(visited.buckets, "url").distinct()
    return new.join(visited.read(level).select("url"), "url", "left_anti")


def level_counters(visited: DataFrame) -> DataFrame:
    """``(level, n_urls, n_new_next, n_visited)`` per level: its URLs, the new ones it gave, the running total."""
    by_level = Window.orderBy("level")
    # One row per level reaches the window.
    return visited.groupBy("level").agg(F.count("*").alias("n_urls")).select(
        "level",
        "n_urls",
        F.coalesce(F.lead("n_urls").over(by_level), F.lit(0)).alias("n_new_next"),
        F.sum("n_urls").over(by_level).alias("n_visited"),
    )


def new_hosts(visited: DataFrame) -> DataFrame:
    """``(host, first_level)``: the level at which each host was first seen."""
    return visited.groupBy(urls.host_key("url").alias("host")).agg(F.min("level").alias("first_level"))


def host_groups(frontier: DataFrame) -> DataFrame:
    """``(host, n_urls, first_url)`` per host.

    The URLs themselves stay rows: one host may hold too many for one list.
    """
    return frontier.groupBy(urls.host_key("url").alias("host")).agg(
        F.count("*").alias("n_urls"), F.min("url").alias("first_url")
    )


def deal_hosts(frontier: DataFrame, workers: int) -> DataFrame:
    """Add ``host`` and ``shard``: hosts in order, dealt round-robin to min(hosts, workers) shards."""
    if workers < 1:
        raise ValueError("workers must be at least 1")
    keyed = frontier.withColumn("host", urls.host_key("url"))
    ranked = rank_in_group(keyed.select("host").distinct(), [], ["host"], "_no")
    # With fewer hosts than workers the remainder never wraps, which is the same deal.
    shards = ranked.select("host", ((F.col("_no") - 1) % workers).cast("int").alias("shard"))
    return keyed.join(shards, "host")


def schedule(frontier: DataFrame, robots: DataFrame | None = None) -> DataFrame:
    """``(host, url, crawl_delay, fetch_offset)``: seconds after the start at which a URL may be fetched.

    Requests to one host are at least its crawl delay apart.
    """
    keyed = frontier.select(urls.authority("url").alias("host"), "url").distinct()
    ranked = rank_in_group(keyed, ["host"], ["url"], "_no")
    if robots is None:
        delayed = ranked.withColumn("crawl_delay", F.lit(R.DEFAULT_DELAY))
    else:
        delays = R.policies(robots).select("host", "crawl_delay")
        delayed = ranked.join(delays, "host", "left").withColumn(
            "crawl_delay", F.coalesce("crawl_delay", F.lit(R.DEFAULT_DELAY))
        )
    offset = (F.col("_no") - 1) * F.col("crawl_delay")
    return delayed.select("host", "url", "crawl_delay", offset.cast("long").alias("fetch_offset"))


def schedule_after(arrivals: DataFrame, last_access: DataFrame, delays: DataFrame | None = None) -> DataFrame:
    """``(host, url, crawl_delay, fetch_at)`` of ``(url, seen_at)``, in seconds, after what is planned already.

    A host's URLs are fetched in text order, a crawl delay apart, from the first time that one of them was seen
    and its ``last_access`` (if it has one) lies a crawl delay back. ``delays`` holds ``(host, crawl_delay)``.
    """
    keyed = arrivals.select(urls.authority("url").alias("host"), "url", "seen_at").where(F.col("host").isNotNull())
    ranked = rank_in_group(keyed, ["host"], ["url"], "_no")
    first = keyed.groupBy("host").agg(F.min("seen_at").alias("_seen")).join(last_access, "host", "left")
    if delays is None:
        first = first.withColumn("crawl_delay", F.lit(R.DEFAULT_DELAY))
    else:
        first = first.join(delays, "host", "left").withColumn("crawl_delay", F.coalesce("crawl_delay", F.lit(R.DEFAULT_DELAY)))
    begin = F.greatest("_seen", F.col("last_access") + F.col("crawl_delay"))  # a NULL is passed over
    begun = first.select("host", "crawl_delay", begin.cast("long").alias("_begin"))
    fetch_at = F.col("_begin") + (F.col("_no") - 1) * F.col("crawl_delay")
    return ranked.join(begun, "host").select("host", "url", F.col("crawl_delay").cast("int"), fetch_at.cast("long").alias("fetch_at"))


def audit_delays(accesses: DataFrame, delay: float = R.DEFAULT_DELAY) -> DataFrame:
    """Accesses ``(host, accessed_time)`` that follow the one before sooner than the delay allows.

    A column ``crawl_delay`` in the input overrules ``delay`` row by row.
    """
    gaps = previous_in_group(accesses, ["host"], "accessed_time", "previous_time")
    passed = (F.col("accessed_time") - F.col("previous_time")).cast("interval second")
    gaps = gaps.withColumn("gap_seconds", passed.cast("decimal(18,6)").cast("double"))
    wanted = F.col("crawl_delay") if "crawl_delay" in accesses.columns else F.lit(delay)
    return gaps.where(F.col("gap_seconds") < wanted)
