"""Queries over robots rules, sitemaps and the frontier."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog import derived as D
from catalog.derived import part, sql_canonical, sql_host
from catalog.registry import query
from catalog.url_queries import PAGE_LINKS
from siteloom.functions import urls
from siteloom.operators import canonical, extract, frontier, robots, sitemap
from siteloom.plans import crawl
from siteloom.session import checkpoint_dir
from siteloom.streaming.politeness import FetchPlan


@query(f"""WITH {D.ROBOT_LINES} SELECT r.host, a.value AS agent, r.line_no::INT AS rule_no,
    r.key = 'allow' OR r.value = '' AS allow, r.value AS path
  FROM lines r JOIN lines a USING (host, group_no) WHERE a.key = 'user-agent' AND r.key IN ('allow', 'disallow')""")
def robots_rules(spark, sf):
    return robots.rules(D.robots(spark, sf)).drop("group_no")


FIRST_RULE = f"""{D.ROBOT_LINES}, rules AS (
  SELECT host, line_no, key = 'allow' OR value = '' AS allow, value AS path FROM mine WHERE key IN ('allow', 'disallow')), verdict AS (
  SELECT p.page_id, p.url, p.host, coalesce(arg_min(r.allow, r.line_no), true) AS allow
  FROM (SELECT page_id, url, {part('url', 2)} AS host, {part('url', 3)} AS path FROM pages) p
  LEFT JOIN rules r ON r.host = p.host AND starts_with(p.path, r.path) GROUP BY ALL)"""


@query(f"WITH {FIRST_RULE} SELECT page_id, host, allow FROM verdict")
def robots_allow(spark, sf):
    pages = D.pages(spark, sf).select("page_id", "url")
    return robots.with_permission(pages, D.robots(spark, sf)).select("page_id", "host", "allow")


@query(f"WITH {FIRST_RULE} SELECT page_id, url FROM verdict WHERE allow")
def robots_frontier(spark, sf):
    return robots.permitted(D.pages(spark, sf).select("page_id", "url"), D.robots(spark, sf))


@query(f"""WITH {D.ROBOT_LINES} SELECT r.host,
    coalesce((SELECT arg_max(value::INT, line_no) FROM mine m WHERE m.host = r.host AND key = 'crawl-delay' AND regexp_matches(value, '^[0-9]+$')), 3) AS crawl_delay,
    (SELECT arg_max(split_part(value, '/', 1)::INT, line_no) FROM mine m WHERE m.host = r.host AND key = 'request-rate') AS req_num,
    (SELECT arg_max(split_part(value, '/', 2)::INT, line_no) FROM mine m WHERE m.host = r.host AND key = 'request-rate') AS req_secs,
    (SELECT arg_max(value, line_no) FROM keyed k WHERE k.host = r.host AND key = 'sitemap') AS sitemap_url
  FROM robots r""")
def robots_policies(spark, sf):
    return robots.policies(D.robots(spark, sf)).drop("rules")


CHOICE = f"""{D.ROBOT_LINES}, named AS (
  SELECT host, arg_max(value, line_no) AS loc FROM keyed WHERE key = 'sitemap' GROUP BY host), {D.SITEMAPS}, chosen AS (
  SELECT h.host, h.scheme, CASE WHEN a.url IS NOT NULL THEN n.loc WHEN b.url IS NOT NULL THEN b.url END AS url, coalesce(a.content, b.content) AS content
  FROM host_facts h LEFT JOIN named n USING (host) LEFT JOIN sitemaps a ON a.url = n.loc
  LEFT JOIN sitemaps b ON b.url = h.scheme || '://' || h.host || '/sitemap.xml')"""


@query(f"WITH {CHOICE} SELECT host, url, content FROM chosen")
def sitemap_choice(spark, sf):
    hosts = D.host_facts(spark, sf).select("host", "scheme")
    return robots.sitemap_choice(hosts, D.robots(spark, sf), D.sitemaps(spark, sf))


@query(f"""WITH {CHOICE}, known AS (SELECT DISTINCT {part('url', 2)} AS domain FROM pages WHERE page_id % 7 = 0)
  SELECT host AS domain, r.content AS robots_content, c.content AS sitemap_content
  FROM chosen c JOIN robots r USING (host) WHERE host NOT IN (SELECT domain FROM known)""")
def site_rows(spark, sf):
    pages = D.pages(spark, sf).select("page_id", "url")
    known = pages.where(F.col("page_id") % 7 == 0).select(urls.authority("url").alias("domain"))
    return robots.site_rows(pages, D.robots(spark, sf), D.sitemaps(spark, sf), known)


LOCS = f"""{D.HOST_FACTS}, {D.SITEMAPS}, locs AS (
  SELECT DISTINCT url AS sitemap_url, replace(trim(unnest(regexp_extract_all(content, '<loc>([^<]*)</loc>', 1))), '&amp;', '&') AS loc FROM sitemaps), typed AS (
  SELECT *, {part('loc', 3)} LIKE '%.xml' AND {part('loc', 3)} LIKE '%sitemap%' AS nested FROM locs)"""


@query(f"WITH {LOCS} SELECT sitemap_url, loc, nested FROM typed")
def sitemap_locs(spark, sf):
    found = sitemap.locations(D.sitemaps(spark, sf)).select("sitemap_url", "loc").distinct()
    return found.withColumn("nested", sitemap.is_nested("loc"))


EXPANDED = f"""WITH RECURSIVE {LOCS}, roots2 AS (
  SELECT url FROM roots), walk(root_url, sitemap_url) AS (
  SELECT url, url FROM roots2 UNION SELECT w.root_url, t.loc FROM walk w JOIN typed t USING (sitemap_url) WHERE t.nested), reached AS (
  SELECT DISTINCT w.root_url, t.loc AS url FROM walk w JOIN typed t USING (sitemap_url) WHERE NOT t.nested)"""


def _roots(spark, sf):
    found = D.sitemaps(spark, sf).select("url")
    return found.where(urls.path("url").isin("/sitemap.xml", "/robots-sitemap.xml"))


@query(f"{EXPANDED} SELECT root_url, url FROM reached")
def sitemap_nested(spark, sf):
    return sitemap.expand(D.sitemaps(spark, sf), _roots(spark, sf))


@query(f"""{EXPANDED}, {PAGE_LINKS} SELECT {sql_canonical('url')} AS canonical_url FROM reached UNION SELECT canonical_url FROM links""")
def sitemap_frontier(spark, sf):
    links = extract.links(D.pages(spark, sf))
    return sitemap.frontier_urls(links, sitemap.expand(D.sitemaps(spark, sf), _roots(spark, sf)))


# --- breadth-first levels ------------------------------------------------------------------------

LEVELS = f"""WITH RECURSIVE {D.EDGES}, walk(id, level) AS (
  SELECT page_id, 0 FROM pages WHERE page_id IN (0, 1)
  UNION SELECT e.dst, w.level + 1 FROM walk w JOIN edges e ON e.src = w.id WHERE w.level < 5), first AS (
  SELECT id, min(level) AS level FROM walk GROUP BY id), visited AS (
  SELECT url, level FROM first JOIN pages ON page_id = id)"""


def _seeds(spark, sf):
    return D.pages(spark, sf).where(F.col("page_id").isin(0, 1)).select("url")


def _visited(spark, sf):
    return frontier.bfs(_seeds(spark, sf), D.url_edges(spark, sf), max_level=6)


@query(f"{LEVELS} SELECT url, level FROM visited")
def bfs_levels(spark, sf):
    return _visited(spark, sf)


@query(f"""WITH RECURSIVE {D.EDGES}, reach(id) AS (
  SELECT page_id FROM pages WHERE page_id IN (0, 1) UNION SELECT e.dst FROM reach r JOIN edges e ON e.src = r.id)
  SELECT url FROM reach JOIN pages ON page_id = id""")
def bfs_fixpoint(spark, sf):
    """All URLs that can be reached, until no level is new."""
    return frontier.bfs(_seeds(spark, sf), D.url_edges(spark, sf)).select("url")


@query(f"{LEVELS} SELECT url, level FROM visited WHERE level = 0 UNION ALL SELECT DISTINCT url, 1 FROM visited WHERE level = 1")
def bfs_one_level(spark, sf):
    seeds = _seeds(spark, sf).withColumn("level", F.lit(0))
    new = frontier.next_level(seeds, D.url_edges(spark, sf), seeds)
    return seeds.unionByName(new.withColumn("level", F.lit(1)))


@query(f"""{LEVELS}, size AS (SELECT level, count(*) AS k FROM visited GROUP BY 1), total AS (
    SELECT level, k, sum(k) OVER (ORDER BY level) AS upto FROM size), placed AS (
    SELECT v.url, v.level, t.upto - t.k + row_number() OVER (PARTITION BY v.level ORDER BY v.url) AS place, t.upto - t.k AS before FROM visited v JOIN total t USING (level)), cut AS (
    SELECT min(level) AS level FROM total WHERE upto > 20)
  SELECT url, p.level FROM placed p, cut WHERE place <= 20 AND p.level <= cut.level""")
def bfs_capped(spark, sf):
    # The level that passes the cap keeps its first URLs; from those the cap lets nothing follow.
    return frontier.bfs(_seeds(spark, sf), D.url_edges(spark, sf), max_level=6, max_pages=20)


@query(f"""{LEVELS}, c AS (SELECT level, count(*) AS n_urls FROM visited GROUP BY 1)
  SELECT level, n_urls, coalesce(lead(n_urls) OVER (ORDER BY level), 0)::BIGINT AS n_new_next, (sum(n_urls) OVER (ORDER BY level))::BIGINT AS n_visited FROM c""")
def level_counts(spark, sf):
    return frontier.level_counters(_visited(spark, sf))


@query(f"{LEVELS} SELECT {sql_host()} AS host, min(level) AS first_level FROM visited GROUP BY 1")
def new_hosts_by_level(spark, sf):
    return frontier.new_hosts(_visited(spark, sf))


@query(f"WITH {PAGE_LINKS} SELECT DISTINCT canonical_url FROM links")
def link_merge(spark, sf):
    return canonical.distinct_urls(extract.links(D.pages(spark, sf)))


CRAWL_EDGES = f"""{FIRST_RULE}, {PAGE_LINKS}, added AS (
  SELECT page_id, unnest(['/en/1', '/fr/x', '/en/2/y', '/zz?a#b']) AS raw, * EXCLUDE (page_id) FROM pages), made AS (
  SELECT {sql_canonical('url')} AS src, lower({part('url', 1)}) || '://' || {part('url', 2)} || raw AS resolved FROM added WHERE page_id % 5 <> 0), canon AS (
  SELECT DISTINCT src, {sql_canonical('resolved')} AS dst FROM made
  UNION SELECT {sql_canonical('p.url')}, l.canonical_url FROM links l JOIN pages p USING (page_id) WHERE page_id % 5 <> 0)"""


@query(f"""WITH {CRAWL_EDGES} SELECT src, dst FROM (
    SELECT c.src, c.dst, arg_min(r.allow, r.line_no) AS allow FROM canon c
    LEFT JOIN rules r ON r.host = {part('c.dst', 2)} AND starts_with({part('c.dst', 3)}, r.path)
    WHERE regexp_matches({part('c.dst', 2)}, '(^|\\.)example\\.(org|com)$') GROUP BY ALL) WHERE coalesce(allow, true)""")
def crawl_edges(spark, sf):
    """Links of pages that are no duplicates, to allowed domains, permitted by robots rules."""
    anchors = F.concat(*[F.lit(f'<a href="{href}">l</a>') for href in ("/en/1", "/fr/x", "/en/2/y", "/zz?a#b")])
    made = D.pages(spark, sf).select("page_id", "url", F.concat("html", anchors).alias("html"))
    duplicates = made.where(F.col("page_id") % 5 == 0).select("page_id")
    return crawl.link_edges(
        made, domains=["example.org", "example.com"], robots=D.robots(spark, sf), duplicates=duplicates
    )


STORED_CRAWL = f"""WITH RECURSIVE {CHOICE}, locs AS (
  SELECT DISTINCT url AS sitemap_url, replace(trim(unnest(regexp_extract_all(content, '<loc>([^<]*)</loc>', 1))), '&amp;', '&') AS loc FROM sitemaps), typed AS (
  SELECT *, {part('loc', 3)} LIKE '%.xml' AND {part('loc', 3)} LIKE '%sitemap%' AS nested FROM locs), walk(host, sitemap_url) AS (
  SELECT host, url FROM chosen WHERE url IS NOT NULL UNION SELECT w.host, t.loc FROM walk w JOIN typed t USING (sitemap_url) WHERE t.nested), listed AS (
  SELECT DISTINCT w.host, {sql_canonical('t.loc')} AS dst FROM walk w JOIN typed t USING (sitemap_url) WHERE NOT t.nested), {PAGE_LINKS}, rules AS (
  SELECT host, line_no, key = 'allow' OR value = '' AS allow, value AS path FROM mine WHERE key IN ('allow', 'disallow')), edges AS (
  SELECT DISTINCT {sql_canonical('p.url')} AS src, l.canonical_url AS dst FROM links l JOIN pages p USING (page_id)), asked AS (
  SELECT {sql_canonical('url')} AS url FROM pages UNION SELECT dst FROM edges), permitted AS (
  SELECT a.url FROM asked a LEFT JOIN rules r ON r.host = {part('a.url', 2)} AND starts_with({part('a.url', 3)}, r.path)
  GROUP BY a.url HAVING coalesce(arg_min(r.allow, r.line_no), true)), zero AS (
  SELECT DISTINCT {sql_canonical('url')} AS url FROM pages WHERE {sql_canonical('url')} IN (SELECT url FROM permitted)), one AS (
  SELECT dst AS url FROM edges WHERE src IN (SELECT url FROM zero) AND dst IN (SELECT url FROM permitted)
  UNION SELECT dst FROM listed WHERE host IN (SELECT {part('url', 2)} FROM zero))"""


@query(f"{STORED_CRAWL} SELECT url, 0 AS level FROM zero UNION ALL SELECT url, 1 FROM one WHERE url NOT IN (SELECT url FROM zero)")
def stored_crawl(spark, sf):
    """The whole crawl over the stored pages, with robots rules and sitemaps, for two levels."""
    pages = D.pages(spark, sf)
    return crawl.stored_crawl(
        pages, pages.select("url"), robots=D.robots(spark, sf), sitemaps=D.sitemaps(spark, sf), max_level=2, max_pages=None
    )


# --- hosts and politeness ------------------------------------------------------------------------


@query(f"SELECT {sql_host()} AS host, count(*) AS n_urls, min(url) AS first_url FROM pages GROUP BY 1")
def host_groups(spark, sf):
    return frontier.host_groups(spark.read.parquet(f"{sf}/pages.parquet"))


@query(f"""WITH h AS (SELECT page_id, {sql_host()} AS host FROM pages), d AS (
    SELECT host, ((row_number() OVER (ORDER BY host) - 1) % 7)::INT AS shard FROM (SELECT DISTINCT host FROM h))
  SELECT page_id, host, shard FROM h JOIN d USING (host)""")
def host_shards(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")
    return frontier.deal_hosts(pages, 7).select("page_id", "host", "shard")


@query(f"""WITH {D.ROBOT_LINES}, p AS (SELECT host, coalesce(max(CASE WHEN key = 'crawl-delay' AND regexp_matches(value, '^[0-9]+$') THEN value::INT END), 3) AS crawl_delay
    FROM robots LEFT JOIN mine USING (host) GROUP BY host)
  SELECT u.host, url, crawl_delay, ((row_number() OVER (PARTITION BY u.host ORDER BY url) - 1) * crawl_delay)::BIGINT AS fetch_offset
  FROM (SELECT DISTINCT {part('url', 2)} AS host, url FROM pages) u JOIN p USING (host)""")
def fetch_schedule(spark, sf):
    return frontier.schedule(D.pages(spark, sf).select("url"), D.robots(spark, sf))


@query(f"""WITH {D.ROBOT_LINES}, p AS (SELECT host, coalesce(max(CASE WHEN key = 'crawl-delay' AND regexp_matches(value, '^[0-9]+$') THEN value::INT END), 3) AS crawl_delay
    FROM robots LEFT JOIN mine USING (host) GROUP BY host)
  SELECT u.host, url, crawl_delay, ((row_number() OVER (PARTITION BY u.host ORDER BY batch, url) - 1) * crawl_delay)::BIGINT AS fetch_at
  FROM (SELECT {part('url', 2)} AS host, url, min(page_id % 3) AS batch FROM pages GROUP BY ALL) u JOIN p USING (host)""")
def fetch_schedule_batches(spark, sf):
    """The URLs come in three batches, the last one with those of the first again; accesses of a host go on from batch to batch."""
    plan = FetchPlan(spark, f"{checkpoint_dir(spark)}/siteloom/{uuid.uuid4().hex}", D.robots(spark, sf))
    seen = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", F.lit(0).cast("long").alias("seen_at"))
    for batch in range(3):
        plan.add(seen.where(F.col("page_id") % 3 == batch), batch)
    plan.add(seen.where(F.col("page_id") % 3 == 0), 3)
    return plan.planned().select("host", "url", "crawl_delay", "fetch_at")


@query("""WITH g AS (SELECT user_id::VARCHAR AS host, ts AS accessed_time,
    epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS us FROM events)
  SELECT host, accessed_time, round(us / 1e6, 6) AS gap_seconds FROM g WHERE us < 600000000""")
def politeness_audit(spark, sf):
    """The users of the event table stand for hosts; their delay is ten minutes."""
    accesses = spark.read.parquet(f"{sf}/events.parquet").select(
        F.col("user_id").cast("string").alias("host"), F.col("ts").cast("timestamp_ntz").alias("accessed_time")
    )
    audited = frontier.audit_delays(accesses, 600)
    return audited.select("host", "accessed_time", F.round("gap_seconds", 6).alias("gap_seconds"))
