"""Tables that the queries derive from the given ones, in Spark and in SQL.

The given pages hold anchors only, so robots texts, sitemaps, images, base
URLs, scripts and responses are made from their URLs and ids by the same rule
on both sides, one row per page or host: they grow with the pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteloom.functions import urls
from siteloom.sources.tables import scan

PATTERN = urls.SPLIT.replace("'", "''")


def part(text: str, k: int) -> str:
    return f"regexp_extract({text}, '{PATTERN}', {k})"


def sql_www(text: str) -> str:
    return f"replace(replace({text}, 'http://www.', 'http://'), 'https://www.', 'https://')"


def sql_host(text: str = "url") -> str:
    return part(sql_www(text), 2)


def sql_canonical(text: str) -> str:
    """Canonical form in SQL, from the parts of ``text``."""
    f, q, p = part(text, 5), part(text, 4), part(text, 3)
    q2 = f"CASE WHEN {f} = '' THEN regexp_replace({q}, '/$', '') ELSE {q} END"
    p2 = f"CASE WHEN {f} = '' AND {q} = '' THEN regexp_replace({p}, '/$', '') ELSE {p} END"
    f2 = f"regexp_replace({f}, '/$', '')"
    path = f"'/' || coalesce(array_to_string(list_slice(string_split({p2}, '/'), 2, 11), '/'), '')"
    whole = (
        f"lower({part(text, 1)}) || '://' || {part(text, 2)} || {path}"
        f" || CASE WHEN ({q2}) = '' THEN '' ELSE '?' || ({q2}) END"
        f" || CASE WHEN {f2} = '' THEN '' ELSE '#' || {f2} END"
    )
    return sql_www(f"({whole})")


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, f"{sf}/pages.parquet", "page_id")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, f"{sf}/documents.parquet", "doc_id")


# --- pages with images, scripts and base URLs ----------------------------------------------


def rich_pages(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("page_id").cast("string")
    base = F.concat(F.lit('<base href="http://b'), (F.col("page_id") % 3).cast("string"), F.lit('.example.org/dir/">'))
    html = F.concat(
        F.when(F.col("page_id") % 2 == 0, base).otherwise(""),
        F.col("html"),
        F.lit('<img src="/img/'), n, F.lit('.png"><img src="pic'), n,
        F.lit(".jpg\"><img src='/x.gif'><img alt=\"none\"><!-- <img src=\"/hidden.png\"> -->"),
        F.lit("<button onclick=\"window.location.href = 'http://www.r"), (F.col("page_id") % 4).cast("string"),
        F.lit(".example.com/go'\">b</button><a href=\"#\" onclick=\"self.location='http://www.s.example.com/"), n,
        F.lit("/'\">c</a><button onclick=\"window.location.assign('http://t.example.net/x')\">d</button>"),
        F.lit('<a href="?q='), n, F.lit('&amp;z=1#f">e</a><a href="mailto:x@a.si">m</a>'),
    )
    return pages(spark, sf).select("page_id", "url", html.alias("html"))


# --- robots and sitemaps -----------------------------------------------------------------------


def host_facts(spark: SparkSession, sf: str) -> DataFrame:
    seen = pages(spark, sf).select(urls.authority("url").alias("host"), urls.path("url").alias("path"), urls.scheme("url").alias("scheme"))
    return seen.groupBy("host").agg(
        F.min("path").alias("low"), F.max("path").alias("high"), F.count("*").alias("n"), F.min("scheme").alias("scheme")
    )


HOST_FACTS = f"""host_facts AS (
  SELECT {part('url', 2)} AS host, min({part('url', 3)}) AS low, max({part('url', 3)}) AS high,
         count(*) AS n, min(lower({part('url', 1)})) AS scheme
  FROM pages GROUP BY 1)"""


def robots(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("n")
    content = F.concat(
        F.when(n % 3 == 0, F.lit("Disallow: /\n\n")).otherwise(F.lit("SITEMAP: http://early.example.com/s.xml\n")),
        F.lit("User-agent: other\nUser-Agent: *  # all\nDisallow: "), F.col("low"),
        F.lit("\nAllow: /en/2\nDisallow: /en%2F\n \nAllow: "), F.col("high"), F.lit("\nDisallow:\nCrawl-delay: "),
        F.when(n % 4 == 1, F.lit("x")).otherwise(n.cast("string")),
        F.lit("\nRequest-rate: "), n.cast("string"), F.lit("/20\n\nUser-agent: *\nDisallow: /fr\n"),
        F.when(n % 2 == 0, F.concat(F.lit("Sitemap: "), F.col("scheme"), F.lit("://"), F.col("host"), F.lit("/robots-sitemap.xml"))).otherwise(""),
    )
    return host_facts(spark, sf).select("host", content.alias("content"))


ROBOTS = f"""{HOST_FACTS}, robots AS (
  SELECT host, CASE WHEN n % 3 = 0 THEN 'Disallow: /' || chr(10) || chr(10)
                    ELSE 'SITEMAP: http://early.example.com/s.xml' || chr(10) END
    || 'User-agent: other' || chr(10) || 'User-Agent: *  # all' || chr(10) || 'Disallow: ' || low
    || chr(10) || 'Allow: /en/2' || chr(10) || 'Disallow: /en%2F' || chr(10) || ' ' || chr(10) || 'Allow: ' || high
    || chr(10) || 'Disallow:' || chr(10) || 'Crawl-delay: ' || CASE WHEN n % 4 = 1 THEN 'x' ELSE n::VARCHAR END
    || chr(10) || 'Request-rate: ' || n || '/20' || chr(10) || chr(10) || 'User-agent: *' || chr(10) || 'Disallow: /fr' || chr(10)
    || CASE WHEN n % 2 = 0 THEN 'Sitemap: ' || scheme || '://' || host || '/robots-sitemap.xml' ELSE '' END AS content
  FROM host_facts)"""

# Lines, groups and the governing group of '*', step by step.
ROBOT_LINES = f"""{ROBOTS}, raw AS (
  SELECT host, unnest(string_split(content, chr(10))) AS line, generate_subscripts(string_split(content, chr(10)), 1) - 1 AS line_no
  FROM robots), cut AS (
  SELECT host, line_no, line = '' AS is_break, regexp_replace(line, '#.*$', '') AS t FROM raw), keyed AS (
  SELECT host, line_no, is_break, lower(trim(split_part(t, ':', 1))) AS key,
         url_decode(replace(trim(substr(t, instr(t, ':') + 1)), '+', '%2B')) AS value
  FROM cut WHERE is_break OR instr(t, ':') > 0), state AS (
  SELECT *, is_break OR (key = 'user-agent' AND coalesce(lag(key) OVER (PARTITION BY host ORDER BY line_no), '') <> 'user-agent') AS st
  FROM keyed WHERE is_break OR key IN ('user-agent', 'allow', 'disallow', 'crawl-delay', 'request-rate')), numbered AS (
  SELECT *, sum(st::INT) OVER (PARTITION BY host ORDER BY line_no) AS group_no FROM state), grp AS (
  SELECT host, group_no FROM numbered WHERE NOT is_break GROUP BY ALL
  HAVING bool_or(key = 'user-agent') AND bool_or(key <> 'user-agent')), lines AS (
  SELECT n.* FROM numbered n JOIN grp USING (host, group_no) WHERE NOT is_break), star AS (
  SELECT host, min(group_no) AS group_no FROM lines WHERE key = 'user-agent' AND value = '*' GROUP BY host), mine AS (
  SELECT l.* FROM lines l JOIN star USING (host, group_no))"""

SHARD = 25


def sitemaps(spark: SparkSession, sf: str) -> DataFrame:
    """Per host a root that names all indexes of the host; an index names at most ``SHARD`` nested sitemaps of at most ``SHARD`` pages."""
    seen = pages(spark, sf).select(
        "page_id", "url", urls.authority("url").alias("host"), urls.scheme("url").alias("scheme"),
        F.floor(F.col("page_id") / SHARD).alias("shard"),
    )
    loc = F.concat(F.lit("<url><loc> "), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit(" </loc></url>"))

    def text(grouped: DataFrame) -> DataFrame:
        joined = F.array_join(F.array_sort(F.collect_list("loc")), "")
        return grouped.agg(F.concat(F.lit("<urlset>"), joined, F.lit("</urlset>")).alias("content"))

    # At most SHARD pages, then at most SHARD shards, per text.
    leaf_url = F.concat(F.lit("http://"), F.col("host"), F.lit("/nested/sitemap"), F.col("shard").cast("string"), F.lit(".xml"))
    leaves = text(seen.withColumns({"sm": leaf_url, "loc": loc}).groupBy("host", "shard", "sm"))
    top = F.floor(F.col("shard") / SHARD)
    mid_url = F.concat(F.lit("http://"), F.col("host"), F.lit("/sitemap-index"), top.cast("string"), F.lit(".xml"))
    wrapped = F.concat(F.lit("<sitemap><loc>"), F.col("sm"), F.lit("</loc></sitemap>"))
    mids = text(leaves.select("host", mid_url.alias("mid"), wrapped.alias("loc")).groupBy("host", "mid"))
    named = F.concat(F.lit("<sitemap><loc>"), F.col("mid"), F.lit("</loc></sitemap>"))
    indexes = mids.groupBy("host").agg(F.array_join(F.array_sort(F.collect_list(named)), "").alias("indexes"))
    roots = host_facts(spark, sf).join(indexes, "host").select(
        "host",
        F.concat("scheme", F.lit("://"), "host", F.when(F.col("n") % 2 == 0, "/robots-sitemap.xml").otherwise("/sitemap.xml")).alias("url"),
        F.concat(
            F.lit("<urlset>"), F.col("indexes"), F.lit("<loc>http://"), F.col("host"), F.lit("/extra</loc><loc>"), F.col("scheme"), F.lit("://"), F.col("host"), F.lit("/sitemap.xml</loc>"),
        ).alias("content"),
    )
    return (
        leaves.select(F.col("sm").alias("url"), "content")
        .unionByName(mids.select(F.col("mid").alias("url"), "content"))
        .unionByName(roots.select("url", "content"))
    )


SITEMAPS = f"""seen AS (
  SELECT page_id, url, {part('url', 2)} AS host, floor(page_id / {SHARD})::BIGINT AS shard FROM pages), leaves AS (
  SELECT host, shard, 'http://' || host || '/nested/sitemap' || shard || '.xml' AS sm,
         '<urlset>' || string_agg(l, '' ORDER BY l) || '</urlset>' AS content
  FROM (SELECT *, '<url><loc> ' || replace(url, '&', '&amp;') || ' </loc></url>' AS l FROM seen) GROUP BY host, shard), mids AS (
  SELECT host, 'http://' || host || '/sitemap-index' || (floor(shard / {SHARD})::BIGINT) || '.xml' AS sm,
         '<urlset>' || string_agg('<sitemap><loc>' || sm || '</loc></sitemap>', '' ORDER BY sm) || '</urlset>' AS content
  FROM leaves GROUP BY 1, 2), indexes AS (
  SELECT host, string_agg('<sitemap><loc>' || sm || '</loc></sitemap>', '' ORDER BY sm) AS indexes FROM mids GROUP BY 1), roots AS (
  SELECT host, scheme || '://' || host || CASE WHEN n % 2 = 0 THEN '/robots-sitemap.xml' ELSE '/sitemap.xml' END AS url,
         '<urlset>' || indexes || '<loc>http://' || host || '/extra</loc><loc>'
         || scheme || '://' || host || '/sitemap.xml</loc>' AS content FROM host_facts JOIN indexes USING (host)), sitemaps AS (
  SELECT sm AS url, content FROM leaves UNION ALL SELECT sm, content FROM mids UNION ALL SELECT url, content FROM roots)"""


# --- link graph ----------------------------------------------------------------------------------


def page_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Two arcs per page to computed pages, and a hub: every third page links to page 0."""
    ids = spark.read.parquet(f"{sf}/pages.parquet").select(F.col("page_id").alias("src"))
    n = ids.count()
    targets = F.array((7 * F.col("src") + 3) % n, (13 * F.col("src") + 5) % n)
    return ids.select("src", F.explode(targets).alias("dst")).unionByName(
        ids.where(F.col("src") % 3 == 0).select("src", F.lit(0).cast("long").alias("dst"))
    )


EDGES = """n AS (SELECT count(*) AS n FROM pages), edges AS (
  SELECT page_id AS src, (7 * page_id + 3) % n AS dst FROM pages, n
  UNION ALL SELECT page_id, (13 * page_id + 5) % n FROM pages, n
  UNION ALL SELECT page_id, 0 FROM pages WHERE page_id % 3 = 0)"""


def url_edges(spark: SparkSession, sf: str) -> DataFrame:
    """The arcs between the pages' URLs."""
    keys = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")
    sources = keys.toDF("src", "src_url")
    targets = keys.toDF("dst", "dst_url")
    edges = page_edges(spark, sf).join(sources, "src").join(targets, "dst")
    return edges.select(F.col("src_url").alias("src"), F.col("dst_url").alias("dst"))


# --- store tables ------------------------------------------------------------------------------------

MIMES = (
    "text/html; charset=utf-8",
    "application/pdf",
    "application/msword",
    "application/vnd.ms-powerpoint",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    "application/pdf; charset=x",
)
STATUS = (200, 203, 302, 404)


def responses(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with a content type (NULL for one page in eight), a status and a duplicate flag."""
    n = F.col("page_id")
    content_type = F.try_element_at(F.array(*[F.lit(m) for m in MIMES]), (n % 8 + 1).cast("int"))
    status = F.element_at(F.array(*[F.lit(s) for s in STATUS]), (n % 4 + 1).cast("int"))
    return pages(spark, sf).select(
        "page_id", "url", "html", content_type.alias("content_type"), status.alias("http_status_code"),
        (n % 5 == 0).alias("is_duplicate"),
    )


RESPONSES = f"""responses AS (
  SELECT page_id, url, html, list_extract([{', '.join(f"'{m}'" for m in MIMES)}], (page_id % 8 + 1)::INT) AS content_type,
         list_extract([{', '.join(map(str, STATUS))}], (page_id % 4 + 1)::INT) AS http_status_code,
         page_id % 5 = 0 AS is_duplicate FROM pages)"""


def store(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Store tables with some rows that break each rule."""
    src = spark.read.parquet(f"{sf}/pages.parquet").select(
        "page_id", "url", F.length("html").alias("size"), urls.authority("url").alias("host")
    )
    hosts = src.groupBy("host").agg(F.min("page_id").alias("site"))  # one site for each host
    src = src.join(hosts, "host")
    n = F.col("page_id")
    page = src.select(
        n.alias("id"),
        F.when(n % 11 != 0, F.col("site")).alias("site_id"),
        F.when(n % 17 == 0, "OTHER").when(n % 5 == 0, "DUPLICATE").otherwise("HTML").alias("page_type_code"),
        F.repeat(F.lit("7"), F.when(n % 31 == 0, 201).otherwise(20)).alias("lsh_hash"),
        "url",
        F.lit(None).cast("string").alias("html_content"),
        F.lit(200).alias("http_status_code"),
        F.lit(None).cast("timestamp_ntz").alias("accessed_time"),
    )
    site = hosts.where(F.col("site") % 13 != 0).select(
        F.col("site").alias("id"), F.col("host").alias("domain"), F.lit(None).cast("string").alias("robots_content"),
        F.lit(None).cast("string").alias("sitemap_content"),
    )
    link = src.select(n.alias("from_page"), F.when(n % 19 == 0, -n - 1).otherwise(n + 1 - n % 2).alias("to_page"))
    image = src.select(
        (n * 2).alias("id"), F.when(n % 23 == 0, -n - 1).otherwise(n).alias("page_id"),
        F.concat(F.lit("i"), n.cast("string"), F.lit(".png")).alias("filename"), F.lit("png").alias("content_type"),
        F.lit("p").alias("path"), F.lit(None).cast("timestamp_ntz").alias("accessed_time"),
    )
    page_data = src.select(
        n.alias("id"), n.alias("page_id"),
        F.element_at(F.array(*[F.lit(c) for c in ("PDF", "DOC", "DOCX", "PPT", "PPTX", "ZIP")]), (n % 6 + 1).cast("int")).alias("data_type_code"),
        F.lit("p").alias("path"), F.col("size").cast("long").alias("size"),
    )
    return {"site": site, "page": page, "link": link, "image": image, "page_data": page_data}


STORE = f"""page AS (
  SELECT page_id AS id, CASE WHEN page_id % 11 <> 0 THEN min(page_id) OVER (PARTITION BY {part('url', 2)}) END AS site_id,
         CASE WHEN page_id % 17 = 0 THEN 'OTHER' WHEN page_id % 5 = 0 THEN 'DUPLICATE' ELSE 'HTML' END AS page_type_code,
         repeat('7', CASE WHEN page_id % 31 = 0 THEN 201 ELSE 20 END) AS lsh_hash, url FROM pages), site AS (
  SELECT min(page_id) AS id, {part('url', 2)} AS domain FROM pages GROUP BY 2 HAVING min(page_id) % 13 <> 0), link AS (
  SELECT page_id AS from_page, CASE WHEN page_id % 19 = 0 THEN -page_id - 1 ELSE page_id + 1 - page_id % 2 END AS to_page FROM pages), image AS (
  SELECT page_id * 2 AS id, CASE WHEN page_id % 23 = 0 THEN -page_id - 1 ELSE page_id END AS page_id,
         'i' || page_id || '.png' AS filename, 'png' AS content_type FROM pages), page_data AS (
  SELECT page_id AS id, page_id, list_extract(['PDF','DOC','DOCX','PPT','PPTX','ZIP'], (page_id % 6 + 1)::INT) AS data_type_code,
         length(html) AS size FROM pages)"""
