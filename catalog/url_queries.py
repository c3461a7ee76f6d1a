"""Queries over URLs, links and page markup."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import derived as D
from catalog.derived import part, sql_canonical, sql_host
from catalog.registry import query
from siteloom.functions import html as H
from siteloom.functions import urls
from siteloom.operators import canonical, extract, report

HREF = """(?i)<a\\s[^>]*?href\\s*=\\s*["'']([^"'']*)["'']"""
PAGE_LINKS = f"""hrefs AS (
  SELECT page_id, url, unnest(regexp_extract_all(html, '{HREF}', 1)) AS raw,
         generate_subscripts(regexp_extract_all(html, '{HREF}', 1), 1) - 1 AS pos FROM pages), resolved AS (
  SELECT page_id, pos::INT AS pos, raw, lower({part('url', 1)}) || '://' || {part('url', 2)} || raw AS resolved
  FROM hrefs WHERE raw LIKE '/%'), links AS (
  SELECT *, {sql_canonical('resolved')} AS canonical_url FROM resolved)"""

EXT = f"regexp_extract({part('url', 3)}, '[^/.][^/]*\\.([^./]*)$', 1)"


@query(f"""SELECT page_id, lower({part('url', 1)}) AS scheme, {part('url', 2)} AS authority, {part('url', 3)} AS path,
  {part('url', 4)} AS query, {part('url', 5)} AS fragment, {sql_host()} AS host, {EXT} AS ext,
  regexp_extract(url, '[^/]*$') AS filename FROM pages""")
def url_parts(spark, sf):
    table = canonical.canonicalise(D.pages(spark, sf).select("page_id", "url"))
    return table.drop("url", "canonical_url")


@query(f"SELECT page_id, {sql_canonical('url')} AS canonical_url FROM pages")
def url_canonical(spark, sf):
    return D.pages(spark, sf).select("page_id", urls.canonical("url").alias("canonical_url"))


@query(f"""SELECT page_id, regexp_replace(url, '[/#?]$', '') AS sanitised,
  {D.sql_www('url')} AS without_www,
  lower({part('url', 1)}) || '://' || {part('url', 2)} || '/' || split_part({part('url', 3)}, '/', 2)
    || CASE WHEN {part('url', 4)} = '' THEN '' ELSE '?' || {part('url', 4)} END
    || CASE WHEN {part('url', 5)} = '' THEN '' ELSE '#' || {part('url', 5)} END AS pruned,
  split_part(url, '://', 1) || '://' || {part('url', 2)} || '/robots.txt' AS robots_url,
  split_part(url, '://', 1) || '://' || {part('url', 2)} || '/sitemap.xml' AS sitemap_url FROM pages""")
def url_variants(spark, sf):
    return D.pages(spark, sf).select(
        "page_id",
        urls.sanitise("url").alias("sanitised"),
        urls.drop_www("url").alias("without_www"),
        urls.prune("url", 1).alias("pruned"),
        urls.robots_url("url").alias("robots_url"),
        urls.default_sitemap_url("url").alias("sitemap_url"),
    )


@query(f"""WITH t AS (SELECT page_id, 'http://h.example.com/p/ x' AS front, '?' || regexp_replace(text, '#', 'N', 'g') AS q FROM (
    SELECT page_id, regexp_extract(html, '<title>([^<]*)', 1) || '~*+ %41=&;' || url AS text FROM pages))
  SELECT page_id, front || '?' || replace(replace(url_encode(substr(q, 2)), '%3D', '='), '%26', '&') AS encoded FROM t""")
def url_query_encode(spark, sf):
    title = F.regexp_extract("html", "<title>([^<]*)", 1)
    text = F.concat(title, F.lit("~*+ %41=&;"), "url")
    made = D.pages(spark, sf).select(
        "page_id",
        F.concat(F.lit("http://h.example.com/p/ x?"), F.regexp_replace(text, "#", "N")).alias("made"),
    )
    return made.select("page_id", urls.encode_query("made").alias("encoded"))


@query(f"SELECT {EXT} AS ext, count(*) AS n FROM pages GROUP BY 1")
def url_ext(spark, sf):
    return D.pages(spark, sf).groupBy(urls.extension("url").alias("ext")).agg(F.count("*").alias("n"))


@query(f"SELECT {sql_host()} AS host, count(*) AS n_pages FROM pages GROUP BY 1")
def url_host_counts(spark, sf):
    return report.pages_per_site(spark.read.parquet(f"{sf}/pages.parquet"))


@query(f"WITH {PAGE_LINKS} SELECT canonical_url, count(*) AS n_pages, min(page_id) AS first_page_id FROM links GROUP BY 1")
def url_collapse(spark, sf):
    return canonical.collapse(extract.links(D.pages(spark, sf)))


KINDS = ["'/../a/./b/' || page_id", "'?p=' || page_id", "'//www.cdn.example.com/i/' || page_id", "'#top'",
         "'HTTP://www.Other.com/' || page_id || '/#'", "'mailto:x@a.si'", "'/x//' || page_id || '/..'", "'rel.html'"]
ORIGIN = f"lower({part('url', 1)}) || '://' || {part('url', 2)}"
WWW_ORIGIN = D.sql_www(f"({ORIGIN})")


@query(f"""WITH {PAGE_LINKS} SELECT page_id, resolved, canonical_url FROM links UNION ALL
  SELECT page_id, CASE page_id % 8 WHEN 0 THEN {ORIGIN} || '/a/b/' || page_id
    WHEN 1 THEN {ORIGIN} || {part('url', 3)} || '?p=' || page_id
    WHEN 2 THEN lower({part('url', 1)}) || '://www.cdn.example.com/i/' || page_id
    WHEN 4 THEN 'HTTP://www.Other.com/' || page_id || '/#' ELSE {ORIGIN} || '/x//' END AS resolved,
  CASE page_id % 8 WHEN 0 THEN {WWW_ORIGIN} || '/a/b/' || page_id
    WHEN 1 THEN {WWW_ORIGIN} || {part('url', 3)} || '?p=' || page_id
    WHEN 2 THEN lower({part('url', 1)}) || '://cdn.example.com/i/' || page_id
    WHEN 4 THEN 'http://Other.com/' || page_id ELSE {WWW_ORIGIN} || '/x/' END AS canonical_url
  FROM pages WHERE page_id % 8 IN (0, 1, 2, 4, 6)""")
def link_resolve(spark, sf):
    n = F.col("page_id").cast("string")
    kinds = F.array(
        F.concat(F.lit("/../a/./b/"), n), F.concat(F.lit("?p="), n), F.concat(F.lit("//www.cdn.example.com/i/"), n), F.lit("#top"),
        F.concat(F.lit("HTTP://www.Other.com/"), n, F.lit("/#")), F.lit("mailto:x@a.si"),
        F.concat(F.lit("/x//"), n, F.lit("/..")), F.lit("rel.html"),
    )
    href = F.element_at(kinds, (F.col("page_id") % 8 + 1).cast("int"))
    tagged = F.concat(F.lit('<a class="k" href="'), href, F.lit('">k</a>'))
    made = D.pages(spark, sf).select("page_id", "url", F.concat("html", tagged).alias("html"))
    return extract.links(made).select("page_id", "resolved", "canonical_url")


@query(f"WITH {PAGE_LINKS} SELECT page_id, pos, 'anchor' AS kind, raw, resolved, canonical_url FROM links")
def links_extract(spark, sf):
    return extract.links(D.pages(spark, sf))


@query(f"WITH {PAGE_LINKS} SELECT page_id, pos, 'anchor' AS kind, raw, resolved, canonical_url FROM links")
def links_extract_parser(spark, sf):
    return extract.links(D.pages(spark, sf), engine="parser")


@query(f"""WITH {PAGE_LINKS}, c AS (SELECT page_id, count(*) AS n FROM links GROUP BY 1)
  SELECT count(*) AS n_pages, round(avg(n), 6) AS mean_items, max(n) AS max_items FROM c""")
def links_per_page(spark, sf):
    return report.per_page(extract.links(D.pages(spark, sf))).withColumn("mean_items", F.round("mean_items", 6))


@query(f"""WITH {PAGE_LINKS} SELECT page_id, pos, canonical_url FROM links
  WHERE regexp_matches({part('canonical_url', 2)}, '(^|\\.)example\\.org$')""")
def links_allowed_domain(spark, sf):
    return extract.allowed(extract.links(D.pages(spark, sf)), ["example.org"]).select("page_id", "pos", "canonical_url")


@query(f"""WITH {PAGE_LINKS} SELECT page_id, pos, canonical_url FROM links
  WHERE canonical_url LIKE '%e.net%' OR canonical_url LIKE '%/de%'""")
def links_allowed_text(spark, sf):
    links = extract.links(D.pages(spark, sf))
    return extract.allowed(links, ["e.net", "/de"], strict=False).select("page_id", "pos", "canonical_url")


@query("""SELECT page_id, unnest(['http://r' || page_id % 4 || '.example.com/go', 'http://s.example.com/' || page_id, 'http://t.example.net/x']) AS canonical_url
  FROM pages""")
def js_redirects(spark, sf):
    found = extract.links(D.rich_pages(spark, sf), scripts=True)
    return found.where(F.col("kind") == "script").select("page_id", "canonical_url")


BASE = f"CASE WHEN page_id % 2 = 0 THEN 'http://b' || page_id % 3 || '.example.org/dir/' ELSE url END"


@query(f"SELECT page_id, url, {BASE} AS base_href FROM pages")
def base_href(spark, sf):
    return extract.base_hrefs(D.rich_pages(spark, sf))


@query(f"""WITH b AS (SELECT page_id, {BASE} AS base FROM pages)
  SELECT page_id, lower({part('base', 1)}) || '://' || {part('base', 2)} || {part('base', 3)} || '?q=' || page_id || '&z=1#f' AS resolved FROM b""")
def links_on_base(spark, sf):
    found = extract.links(D.rich_pages(spark, sf))
    return found.where(F.startswith("raw", F.lit("?"))).select("page_id", "resolved")


@query(f"""WITH b AS (SELECT page_id, url, {BASE} AS base FROM pages), o AS (
    SELECT page_id, url AS page_url, lower({part('base', 1)}) || '://' || {part('base', 2)} AS origin, {part('base', 2)} AS host FROM b)
  SELECT page_id, page_url, origin || '/img/' || page_id || '.png' AS src, page_id || '.png' AS filename, 'png' AS content_type,
         'files/images/' || host || '/' || page_id || '.png' AS path FROM o
  UNION ALL SELECT page_id, page_url, 'pic' || page_id || '.jpg', 'pic' || page_id || '.jpg', 'jpg',
         'files/images/' || host || '/pic' || page_id || '.jpg' FROM o""")
def images_extract(spark, sf):
    return extract.images(D.rich_pages(spark, sf)).drop("pos")


DOC_TYPE = "CASE " + " ".join(f"WHEN content_type = '{m}' THEN '{t}'" for m, t in H.DOCUMENT_TYPES.items()) + " END"


@query(f"""WITH {D.RESPONSES} SELECT content_type, {DOC_TYPE} AS data_type_code,
  content_type IS NULL OR content_type LIKE '%text/html%' AS is_html, count(*) AS n FROM responses GROUP BY ALL""")
def mime_types(spark, sf):
    typed = D.responses(spark, sf).select(
        "content_type", H.document_type("content_type").alias("data_type_code"), H.is_html("content_type").alias("is_html")
    )
    return typed.groupBy("content_type", "data_type_code", "is_html").agg(F.count("*").alias("n"))


PAGE_CLASS = f"""{D.RESPONSES}, typed AS (
  SELECT *, content_type IS NULL OR content_type LIKE '%text/html%' AS h, {DOC_TYPE} AS d FROM responses), classed AS (
  SELECT page_id, url, html, CASE WHEN h AND http_status_code IN (200, 203, 302) THEN
      CASE WHEN is_duplicate THEN 'DUPLICATE' ELSE 'HTML' END WHEN d IS NOT NULL THEN 'BINARY' END AS page_type_code,
    d AS data_type_code FROM typed)"""


@query(f"""WITH {PAGE_CLASS} SELECT page_id, page_type_code, data_type_code,
  CASE WHEN page_type_code = 'HTML' THEN length(html)::INT END AS content_length FROM classed""")
def page_class(spark, sf):
    classed = extract.classify(D.responses(spark, sf))
    return classed.select("page_id", "page_type_code", "data_type_code", F.length("html_content").alias("content_length"))


@query(f"WITH {PAGE_LINKS} SELECT DISTINCT canonical_url AS url, 'FRONTIER' AS page_type_code FROM links WHERE canonical_url NOT IN (SELECT url FROM pages)")
def frontier_pages(spark, sf):
    pages = D.pages(spark, sf)
    return extract.frontier_pages(extract.links(pages), pages)


@query(f"""WITH {PAGE_CLASS} SELECT data_type_code, page_id, 'files/' || data_type_code || '/' || {part('url', 2)} || '/' || regexp_extract(url, '[^/]*$') AS path
  FROM classed WHERE page_type_code = 'BINARY'""")
def document_paths(spark, sf):
    classed = extract.classify(D.responses(spark, sf)).where(F.col("page_type_code") == "BINARY")
    return classed.select(
        "data_type_code", "page_id", urls.document_path("data_type_code", urls.authority("url"), "url").alias("path")
    )
