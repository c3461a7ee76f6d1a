"""Queries over the store tables, the link graph and the corpus report."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog import derived as D
from catalog.derived import part, sql_canonical, sql_host
from catalog.registry import query
from catalog.url_queries import PAGE_CLASS, PAGE_LINKS
from siteloom.functions import urls
from siteloom.operators import extract, graph, integrity, report
from siteloom.plans.ingest import ingest
from siteloom.session import checkpoint_dir, materialise
from siteloom.sources.indexed import IndexedStore
from siteloom.sources import pajek
from siteloom.sources import tables as T

DIRECTORY = f"{part('url', 2)} || regexp_replace({part('url', 3)}, '[0-9]+.*$', '')"


def _plain(spark, sf):
    return spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")


@query(f"WITH k AS (SELECT page_id, {DIRECTORY} AS dir FROM pages) SELECT dir, min(page_id) AS page_id FROM k GROUP BY 1")
def keep_first_url(spark, sf):
    """One page per directory of a host."""
    folder = F.concat(urls.authority("url"), F.regexp_replace(urls.path("url"), "[0-9]+.*$", ""))
    rows = _plain(spark, sf).select("page_id", folder.alias("dir"))
    return integrity.keep_first(rows, "dir", ["page_id"])


@query(f"""WITH {D.STORE} SELECT page_id, {part('url', 2)} AS host, (SELECT min(s.id) FROM site s WHERE s.domain = {part('p.url', 2)}) AS site_id FROM pages p""")
def site_lookup(spark, sf):
    sites = D.store(spark, sf)["site"].groupBy("domain").agg(F.min("id").alias("id"))
    return integrity.site_ids(_plain(spark, sf), sites).select("page_id", "host", "site_id")


@query(f"""WITH {D.STORE}, l AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url || 'x' ELSE url END AS url FROM pages)
  SELECT l.page_id, l.url, p.id FROM l LEFT JOIN page p ON p.url = l.url""")
def page_lookup(spark, sf):
    asked = _plain(spark, sf).select(
        "page_id", F.when(F.col("page_id") % 3 == 0, F.concat("url", F.lit("x"))).otherwise(F.col("url")).alias("url")
    )
    return integrity.page_ids(asked, D.store(spark, sf)["page"]).select("page_id", "url", "id")


def _fk(table: str, column: str, target: str, key: str) -> str:
    known = f"SELECT {key} FROM {target}" if target not in T.CODES else "SELECT unnest([" + ", ".join(f"'{c}'" for c in T.CODES[target]) + "])"
    return f"""SELECT '{table}.{column} -> {target}.{key}' AS "constraint", {column}::VARCHAR AS value, count(*) AS n_rows
      FROM {table} WHERE {column} IS NOT NULL AND {column} NOT IN ({known}) GROUP BY ALL"""


@query(f"WITH {D.STORE} " + " UNION ALL ".join(_fk(*key) for key in integrity.FOREIGN_KEYS))
def fk_audit(spark, sf):
    codes = {name: T.code_table(spark, name) for name in T.CODES}
    return integrity.foreign_key_violations({**D.store(spark, sf), **codes})


KEYS = [("page", ["id"]), ("page", ["url"]), ("site", ["domain"]), ("link", ["from_page", "to_page"]), ("image", ["page_id", "filename"])]


def _repeated(table: str, columns: list[str]) -> str:
    value = " || ',' || ".join(f"CAST({c} AS VARCHAR)" for c in columns)
    held = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    return f"""SELECT '{table}({', '.join(columns)})' AS "constraint", {value} AS value, count(*) AS n_rows
      FROM {table} WHERE {held} GROUP BY {', '.join(columns)} HAVING count(*) > 1"""


# Every seventh row twice, so that there is something to find.
@query(f"""WITH {D.STORE.replace(' page AS (', ' page0 AS (', 1).replace('page AS (', 'page0 AS (', 1)},
  page AS (SELECT id, url FROM page0 UNION ALL SELECT id, url FROM page0 WHERE id % 7 = 0)
  {' UNION ALL '.join(_repeated(*key) for key in KEYS)}""")
def key_audit(spark, sf):
    stored = D.store(spark, sf)
    page = stored["page"]
    return integrity.key_violations({**stored, "page": page.unionByName(page.where(F.col("id") % 7 == 0))}, KEYS)


@query(f"WITH {D.STORE} SELECT page_type_code AS value, count(*) AS n_rows FROM page WHERE page_type_code NOT IN ('HTML', 'BINARY', 'DUPLICATE', 'FRONTIER') GROUP BY 1")
def code_audit(spark, sf):
    return integrity.code_violations(D.store(spark, sf)["page"], "page_type_code", "page_type")


def _column_checks() -> str:
    tables = ("site", "page", "link", "image", "page_data")
    checks = [(t, f"{t}.{c} is null", f"{c} IS NULL") for t, c in integrity.NOT_NULL if t in tables]
    checks += [(t, f"length({t}.{c}) > {n}", f"length({c}) > {n}") for t, c, n in integrity.MAX_LENGTHS if t in tables]
    return " UNION ALL ".join(f"""SELECT '{name}' AS "check", count(*) FILTER (WHERE {test}) AS n_rows FROM {t}""" for t, name, test in checks)


@query(f"WITH {D.STORE} {_column_checks()}")
def column_audit(spark, sf):
    return integrity.column_violations(D.store(spark, sf))


@query(f"""WITH {D.STORE} SELECT DISTINCT {part('url', 2)} AS domain, 'r' AS robots_content, NULL::VARCHAR AS sitemap_content FROM pages
  WHERE {part('url', 2)} NOT IN (SELECT domain FROM site)""")
def site_upsert(spark, sf):
    candidates = _plain(spark, sf).select(
        urls.authority("url").alias("domain"), F.lit("r").alias("robots_content"), F.lit(None).cast("string").alias("sitemap_content")
    )
    return T.new_sites(candidates, D.store(spark, sf)["site"]).drop("id")


@query("SELECT url, 'HTML' AS page_type_code, 200 AS http_status_code, true AS has_id, true AS has_time FROM pages")
def page_append(spark, sf):
    rows = D.pages(spark, sf).select(
        F.lit(None).cast("long").alias("site_id"), F.lit("HTML").alias("page_type_code"), F.lit(None).cast("string").alias("lsh_hash"),
        "url", F.col("html").alias("html_content"), F.lit(200).alias("http_status_code"),
    )
    stamped = T.stamped_pages(rows)
    return stamped.select(
        "url", "page_type_code", "http_status_code", F.col("id").isNotNull().alias("has_id"), F.col("accessed_time").isNotNull().alias("has_time")
    )


@query("""SELECT page_id, page_id || '.png' AS filename, 'png' AS content_type FROM pages WHERE page_id % 4 <> 0
  UNION ALL SELECT page_id, 'pic' || page_id || '.jpg', 'jpg' FROM pages WHERE page_id % 4 <> 0""")
def image_append(spark, sf):
    stored = _plain(spark, sf).where(F.col("page_id") % 4 != 0).select(F.col("page_id").alias("id"), "url")
    rows = T.resolved_images(extract.images(D.rich_pages(spark, sf)), stored)
    return rows.select("page_id", "filename", "content_type")


def _files(spark, sf):
    typed = extract.classify(D.responses(spark, sf)).where(F.col("page_type_code") == "BINARY")
    path = urls.document_path("data_type_code", urls.authority("url"), "url")
    stored = _plain(spark, sf).where(F.col("page_id") % 3 != 0).select(F.col("page_id").alias("id"), "url")
    return T.resolved_files(typed.select("url", "data_type_code", path.alias("path")), stored)


FILES = f"""{PAGE_CLASS}, files AS (
  SELECT page_id, url, data_type_code, 'files/' || data_type_code || '/' || {part('url', 2)} || '/' || regexp_extract(url, '[^/]*$') AS path
  FROM classed WHERE page_type_code = 'BINARY')"""


@query(f"WITH {FILES} SELECT page_id, data_type_code, path FROM files WHERE page_id % 3 <> 0")
def file_append(spark, sf):
    return _files(spark, sf)[0].drop("id")


@query(f"WITH {FILES} SELECT url, data_type_code, path FROM files WHERE page_id % 3 = 0")
def file_rejects(spark, sf):
    return _files(spark, sf)[1].select("url", "data_type_code", "path")


@query(f"WITH {D.EDGES} SELECT DISTINCT src AS from_page, dst AS to_page FROM edges WHERE src % 10 <> 0")
def link_append(spark, sf):
    pairs = D.page_edges(spark, sf).select(F.col("src").alias("from_page"), F.col("dst").alias("to_page"))
    stored = pairs.where(F.col("from_page") % 10 == 0)
    return T.new_links(pairs, stored)


@query(f"WITH {D.EDGES} SELECT DISTINCT src AS from_page, dst AS to_page FROM edges WHERE src % 4 <> 0 AND dst % 4 <> 0")
def link_by_url(spark, sf):
    pairs = D.url_edges(spark, sf).toDF("from_url", "to_url")
    stored = _plain(spark, sf).where(F.col("page_id") % 4 != 0).select(F.col("page_id").alias("id"), "url")
    return T.links_by_url(pairs, stored)


@query(f"WITH {D.STORE} SELECT p.id, p.url FROM page p JOIN image i ON i.page_id = p.id WHERE p.page_type_code = 'HTML' AND p.site_id > 20")
def sql_lookup(spark, sf):
    store = T.CorpusStore(spark, _folder(spark))
    store.create()
    rows = D.store(spark, sf)
    for name in ("page", "image"):
        rows[name].select(*T.schema(name).names).write.mode("append").parquet(store.path(name))
    sql = "SELECT p.id, p.url FROM page p JOIN image i ON i.page_id = p.id WHERE p.page_type_code = ? AND p.site_id > ?"
    return store.query(sql, args=["HTML", 20])


# --- link graph ---------------------------------------------------------------------------------------


def _vertices(spark, sf):
    ids = spark.read.parquet(f"{sf}/pages.parquet").select(F.col("page_id").alias("v_no"))
    return ids.withColumn("label", F.concat(F.col("v_no").cast("string"), F.lit(".0")))


DEGREE = f"""{D.EDGES}, vertices AS (SELECT page_id AS v_no, page_id || '.0' AS label FROM pages), degrees AS (
  SELECT v_no, label, (SELECT count(*) FROM edges WHERE src = v_no) + (SELECT count(*) FROM edges WHERE dst = v_no) AS degree FROM vertices)"""


@query(f"WITH {DEGREE} SELECT v_no, label, degree::BIGINT AS degree FROM degrees")
def degree(spark, sf):
    return graph.degrees(_vertices(spark, sf), D.page_edges(spark, sf))


@query(f"WITH {DEGREE} SELECT count(*) AS n_vertices, (SELECT count(*) FROM edges) AS n_arcs, round(sum(degree) / count(*), 6) AS mean_degree FROM degrees")
def graph_summary(spark, sf):
    found = graph.summary(_vertices(spark, sf), D.page_edges(spark, sf))
    return found.withColumn("mean_degree", F.round("mean_degree", 6))


@query(f"WITH {DEGREE} SELECT v_no, label, degree::BIGINT AS degree FROM degrees ORDER BY degree DESC, label LIMIT 10")
def top_hubs(spark, sf):
    return graph.top_hubs(_vertices(spark, sf), D.page_edges(spark, sf), 10)


@query(f"""WITH {DEGREE} SELECT v_no, label, degree::BIGINT AS degree, {part('url', 2)} AS name FROM (
  SELECT * FROM degrees ORDER BY degree DESC, label LIMIT 10) JOIN pages ON page_id = v_no""")
def hub_sites(spark, sf):
    sites = _plain(spark, sf).select(F.col("page_id").alias("site_id"), urls.authority("url").alias("site_name"))
    return graph.hub_sites(graph.top_hubs(_vertices(spark, sf), D.page_edges(spark, sf), 10), sites)


@query(f"""WITH {D.EDGES}, o AS (SELECT dst, count(*) AS k FROM edges GROUP BY 1)
  SELECT max(k) AS max_out_degree, sum(k)::BIGINT AS n_arcs, round(max(k) / sum(k), 6) AS share FROM o""")
def hub_share(spark, sf):
    """Over the reversed arcs, in which one page is a hub."""
    reversed_arcs = D.page_edges(spark, sf).select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return graph.hub_share(reversed_arcs).withColumn("share", F.round("share", 6))


@query(f"WITH {DEGREE} SELECT v_no, label FROM vertices WHERE v_no NOT IN (SELECT src FROM edges WHERE src % 2 = 0)")
def no_out_links(spark, sf):
    edges = D.page_edges(spark, sf).where(F.col("src") % 2 == 0)
    return graph.without_out_arcs(_vertices(spark, sf), edges)


@query(f"WITH {D.STORE} SELECT site_id AS src, id AS dst FROM page WHERE site_id IS NOT NULL")
def site_edges(spark, sf):
    return graph.site_edges(D.store(spark, sf)["page"], page_id="id")


# --- report ---------------------------------------------------------------------------------------------


@query(f"""WITH {D.STORE} SELECT unnest(['pages', 'images', 'files', 'duplicates', 'sites']) AS metric,
  unnest([(SELECT count(*) FROM page), (SELECT count(*) FROM image), (SELECT count(*) FROM page_data),
          (SELECT count(*) FROM page WHERE page_type_code = 'DUPLICATE'), (SELECT count(*) FROM site)]) AS value""")
def corpus_totals(spark, sf):
    stored = D.store(spark, sf)
    return report.totals(
        {
            "pages": stored["page"],
            "images": stored["image"],
            "files": stored["page_data"],
            "duplicates": stored["page"].where(F.col("page_type_code") == "DUPLICATE"),
            "sites": stored["site"],
        }
    )


@query("SELECT count(*) AS n_pages, 2.0::DOUBLE AS mean_items, 2::BIGINT AS max_items FROM pages")
def images_per_page(spark, sf):
    return report.per_page(extract.images(D.rich_pages(spark, sf)))


@query(f"WITH {D.STORE} SELECT data_type_code AS type, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM page_data GROUP BY 1")
def type_share(spark, sf):
    return report.type_share(D.store(spark, sf)["page_data"], "data_type_code").withColumn("share", F.round("share", 6))


@query(f"WITH {D.STORE} SELECT data_type_code AS type, count(*) AS n, sum(size)::BIGINT AS bytes FROM page_data GROUP BY 1")
def bytes_by_type(spark, sf):
    return report.bytes_by_type(D.store(spark, sf)["page_data"], "data_type_code", "size")


@query(f"""WITH {FILES} SELECT f.data_type_code AS type, count(*) AS n,
  coalesce(sum(strlen(html)) FILTER (WHERE c.page_id % 3 <> 0), 0)::BIGINT AS bytes, count(*) FILTER (WHERE c.page_id % 3 = 0) AS n_missing
  FROM files f JOIN classed c USING (page_id) GROUP BY 1""")
def bytes_of_files(spark, sf):
    """Two thirds of the files lie in a folder; their sizes come from there."""
    typed = extract.classify(D.responses(spark, sf)).where(F.col("page_type_code") == "BINARY")
    place = F.concat(urls.document_path("data_type_code", urls.authority("url"), "url"), F.lit("-"), F.col("page_id").cast("string"))
    rows = typed.select("page_id", "data_type_code", place.alias("path"), F.col("html").alias("content"))
    folder = _folder(spark)
    T.write_files(rows.where(F.col("page_id") % 3 != 0), folder)
    return report.bytes_of_files(rows.drop("content"), T.file_sizes(spark, folder))


@query(f"WITH {PAGE_LINKS} SELECT {sql_host('canonical_url')} AS host, count(*) AS n_pages FROM links GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def top_linked_hosts(spark, sf):
    return report.pages_per_site(extract.links(D.pages(spark, sf)), "canonical_url").limit(10)


@query("""SELECT count(*) AS n_pages, round(epoch_us(max(ts)) / 1e6 - epoch_us(min(ts)) / 1e6, 3) AS seconds,
  round(count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6), 6) AS pages_per_second FROM events""")
def crawl_speed(spark, sf):
    accesses = spark.read.parquet(f"{sf}/events.parquet").select(F.col("ts").cast("timestamp_ntz").alias("accessed_time"))
    speed = report.crawl_speed(accesses)
    return speed.select("n_pages", F.round("seconds", 3).alias("seconds"), F.round("pages_per_second", 6).alias("pages_per_second"))


# --- files and store: written to the shared folder and read back ------------------------------------


def _folder(spark) -> str:
    return f"{checkpoint_dir(spark)}/siteloom/{uuid.uuid4().hex}"


@query(f"WITH {D.EDGES} SELECT src AS from_page, dst AS to_page FROM edges")
def link_csv(spark, sf):
    path = _folder(spark)
    D.page_edges(spark, sf).write.csv(path, sep=";")
    return T.read_links(spark, path)


@query(f"""WITH {D.STORE} SELECT id AS site_id, domain AS site_name,
  'User-agent: *' || chr(10) || 'Disallow: /x' || id AS robots, 'a;"' || id || '"' AS sitemap FROM site""")
def site_csv(spark, sf):
    path = _folder(spark)
    site = D.store(spark, sf)["site"]
    robots = F.concat(F.lit("User-agent: *\nDisallow: /x"), F.col("id").cast("string"))
    sitemap = F.concat(F.lit('a;"'), F.col("id").cast("string"), F.lit('"'))
    rows = site.select(F.col("id").alias("site_id"), F.col("domain").alias("site_name"), robots.alias("robots"), sitemap.alias("sitemap"))
    rows.write.csv(path, sep=";", header=True)
    return T.read_sites(spark, path)


@query(f"""WITH {D.STORE} SELECT id, site_id, page_type_code AS type, lsh_hash, url, 200 AS status_code,
  TIMESTAMP '2024-02-28 23:00:00' + to_seconds(id * 61) AS time_retreived FROM page""")
def page_csv(spark, sf):
    path = _folder(spark)
    page = D.store(spark, sf)["page"]
    rows = page.select(
        "id", "site_id", F.col("page_type_code").alias("type"), "lsh_hash", "url", F.col("http_status_code").alias("status_code"),
        (F.lit("2024-02-28 23:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=(F.col("id") * 61).cast("decimal(18,6)"))).cast("string").alias("time_retreived"),
    )
    rows.write.csv(path, sep=";", header=True)
    return T.read_page_list(spark, path)


@query(f"""WITH {D.EDGES} SELECT s.url AS src, t.url AS dst, 1.0::DOUBLE AS weight
  FROM edges JOIN pages s ON s.page_id = src JOIN pages t ON t.page_id = dst""")
def pajek_round_trip(spark, sf):
    path = _folder(spark)
    pajek.write_pajek(D.url_edges(spark, sf), path)
    vertices, edges = pajek.read_pajek(spark, path)
    sources, targets = vertices.toDF("src", "src_url"), vertices.toDF("dst", "dst_url")
    named = edges.join(sources, "src").join(targets, "dst")
    return named.select(F.col("src_url").alias("src"), F.col("dst_url").alias("dst"), "weight")


@query("SELECT url AS gram, row_number() OVER (ORDER BY url) - 1 AS idx FROM (SELECT DISTINCT url FROM pages)")
def vocabulary_file(spark, sf):
    path = _folder(spark)
    _plain(spark, sf).select("url").distinct().orderBy("url").write.text(path)
    return T.read_vocabulary(spark, path)


@query("SELECT DISTINCT url FROM pages")
def seed_table(spark, sf):
    urls_ = _plain(spark, sf).select("url")
    return T.seeds(spark, urls_.unionByName(urls_))


@query("""SELECT unnest(['first', 'truncated', 'second']) AS state,
  unnest([count(DISTINCT url), 0, count(DISTINCT url) FILTER (WHERE page_id % 2 = 0)]) AS n_pages FROM pages""")
def store_refresh(spark, sf):
    """Append, empty and append again; a URL that comes twice is stored once."""
    stored = T.CorpusStore(spark, _folder(spark))
    stored.create()
    rows = D.store(spark, sf)["page"].drop("id", "accessed_time")
    counts = []

    def note(state: str) -> None:
        # Written out, as the files are replaced by the next step.
        counts.append(materialise(stored.read("page").agg(F.lit(state).alias("state"), F.count("*").alias("n_pages"))))

    stored.add_pages(rows)
    stored.add_pages(rows)
    note("first")
    stored.truncate()
    note("truncated")
    even = _plain(spark, sf).where(F.col("page_id") % 2 == 0).select("url")
    stored.add_pages(rows.join(even.distinct(), "url", "left_semi"))
    note("second")
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query(f"""WITH {PAGE_CLASS}, seen AS (
  SELECT page_id, url, page_type_code, page_id % 3 AS batch FROM classed c WHERE page_type_code IS NOT NULL), html AS (
  SELECT * FROM seen WHERE page_type_code <> 'BINARY')
  SELECT 'site' AS tab, count(DISTINCT {part('url', 2)}) AS n FROM seen
  UNION ALL SELECT 'page', count(*) FROM seen
  UNION ALL SELECT 'image', count(*) FROM html
  UNION ALL SELECT 'page_data', count(*) FROM seen WHERE page_type_code = 'BINARY'
  UNION ALL SELECT 'link', count(*) FROM html a JOIN seen b ON b.page_id IN (a.page_id - 1, a.page_id + 1) AND b.batch <= a.batch
    WHERE {sql_canonical('b.url')} = b.url""")
def store_ingest(spark, sf):
    """Pages that come in three batches to all tables of an indexed store; a link needs both of its pages."""
    typed = D.responses(spark, sf).select("page_id", "url", "content_type", "http_status_code")
    near = typed.select((F.col("page_id") + 1).alias("page_id"), F.col("url").alias("prev"))
    far = typed.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("next"))
    n = F.col("page_id").cast("string")
    anchor = lambda url, text: F.concat(F.lit('<a href="'), F.coalesce(url, F.lit("#")), F.lit(f'">{text}</a>'))
    html = F.concat(F.lit('<img src="/i'), n, F.lit('.png">'), anchor(F.col("prev"), "p"), anchor(F.col("next"), "n"), F.lit('<a href="/none/'), n, F.lit('">x</a>'))
    time = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    made = materialise(typed.join(near, "page_id", "left").join(far, "page_id", "left").withColumns({"html": html, "accessed_time": time}))
    store = IndexedStore(spark, _folder(spark))
    store.create()
    for batch in range(3):
        ingest(store, made.where(F.col("page_id") % 3 == batch))
    counts = [store.read(name).agg(F.lit(name).alias("tab"), F.count("*").alias("n")) for name in ("site", "page", "image", "page_data", "link")]
    return materialise(reduce(DataFrame.unionByName, counts))
