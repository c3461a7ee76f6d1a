"""One flow from fetched pages to the rows of all tables of a store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteloom.functions import urls
from siteloom.operators import extract, integrity
from siteloom.operators.dedup import Similarity
from siteloom.plans.crawl import PRESETS
from siteloom.session import materialise
from siteloom.sources.indexed import IndexedStore

FETCHED = "url string, html string, content_type string, http_status_code int, accessed_time timestamp_ntz"


def ingest(
    store: IndexedStore,
    fetched: DataFrame,
    *,
    batch_id: int | None = None,
    similarity: Similarity | None = None,
    robots: DataFrame | None = None,
    preset: str = "code",
) -> DataFrame:
    """Store fetched pages (``FETCHED``) as one batch; gives ``(page_id, orig_id, score)`` of its duplicates.

    Sites of new hosts come first (with ``robots(host, content)`` if given), then pages by their class, duplicates marked and
    linked, then images and links of the HTML pages that are kept, and the files of binary ones. A link is stored where both
    pages are, in this batch or an earlier one. Each table drops what it has already, so a batch that is run
    again after a failure adds nothing twice. Pages of no class are not stored.
    """
    batch = store.last_batch() + 1 if batch_id is None else batch_id
    rows = fetched.select("url", "html", "content_type", "http_status_code", "accessed_time", F.lit(False).alias("is_duplicate"))
    rows = materialise(extract.classify(rows.where(F.col("url").isNotNull())).where(F.col("page_type_code").isNotNull()))

    hosts = rows.select(urls.authority("url").alias("domain")).where("domain <> ''").distinct()
    none = F.lit(None).cast("string")
    texts = hosts.withColumn("robots_content", none)
    if robots is not None:
        given = robots.select(F.col("host").alias("domain"), F.col("content").alias("robots_content"))
        texts = hosts.join(given, "domain", "left")
    store.add_sites(texts.withColumn("sitemap_content", none))

    sited = integrity.site_ids(rows, store.read("site")).withColumn("lsh_hash", none)
    duplicates = store.add_pages(sited.drop("host"), batch, similarity=similarity)

    kept = materialise(store.batch(batch).select(F.col("id").alias("page_id"), "url", F.col("html_content").alias("html"), "page_type_code"))
    bodies = kept.where(F.col("html").isNotNull()).drop("page_type_code")
    store.add_images(extract.images(bodies))
    store.add_files(
        rows.where(F.col("page_type_code") == "BINARY")
        .join(kept.where(F.col("page_type_code") == "BINARY").select("url"), "url", "left_semi")
        .select("url", "data_type_code", urls.document_path("data_type_code", urls.authority("url"), "url").alias("path"))
    )
    found = extract.links(bodies, **PRESETS[preset])
    sources = bodies.select("page_id", F.col("url").alias("from_url"))
    store.add_links_by_url(found.join(sources, "page_id").select("from_url", F.col("canonical_url").alias("to_url")))
    return duplicates
