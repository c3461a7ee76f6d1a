import pytest

import __spark_entry__ as entry
from check import compare

SF = "/root/testdata/sf0.001"
# A spread over the jobs; ``check.py`` runs all.
NAMES = ["url_parts", "links_extract", "robots_allow", "sitemap_nested", "bfs_capped", "fetch_schedule", "band_signatures", "dedup_batch", "fk_audit", "top_hubs"]


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    assert compare(spark, SF, name).startswith("ok")


def test_entry(spark):
    assert entry.entry(spark).count() == 10


def test_all_pages_are_in_the_sitemap_tree(spark):
    sf = "/root/testdata/sf0.1"
    reached = entry.queries()["sitemap_nested"](spark, sf).select("url").distinct()
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("url").distinct()
    assert pages.join(reached, "url", "left_anti").count() == 0
