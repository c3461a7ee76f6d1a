from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from siteloom.operators import frontier, skew
from siteloom.operators.ordering import previous_in_group, rank_in_group
from siteloom.plans import crawl

# One hub with many links, a cycle, and a vertex that is not reached.
EDGES = [("hub", f"n{k}") for k in range(40)] + [("n1", "far"), ("far", "hub"), ("n2", "n3"), ("lost", "hub"), ("far", "end")]


def levels(df):
    return {row.url: row.level for row in df.collect()}


def reference_levels(seeds, max_level):
    out, frontier_set = {}, set(seeds)
    for level in range(max_level):
        out.update({url: level for url in frontier_set})
        frontier_set = {d for s, d in EDGES if s in frontier_set} - set(out)
    return out


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, "src string, dst string")


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_bfs(spark, edges, hot_rows):
    seeds = spark.createDataFrame([("hub",), ("hub",)], "url string")
    for depth in (0, 1, 2, 4):
        found = levels(frontier.bfs(seeds, edges, max_level=depth, hot_rows=hot_rows))
        assert found == reference_levels(["hub"], depth)
    assert levels(frontier.bfs(seeds, edges, max_level=None)) == reference_levels(["hub"], 10)


def test_bfs_cap(spark, edges):
    seeds = spark.createDataFrame([("hub",)], "url string")
    found = levels(frontier.bfs(seeds, edges, max_level=None, max_pages=5))
    assert found == {"hub": 0, "n0": 1, "n1": 1, "n10": 1, "n11": 1}


def test_bucketed_links_are_not_shuffled(spark):
    from siteloom.session import bucketed

    big = spark.range(1000).select(F.col("id").cast("string").alias("src"), F.col("id").alias("dst"), F.lit(0).alias("_salt"))
    table, name = bucketed(big, ["src", "_salt"])
    asked = spark.range(10).select(F.col("id").cast("string").alias("src"), F.explode(F.array(F.lit(0), F.lit(1))).alias("_salt"))
    plan = asked.hint("merge").join(table, ["src", "_salt"])._jdf.queryExecution().executedPlan().toString()
    spark.sql(f"DROP TABLE {name}")
    assert plan.count("Exchange hashpartitioning") == 1


def test_counters_and_hosts(spark, edges):
    visited = spark.createDataFrame([("http://a.si/", 0), ("http://www.a.si/x", 1), ("http://b.si/", 1)], "url string, level int")
    rows = [tuple(row) for row in frontier.level_counters(visited).orderBy("level").collect()]
    assert rows == [(0, 1, 2, 1), (1, 2, 0, 3)]
    assert {tuple(row) for row in frontier.new_hosts(visited).collect()} == {("a.si", 0), ("b.si", 1)}
    groups = {row.host: row.n_urls for row in frontier.host_groups(visited.select("url")).collect()}
    assert groups == {"a.si": 2, "b.si": 1}


def test_deal_hosts(spark):
    pages = spark.createDataFrame([(f"http://h{k % 7}.si/{k}",) for k in range(50)], "url string")
    rows = frontier.deal_hosts(pages, 3).collect()
    shards = defaultdict(set)
    for row in rows:
        shards[row.host].add(row.shard)
    assert len(rows) == 50 and all(len(found) == 1 for found in shards.values())
    assert Counter(min(found) for found in shards.values()) == {0: 3, 1: 2, 2: 2}
    assert {row.shard for row in frontier.deal_hosts(pages, 100).collect()} == set(range(7))


@pytest.mark.parametrize("partitions", ["1", "50"])
def test_rank_and_previous_over_slices(spark, partitions):
    """One group holds most rows, and its slices are many."""
    before = {name: spark.conf.get(name) for name in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = [("hot" if k % 5 else f"c{k}", (k * 7919) % 1009) for k in range(1000)]
        df = spark.createDataFrame(rows, "host string, t int")
        ranked = defaultdict(list)
        for row in rank_in_group(df, ["host"], ["t"]).collect():
            ranked[row.host].append((row["rank"], row.t))
        for host, found in ranked.items():
            assert sorted(found) == list(enumerate(sorted(t for h, t in rows if h == host), 1))
        pairs = defaultdict(list)
        for row in previous_in_group(df, ["host"], "t").collect():
            pairs[row.host].append((row.t, row.previous))
        for host, found in pairs.items():
            times = sorted(t for h, t in rows if h == host)
            assert sorted(found) == list(zip(times, [None, *times[:-1]]))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_schedule_and_audit(spark):
    rules = spark.createDataFrame([("a.si", "User-agent: *\nCrawl-delay: 10")], "host string, content string")
    urls = spark.createDataFrame([("http://a.si/1",), ("http://a.si/2",), ("http://b.si/1",), ("http://b.si/2",)], "url string")
    offsets = {row.url: row.fetch_offset for row in frontier.schedule(urls, rules).collect()}
    assert offsets == {"http://a.si/1": 0, "http://a.si/2": 10, "http://b.si/1": 0, "http://b.si/2": 3}
    times = spark.sql("""SELECT host, CAST(t AS timestamp_ntz) AS accessed_time FROM VALUES
      ('a', '2024-01-01 00:00:00'), ('a', '2024-01-01 00:00:02.5'), ('a', '2024-01-01 00:00:05.5'), ('b', '2024-01-01 00:00:01') AS v(host, t)""")
    late = frontier.audit_delays(times).collect()
    assert [(row.host, row.gap_seconds) for row in late] == [("a", 2.5)]


def test_salting_keeps_all_rows(spark):
    left = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    right = left.select("k").distinct().withColumn("v", F.length("k"))
    hot = skew.hot_keys(left, "k", min_rows=50)
    assert [row._hot for row in hot.collect()] == ["hot"]
    spread = skew.salted(left, hot, "k", [F.col("id")])
    assert spread.where("k = 'hot'").select("_salt").distinct().count() > 3
    joined = spread.join(skew.repeated(right, hot, "k"), ["k", "_salt"])
    assert joined.count() == 1000 and joined.select("id").distinct().count() == 1000
    assert skew.hot_keys(left, "k") is None


def test_stored_crawl(spark):
    anchor = '<a href="{}">x</a>'.format
    pages = spark.createDataFrame(
        [
            (1, "http://a.si/", anchor("/p") + anchor("/private/x") + anchor("http://other.com/")),
            (2, "http://a.si/p", anchor("/q")),
            (3, "http://a.si/q", anchor("/deep")),
            (4, "http://a.si/s", anchor("/from-sitemap")),
        ],
        "page_id long, url string, html string",
    )
    rules = spark.createDataFrame([("a.si", "User-agent: *\nDisallow: /private")], "host string, content string")
    maps = spark.createDataFrame([("http://a.si/sitemap.xml", "<loc>http://www.a.si/s/</loc>")], "url string, content string")
    seeds = spark.createDataFrame([("http://www.a.si",)], "url string")
    options = {"robots": rules, "domains": ["a.si"], "max_level": None}
    found = levels(crawl.stored_crawl(pages, seeds, sitemaps=maps, **options))
    assert found == {"http://a.si/": 0, "http://a.si/p": 1, "http://a.si/s": 1, "http://a.si/q": 2,
                     "http://a.si/from-sitemap": 2, "http://a.si/deep": 3}
    duplicates = spark.createDataFrame([(2,)], "page_id long")
    found = levels(crawl.stored_crawl(pages, seeds, duplicates=duplicates, **options))
    assert found == {"http://a.si/": 0, "http://a.si/p": 1}
