from urllib.robotparser import RobotFileParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siteloom.operators import robots as R
from siteloom.operators import sitemap as S

TEXTS = {
    "a.si": "User-agent: *\nDisallow: /a\nAllow: /a/b\nDisallow:\nCrawl-delay: 2",
    "b.si": "User-agent: *\nAllow: /a/b\nDisallow: /a\nDisallow: /*.pdf",
    "c.si": "User-agent: *\nDisallow: /a\n\nUser-agent: *\nDisallow: /z",
    "d.si": "User-agent: *\nDisallow: /a\n# c\n \nDisallow: /z",
    "e.si": "User-agent: *\nDisallow: /a\n\nDisallow: /z",
    "f.si": "SITEMAP: http://a.si/s1.xml\nUser-agent: *\nCrawl-delay: x\nRequest-rate: 3/20\nSitemap: http://a.si/s2.xml",
    "g.si": "",
    "h.si": "User-agent: x\nUser-agent: *\r\nDisallow: /a%20b  # note\nDisallow: /q?\nAllow: /\nDisallow: /z",
}


@pytest.fixture(scope="module")
def robots(spark):
    return spark.createDataFrame(list(TEXTS.items()), "host string, content string")


def verdicts(spark, robots, paths):
    rows = [(f"http://{host}{path}",) for host, path in paths]
    tested = R.with_permission(spark.createDataFrame(rows, "url string"), robots)
    found = {row.url: row.allow for row in tested.collect()}
    return [found[url] for (url,) in rows]


def test_permission(spark, robots):
    cases = {
        ("a.si", "/a"): False, ("a.si", "/a/b"): False, ("a.si", "/q"): True,
        ("b.si", "/a"): False, ("b.si", "/a/b"): True, ("b.si", "/q.pdf"): True, ("b.si", ""): True,
        ("c.si", "/a"): False, ("c.si", "/z"): True, ("d.si", "/z"): False, ("e.si", "/z"): True,
        ("g.si", "/a"): True, ("h.si", "/a b/c"): False, ("h.si", "/a%20b"): False, ("h.si", "/qq"): False,
        ("h.si", "/z"): True, ("none.si", "/a"): True,
    }
    assert verdicts(spark, robots, cases) == list(cases.values())


def test_policies(robots):
    found = {row.host: row for row in R.policies(robots).collect()}
    assert found["a.si"].crawl_delay == 2 and found["f.si"].crawl_delay == 3 and found["g.si"].crawl_delay == 3
    assert (found["f.si"].req_num, found["f.si"].req_secs) == (3, 20)
    assert found["f.si"].sitemap_url == "http://a.si/s2.xml" and found["g.si"].sitemap_url is None


LINES = ["User-agent: *", "User-agent: other", "Disallow: /a", "Allow: /a/b", "Disallow:", "Disallow: /", "", " ",
         "# note", "Crawl-delay: 4", "Crawl-delay: x", "Request-rate: 1/9", "Disallow: /b%2Fc", "nonsense", "allow:/a+b"]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.lists(st.sampled_from(LINES), max_size=12), min_size=25, max_size=40))
def test_equals_the_standard_library_parser(spark, files):
    texts = [(f"h{n}.si", "\n".join(lines)) for n, lines in enumerate(files)]
    robots = spark.createDataFrame(texts, "host string, content string")
    paths = ["/a", "/a/b", "/b/c", "/a+b", "/", "/zz"]
    asked = [(host, path) for host, _ in texts for path in paths]
    want, delays = [], {}
    for host, text in texts:
        parser = RobotFileParser()
        parser.parse(text.split("\n"))
        want += [parser.can_fetch("*", path) for path in paths]
        delays[host] = parser.crawl_delay("*") or 3
    assert verdicts(spark, robots, asked) == want
    assert {row.host: row.crawl_delay for row in R.policies(robots).collect()} == delays


MAPS = [
    ("http://a.si/sitemap.xml", "<urlset><url><loc>http://a.si/p1</loc></url><loc> http://a.si/nested/sitemap.xml </loc></urlset>"),
    ("http://a.si/nested/sitemap.xml", "<loc>http://a.si/p2?a=1&amp;b</loc><loc>http://a.si/sitemap.xml</loc><location>no</location>"),
    ("http://bad.si/sitemap.xml", "<urlset><url><loc>a</loc>"),
]


def test_sitemaps(spark):
    maps = spark.createDataFrame(MAPS, "url string, content string")
    flat = S.locations(maps).collect()
    assert len([row for row in flat if row.sitemap_url == MAPS[0][0]]) == 2
    assert [row.loc for row in flat if row.sitemap_url == MAPS[2][0]] == ["a"]
    roots = maps.where("url like '%.si/sitemap.xml'").select("url")
    found = {tuple(row) for row in S.expand(maps, roots).collect()}
    assert found == {
        (MAPS[0][0], "http://a.si/p1"), (MAPS[0][0], "http://a.si/p2?a=1&b"), (MAPS[2][0], "a"),
    }
    assert {tuple(row) for row in S.expand(maps, roots, max_depth=1).collect()} == found - {(MAPS[0][0], "http://a.si/p2?a=1&b")}
    names = ["http://someurl.com/nested/sitemap.xml", "http://a.si/feed.xml", "http://a.si/sitemap"]
    asked = spark.createDataFrame([(name,) for name in names], "url string")
    assert [row[0] for row in asked.select(S.is_nested("url")).collect()] == [True, False, False]


def test_site_rows(spark, robots):
    maps = spark.createDataFrame([("http://b.si/sitemap.xml", "B"), ("http://a.si/s2.xml", "F")], "url string, content string")
    seen = spark.createDataFrame([(f"http://{host}/x",) for host in ("a.si", "b.si", "f.si", "n.si")], "url string")
    known = spark.createDataFrame([("a.si",)], "domain string")
    rows = {row.domain: row for row in R.site_rows(seen, robots, maps, known).collect()}
    assert set(rows) == {"b.si", "f.si", "n.si"}
    assert rows["b.si"].sitemap_content == "B" and rows["f.si"].sitemap_content == "F"
    assert rows["n.si"].robots_content is None and rows["n.si"].sitemap_content is None


def test_numbers_that_fit_no_int_are_passed_over(spark):
    from siteloom.operators import robots

    rows = [("a", "User-agent: *\nCrawl-delay: 7\nCrawl-delay: 99999999999999\nRequest-rate: 1/" + "9" * 40)]
    found = robots.policies(spark.createDataFrame(rows, "host string, content string")).first()
    assert (found.crawl_delay, found.req_num, found.req_secs) == (7, None, None) or (found.crawl_delay, found.req_secs) == (7, None)
