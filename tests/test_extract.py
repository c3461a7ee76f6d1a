import pytest
from pyspark.sql import functions as F

from siteloom.operators import extract

PAGES = [
    (1, "http://a.si/x/y", """<base href="http://b.si/"><a href="/p/">p</a><a href="?q=1">q</a><a href="#t">t</a><a>no</a>
<img src="/i/one.png"><img src="two.jpg"><img src="/three.gif">"""),
    (2, "http://a.si/js", """<button onclick="window.location.href = 'http://a.si/r1'">b</button>
<a href="#" onclick="self.location='http://www.a.si/r2/'">c</a>
<button onclick="window.location.assign('http://a.si/r3')">d</button>"""),
    (3, "http://a.si/odd", """<!-- <a href="/no"> --><script>var x = '<a href="/no2">';</script><A title="a>b" HREF='/a&amp;b'>x</A>
<a data-href="/no3" href=/bare>y</a><abbr href="/no4"><a href="foo.html"><a href="mailto:x@a.si"><a href="javascript:void(0)"><a href="http://c.si/d e">"""),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string")


def urls_of(df, page_id):
    return [row[0] for row in df.where(F.col("page_id") == page_id).orderBy("pos").select("canonical_url").collect()]


@pytest.mark.parametrize("engine", ["native", "parser"])
def test_links(pages, engine):
    own = extract.links(pages, engine=engine, base="page")
    assert urls_of(own, 1) == ["http://a.si/p", "http://a.si/x/y?q=1"]
    on_base = extract.links(pages, engine=engine)
    assert urls_of(on_base, 1) == ["http://b.si/p", "http://b.si/?q=1"]
    assert urls_of(on_base, 3) == ["http://a.si/a&b", "http://a.si/bare", "http://c.si/d e"]
    everything = extract.links(pages, engine=engine, resolve="all")
    assert "http://a.si/foo.html" in urls_of(everything, 3)


@pytest.mark.parametrize("engine", ["native", "parser"])
def test_script_redirects(pages, engine):
    found = extract.links(pages, engine=engine, scripts=True)
    assert urls_of(found, 2) == ["http://a.si/r1", "http://a.si/r2", "http://a.si/r3"]


@pytest.mark.parametrize("engine", ["native", "parser"])
def test_images(pages, engine):
    rows = extract.images(pages, engine=engine).orderBy("pos").collect()
    assert [(r.src, r.filename, r.content_type) for r in rows] == [
        ("http://b.si/i/one.png", "one.png", "png"), ("two.jpg", "two.jpg", "jpg"),
    ]
    assert rows[0].path == "files/images/b.si/one.png"


def test_base_href(pages):
    assert {r.page_id: r.base_href for r in extract.base_hrefs(pages).collect()} == {
        1: "http://b.si/", 2: "http://a.si/js", 3: "http://a.si/odd",
    }


def test_allowed(spark):
    links = spark.createDataFrame(
        [("http://shop.gov.example/x",), ("http://a.shop.gov.example:80/",), ("http://x.si/?u=shop.gov.example",), ("http://notshop.gov.example/",)],
        "canonical_url string",
    )
    assert extract.allowed(links, ["shop.gov.example"]).count() == 2
    assert extract.allowed(links, ["shop.gov.example"], strict=False).count() == 4


def test_classes(spark):
    rows = [
        (1, "h", "text/html; charset=utf-8", 200, False, "HTML"), (2, "h", None, 203, False, "HTML"),
        (3, "h", "text/html", 302, True, "DUPLICATE"), (4, "h", "text/html", 404, False, None),
        (5, "h", "application/pdf", 500, False, "BINARY"), (6, "h", "application/pdf; charset=x", 200, False, None),
        (7, "h", "text/html", 204, False, None), (8, "h", "text/html", 301, False, None),
    ]
    ddl = "id int, html string, content_type string, http_status_code int, is_duplicate boolean, want string"
    classed = extract.classify(spark.createDataFrame(rows, ddl))
    assert classed.where(~F.col("page_type_code").eqNullSafe(F.col("want"))).count() == 0
    assert classed.where("html_content is not null").select("page_type_code").distinct().collect()[0][0] == "HTML"


def test_frontier_pages(spark, pages):
    found = extract.frontier_pages(extract.links(pages, scripts=True), pages)
    assert "http://a.si/r1" in {row.url for row in found.collect()}


def test_native_links_use_no_python_and_read_three_columns(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = extract.links(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and "Exchange" not in plan


def test_open_comments_quotes_and_many_attributes_are_linear(spark):
    import time

    from siteloom.functions import html

    texts = [
        "<!-- " * 200_000,
        "<script>" * 120_000,
        "<a href=\"x " * 100_000,
        "<a " + " ".join(f"k{n}='v'" for n in range(100_000)) + " href='/end'>",
        "<a href='/one'><!-- <a href='/two'>",
    ]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "n long, text string")
    found = df.select("n", F.explode(html.tags(html.visible("text"), ("a",))).alias("tag"))
    started = time.time()
    rows = {r.n: r.href for r in found.select("n", html.attribute(F.col("tag"), "href").alias("href")).collect()}
    assert time.time() - started < 30
    assert rows == {3: "/end", 4: "/one"}


def test_entities(spark):
    import html as library

    from siteloom.functions import html

    texts = ["/caf&eacute;&#38;z", "a&amp;lt;b", "x&#x41;&#0038;&#x1F600;", "&&;&nosuch;&#;&#x;q&lt", "no", "", "?a=1&b=2&copy;", "&#55296;&#99999999999999999999;"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(html.decode_entities(F.col("t"))).collect()]
    want = [library.unescape(t) for t in texts]
    want[3] = want[3].replace("<", "&lt")  # without a semicolon it stays
    want[7] = "\ufffd\ufffd"
    assert got == want
