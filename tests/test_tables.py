import glob

import pytest

from siteloom.operators import graph, integrity, report
from siteloom.sources import pajek
from siteloom.sources import tables as T
from siteloom.sources.tables import CorpusStore


def test_csv_sources(spark, tmp_path):
    (tmp_path / "link.csv").write_bytes(b"\xef\xbb\xbf2233;2248\r\n2244;2248\r\n")
    assert [tuple(row) for row in T.read_links(spark, str(tmp_path / "link.csv")).collect()] == [(2233, 2248), (2244, 2248)]
    (tmp_path / "site.csv").write_text('id;domain;r;s\n1;a.si;"User-agent: *\nDisallow: /";\n2;b.si;;\n')
    sites = T.read_sites(spark, str(tmp_path / "site.csv")).orderBy("site_id").collect()
    assert [(s.site_id, s.site_name) for s in sites] == [(1, "a.si"), (2, "b.si")] and "\n" in sites[0].robots
    (tmp_path / "page.csv").write_text("1;2;HTML;7;http://a.si;200;2019-03-01 10:00:00\n")
    page = T.read_page_list(spark, str(tmp_path / "page.csv"), header=False).first()
    assert page.status_code == 200 and page.time_retreived.year == 2019


def test_vocabulary_source(spark, tmp_path):
    (tmp_path / "v.txt").write_text("abc\n a \n a \nb c\n")
    found = {row.gram: row.idx for row in T.read_vocabulary(spark, str(tmp_path / "v.txt")).collect()}
    assert found == {"abc": 0, " a ": 2, "b c": 3}
    assert "a" in {row.gram for row in T.read_vocabulary(spark, str(tmp_path / "v.txt"), strip=True).collect()}


def test_pajek_round_trip(spark, tmp_path):
    (tmp_path / "g.net").write_text('*vertices 4\n1 258.0 0.0 0.0 ellipse\n2 "a b" 0.0 0.0 ellipse\n3 21\n4 22\n*arcs\n1 3 1.0\n1 4\n1 3 2.5\n')
    vertices, edges = pajek.read_pajek(spark, str(tmp_path / "g.net"))
    assert {tuple(row) for row in vertices.collect()} == {(1, "258.0"), (2, "a b"), (3, "21"), (4, "22")}
    assert sorted(tuple(row) for row in edges.collect()) == [(1, 3, 1.0), (1, 3, 2.5), (1, 4, 1.0)]
    assert {row.label: row.degree for row in graph.degrees(vertices, edges).collect()} == {"258.0": 3, "a b": 0, "21": 2, "22": 1}
    assert tuple(graph.summary(vertices, edges).first()) == (4, 3, 1.5)
    top = graph.hub_sites(graph.top_hubs(vertices, edges), spark.createDataFrame([(258, "e.si")], "site_id long, site_name string"))
    assert (top.first().label, top.first().name) == ("258.0", "e.si")
    assert graph.hub_share(edges).first().share == 1.0
    assert graph.without_out_arcs(vertices, edges).count() == 3

    labelled = spark.createDataFrame([("s 1", "p1"), ("s 1", "p2")], "src string, dst string")
    pajek.write_pajek(labelled, str(tmp_path / "out"))
    text = "".join(open(part).read() for part in sorted(glob.glob(str(tmp_path / "out" / "part-*"))))
    assert text.splitlines() == [
        "*vertices 3", "1 p1 0.0 0.0 ellipse", "2 p2 0.0 0.0 ellipse", '3 "s 1" 0.0 0.0 ellipse', "*arcs", "3 1 1.0", "3 2 1.0",
    ]
    back, arcs = pajek.read_pajek(spark, str(tmp_path / "out"))
    assert back.count() == 3 and arcs.count() == 2


@pytest.fixture()
def store(spark, tmp_path):
    made = CorpusStore(spark, str(tmp_path / "store"))
    made.create()
    return made


def page_rows(spark, urls):
    rows = [(None, "HTML", None, url, "h", 200) for url in urls]
    return spark.createDataFrame(rows, "site_id long, page_type_code string, lsh_hash string, url string, html_content string, http_status_code int")


def test_store(spark, store):
    assert [row.code for row in store.read("data_type").orderBy("code").collect()] == ["DOC", "DOCX", "PDF", "PPT", "PPTX"]
    store.add_pages(page_rows(spark, ["http://a.si/1", "http://a.si/2", "http://a.si/2"]))
    store.add_pages(page_rows(spark, ["http://a.si/2", "http://a.si/3"]))
    assert sorted(row.url[-1] for row in store.read("page").collect()) == ["1", "2", "3"]

    site = ("https://x.ru", "User-agent: * Disallow: / search", "<urlset></urlset>")
    sites = spark.createDataFrame([site, site], "domain string, robots_content string, sitemap_content string")
    store.add_sites(sites)
    store.add_sites(sites)
    assert [tuple(row)[1:] for row in store.read("site").collect()] == [site]

    images = [("http://a.si/1", "i.png", "png", "p"), ("http://none.si", "j.png", "png", "p")]
    store.add_images(spark.createDataFrame(images, "page_url string, filename string, content_type string, path string"))
    assert [row.filename for row in store.read("image").collect()] == ["i.png"]
    files = spark.createDataFrame([("http://a.si/2", "PDF", "p"), ("http://none.si", "PDF", "p")], "url string, data_type_code string, path string")
    assert [row.url for row in store.add_files(files).collect()] == ["http://none.si"]
    assert store.read("page_data").count() == 1
    pairs = spark.createDataFrame([("http://a.si/1", "http://a.si/2"), ("http://a.si/1", "http://none.si")] * 2, "from_url string, to_url string")
    store.add_links_by_url(pairs)
    store.add_links_by_url(pairs)
    assert store.read("link").count() == 1

    tables = {name: store.read(name) for name in T.SCHEMAS}
    assert integrity.foreign_key_violations(tables).count() == 0
    assert integrity.column_violations(tables).where("n_rows > 0").count() == 0
    assert store.query("SELECT url FROM page WHERE url = ?", ["http://a.si/3"]).count() == 1
    assert store.query_one("SELECT url FROM page WHERE url = ?", ["none"]) is None

    store.truncate()
    assert all(store.read(name).count() == 0 for name in T.CLEARED)
    assert store.read("page_type").count() == 4


def test_keep_first(spark):
    rows = spark.createDataFrame([("u", 2, 1, "b"), ("u", 1, 9, "a"), ("v", 1, 3, "c"), (None, 1, 4, "d")], "url string, t int, id int, html string")
    kept = integrity.keep_first(rows, "url", ["t", "id"])
    assert sorted(row.html for row in kept.collect()) == ["a", "c", "d"]


def test_document_layout(spark, store):
    rows = spark.createDataFrame([("http://a.si/x.pdf", "PDF", "a.si")], "url string, data_type_code string, host string")
    store.write_documents(rows)
    assert glob.glob(f"{store.root}/files_index/data_type_code=PDF/host=a.si/*.parquet")


def test_report(spark):
    items = spark.createDataFrame([(1, "PDF", 10), (1, "PDF", 20), (2, "DOC", 5)], "page_id int, type string, size int")
    assert tuple(report.per_page(items).first()) == (2, 1.5, 2)
    shares = {row.type: row.share for row in report.type_share(items, "type").collect()}
    assert shares["PDF"] == pytest.approx(2 / 3)
    assert {row.type: row.bytes for row in report.bytes_by_type(items, "type", "size").collect()} == {"PDF": 30, "DOC": 5}
    pages = spark.sql("SELECT timestamp_ntz'2024-01-01' AS accessed_time UNION ALL SELECT timestamp_ntz'2024-01-01 00:00:04'")
    assert tuple(report.crawl_speed(pages).first()) == (2, 4.0, 0.5)
    assert tuple(report.totals({"pages": pages}).first()) == ("pages", 2)


def test_seeds(spark):
    assert T.seeds(spark, ["http://a.si", "http://a.si", "http://b.si"]).count() == 2


def test_pajek_with_many_sections(spark, tmp_path):
    from siteloom.sources.pajek import read_pajek

    text = "".join(f"*partition p{k}\n{k}\n" for k in range(1200)) + "*vertices 2\n1 \"a b\"\n2 c\nodd line\n*arcs\n1 2\n2 1 0.5\n99999999999999999999 1\n"
    (tmp_path / "net").write_text(text)
    vertices, edges = read_pajek(spark, str(tmp_path / "net"))
    assert sorted(map(tuple, vertices.collect())) == [(1, "a b"), (2, "c")]
    assert sorted(map(tuple, edges.collect())) == [(1, 2, 1.0), (2, 1, 0.5)]


def test_keys(spark):
    from siteloom.operators import integrity

    rows = spark.createDataFrame([(1, "u"), (1, "v"), (2, "v"), (3, None), (4, None)], "id long, url string")
    found = integrity.key_violations({"page": rows}, [("page", ["id"]), ("page", ["url"]), ("page", ["id", "url"])])
    assert sorted(map(tuple, found.collect())) == [("page(id)", "1", 2), ("page(url)", "v", 2)]
    assert integrity.keep_first(rows, "url", ["id"]).count() == 4
