"""The indexed store, the ingest flow, streams with state, and records of files read in splits."""

import csv
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from siteloom.operators import dedup, frontier, integrity, minhash
from siteloom.plans import ingest as plan
from siteloom.sources import records
from siteloom.sources import tables as T
from siteloom.sources.indexed import IndexedStore
from siteloom.streaming import arrivals, ingest, politeness

SCHEME = minhash.Scheme(num_bands=1, num_hash=1)


@pytest.fixture(scope="module")
def vocab(spark):
    return spark.createDataFrame([(g, n) for n, g in enumerate(["the", "THE", "oth", "qui"])], "gram string, idx long")


def page_rows(spark, rows):
    made = spark.createDataFrame(rows, "url string, html_content string")
    return made.select(
        F.lit(None).cast("long").alias("site_id"), F.lit("HTML").alias("page_type_code"), F.lit(None).cast("string").alias("lsh_hash"),
        "url", "html_content", F.lit(200).alias("http_status_code"), F.lit(None).cast("timestamp_ntz").alias("accessed_time"),
    )


def test_indexed_store(spark, tmp_path, vocab):
    store = IndexedStore(spark, str(tmp_path / "store"), vocab, SCHEME, buckets=2, parts=4)
    store.create()
    assert store.read("page").count() == 0 and store.last_batch() == -1
    text = "the quick brown fox jumps over the lazy dog and runs away from it"
    store.add_pages(page_rows(spark, [("http://a/1", text), ("http://a/2", "something else"), ("http://a/1", text + "!"), (None, text)]))
    similarity = dedup.matching_blocks(autojunk=False)
    second = [("http://a/1", "again"), ("http://a/3", text), ("http://a/4", "a third kind of text, quite new"), ("http://a/5", None)]
    found = store.add_pages(page_rows(spark, second), similarity=similarity)
    pages = {r.url: r for r in store.read("page").collect()}
    assert set(pages) == {f"http://a/{k}" for k in range(1, 6)}
    assert {u: r.page_type_code for u, r in pages.items() if r.page_type_code != "HTML"} == {"http://a/3": "DUPLICATE"}
    assert pages["http://a/3"].html_content is None and pages["http://a/1"].html_content.startswith(text)
    assert [(r.page_id, r.orig_id) for r in found.collect()] == [(pages["http://a/3"].id, pages["http://a/1"].id)]
    assert all((r.lsh_hash is None) == (u == "http://a/5") for u, r in pages.items())
    assert [tuple(r) for r in store.read("link").collect()] == [(pages["http://a/1"].id, pages["http://a/3"].id)]
    signed = minhash.signatures(page_rows(spark, [("u", text)]).select(F.lit(1).alias("page_id"), F.col("html_content").alias("text")), vocab, SCHEME, doc_id="page_id")
    assert pages["http://a/3"].lsh_hash == signed.first().sig
    # The same batch again, by another session, changes nothing.
    again = IndexedStore(spark, str(tmp_path / "store"), vocab, SCHEME)
    again.add_pages(page_rows(spark, second), 1, similarity=similarity)
    assert {r.url: (r.id, r.page_type_code) for r in again.read("page").collect()} == {u: (r.id, r.page_type_code) for u, r in pages.items()}
    assert again.query("SELECT count(*) AS n FROM page WHERE page_type_code = ?", ["HTML"]).first().n == 4
    again.truncate()
    assert again.read("page").count() == 0
    again.add_pages(page_rows(spark, [("http://a/1", text)]))
    assert [r.url for r in again.read("page").collect()] == ["http://a/1"]


def test_appends_read_no_stored_urls(spark, tmp_path, monkeypatch):
    store = IndexedStore(spark, str(tmp_path / "store"), buckets=2)
    store.create()
    for k in range(8):
        store.add_pages(page_rows(spark, [(f"http://a/{n}", "x") for n in range(5 * k, 5 * k + 10)]))
    page = store.read("page")
    assert page.count() == 45 and integrity.key_violations({"page": page}, [("page", ["id"]), ("page", ["url"])]).count() == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = spark.createDataFrame([(1, 2)], "id long, check long")
    shown = store.met(rows, 9)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert shown.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in shown and "url" not in shown
    # Two URLs with one id: as if the hash function made them collide.
    monkeypatch.setattr(T, "row_id", lambda column: F.lit(77).cast("long"))
    with pytest.raises(ValueError, match="two URLs"):
        store.add_pages(page_rows(spark, [("http://b/1", "x"), ("http://b/2", "x")]))
    store.add_pages(page_rows(spark, [("http://b/1", "x")]))
    with pytest.raises(ValueError, match="two URLs"):
        store.add_pages(page_rows(spark, [("http://b/2", "x")]))
    assert store.read("page").count() == 46


def fetched(spark, rows):
    made = spark.createDataFrame(rows, "url string, html string, content_type string")
    return made.withColumns({"http_status_code": F.lit(200), "accessed_time": F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")})


TEXT = "the quick brown fox jumps over the lazy dog and runs away from it "
BATCHES = [
    [("http://h/1", f'{TEXT}<a href="/2">x</a><img src="/i.png">', "text/html"), ("http://h/f.pdf", "%PDF", "application/pdf"), ("http://h/x", "?", "text/odd")],
    [("http://h/2", 'other words that are not like it <a href="/1">y</a><a href="/3">z</a>', None), ("http://h/1", "again", "text/html")],
    [("http://g/3", f'{TEXT}<a href="/2">x</a><img src="/i.png">', "text/html"), ("http://h/3", "third page, quite new in this store", "text/html")],
]


def state_of(store):
    page = {r.id: (r.url, r.page_type_code) for r in store.read("page").collect()}
    return {
        "site": sorted(r.domain for r in store.read("site").collect()),
        "page": sorted(page.values()),
        "image": sorted((page[r.page_id][0], r.filename) for r in store.read("image").collect()),
        "page_data": sorted((page[r.page_id][0], r.data_type_code) for r in store.read("page_data").collect()),
        "link": sorted((page[r.from_page][0], page[r.to_page][0]) for r in store.read("link").collect()),
    }


WANT = {
    "site": ["g", "h"],
    "page": [("http://g/3", "DUPLICATE"), ("http://h/1", "HTML"), ("http://h/2", "HTML"), ("http://h/3", "HTML"), ("http://h/f.pdf", "BINARY")],
    "image": [("http://h/1", "i.png")],
    "page_data": [("http://h/f.pdf", "PDF")],
    "link": [("http://h/1", "http://g/3"), ("http://h/2", "http://h/1")],
}


def test_stream_to_all_tables(spark, tmp_path, vocab):
    """Three files, a repeated URL, and a failure in the middle of the second batch."""
    source, root, progress = (str(tmp_path / name) for name in ("in", "store", "progress"))
    options = {"similarity": dedup.matching_blocks(autojunk=False)}

    def opened():
        return IndexedStore(spark, root, vocab, SCHEME, buckets=2, parts=4)

    opened().create()
    for number, rows in enumerate(BATCHES):
        fetched(spark, rows).coalesce(1).write.mode("append").parquet(source)
        store = opened()
        if number == 1:

            def broken(pairs):
                raise RuntimeError("lost")

            store.add_links_by_url = broken
            with pytest.raises(Exception, match="lost"):
                ingest.start(store, source, progress, **options).awaitTermination()
            store = opened()
        ingest.start(store, source, progress, **options).awaitTermination()
    assert state_of(store) == WANT
    robots = spark.createDataFrame([("k", "User-agent: *")], "host string, content string")
    plan.ingest(store, fetched(spark, [("http://k/1", "one more", "text/html")]), robots=robots)
    assert {r.domain: r.robots_content for r in store.read("site").collect()} == {"g": None, "h": None, "k": "User-agent: *"}


def test_arrivals_store_a_url_once(spark, tmp_path, vocab):
    source, store, progress = (str(tmp_path / name) for name in ("in", "store", "progress"))
    for rows in ([(1, "u1", TEXT), (2, "u2", None), (9, "u1", "x")], [(3, "u1", "new text"), (4, None, TEXT + "!"), (5, "u5", TEXT)]):
        spark.createDataFrame(rows, arrivals.ARRIVALS).coalesce(1).write.mode("append").parquet(source)
        arrivals.start(spark, source, store, progress, vocab, SCHEME, similarity=dedup.matching_blocks(autojunk=False)).awaitTermination()
    assert {(r.page_id, r.page_type_code) for r in arrivals.stored_pages(spark, store).collect()} == {(1, "HTML"), (2, "HTML"), (4, "DUPLICATE"), (5, "DUPLICATE")}


def test_fetch_plan_over_batches(spark, tmp_path):
    source, folder, progress = (str(tmp_path / name) for name in ("in", "plan", "progress"))
    robots = spark.createDataFrame([("slow", "User-agent: *\nDisallow: /x\nCrawl-delay: 10")], "host string, content string")
    rng = random.Random(2)
    want, last, seen = {}, {}, set()
    batches = []
    for number, time in enumerate((0, 25, 26)):
        rows = [(f"http://{rng.choice(['a', 'b', 'slow'])}/{rng.randrange(12)}", time + rng.randrange(3)) for _ in range(25)]
        batches.append(rows)
        by_host = defaultdict(dict)
        for url, at in rows:
            if url not in seen:
                host = url.split("/")[2]
                by_host[host][url] = min(at, by_host[host].get(url, at))
        for host, some in by_host.items():
            delay = 10 if host == "slow" else 3
            at = max([min(some.values())] + ([last[host] + delay] if host in last else []))
            for k, url in enumerate(sorted(some)):
                want[url] = at + k * delay
            last[host] = at + (len(some) - 1) * delay
        seen |= {url for url, _ in rows}
    for number, rows in enumerate(batches):
        spark.createDataFrame(rows, politeness.ARRIVALS).coalesce(1).write.mode("append").parquet(source)
        fetch = politeness.FetchPlan(spark, folder, robots, buckets=2)  # a restart before each batch
        if number == 1:
            fetch.hosts.write = None  # fails after the plan of the batch is written
            with pytest.raises(Exception, match="NoneType"):
                fetch.start(source, progress).awaitTermination()
            fetch = politeness.FetchPlan(spark, folder, robots)
        fetch.start(source, progress).awaitTermination()
    got = fetch.planned().collect()
    assert {r.url: r.fetch_at for r in got} == want and len(got) == len(want)
    times = fetch.planned().select("host", "crawl_delay", F.timestamp_seconds("fetch_at").cast("timestamp_ntz").alias("accessed_time"))
    assert frontier.audit_delays(times).count() == 0


# --- records of files ----------------------------------------------------------------------------------------


def site_rows(n):
    rng = random.Random(4)
    texts = ["plain", "", 'a;"5"', "two\nlines", "\n", "ends with \\", 'x"y', '"', 'q";\n"', "User-agent: *\n\nDisallow: /a\r\n", "é;;", "  wide  "]
    return [(k, rng.choice(["h.si", "a b"]), "".join(rng.choices(texts, k=rng.randint(0, 3))) or None, rng.choice(texts) or None) for k in range(n)]


@pytest.mark.parametrize("escape", ["\\", '"'])
@pytest.mark.parametrize("size", ["128m", "1000", "64"])
def test_sites_in_splits(spark, tmp_path, escape, size):
    rows = site_rows(150)
    path = str(tmp_path / "sites")
    table = spark.createDataFrame(rows, "site_id long, site_name string, robots string, sitemap string")
    write = {"sep": ";", "header": True, "escape": escape, "quoteAll": True, "ignoreTrailingWhiteSpace": False, "ignoreLeadingWhiteSpace": False}
    table.coalesce(2).write.csv(path, **write)
    read = {"sep": ";", "header": True, "escape": escape, "ignoreTrailingWhiteSpace": True, "multiLine": True}
    want = {tuple(r) for r in spark.read.csv(path, schema=T.SITE_CSV, **read).collect()}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        got = T.read_sites(spark, path, escape=escape)
        found = got.collect()
        splits = spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert {tuple(r) for r in found} == want and len(found) == 150
    assert splits > 2 or size == "128m"


def test_sites_as_another_library_writes_them(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "MOST_SPLITS", 0)  # the way without a broadcast
    rows = [(k, n, r or "", s or "") for k, n, r, s in site_rows(80)]
    rows = [(k, n, r.replace("\r", ""), s.replace("\r", "")) for k, n, r, s in rows]
    with open(tmp_path / "sites.csv", "w", newline="", encoding="utf-8-sig") as file:
        out = csv.writer(file, delimiter=";", lineterminator="\r\n")
        out.writerow(["id", "domain", "robots", "sitemap"])
        out.writerows(rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        found = T.read_sites(spark, str(tmp_path / "sites.csv"), escape='"').collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {(r.site_id, r.site_name, (r.robots or "").rstrip(), (r.sitemap or "").rstrip()) for r in found} == {
        (k, n, r.rstrip(), s.rstrip()) for k, n, r, s in rows
    }


def test_vocabulary_lines_are_numbered_over_splits(spark, tmp_path):
    lines = [f"{k % 70:03d} \t" for k in range(400)]
    (tmp_path / "v.txt").write_text("\n".join(lines), newline="")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        table = T.read_vocabulary(spark, str(tmp_path / "v.txt"))
        assert "PythonRDD" not in table._jdf.queryExecution().executedPlan().toString()
        assert {r.gram: r.idx for r in table.collect()} == {line: k for k, line in enumerate(lines)}
        assert {r.gram for r in T.read_vocabulary(spark, str(tmp_path / "v.txt"), strip=True).collect()} == {line.strip() for line in lines}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_file_sizes(spark, tmp_path):
    files = spark.createDataFrame([("a/b.pdf", b"123"), ("c.doc", b"4"), ("a/b.pdf", b"12")], "path string, content binary")
    assert {tuple(r) for r in T.write_files(files, str(tmp_path / "files")).collect()} == {("a/b.pdf", 3), ("c.doc", 1)}
    sizes = T.file_sizes(spark, str(tmp_path / "files"))
    assert {tuple(r) for r in sizes.collect()} == {("a/b.pdf", 3), ("c.doc", 1)}
    assert "content" not in sizes._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
    with pytest.raises(Exception, match="leads out"):
        T.write_files(spark.createDataFrame([("../x", b"1")], "path string, content binary"), str(tmp_path / "files"))
