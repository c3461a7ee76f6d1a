from urllib.parse import quote, urljoin, urlsplit

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siteloom.functions import urls
from siteloom.operators.canonical import canonicalise, collapse, distinct_urls


def apply(spark, rule, inputs):
    rows = spark.createDataFrame([(n, text) for n, text in enumerate(inputs)], "n int, url string")
    return [row[0] for row in rows.select("n", rule(F.col("url")).alias("out")).orderBy("n").select("out").collect()]


LONG = "http://www.Python.org/ena/dva/tri/stiri/pet/sest?kveri=parameter#l"


def test_sanitise(spark):
    given_urls = ["HTTP://www.Python.org/doc/#", "http://a.si/x?", "http://a.si/x//", "", "a b?c#"]
    assert apply(spark, urls.sanitise, given_urls) == [
        "http://www.Python.org/doc", "http://a.si/x", "http://a.si/x/", None, "a b?c",
    ]


def test_prune(spark):
    assert apply(spark, lambda u: urls.prune(u, 4), [LONG, "http://www.Python.org/ena"]) == [
        "http://www.Python.org/ena/dva/tri/stiri?kveri=parameter#l", "http://www.Python.org/ena",
    ]
    assert apply(spark, urls.prune, [LONG, "http://a.si"]) == [LONG, "http://a.si/"]


def test_encode_query(spark):
    wild = "http://www.Python.org/doc/neki?hack=* from USERS; DROP * WHERE user.id < 300000&hack2=yeet;#ezgg"
    tame = (
        "http://www.Python.org/doc/neki?hack=%2A%20from%20USERS%3B%20DROP%20%2A%20WHERE%20user.id"
        "%20%3C%20300000&hack2=yeet%3B#ezgg"
    )
    plain = "http://www.Python.org/ena/dva/tri/stiri/pet/sest"
    assert apply(spark, urls.encode_query, [wild, plain]) == [tame, plain]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_characters="#\r\n\t"), max_size=20), min_size=30, max_size=60))
def test_percent_encoding_equals_the_standard_library(spark, texts):
    assert apply(spark, urls.percent_encode, texts) == [quote(text, safe="=&") for text in texts]


def test_drop_www(spark):
    assert apply(spark, urls.drop_www, ["https://www.a.si/x", "HTTP://www.a.si", "http://a.si/?u=http://www.b.si"]) == [
        "https://a.si/x", "HTTP://www.a.si", "http://a.si/?u=http://b.si",
    ]


def test_canonical(spark):
    inputs = ["HTTP://www.A.si/x/", "http://a.si", "http://a.si/x//", "http://a.si/?q=1/", "http://a.si/a/#x/", LONG]
    assert apply(spark, urls.canonical, inputs) == [
        "http://A.si/x", "http://a.si/", "http://a.si/x/", "http://a.si/?q=1", "http://a.si/a/#x",
        LONG.replace("www.", ""),
    ]
    assert apply(spark, lambda u: urls.canonical(u, drop_fragment=True, encode=True), ["http://a.si/x?a b#c"]) == [
        "http://a.si/x?a%20b"
    ]


parts = st.tuples(
    st.sampled_from(["http", "HTTPS"]),
    st.sampled_from(["a.si", "www.a.si", "www.www.B.si:8080"]),
    st.lists(st.sampled_from(["", "a", "b.c", "http:"]), max_size=13).map(lambda s: "".join("/" + x for x in s)),
    st.sampled_from(["", "?", "?q=1/", "?/", "?x//"]),
    st.sampled_from(["", "#", "#f/", "#//"]),
)


@settings(max_examples=5, deadline=None)
@given(st.lists(parts, min_size=40, max_size=80))
def test_canonical_fixpoint_is_idempotent(spark, made):
    def rule(u):
        return urls.canonical(u, fixpoint=True)

    once = apply(spark, rule, [f"{s}://{a}{p}{q}{f}" for s, a, p, q, f in made])
    assert apply(spark, rule, once) == once


@settings(max_examples=5, deadline=None)
@given(st.lists(parts, min_size=40, max_size=80))
def test_split_equals_the_standard_library(spark, made):
    texts = [f"{s}://{a}{p}{q}{f}" for s, a, p, q, f in made]
    rows = spark.createDataFrame([(text,) for text in texts], "url string")
    split = urls.split("url")
    columns = [split.scheme, split.authority, split.path, split.query, split.fragment]
    assert [tuple(row) for row in rows.select(*columns).collect()] == [tuple(urlsplit(text)) for text in texts]


CASES = [
    ("http://a.si/x/y?q=1", "/z", "http://a.si/z"),
    ("http://a.si/x/y?q=1", "?p=2", "http://a.si/x/y?p=2"),
    ("http://a.si/x/y?q=1", "?", "http://a.si/x/y?q=1"),
    ("http://a.si", "?p=2", "http://a.si?p=2"),
    ("http://a.si/x/y", "//cdn.si/i.png", "http://cdn.si/i.png"),
    ("http://a.si/x", "/../b/./c", "http://a.si/b/c"),
    ("http://a.si/x", "/b/c/..", "http://a.si/b/"),
    ("http://a.si/x", "/.", "http://a.si/"),
    ("http://a.si/x", "#top", None),
    ("http://a.si/x", "", None),
    ("http://a.si/x", "foo.html", "foo.html"),
]


def resolved(spark, cases, mode):
    rows = spark.createDataFrame([(n, base, link) for n, (base, link, *_) in enumerate(cases)], "n int, base string, link string")
    return [row[1] for row in rows.select("n", urls.resolve("base", "link", mode)).orderBy("n").collect()]


def test_resolve(spark):
    assert resolved(spark, CASES, "rooted") == [want for _, _, want in CASES]


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["http://a.si/x/y/z?q=1", "http://a.si/", "http://a.si", "https://b.si/p/"]),
            st.lists(st.sampled_from(["..", ".", "a", "b.c", ""]), min_size=1, max_size=6).map("/".join),
            st.sampled_from(["", "?k=v", "#f", "?k#f"]),
        ),
        min_size=40,
        max_size=80,
    )
)
def test_resolve_all_equals_the_standard_library(spark, made):
    cases = [(base, path + tail) for base, path, tail in made if path and not path.startswith("//")]
    assert resolved(spark, cases, "all") == [urljoin(base, link) for base, link in cases]


def test_extension_and_names(spark):
    inputs = ["/a/b.tar.gz", "/a/.png", "/a.b/c", "/x.", "/img.PNG", "http://a.si/i.png;v=1?x.y"]
    assert apply(spark, urls.extension, inputs) == ["gz", "", "", "", "PNG", "png"]
    assert apply(spark, urls.file_name, ["http://a.si/x/i.png?v=1"]) == ["i.png?v=1"]
    assert apply(spark, urls.host_key, ["http://www.A.si:80/x"]) == ["A.si:80"]
    assert apply(spark, urls.robots_url, ["http://a.si/x"]) == ["http://a.si/robots.txt"]
    assert apply(spark, urls.default_sitemap_url, ["http://a.si/x"]) == ["http://a.si/sitemap.xml"]


def test_collapse(spark):
    pages = spark.createDataFrame([(1, "http://www.a.si/x/"), (2, "http://a.si/x"), (3, "http://a.si/y")], "page_id long, url string")
    table = canonicalise(pages)
    rows = {tuple(row) for row in collapse(table).collect()}
    assert rows == {("http://a.si/x", 2, 1), ("http://a.si/y", 1, 3)}
    assert distinct_urls(table).count() == 2
