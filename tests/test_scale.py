"""Structures that keep work local: key tables, the visited set, prefix joins, shared sitemaps, verification by ids."""

import random
import re

import pytest
from pyspark.sql import functions as F

from siteloom.operators import dedup, frontier, minhash, robots, sitemap
from siteloom.session import materialise
from siteloom.sources.keyed import KeyTable
from siteloom.sources.signed import SignatureIndex


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def sorted_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# --- key tables --------------------------------------------------------------------------------------------


def test_key_table(spark, tmp_path, sorted_joins):
    path = str(tmp_path / "keys")
    table = KeyTable(spark, path, "id long, name string", "id", 3)
    assert table.read().count() == 0
    table.write(spark.range(100).select("id", F.lit("a").alias("name")), 0)
    table.write(spark.range(100, 140).select("id", F.lit("b").alias("name")), 1)
    table.write(spark.range(100, 150).select("id", F.lit("c").alias("name")), 1)  # run again
    again = KeyTable(spark, path, "id long, name string", "id", 99)  # another session
    assert again.buckets == 3
    assert {r["name"]: r["count"] for r in again.read().groupBy("name").count().collect()} == {"a": 100, "c": 50}
    assert again.read(1).count() == 100 and again.at(1).count() == 50
    asked = spark.range(0, 1000, 7)
    plan = plan_of(again.read().join(asked, "id", "left_semi"))
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    again.clear()
    assert again.read().count() == 0
    again.detach()


# --- the visited set ---------------------------------------------------------------------------------------


def links_of(spark, pairs):
    return spark.createDataFrame(pairs, "src string, dst string")


def test_a_level_shuffles_its_targets_alone(spark, tmp_path, sorted_joins):
    by_source = KeyTable(spark, str(tmp_path / "links"), "src string, dst string", "src", 4)
    visited = KeyTable(spark, str(tmp_path / "visited"), "url string", "url", 4)
    by_source.write(links_of(spark, [(f"u{k}", f"u{(3 * k + 1) % 50}") for k in range(50)]), 0)
    visited.write(spark.createDataFrame([("u1",)], "url string"), 0)
    plan = plan_of(frontier.next_urls(visited, by_source, None, None, 1))
    assert plan.count("Exchange") == 1
    visited.write_dealt(frontier.next_urls(visited, by_source, None, None, 1), 1, append=True)
    assert [r.url for r in visited.at(1).select("url").collect()] == ["u4"]


def test_a_long_chain_and_no_tables_left(spark):
    pairs = [(f"n{k}", f"n{k + 1}") for k in range(30)] + [(f"n{k}", "n0") for k in range(31)]
    before = {t.name for t in spark.catalog.listTables()}
    found = {r.url: r.level for r in frontier.bfs(links_of(spark, [("n0", "n0")]).select(F.col("src").alias("url")), links_of(spark, pairs)).collect()}
    assert found == {f"n{k}": k for k in range(31)}
    with pytest.raises(Exception, match="nowhere"):
        frontier.bfs(spark.createDataFrame([("n0",)], "url string"), links_of(spark, pairs), host_links=spark.range(1).select(F.raise_error(F.lit("nowhere")).alias("host"), F.lit("x").alias("dst")))
    assert {t.name for t in spark.catalog.listTables()} == before


# --- robots ------------------------------------------------------------------------------------------------


def first_rule(rules, path):
    return next((allow for allow, prefix in rules if path.startswith(prefix)), True)


def test_many_rules_go_by_prefix(spark):
    rng = random.Random(1)
    rules = {"big": [], "small": [(False, "/a/"), (True, "/a")]}
    for _ in range(3000):
        rules["big"].append((rng.random() < 0.4, "/" + "/".join(rng.choices("abcdef", k=rng.randint(1, 6)))))
    rules["big"].insert(1500, (False, "/zz"))
    text = {h: "User-agent: *\n" + "\n".join(("Allow: " if a else "Disallow: ") + p for a, p in some) for h, some in rules.items()}
    content = spark.createDataFrame(list(text.items()), "host string, content string")
    asked = []
    for k in range(4000):
        path = "/" + "/".join(rng.choices("abcdefz", k=rng.randint(0, 8)))
        asked.append((k, f"http://{rng.choice(['big', 'small', 'none'])}{path}"))
    pages = spark.createDataFrame(asked, "page_id long, url string")
    want = {}
    for k, url in asked:
        host, path = re.match(r"http://([^/]*)(.*)", url).groups()
        want[k] = first_rule(rules.get(host, []), path or "/")
    for few in (100, 0, 10**6):
        rows = robots.with_permission(pages, content, few=few).collect()
        assert {r.page_id: r.allow for r in rows} == want and len(rows) == len(asked)
    assert set(robots.with_permission(pages, content).columns) == {"page_id", "url", "host", "allow"}


def test_twenty_thousand_rules(spark):
    lines = "\n".join(f"Disallow: /d{k}/" for k in range(20_000))
    content = spark.createDataFrame([("h", f"User-agent: *\n{lines}")], "host string, content string")
    pages = spark.range(200_000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h/d"), (F.col("id") % 40_000).cast("string"), F.lit("/x")).alias("url"))
    counted = robots.with_permission(pages, content).groupBy("allow").count().collect()
    assert {r["allow"]: r["count"] for r in counted} == {True: 100_000, False: 100_000}


# --- sitemaps ----------------------------------------------------------------------------------------------


def sitemap_text(locs):
    return "<urlset>" + "".join(f"<loc>{u}</loc>" for u in locs) + "</urlset>"


def test_roots_share_one_walk(spark, monkeypatch):
    tree = {"http://h/sitemap-all.xml": ["http://h/sitemap-1.xml", "http://h/sitemap-2.xml"]}
    tree["http://h/sitemap-1.xml"] = ["http://h/p1", "http://h/sitemap-all.xml", "http://h/sitemap-3.xml"]
    tree["http://h/sitemap-2.xml"] = ["http://h/p2", "http://h/p1"]
    tree["http://h/sitemap-3.xml"] = ["http://h/p3", "http://h/sitemap-lost.xml"]
    roots = [f"http://r{k}/sitemap.xml" for k in range(200)]
    tree |= {r: ["http://h/sitemap-all.xml", f"{r}/own"] for r in roots}
    tables = spark.createDataFrame([(u, sitemap_text(locs)) for u, locs in tree.items()], "url string, content string")
    asked = spark.createDataFrame([(r,) for r in roots], "url string")
    walks, closures = [], sitemap.closures

    def watched(*given):
        found = closures(*given)
        walks.append(found.count())
        return found

    monkeypatch.setattr(sitemap, "closures", watched)
    got = {tuple(r) for r in sitemap.expand(tables, asked).collect()}
    assert got == {(r, u) for r in roots for u in (f"{r}/own", "http://h/p1", "http://h/p2", "http://h/p3")}
    assert walks == [5]  # one entry with five sitemaps (one of them not stored), not 200 times as many
    by_depth = [sum(1 for r in sitemap.expand(tables, asked, depth).collect()) // 200 for depth in (0, 1, 2, 3, 4)]
    assert by_depth == [0, 1, 1, 3, 4]


# --- verification by ids ------------------------------------------------------------------------------------


def near_texts(n, seed=5):
    rng = random.Random(seed)
    base = "the quick brown fox jumps over the lazy dog near the river bank and runs away from it"
    rows = []
    for k in range(n):
        place = rng.randrange(len(base))
        rows.append((k, base[:place] + rng.choice("xyzq") * rng.randint(1, 9) + base[place:]))
    return rows


SCHEME = minhash.Scheme(num_bands=4, num_hash=8)


def vocabulary(pages):
    return minhash.vocabulary(pages, 30)


def greedy_any(rows, bands, known, score, threshold, stored=frozenset()):
    kept, found = [], {}
    for page, text in sorted(rows, key=lambda r: (r[0] not in stored, r[0])):
        if page not in stored:
            for other, before in kept:
                near = known[page] and any(a == b for a, b in zip(bands[page], bands[other]))
                if (near or text.lower() == before.lower()) and score(text.lower(), before.lower()) >= threshold:
                    found[page] = other
                    break
        if page not in found:
            kept.append((page, text))
    return found


def jaccard_of(a, b):
    x, y = ({t[k : k + 3] for k in range(len(t) - 2)} for t in (a, b))
    return len(x & y) / len(x | y) if x | y else 1.0


@pytest.mark.parametrize(("block", "parts", "threshold"), [(2, 1, 0.8), (32, 7, 0.9), (4, 3, 0.85)])
def test_any_band_against_brute_force(spark, block, parts, threshold):
    rows = near_texts(70) + [(200, "###"), (201, "###"), (202, "####"), (203, "")]
    pages = spark.createDataFrame(rows, "page_id long, text string")
    vocab = vocabulary(pages)
    signed = {r.page_id: r for r in minhash.signatures(pages, vocab, SCHEME, doc_id="page_id").collect()}
    bands, known = ({p: r[c] for p, r in signed.items()} for c in ("bands", "has_units"))
    want = greedy_any(rows, bands, known, jaccard_of, threshold)
    options = {"similarity": dedup.shingle_jaccard(), "match": "any_band", "threshold": threshold, "block": block, "hot_rows": 50}
    found = dedup.near_duplicates(pages.repartition(parts), vocab, SCHEME, **options)
    assert {r.page_id: r.orig_id for r in found.collect()} == want and len(want) > 5
    if parts == 3:
        stored = {k for k, _ in rows if k % 3 == 0}
        want = greedy_any(rows, bands, known, jaccard_of, threshold, stored)
        is_stored = F.col("page_id") % 3 == 0
        found = dedup.near_duplicates(pages.where(~is_stored), vocab, SCHEME, history=pages.where(is_stored), **options)
        assert {r.page_id: r.orig_id for r in found.collect()} == want


def test_pairs_hold_no_texts(spark):
    rows = near_texts(300)
    texts = spark.createDataFrame(rows, "page_id long, text string")
    similarity = dedup.matching_blocks(autojunk=False)
    members = materialise(texts.select(
        "page_id", F.lit("k").alias("key"), F.lit(True).alias("is_new"), F.length("text").cast("long").alias("n_chars"), F.lit(0).alias("band"),
        similarity.profile(F.col("text")).alias("profile"),
    ))
    kept = members.where("page_id < 3")
    pairs = dedup._candidates(members, kept, similarity, 0.9, 10**6)
    assert "text" not in pairs.columns and not re.search(r"\btext#", plan_of(pairs))
    chosen = pairs.collect()
    assert len(chosen) > 400
    scored = dedup._verify(spark.createDataFrame(chosen), texts, similarity, 0.9).collect()
    from difflib import SequenceMatcher

    by = dict(rows)
    ratio = {(r.page_id, r.orig_id): SequenceMatcher(None, by[r.page_id], by[r.orig_id], False).ratio() for r in chosen}
    # Bounds lose no pair: all pairs of a later with an earlier page were either dropped below 0.9 or verified.
    every = {(a, b): SequenceMatcher(None, by[a], by[b], False).ratio() for a in by for b in range(3) if b < a}
    assert {(r.page_id, r.orig_id) for r in scored} == {p for p, v in every.items() if v >= 0.9}
    assert all(abs(r.score - ratio[r.page_id, r.orig_id]) < 1e-12 for r in scored)


# --- the index of signatures --------------------------------------------------------------------------------


def test_index_reads_texts_of_contested_keys_alone(spark, tmp_path, sorted_joins):
    rng = random.Random(3)
    others = [(1000 + k, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=60))) for k in range(150)]
    rows = near_texts(40) + others + [(2000, "###"), (2001, "%%")]
    pages = spark.createDataFrame(rows, "page_id long, text string")
    vocab = vocabulary(pages.where("page_id < 2000"))
    scheme = minhash.Scheme(num_bands=1, num_hash=2)
    old, new = pages.where("page_id % 4 <> 1"), pages.where("page_id % 4 = 1")
    index = SignatureIndex(spark, str(tmp_path / "index"), vocab, scheme, parts=32)
    index.append(old.where("page_id % 2 = 0"), 0)
    index.append(old.where("page_id % 2 = 1"), 1)
    index.append(old.where("page_id % 2 = 1"), 1)  # run again
    options = {"similarity": dedup.shingle_jaccard(), "threshold": 0.8}
    want = {tuple(r) for r in dedup.dedup_batch(new, old, vocab, scheme, **options).collect()}
    index = SignatureIndex(spark, str(tmp_path / "index"), vocab, scheme, parts=5)  # another session
    assert index.parts == 32
    assert {tuple(r) for r in dedup.dedup_signed(new, index, **options).collect()} == want and want
    signed = dedup.described(new, vocab, scheme)
    plan = plan_of(index.hits(signed))
    scan = plan.split("SortMergeJoin")[1].split("Exchange")[0]  # the index's side: sorted and filtered where it lies
    assert "Bucketed: true" in scan and "text" not in plan.split("Bucketed: true")[0].split("FileScan")[-1]
    one = spark.createDataFrame([rows[0]], "page_id long, text string")  # a stored page
    asked = index.describe(one).select("page_id", "key")
    read = index.texts(asked)
    part = index.describe(one).first().part
    assert f"part IN ({part})" in plan_of(read) or f"part#" in plan_of(read) and f" = {part})" in plan_of(read)
    assert read.count() == 1
    assert dedup.dedup_signed(one, index, before=0, **options).count() == 0
