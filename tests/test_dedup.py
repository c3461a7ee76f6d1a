from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from siteloom.functions.text import characters, shingles
from siteloom.operators import dedup, minhash
from siteloom.operators.minhash import Scheme

TOY = Scheme(
    num_bands=2,
    hash_funcs=[lambda i: (i + 1) % 5, lambda i: (3 * i + 1) % 5],
    shingle=characters,
)


@pytest.fixture(scope="module")
def letters(spark):
    return spark.createDataFrame([(c, n) for n, c in enumerate("abcde")], "gram string, idx long")


def test_toy_signatures(spark, letters):
    texts = ["ad", "c", "bde", "acd", "a", "", "afb"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {texts[row.doc_id]: row for row in minhash.signatures(docs, letters, TOY).collect()}
    big = 2**31 - 1
    want = {
        "ad": ([1, 0], [7, 6]), "c": ([3, 2], [5, 4]), "bde": ([0, 0], [6, 6]), "acd": ([1, 0], [7, 6]),
        "a": ([1, 1], [7, 7]), "": ([big, big], [2147483641, 2147483641]), "afb": ([1, 1], [7, 7]),
    }
    assert {text: (row.dense, row.bands) for text, row in rows.items()} == want
    assert rows["ad"].sig == "7-6" and not rows[""].has_units
    sets = minhash.encoded_sets(minhash.encode(docs, letters, shingle=characters))
    assert {texts[row.doc_id]: row.indices for row in sets.collect()} == {
        "ad": [0, 3], "c": [2], "bde": [1, 3, 4], "acd": [0, 2, 3], "a": [0], "afb": [0, 1],
    }
    groups = dedup.candidate_groups(minhash.signatures(docs, letters, TOY), page_id="doc_id").collect()
    assert {row.key: (row.n_pages, row.first_id, row.n_pairs) for row in groups} == {"7-6": (2, 0, 1), "7-7": (2, 4, 1)}


def test_bad_arguments():
    def two(i):
        return i

    for options in ({"num_bands": 10, "hash_funcs": [two, two]}, {"num_bands": 5, "num_hash": 7, "hash_funcs": [two] * 7}, {"num_bands": 1}):
        with pytest.raises(ValueError):
            Scheme(**options)


def test_band_hasher(spark, letters):
    docs = spark.createDataFrame([(1, "bde")], "doc_id long, text string")
    scheme = Scheme(num_bands=1, hash_funcs=TOY.hash_funcs, shingle=characters, band_hasher=lambda values: values[0] * 10 + values[1] + 1)
    assert minhash.signatures(docs, letters, scheme).first().bands == [1]


def test_shingles(spark):
    texts = ["ab", "abc", "abcd", "", "a😀b\n\U0001f601", "\r\n\r\n"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", shingles("t"), characters("t")).collect()
    for text, three, one in rows:
        assert three == [text[i : i + 3] for i in range(len(text) - 2)] and one == list(text)


def test_vocabulary(spark):
    docs = spark.createDataFrame([("abcabc",), ("abcx",)], "text string")
    assert [tuple(row) for row in minhash.vocabulary(docs, 2).orderBy("idx").collect()] == [("abc", 0, 3), ("bca", 1, 1)]


def test_matching_blocks_ratio(spark):
    pairs = [("abcd", "bcde"), ("", ""), ("tide", "diet"), ("diet", "tide"), ("x" + "ab" * 200, "ab" * 200)]
    df = spark.createDataFrame(pairs, "a string, b string")
    scores = [row[0] for row in df.select(dedup.matching_blocks(autojunk=True).score(F.col("a"), F.col("b"))).collect()]
    assert scores == [0.75, 1.0, 0.25, 0.5, 0.0]
    again = df.select(dedup.matching_blocks(autojunk=False).score(F.col("a"), F.col("b"))).collect()
    assert again[-1][0] > 0.99


# --- duplicates against brute force --------------------------------------------------------------


def greedy(texts, signatures, score, threshold, stored=frozenset(), known=None):
    """Pages in order, each against the kept pages of its signature."""
    kept, found = [], {}
    for page in sorted(texts, key=lambda p: (p not in stored, p)):
        text = texts[page].lower()
        if page not in stored:
            for other in kept:
                same = signatures[other] == signatures[page]
                if not same or (not known[page] and texts[other].lower() != text):
                    continue
                value = score(text, texts[other].lower())
                if value >= threshold:
                    found[page] = (other, value)
                    break
        if page not in found:
            kept.append(page)
    return found


def blocks(a, b):
    return SequenceMatcher(None, a, b).ratio()


def corpus():
    """Copies, near copies, chains, hot groups, texts without known units."""
    base = ["the quick brown fox jumps over the lazy dog near the river bank", "pack my box with five dozen jugs of liquor and go"]
    texts = []
    for k in range(60):
        text = base[k % 2]
        if k % 3:
            place = (k * 7) % len(text)
            text = text[:place] + "xyz"[k % 3] * (1 + k % 9) + text[place:]
        texts.append(text.upper() if k % 10 == 0 else text)
    texts += ["###", "###", "####", ""] + ["the quick brown fox" * 3] * 12
    return dict(enumerate(texts))


@pytest.fixture(scope="module")
def world(spark):
    texts = corpus()
    pages = spark.createDataFrame(list(texts.items()), "page_id long, text string")
    vocab = minhash.vocabulary(pages.where("text not like '#%'"), 40)
    scheme = Scheme(num_bands=1, num_hash=1)
    signed = {row.page_id: row for row in minhash.signatures(pages, vocab, scheme, doc_id="page_id").collect()}
    return texts, pages, vocab, scheme, {p: r.sig for p, r in signed.items()}, {p: r.has_units for p, r in signed.items()}


def decisions(df):
    rows = df.collect()
    assert len({row.page_id for row in rows}) == len(rows)
    return {row.page_id: (row.orig_id, pytest.approx(row.score)) for row in rows}


@pytest.mark.parametrize("block,hot_rows", [(1, 10**6), (4, 5), (64, 10**6)])
def test_duplicates_equal_brute_force(world, block, hot_rows):
    texts, pages, vocab, scheme, sigs, known = world
    want = greedy(texts, sigs, blocks, 0.9, known=known)
    assert len(want) > 20
    found = dedup.near_duplicates(pages, vocab, scheme, similarity=dedup.matching_blocks(autojunk=True), block=block, hot_rows=hot_rows)
    assert decisions(found) == want


def test_duplicates_do_not_depend_on_partitions(spark, world):
    texts, pages, vocab, scheme, sigs, known = world
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    one = decisions(dedup.near_duplicates(pages.repartition(7), vocab, scheme, similarity=dedup.matching_blocks(autojunk=True), block=2))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert one == greedy(texts, sigs, blocks, 0.9, known=known)


def test_batch_against_history(world):
    texts, pages, vocab, scheme, sigs, known = world
    stored = {page for page in texts if page % 4 == 3}
    is_stored = F.col("page_id") % 4 == 3
    found = dedup.dedup_batch(pages.where(~is_stored), pages.where(is_stored), vocab, scheme, similarity=dedup.matching_blocks(autojunk=True), block=3)
    assert decisions(found) == greedy(texts, sigs, blocks, 0.9, stored, known)


def test_new_copy_of_a_stored_page_belongs_to_the_first_similar_stored_page(spark, world):
    _, _, vocab, scheme, _, _ = world
    text = "the quick brown fox jumps over the lazy dog near the river bank"
    rows = [(5, text + "!"), (6, text), (7, text), (1, text), (2, text.upper()), (3, text), (8, "###"), (4, "###")]
    pages = spark.createDataFrame(rows, "page_id long, text string")
    found = dedup.dedup_batch(pages.where("page_id < 5"), pages.where("page_id >= 5"), vocab, scheme, similarity=dedup.matching_blocks(autojunk=True)).collect()
    assert {(row.page_id, row.orig_id) for row in found} == {(1, 5), (3, 5), (4, 8)}
    assert {row.score for row in found if row.page_id == 4} == {1.0}


def test_levenshtein_option(world):
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    texts, pages, vocab, scheme, sigs, known = world
    want = greedy(texts, sigs, lambda a, b: 1 - distance(a, b) / max(len(a), len(b), 1), 0.8, known=known)
    found = dedup.near_duplicates(pages, vocab, scheme, similarity=dedup.levenshtein_ratio(), threshold=0.8)
    assert decisions(found) == want


def test_marks_and_links(spark):
    pages = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "page_id long, html string")
    duplicates = spark.createDataFrame([(2, 1, 1.0)], dedup.DECISION)
    marked = {row.page_id: (row.page_type_code, row.html) for row in dedup.mark(pages, duplicates).collect()}
    assert marked == {1: ("HTML", "a"), 2: ("DUPLICATE", None), 3: ("HTML", "b")}
    assert [tuple(row) for row in dedup.duplicate_links(duplicates).collect()] == [(1, 2)]
    assert tuple(dedup.duplicate_report(pages, duplicates).first()) == (3, 1, 1)
    assert dedup.followed_links(pages, duplicates).count() == 2


def test_plan_of_signatures(spark, world):
    _, pages, vocab, scheme, _, _ = world
    signed = minhash.signatures(pages, vocab, scheme, doc_id="page_id")
    plan = signed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Cartesian" not in plan and "Python" not in plan
