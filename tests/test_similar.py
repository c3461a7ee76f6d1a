import random
from difflib import SequenceMatcher

import numpy as np
from pyspark.sql import functions as F

from siteloom.functions.text import characters, shingles
from siteloom.operators import dedup, minhash, similar
from siteloom.operators.blocks import Blocks
from siteloom.session import materialise


def sets(rng, n):
    """Random sets of hashes, each with a copy that is changed in some places."""
    found = []
    for _ in range(n):
        one = set(rng.getrandbits(62) for _ in range(rng.choice([1, 5, 40, 70, 300])))
        other = set(list(one)[: rng.randint(1, len(one))]) | {rng.getrandbits(62) for _ in range(rng.randint(0, 9))}
        found += [one, other]
    return found + [set(), set()]


def test_groups_lose_no_pair(spark, monkeypatch):
    rng = random.Random(5)
    units = sets(rng, 60)
    rows = spark.createDataFrame([(k, sorted(u)) for k, u in enumerate(units)], "page_id long, units array<long>")
    keyed = rows.select("page_id", F.lit("k").alias("key"), (F.col("page_id") % 5 > 0).alias("is_new"))
    likeness = dedup.shingle_jaccard()
    for size, threshold in ((1024, 0.9), (16, 0.8), (16, 1.0)):
        monkeypatch.setattr(similar, "SLICE", size)
        found = similar.groups(keyed, similar.sketches(rows), likeness.apart(threshold), likeness.units_ratio(threshold))
        group = {r.page_id: r.group for r in found.collect()}
        pairs = [(a, b) for a in range(len(units)) for b in range(a) if a % 5 or b % 5]
        near = [(a, b) for a, b in pairs if (len(units[a] & units[b]) / len(units[a] | units[b]) if units[a] | units[b] else 1) >= threshold]
        assert near and all(a in group and group[a] == group.get(b) for a, b in near)
        assert len(group) < len(units)


def test_folded_sketches_bound_the_difference():
    rng = np.random.default_rng(3)
    one = rng.integers(0, 2**62, 500)
    other = np.concatenate([one[:60], rng.integers(0, 2**62, 30)])
    a, b = similar._folded([similar.sketch(one)], 1), similar._folded([similar.sketch(other)], 1)
    assert np.bitwise_count(a ^ b).sum() <= 440 + 30
    assert (similar._folded([similar.sketch(one[::-1])], 1) == a).all()


def test_unlike_pages_of_one_key_are_not_paired(spark, monkeypatch):
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(300)]
    rows = [(k, " ".join(rng.sample(words, 40))) for k in range(120)]
    rows += [(200 + k, rows[k][1] + " x") for k in range(10)]
    pages = spark.createDataFrame(rows, "page_id long, text string")
    vocab = minhash.vocabulary(pages, 1)
    scheme = minhash.Scheme(num_bands=1, num_hash=1)  # one signature for all pages that hold the unit
    counted, verify = [], dedup._verify

    def watched(pairs, *rest):
        counted.append(pairs.count())
        return verify(pairs, *rest)

    monkeypatch.setattr(dedup, "_verify", watched)
    for match in ("full", "any_band"):
        counted.clear()
        found = dedup.near_duplicates(pages, vocab, scheme, similarity=dedup.shingle_jaccard(), match=match).collect()
        known = {r.page_id for r in minhash.signatures(pages, vocab, scheme, doc_id="page_id").where("has_units").collect()}
        assert {(r.page_id, r.orig_id) for r in found} == {(200 + k, k) for k in range(10) if {k, 200 + k} <= known}
        assert len(found) > 3 and sum(counted) < 4 * len(found)  # all pairs of the key are thousands


def test_units_by_batches_equal_the_column(spark):
    texts = ["ab", "abc", "abcd", "", None, "a😀b\n\U0001f601aé\0\0", "\r\n\r\n", "aaaaa", "ßıİ" * 5]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for unit in (shingles, characters):
        other = lambda text: unit(text)  # noqa: E731  (another function: by its Column)
        one, two = (minhash.vocabulary(docs, 50, shingle=x) for x in (unit, other))
        assert [tuple(r) for r in one.orderBy("idx").collect()] == [tuple(r) for r in two.orderBy("idx").collect()]
        assert "Generate" not in one._jdf.queryExecution().executedPlan().toString()  # no row for each character
        vocab = one.where("idx % 2 = 0")
        assert sorted(map(tuple, minhash.encode(docs, vocab, shingle=unit).collect())) == sorted(map(tuple, minhash.encode(docs, vocab, shingle=other).collect()))
        schemes = [minhash.Scheme(num_bands=2, num_hash=4, shingle=x) for x in (unit, other)]
        assert sorted(map(str, minhash.signatures(docs, vocab, schemes[0]).collect())) == sorted(map(str, minhash.signatures(docs, vocab, schemes[1]).collect()))


def test_signatures_hand_over_one_column_of_hashes(spark):
    docs = spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")
    signed = minhash.signatures(docs, minhash.vocabulary(docs, 3), minhash.Scheme(num_bands=8, num_hash=32))
    plan = signed._jdf.queryExecution().executedPlan().toString()
    assert "hashes" in plan and "BroadcastHashJoin" in plan


def prose(rng, n):
    """Texts of frequent and rare letters, each with copies that are changed in some places."""
    found = []
    for _ in range(n):
        text = "".join(rng.choices("etaoinsr zqxj,", weights=[9, 9, 8, 8, 7, 7, 6, 6, 9, 1, 1, 1, 1, 1], k=rng.choice([3, 60, 199, 200, 400, 900])))
        found.append(text)
        for edits in (1, 4, 12):
            other = list(text)
            for _ in range(edits):
                at = rng.randrange(len(other) + 1)
                other[at : at + rng.randint(0, 9)] = rng.choices("etaoinszq", k=rng.randint(0, 9))
            found.append("".join(other))
        found.append(text[len(text) // 15 :])
    return found


def test_groups_by_blocks_lose_no_pair(spark, monkeypatch):
    texts = prose(random.Random(11), 24)
    pages = spark.createDataFrame(list(enumerate(texts)), "page_id long, text string")
    rows = pages.select("page_id", F.length("text").cast("long").alias("size"), F.col("text").cast("binary").alias("sketch"))
    keyed = pages.select("page_id", F.lit("k").alias("key"), F.lit(True).alias("is_new"))
    likeness = dedup.matching_blocks(autojunk=True)
    ratio = {(b, a): SequenceMatcher(None, texts[b], texts[a]).ratio() for b in range(len(texts)) for a in range(b)}
    for size, size_bytes, threshold in ((1024, 4000, 0.9), (16, 1 << 25, 0.75)):
        monkeypatch.setattr(similar, "SLICE", size)
        monkeypatch.setattr(similar, "SLICE_BYTES", size_bytes)
        found = similar.groups(keyed, rows, likeness.apart(threshold), likeness.units_ratio(threshold), likeness.texts).collect()
        group = {r.page_id: r.group for r in found}
        near = [pair for pair, value in ratio.items() if value >= threshold]
        assert len(near) > 30 and all(b in group and group[b] == group.get(a) for b, a in near)
        # Long texts of different origin are apart.
        assert len({group.get(k, -k) for k in range(len(texts)) if len(texts[k]) > 350}) > 5 or threshold < 0.9


def test_blocks_equal_the_standard_matcher():
    rng = random.Random(9)
    scripts = ["etaoinsr zqxj,", "abzq", "".join(map(chr, range(0x4E00, 0x4E00 + 300)))]
    for k in range(150):
        letters = scripts[k % 3]
        weights = [1 + 8 * (n % 2) for n in range(len(letters))]
        one = "".join(rng.choices(letters, weights, k=rng.choice([0, 1, 199, 200, 400, 900])))
        at = rng.randint(0, len(one))
        other = one[at:] + "".join(rng.choices(letters, k=rng.randint(0, 9))) + one[: at // (1 + k % 5)]
        for a, b in ((one, other), (other, one), (one, one[:at] + "q" + one[at:])):
            want = sum(m.size for m in SequenceMatcher(None, a, b).get_matching_blocks())
            assert Blocks(b, True).letters(a, 0) == want
            assert Blocks(b, True).letters(a, want) == want


def test_ratio_ends_early_and_stays_exact(spark):
    texts = prose(random.Random(2), 8)
    pairs = [(a, b) for a in texts for b in texts] + [("", ""), ("", "a")]
    df = spark.createDataFrame(pairs, "a string, b string").coalesce(1)
    for autojunk in (True, False):
        want = [SequenceMatcher(None, a, b, autojunk).ratio() for a, b in pairs]
        likeness = dedup.matching_blocks(autojunk=autojunk)
        assert [r[0] for r in df.select(likeness.score(F.col("a"), F.col("b"))).collect()] == want
        got = [r[0] for r in df.select(likeness.score(F.col("a"), F.col("b"), 0.9)).collect()]
        assert all(value == score if score >= 0.9 else value is None or value == score for value, score in zip(got, want))
        assert sum(value is None for value in got) > len(pairs) / 2


def test_unlike_long_texts_of_one_key_are_not_paired(spark, monkeypatch):
    rng = random.Random(3)
    words = ["".join(rng.choices("etaoinsr", k=5)) + rng.choice(["", "", "", ",", "q"]) for _ in range(400)]
    rows = [(k, " ".join(rng.choices(words, k=200))) for k in range(60)]
    rows += [(100 + k, rows[k][1] + " end") for k in range(10)]
    texts = dict(rows)
    pages = spark.createDataFrame(rows, "page_id long, text string")
    vocab = spark.createDataFrame([("eta", 0, 1), ("oin", 1, 1), (" ", 2, 1), (words[0][:3], 3, 1)], "gram string, idx long, n long")
    scheme = minhash.Scheme(num_bands=1, num_hash=1)
    sigs = {r.page_id: r.sig for r in minhash.signatures(pages, vocab, scheme, doc_id="page_id").where("has_units").collect()}
    want = {}
    for page in sorted(sigs):
        for other in sorted(p for p in sigs if p < page and p not in want and sigs[p] == sigs[page]):
            score = SequenceMatcher(None, texts[page], texts[other]).ratio()
            if score >= 0.9:
                want[page] = (other, score)
                break
    counted, verify = [], dedup._verify

    def watched(pairs, *rest):
        counted.append(pairs.count())
        return verify(pairs, *rest)

    monkeypatch.setattr(dedup, "_verify", watched)
    found = dedup.near_duplicates(pages, vocab, scheme, similarity=dedup.matching_blocks(autojunk=True)).collect()
    assert {r.page_id: (r.orig_id, r.score) for r in found} == want
    assert len(want) > 3 and sum(counted) < 60  # all pairs of the keys are hundreds


def test_pages_of_a_chain_are_not_all_paired(spark, monkeypatch):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(400)]
    # Neighbours are alike, so that all pages are one group, while most of its pages are not.
    texts = {k: "zz " + " ".join(words[2 * at : 2 * at + 100]) for k, at in enumerate(rng.sample(range(60), 60))}
    pages = spark.createDataFrame(list(texts.items()), "page_id long, text string")
    vocab = spark.createDataFrame([("zz ", 0, 1)], "gram string, idx long, n long")
    grams = {k: {t[i : i + 3] for i in range(len(t) - 2)} for k, t in texts.items()}
    kept, want = [], {}
    for page in range(60):
        near = [k for k in kept if len(grams[page] & grams[k]) / len(grams[page] | grams[k]) >= 0.9]
        if near:
            want[page] = near[0]
        else:
            kept.append(page)
    counted, verify = [], dedup._verify

    def watched(pairs, *rest):
        counted.append(pairs.count())
        return verify(pairs, *rest)

    monkeypatch.setattr(dedup, "_verify", watched)
    scheme = minhash.Scheme(num_bands=2, num_hash=2)
    found = dedup.near_duplicates(pages, vocab, scheme, similarity=dedup.shingle_jaccard(), match="any_band").collect()
    assert {r.page_id: r.orig_id for r in found} == want and len(kept) > 12
    assert sum(counted) < 4 * len(texts)  # all pairs of the group are 1,770


def test_pairs_lose_nothing_and_count_once(spark, monkeypatch):
    rng = random.Random(8)
    units = [u for u in sets(rng, 30) if u]
    bands = [[rng.randint(0, 1) for _ in range(3)] for _ in units]
    rows = spark.createDataFrame([(k, k % 3 > 0, sorted(u), b) for k, (u, b) in enumerate(zip(units, bands))], "page_id long, is_new boolean, units array<long>, bands array<long>")
    made = similar.sketches(rows.select("page_id", "units"), similar.PAIR_BITS, similar.PAIR_BITS)
    members = rows.join(made, "page_id").select("page_id", "is_new", "bands", F.struct("size", "sketch").alias("profile"), F.posexplode("bands").alias("no", "band"))
    members = materialise(members.withColumn("key", F.concat_ws(":", "no", "band")))
    likeness = dedup.shingle_jaccard()
    want = {(b, a) for b in range(len(units)) for a in range(len(units)) if b % 3 and (a % 3 > 0, a) < (True, b) and len(units[a] & units[b]) >= 0.8 * len(units[a] | units[b])}
    shared = {(b, a) for b, a in want if any(x == y for x, y in zip(bands[a], bands[b]))}
    for hot_rows, chunk in ((10**6, similar.CHUNK), (7, 300)):
        monkeypatch.setattr(similar, "CHUNK", chunk)
        got = dedup._candidates(members, members, likeness, 0.8, hot_rows).collect()
        pairs = [(r.page_id, r.orig_id) for r in got]
        assert len(set(pairs)) == len(pairs) < 3 * len(shared) and shared <= set(pairs) and len(shared) > 3
        for r in got:
            same = [x == y for x, y in zip(bands[r.page_id], bands[r.orig_id])]
            assert r.key == f"{same.index(True)}:{bands[r.page_id][same.index(True)]}" and r.orig_new == (r.orig_id % 3 > 0)


def test_signatures_by_a_table_equal_those_by_rows(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "abcdef"), (2, "a😀b"), (3, None), (4, "xbcd"), (4, "def"), (None, "cde")], "doc_id long, text string")
    vocab = spark.createDataFrame([("abc", 0), ("bcd", 7), ("a😀b", 3), (" ", 1), ("def", None), ("cde", 2), ("cde", 5)], "gram string, idx long")
    scheme = minhash.Scheme(num_bands=2, num_hash=4)
    one = sorted(map(str, minhash.signatures(docs, vocab, scheme).collect()))
    monkeypatch.setattr(minhash, "TABLE_BYTES", 0)
    assert sorted(map(str, minhash.signatures(docs, vocab, scheme).collect())) == one and len(one) == 5
