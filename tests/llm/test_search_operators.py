"""Archives, exact search, the language model, near and exact duplicates, the pipeline."""

import base64
import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from siteloom.llm import common, graph, hamming, ngrams, prefixfree, sketch, topk, warc


def test_warc(spark, tmp_path):
    rows = [(k, f"http://h/{k % 7}?q=a b\r\nX: y", f"<p>{k % 5}</p>" * (1 + k % 3)) for k in range(40)]
    rows += [(40, None, None), (41, "http://e", ""), (42, "ü", "é" * 50_000), (3, "again", "<p>3</p>"), (3, "again", "<p>3</p>"), (None, None, "<p>0</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn("kind", F.lit("x"))
    folder = tmp_path / "warc"
    manifest = warc.write(pages, str(folder), roll=2000, rows=8)
    got = warc.read(spark, str(folder)).collect()
    assert len(got) == len(rows) and len(manifest["files"]) > 5
    first = {}
    for i, _, html in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        first.setdefault(html or "", i)
    responses = Counter()
    for r in got:
        text = next(h or "" for i, _, h in rows if i == r.page_id and base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode() == r.payload_digest)
        assert r.payload_bytes == len(text.encode())
        if r.record_type == "response":
            responses[text] += 1
            assert r.page_id == first[text] and bytes(r.payload).decode() == text and r.refers_to is None
        else:
            assert r.refers_to == first[text] and r.payload is None
    assert set(responses.values()) == {1} and set(responses) == set(first)
    again = tmp_path / "again"
    assert warc.write(pages.repartition(5), str(again), roll=2000, rows=8) == manifest
    for f in manifest["files"]:
        data = (folder / f["name"]).read_bytes()
        assert hashlib.sha256(data).hexdigest() == f["sha256"] and data == (again / f["name"]).read_bytes()
    large = warc.write(pages, str(tmp_path / "least"), least=10)
    assert sum(f["records"] for f in large["files"]) == len(rows)
    small = [r for r in warc.read(spark, str(tmp_path / "least")).collect() if r.payload_bytes < 10]
    assert small and {r.record_type for r in small} == {"response"}
    warc.write(pages.limit(0), str(tmp_path / "none"))
    assert warc.read(spark, str(tmp_path / "none")).count() == 0


def test_warc_ids():
    for key in (0, 1, -5, 2**63 - 1, common.LOWEST):
        assert warc.page_of(warc.record_id(key, 7)) == key


@pytest.mark.parametrize("width,spread", [(3, 1.0), (16, 0.1)])
def test_topk(spark, width, spread):
    rng = np.random.RandomState(width)
    rows = [(int(k), [float(x) for x in rng.randn(width) * spread]) for k in range(300)]
    rows += [(300 + k, rows[7][1]) for k in range(20)]  # ties
    rows += [(400, None), (401, [None] * width), (402, [float("nan")] * width), (403, [float("inf")] * width), (404, [1.0]), (None, rows[0][1])]
    rows += [(7, rows[8][1])]  # an id twice
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("vector", F.lit("clash"))
    got = {}
    for r in topk.search(df, k=5, every=50, block=100).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    valid = [(i, np.floor(256 * np.array([*v, *[0.0] * (width - len(v))]))) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    for q, own in valid:
        if q % 50 == 0:
            best = sorted((-int(v @ own), i) for i, v in valid if i != q)[:5]
            assert sorted(got[q]) == [(n + 1, -s, i) for n, (s, i) in enumerate(best)]
    assert topk.search(df.limit(0)).count() == 0


@pytest.mark.parametrize("scale", [1, 70_000, 3e6, 2e13, 1e30])
def test_topk_of_large_components(spark, scale):
    rng = np.random.RandomState(5)
    rows = [(k, [float(np.float32(x * (scale if k % 3 else 1))) for x in rng.randn(4)]) for k in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    low, high = -(2**63), 2**63 - 1
    whole = {i: [min(max(math.floor(256 * x), low), high) for x in v] for i, v in rows}
    got = {}
    for r in topk.search(df, k=5, every=50, block=40).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    for q in (0, 50, 100):
        scores = [(i, min(max(sum(a * b for a, b in zip(whole[q], v, strict=True)), low), high)) for i, v in whole.items() if i != q]
        best = sorted((-s, i) for i, s in scores)[:5]
        assert sorted(got[q]) == [(n + 1, -s, i) for n, (s, i) in enumerate(best)]


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(50)] + [(k, k + 1) for k in range(100, 140)]
    least = {}
    for a, b in pairs:
        least.setdefault(a, a), least.setdefault(b, b)
    for _ in range(200):
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {k: v for k, v in least.items() if any(k in p and p[0] != p[1] for p in pairs)}


def brute_near(rows):
    def items(text):
        words = (text or "").encode().translate(common.LOWER).split()
        return {tuple(words)} if 0 < len(words) < 5 else {tuple(words[k : k + 5]) for k in range(len(words) - 4)}

    sets = [items(t) for _, t in rows]
    part = [i for i, _ in rows]
    changed = True
    links = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(part[a], part[b])
            changed |= part[a] != low or part[b] != low
            part[a] = part[b] = low
    return {i: (len(s), p) for (i, _), s, p in zip(rows, sets, part, strict=True)}


def near_rows():
    rng = random.Random(11)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for _ in range(25):
        base = rng.choices(words, k=rng.randint(6, 120))
        rows.append(" ".join(base))
        for _ in range(rng.randint(0, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append(" ".join(copy).title() if rng.random() < 0.5 else "\t".join(copy))
    rows += [None, "", "  \n", "one two", "ONE  two", "one", "x" * 40_000, " ".join(words * 20), " ".join(words * 20)]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_near_duplicates(spark, monkeypatch):
    rows = near_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"id": F.lit(1), "key": F.lit("x"), "_stays": F.lit(2)})
    want = brute_near(rows)
    for size in (1024, 3):
        monkeypatch.setattr(hamming, "SLICE", size)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in hamming.near_duplicates(df).collect()}
        assert got == want
    kept = hamming.kept(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, (_, p) in want.items() if i == p}
    assert hamming.near_duplicates(df.limit(0)).count() == 0


def test_near_duplicates_at_keys_without_links(spark, monkeypatch):
    """Half of each text is a passage of all: many classes at a key, hardly any linked; no run holds them all."""
    rng = random.Random(19)
    shared = [f"s{k}" for k in range(64)]
    rows = [" ".join(shared + [f"o{rng.random()}" for _ in range(60)]) for _ in range(400)]
    rows += [r.rsplit(" ", 3)[0] for r in rows[::20]]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    runs, across = [], hamming._across

    def watched(dealt, *rest):
        runs.append({(r.key, r.slice): r["count"] for r in dealt.groupBy("key", "slice").count().collect()})
        return across(dealt, *rest)

    monkeypatch.setattr(hamming, "SLICE", 8)
    monkeypatch.setattr(hamming, "_across", watched)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in hamming.near_duplicates(df).collect()} == brute_near(rows)
    keys = Counter(key for key, _ in runs[0])
    assert max(keys.values()) > 8 and max(runs[0].values()) <= 36


def test_dealt_blocks_hold_each_pair_once(spark, monkeypatch):
    monkeypatch.setattr(hamming, "SLICE", 5)
    rows = [(1, i, i) for i in range(40)] + [(2, i, 0 if i < 30 else i // 2) for i in range(50)] + [(3, 1, 1), (3, 2, 2), (4, 1, 1), (4, 2, 1)]
    placed = spark.createDataFrame(rows, "key long, id long, component long")
    slices = {}
    for r in hamming._dealt(placed, hamming._mixed(placed)).collect():
        slices.setdefault((r.key, r.slice), []).append(r)
    met = Counter()
    for (key, _), held in slices.items():
        assert len({r.inner for r in held}) == 1
        for x in held:
            for y in held:
                if x.id < y.id and x.component != y.component and (x.inner or x.side != y.side):
                    met[key, x.id, y.id] += 1
    assert met == {(k, a, b): 1 for k, a, p in rows for m, b, q in rows if k == m and a < b and p != q}


def test_near_duplicates_of_one_large_group(spark, monkeypatch):
    """A star of many near copies goes in blocks, and a repeated id may have a text of another class."""
    monkeypatch.setattr(hamming, "STAR", 16)
    rng = random.Random(4)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = [(5000, " ".join(base))]
    for k in range(400):
        copy = list(base)
        copy[rng.randrange(120)] = f"x{k}"
        rows.append((k, " ".join(copy)))
    df = spark.createDataFrame([*rows, (7, "another text under the same id, linked with nothing at all")], "doc_id long, text string")
    got = hamming.near_duplicates(df).collect()
    assert {r.component_id for r in got if r.doc_id != 7} == {0}
    assert len(got) == 402


def test_near_duplicates_with_null_and_repeated_ids(spark):
    text = "a b c d e f g h i j"
    rows = [(None, text), (5, text), (5, text), (6, "other words stand in this one here"), (6, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.component_id, r.kept) for r in hamming.near_duplicates(df).collect())
    assert got == {(None, None, True): 1, (5, None, False): 2, (6, 6, True): 2}
    assert Counter(r.doc_id for r in hamming.kept(df).collect()) == {None: 1, 6: 2}


def test_signature_distance_of_linked_pairs():
    rng = np.random.RandomState(3)
    for n in (40, 400):
        far = []
        for _ in range(60):
            both = rng.randint(0, 1 << 62, n).astype("uint64")
            a = np.unique(np.concatenate([both, rng.randint(0, 1 << 62, n // 6).astype("uint64")]))
            b = np.unique(np.concatenate([both, rng.randint(0, 1 << 62, n // 6).astype("uint64")]))
            x, y = sketch.signature(a), sketch.signature(b)
            far.append(int((x != y).sum()))
            kx, ky = hamming._keys(x[None]), hamming._keys(y[None])
            assert far[-1] > hamming.DISTANCE or (kx == ky).any()
        assert max(far) <= hamming.DISTANCE and abs(np.mean(far) - 20) < 3


def brute_repeats(rows, length):
    least = {}
    blobs = [(common.LOWEST if i is None else i, (t or "").encode()) for i, t in rows]
    for i, b in blobs:
        for k in range(len(b) - length + 1):
            piece = b[k : k + length]
            least[piece] = min(i, least.get(piece, i))
    out = []
    for i, b in blobs:
        gone = [False] * len(b)
        for k in range(len(b) - length + 1):
            if least[b[k : k + length]] < i:
                gone[k : k + length] = [True] * length
        runs = sum(gone[k] and (k == 0 or not gone[k - 1]) for k in range(len(b)))
        out.append((None if i == common.LOWEST else i, len(b), sum(gone), runs, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return Counter(out)


def repeat_rows():
    rng = random.Random(9)
    passages = ["".join(rng.choices("abcdé ", k=rng.randint(45, 400))) for _ in range(12)] + ["z" * 300, "ab" * 200]
    rows = []
    for k in range(60):
        parts = ["".join(rng.choices("efgh ü", k=rng.randint(0, 90))) if rng.random() < 0.5 else rng.choice(passages) for _ in range(rng.randint(0, 5))]
        rows.append((k, "".join(parts)))
    return rows + [(60, None), (61, ""), (4, rows[9][1]), (4, rows[9][1]), (None, passages[3]), (62, "z" * 5000), (63, "\x00" * 120), (64, "q\x00" + "\x00" * 80)]


@pytest.mark.parametrize("block", [1 << 22, 2000])
def test_repeated_strings(spark, block):
    rows = repeat_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"block": F.lit("x"), "id": F.lit(1), "kept": F.lit(0), "n_chars": F.lit(-1)})
    for length in (50, 30):
        got = prefixfree.repeated(df, length, block).collect()
        assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == brute_repeats(rows, length)
        assert all(len(r.starts) == r.n_spans and sum(r.ends) - sum(r.starts) == r.n_removed for r in got)
    clean = prefixfree.cleaned(df, 50, block)
    assert clean.columns == df.columns and clean.schema["n_chars"].dataType == df.schema["n_chars"].dataType
    want = Counter((i, kept.decode("utf-8", "ignore")) for (i, _, _, _, kept), n in brute_repeats(rows, 50).items() for _ in range(n))
    found = clean.collect()
    assert Counter((r.doc_id, r.text or "") for r in found) == want
    assert all(r.n_chars == len(r.text or "") and r.block == "x" for r in found)
    assert prefixfree.repeated(df.limit(0)).count() == 0


def test_texts_made_to_collide_in_rolling_hashes_are_kept(spark):
    """Sums of powers modulo 2**64 are equal for texts that differ in 128 places in Thue-Morse order."""
    rng = random.Random(2)
    base = rng.choices("abcdefghijklmnopqrstuvwxyz ", k=8192)
    one, two = list(base), list(base)
    for k in range(128):
        odd = bin(k).count("1") % 2
        one[64 * k], two[64 * k] = "ab"[odd], "ba"[odd]
    rows = [(0, "".join(one)), (1, "".join(two))]
    got = prefixfree.repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == brute_repeats(rows, 50)


def test_repeated_strings_parts_grow_with_the_text(spark, monkeypatch):
    rows = [(i, t) for i, t in repeat_rows() if i is not None and i != 4]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    parts, owned = {}, prefixfree._owned

    def watched(requests, kind, length):
        parts[kind] = requests.select("part").distinct().count()
        return owned(requests, kind, length)

    monkeypatch.setattr(prefixfree, "PART_BYTES", 500, raising=False)
    monkeypatch.setattr(prefixfree, "_owned", watched)
    got = prefixfree.repeated(df, 50).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == brute_repeats(rows, 50)
    assert parts["unit"] > 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_repeated_strings_of_an_id_with_many_rows(spark):
    """Null ids fill blocks of their own, which count as one place among the ids."""
    rng = random.Random(4)
    passages = ["".join(rng.choices("abcd ", k=120)) for _ in range(40)]
    rows = [(k // 3, rng.choice(passages) + str(rng.random())) for k in range(150)]
    rows += [(None, rng.choice(passages) + str(rng.random())) for _ in range(300)]
    rows += [(20, rng.choice(passages) + str(rng.random())) for _ in range(200)] + [(20, rows[0][1])] * 30
    rows += [(2**63 - 1, rng.choice(passages) + str(rng.random())) for _ in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = prefixfree.repeated(df, 50, 4000).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == brute_repeats(rows, 50)


def test_a_third_of_all_rows_without_id_is_dealt_out(spark):
    docs = spark.range(150_000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("key"), F.col("id").cast("string").alias("text"))
    sized = docs.select(common.ids("key").alias("key"), F.xxhash64("text").alias("tie"), (F.length("text") + 64).cast("long").alias("size"))
    total = sized.agg(F.sum("size")).first()[0]
    splits = common.cuts(sized, total, 100_000)
    assert total // 100_000 <= len(splits) <= 2 * total // 100_000
    first = common.first_places(splits)
    assert (first[:30] == 0).all() or (first[1:30] == 1).all()
    sizes, seen = Counter(), {}
    for key, tie, size in sized.collect():
        place = int(common.places(np.array([key]), np.array([tie]), splits)[0])
        sizes[place] += size
        assert seen.setdefault(key, first[place]) == first[place]
    assert max(sizes.values()) < 250_000
    ordered = [seen[key] for key in sorted(seen)]
    assert ordered == sorted(ordered)


def test_long_texts_are_hashed_in_windows(monkeypatch):
    rng = random.Random(6)
    texts = ["".join(rng.choices("abcde \u00e9", k=n)) for n in (9000, 40, 0, 777, 2100)]
    whole = prefixfree.Parsed(list(range(5)), texts)
    whole.settle(np.arange(len(whole.starts)) % 3 == 0)
    monkeypatch.setattr(prefixfree, "WINDOW", 500)
    cut = prefixfree.Parsed(list(range(5)), texts)
    assert (cut.starts == whole.starts).all() and (cut.stops == whole.stops).all()
    cut.settle(np.arange(len(cut.starts)) % 3 == 0)

    def strings(parsed):
        return [(p + j, a) for p, n, a in zip(parsed.runs.tolist(), parsed.run_sizes.tolist(), parsed.anchors.tolist(), strict=True) for j in range(n)]

    assert strings(cut) == strings(whole) and len(cut.runs) > len(whole.runs)


def score_of(model, text):
    return float(ngrams.score_texts(model, [text])["score"][0])


def part_of(model, text):
    """log10 probability of the words alone, without the end."""
    made = ngrams.probabilities(model, [text])
    return float(np.log10(made[1:-1]).sum())


def test_language_model(spark, monkeypatch):
    rng = random.Random(13)
    words = [f"v{int(rng.paretovariate(0.8))}" for _ in range(3000)]
    rows = [(k, " ".join(words[a : a + rng.randint(0, 60)])) for k, a in enumerate(rng.choices(range(2900), k=200))]
    rows += [(200, None), (201, ""), (202, "NEW words Here"), (203, "y" * 50_000), (None, "v1 v2"), (5, "v1 V2 v3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    monkeypatch.setattr(ngrams, "SHARD_WORDS", 64)
    monkeypatch.setattr(ngrams, "SHARD_TOKENS", 500)
    model = ngrams.train(docs.where(~ngrams.held_out()))
    assert len(model.shards) > 3 and len(model.vocabulary) > 3
    got = Counter()
    scored = {}
    for r in ngrams.score(docs, model).collect():
        got[(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))] += 1
        scored.setdefault(r.doc_id, []).append(r.score)
    counts = Counter()
    split = [(i, (t or "").encode().translate(common.LOWER).split() + [None]) for i, t in rows]
    for i, tokens in split:
        if i is None or zlib.crc32(str(i).encode()) % 10:
            counts.update(tokens)
    n, v = sum(counts.values()), len(counts)
    want = Counter(
        (i, len(t), sum(counts[w] > 0 for w in t), n, round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), 6)) for i, t in split
    )
    assert got == want
    # After any context the probabilities of all words, an unknown one and the end are 1 at most.
    known = [w.decode() for w in counts if w is not None] + ["never-seen"]
    for context in ("v1", "v1 v2", "v2 v1", "never-seen v1"):
        total = 10 ** (score_of(model, context) - part_of(model, context))
        for w in known:
            total += 10 ** (part_of(model, f"{context} {w}") - part_of(model, context))
        assert 0.8 < total <= 1 + 1e-9
    again = ngrams.load(model.folder)
    assert vars(again) == vars(model)
    empty = ngrams.train(docs.limit(0))
    assert [r.n_known for r in ngrams.score(docs.limit(3), empty).collect()] == [0, 0, 0]


def brute_scores(train, texts):
    """log10 scores under the formulas of ngrams.py with every n-gram counted, none dropped."""

    def tokens(text):
        return [0, *(text or "").encode().translate(common.LOWER).split(), 1]

    one, two, three = Counter(), Counter(), Counter()
    for row in map(tokens, train):
        one.update(row)
        two.update(zip(row, row[1:]))
        three.update(zip(row, row[1:], row[2:]))
    after, after_two = Counter(a for a, _ in two), Counter((a, b) for a, b, _ in three)
    n, v = sum(one.values()) - len(train), len(one) - 1
    scores = []
    for row in map(tokens, texts):
        total = 0.0
        for k, d in enumerate(row[1:], 1):
            b = row[k - 1]
            p = (one[d] + 0.1) / (n + 0.1 * (v + 1))
            if one[b]:
                grown = one[b] + 3 * after[b]
                p = two[b, d] / grown + 3 * after[b] / grown * p
            if k > 1 and two[row[k - 2], b]:
                held, types = two[row[k - 2], b], after_two[row[k - 2], b]
                p = three[row[k - 2], b, d] / (held + types) + types / (held + types) * p
            total += math.log10(p)
        scores.append(total)
    return scores


def test_language_model_keeps_every_trigram(spark):
    rng = random.Random(17)
    train = [" ".join(f"v{int(rng.paretovariate(0.7))}" for _ in range(rng.randint(0, 60))) for _ in range(150)]
    train += ["one rare passage that a single text holds", None]
    asked = train + ["a rare passage that a single text holds once more", "v1 v2 v1 v1 new V2", ""]
    model = ngrams.train(spark.createDataFrame(list(enumerate(train)), "doc_id long, text string"))
    got = ngrams.score_texts(model, asked)
    # Shares are rounded down to a fortieth of a decade.
    for text, score, n, want in zip(asked, got["score"], got["n_tokens"], brute_scores(train, asked), strict=True):
        assert want - n / ngrams.STEP - 1e-6 <= score <= want + 1e-6, text


def test_language_model_keeps_small_shares(spark):
    pairs, triples = np.array([2 << 32 | 3, 3 << 32 | 1]), np.arange(100, dtype="int64") + 4
    many = np.where(np.arange(100) == 0, 5_000_000, 1)
    grams = ngrams.eliasfano.squeeze([np.diff(pairs, prepend=0), np.array([many.sum(), 1]), np.zeros(100, "int64"), triples, many])
    df = spark.createDataFrame([(0, bytearray(grams))], "shard int, grams binary")
    model = ngrams.Model(common.scratch(df, "ngrams"), words=200, tokens=int(many.sum()), vocabulary={0: (200, 0)})
    common.filesystem(model.folder)[0].create_dir(common.filesystem(model.folder)[1], recursive=True)
    ngrams._store_trie(model, df).collect()
    model.shards = [0]
    number = np.array([0, 2, 3, 50])
    count = np.array([1, 100, many.sum(), 0])
    made = {"number": number, "count": count, "types": np.array([1, 1, 100, 0]), "text": np.zeros(4, "int64")}
    p, none = ngrams.probabilities(model, [], made)[3], ngrams.probabilities(model, [], made | {"number": np.array([0, 2, 3, -1])})[3]
    assert p - none == pytest.approx(1 / (many.sum() + 100), rel=0.07)


def test_pipeline_on_small_tables(spark, tmp_path):
    import corpus_pipeline

    rows = [(k, t, "en", "s", len(t or ""), "extra") for k, t in near_rows()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _score string")
    labels = spark.createDataFrame([(0, 1), (1, 1)], "doc_id long, quality int")
    for name, table in (("documents", docs), ("labels", labels)):
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    stage = docs
    for name, function in corpus_pipeline.STAGES[:-1]:
        stage = function(spark, stage, str(tmp_path))
        assert stage.columns == docs.columns, name
    want = [(i, t) for i, t in near_rows() if brute_near(near_rows())[i][1] == i]
    texts = {i: kept.decode() for i, _, _, _, kept in brute_repeats(want, 50)}
    assert {r.doc_id: r.text or "" for r in stage.collect()} == texts
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == set(texts)
    for name in ("documents", "labels"):
        spark.read.parquet(f"{tmp_path}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/none/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_monotone_sequences():
    """Values, and successors within bounds, as on the plain array; a sequence may start anywhere in a buffer."""
    rng = np.random.default_rng(1)
    for n, most in [(1, 5), (1, 2**40), (10, 3), (900, 2**50), (5000, 5000), (60_000, 2**40), (300, 10)]:
        values = np.sort(rng.integers(0, most, n))
        data = memoryview(b"x" * 8 + ngrams.eliasfano.encode(values) + b"tail")
        made = ngrams.eliasfano.Sequence(data, 8)
        assert bytes(data[made.end :]) == b"tail"
        assert (made.values(np.arange(n)) == values).all() and (ngrams.eliasfano.decode(data, 8)[0] == values).all()
        asked = np.concatenate([values, values + 1, np.maximum(values - 1, 0), rng.integers(0, most + 10, 200)])
        place, same = made.successor(asked)
        want = np.searchsorted(values, asked)
        assert (place == want).all() and (same == ((want < n) & (values[np.minimum(want, n - 1)] == asked))).all()
        first = rng.integers(0, n, len(asked))
        last = np.minimum(n, first + rng.integers(0, 9, len(asked)))
        place, same = made.successor(asked, first, last)
        for k in range(0, len(asked), 7):
            part = values[first[k] : last[k]]
            assert same[k] == (asked[k] in part)
            assert not same[k] or place[k] == first[k] + np.searchsorted(part, asked[k])
    none = ngrams.eliasfano.Sequence(memoryview(ngrams.eliasfano.encode(np.zeros(0, "int64"))))
    assert none.n == 0 and not none.successor(np.array([3]))[1].any()
