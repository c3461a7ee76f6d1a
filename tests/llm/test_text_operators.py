"""Fingerprints, tokens, packing, files, quality: small tables with every odd case."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from siteloom.llm import bytebpe, common, cws, packing, quality, tokenfiles, wordtokens

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, score double, ids string, slice int, key string, length string, own int"


def odd_rows():
    rng = random.Random(5)
    words = ["The", "and", "Élan", "naïve", "x,y.", "don't", "b|c", "...", "naïve.", "end.", "中文", "<|endoftext|>", "<|ENDOFTEXT|>", "ΑΣ"]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(20)]
    rows = [(k, t) for k, t in enumerate(texts)]
    rows += [(20, None), (21, ""), (22, "  \n\t "), (23, "a" * 30_000), (24, texts[0]), (24, texts[1]), (3, texts[3]), (None, "no id here"), (None, None)]
    rows += [(25, "two  spaces \n and\x1cmore　wide"), (26, "ending \n")]
    return rows


@pytest.fixture
def odd(spark):
    rows = [(i, t, 0.5, "x", 1, "k", "l", 2) for i, t in odd_rows()]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def in_order():
    return sorted(((common.LOWEST if i is None else i), t or "") for i, t in odd_rows())


def test_edited_fingerprints(odd, nothing):
    rows = cws.edited(odd, rows=4).collect()
    ordered = in_order()
    assert len(rows) == len(ordered)
    want = Counter()
    for (key, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        want[(None if key == common.LOWEST else key, len(text), hashlib.sha256(new.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert cws.edited(nothing).count() == 0


def test_equal_texts_equal_fingerprints(odd):
    rows = cws.fingerprint(odd, name="score").collect()
    by = {}
    for r in rows:
        assert by.setdefault(r.text or "", r.score) == r.score
    assert by[""] == "" and len(set(by.values())) > 15
    near = odd.select("text").transform(lambda d: cws.fingerprint(d)).withColumn("other", F.col("fingerprint"))
    assert {r[0] for r in near.select(cws.likeness_of("fingerprint", "other")).collect()} == {1.0}


def test_likeness_is_generalised_jaccard():
    rng = random.Random(1)
    off = []
    for _ in range(60):
        a, b = (Counter(rng.choices("abcdefghijkl", k=rng.randint(5, 40))) for _ in range(2))
        true = sum((a & b).values()) / sum((a | b).values())
        one, two = cws.signatures([" ".join(a.elements()), " ".join(b.elements())], 1024)
        off.append(cws.likeness(one, two) - true)
    assert abs(np.mean(off)) < 0.01 and np.std(off) < 0.03


def tokens(text, end=True):
    encode = wordtokens.encoder(WORDS).library.encode(text, add_special_tokens=False)
    return encode.ids + [1] * end


def test_word_tokens_as_the_library():
    texts = [t for _, t in in_order()]
    assert [r.tolist() for r in wordtokens.encoder(WORDS).ids(texts)] == [tokens(t, False) for t in texts]


@pytest.mark.parametrize("size", [8, 2048])
def test_packing(odd, nothing, size):
    cut = packing.pieces(odd, WORDS, size)
    clashes = {c: F.lit(c) for c in ("sequence", "_slice", "_row", "_n", "_first", "_before", "offset", "SEQUENCE_ID")}
    table = packing.pack(cut.withColumns(clashes), size)
    assert table.columns == [*cut.columns, *list(clashes)[:6], "sequence_id", "offset"]
    packed = table.collect()
    assert {r["_first"] for r in packed} == {"_first"}
    whole = Counter((None if k == common.LOWEST else k, tuple(tokens(t))) for k, t in in_order())
    room = {}
    for r in packed:
        place = room.setdefault(r.sequence_id, [])
        place.append((r.offset, r.length))
        assert 1 <= r.length <= size and zlib.crc32(bytes(r.ids)) and len(r.ids) == 4 * r.length
    for place in room.values():
        ends = 0
        for offset, length in sorted(place):
            assert offset == ends
            ends += length
        assert ends <= size
    assert sorted(room) == list(range(len(room)))
    assert Counter((r.doc_id, r.start) for r in packed) == Counter(
        (i, s) for (i, ids), n in whole.items() for s in range(0, len(ids), size) for _ in range(n)
    )
    assert packing.pack(packing.pieces(nothing, WORDS)).count() == 0


def test_patterns_use_each_piece_once_with_little_padding():
    rng = random.Random(3)
    for size in (16, 100, 2048):
        histogram = Counter(min(size, 1 + int(rng.expovariate(3 / size))) for _ in range(5000))
        found = packing.patterns(dict(histogram), size)
        used = Counter()
        for lengths, count in found:
            assert sum(lengths) <= size and count > 0
            for length in lengths:
                used[length] += count
        assert used == histogram
        total = sum(k * n for k, n in histogram.items())
        assert sum(n for _, n in found) <= total / size * 1.02 + 2


def test_token_files_of_an_id_with_many_rows(spark, tmp_path):
    rows = [(None if k % 3 else k, f"text {k * 7919 % 1000} of {k}") for k in range(400)] + [(3, "the same")] * 20
    df = spark.createDataFrame(rows, "doc_id long, text string")
    manifest = tokenfiles.write(df, str(tmp_path), WORDS, rows=30)
    assert max(shard["docs"] for shard in manifest["shards"]) <= 80
    got = sorted(tokenfiles.read(spark, str(tmp_path)).collect(), key=lambda r: r.start)
    assert [r.doc_id is not None for r in got] == [False] * 266 + [True] * 154
    ids = [r.doc_id for r in got if r.doc_id is not None]
    assert ids == sorted(ids) and [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got[:-1])]).tolist()
    assert Counter((r.doc_id, bytes(r.ids)) for r in got) == Counter((i, np.array(tokens(t), "<u4").tobytes()) for i, t in rows)


def test_the_dictionary_sees_all_places_of_a_long_document():
    long = tokenfiles.windows(np.arange(100_000))
    assert len(long) == tokenfiles.SAMPLE_IDS and long[0] == 0 and long[-1] == 99_999
    assert max(np.diff(long)) < 100_000 / (tokenfiles.WINDOWS - 1)
    assert tokenfiles.windows(np.arange(50)).tolist() == list(range(50))


def test_token_files(odd, nothing, tmp_path):
    folder = str(tmp_path / "ids")
    manifest = tokenfiles.write(odd, folder, WORDS, rows=5)
    rows = sorted(tokenfiles.read(odd.sparkSession, folder).collect(), key=lambda r: r.start)
    ordered = in_order()
    assert [r.doc_id for r in rows] == [None if k == common.LOWEST else k for k, _ in ordered]
    start = 0
    for r, (_, text) in zip(rows, ordered, strict=True):
        ids = tokens(text)
        assert (r.start, r.n_tokens) == (start, len(ids))
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        start += len(ids)
    assert len(manifest["shards"]) > 2
    last = manifest["shards"][-1]["name"]
    assert [x.tolist() for x in tokenfiles.lookup(folder, last, 26)] == [tokens("ending \n")]
    again = str(tmp_path / "again")
    tokenfiles.write(odd.repartition(3), again, WORDS, rows=5)
    for shard in manifest["shards"]:
        assert (tmp_path / "ids" / shard["name"]).read_bytes() == (tmp_path / "again" / shard["name"]).read_bytes()
    tokenfiles.write(nothing, str(tmp_path / "none"), WORDS)
    assert tokenfiles.read(odd.sparkSession, str(tmp_path / "none")).count() == 0


@pytest.fixture(scope="module")
def table():
    return bytebpe.bpe(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(table):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table.ranks, special_tokens={})


def test_each_token_encodes_to_itself(table):
    assert table.reachable()


def test_join_is_the_encoding_of_both(table, library):
    rng = random.Random(2)
    for _ in range(400):
        text = "".join(rng.choices("abcdeionrstäß中文字的😀", k=rng.randint(2, 300))).encode()
        at = rng.randint(0, len(text))
        left, right = table.encode_bytes(text[:at]), table.encode_bytes(text[at:])
        assert table.join(left, right) == library._encode_single_piece(text) == table.encode_bytes(text)


def test_texts_as_the_library(table, library):
    rng = random.Random(4)
    parts = ["a", "th", "ing", " ", "  ", "\n", "\t", "é", "é", "中", "\x1c", "\x85", "​", "'s", "1", "!", "　", " ", "😀"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 50))) for _ in range(800)] + [t for _, t in in_order()]
    made = table.encode(texts)
    for text, ids in zip(texts, made, strict=True):
        assert ids.tolist() == library.encode_ordinary(text)
        assert table.decode(ids.tolist()) == text.encode()


def test_byte_bpe_columns(odd, nothing, library):
    ids = bytebpe.encode(odd, RANKS, public_tokenizers.PATTERN, decoded="own")
    rows = bytebpe.decode(ids, RANKS, public_tokenizers.PATTERN, name="back").collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter(odd_rows())
    for r in rows:
        assert r.ids == library.encode_ordinary(r.text or "")
        assert bytes(r.own) == bytes(r.back) == (r.text or "").encode()
    assert bytebpe.encode(nothing, RANKS, public_tokenizers.PATTERN).count() == 0


def test_quality(spark, odd, nothing):
    rng = random.Random(7)
    good = ["house", "river", "small", "winter", "garden", "writes", "letter", "slowly"]
    rows, labels = [], []
    for k in range(600):
        label = k % 3 > 0
        words = rng.choices(good, k=rng.randint(20, 60))
        rows.append((k, " ".join(words if label else [w.upper() + "!!" for w in words])))
        labels.append((k, int(label)))
    labels += [(1, 0), (None, 1), (5, None)]  # contradiction, nulls
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    told = spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.train(docs, told)
    scored = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    tests = [k for k in range(600) if zlib.crc32(str(k).encode()) % 4 == 2]
    assert sum((scored[k] >= quality.CUT) == (k % 3 > 0) for k in tests) > 0.97 * len(tests)
    other = quality.score(odd, model).collect()
    assert len(other) == len(odd_rows()) and all(0 <= r.score <= 1 for r in other)
    assert quality.score(nothing, model).count() == 0
    bare = quality.train(nothing, told.limit(0))
    assert {r.score for r in quality.score(odd, bare).collect()} == {0.5}
    one = quality.train(docs, told.where("quality = 1"))
    assert all(r.score > 0.9 for r in quality.score(odd, one).collect())
    assert not math.isnan(model.weights[0])
