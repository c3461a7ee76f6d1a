"""The registered queries, each run on a small folder and compared with plain Python."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from siteloom.llm import common, quality, tokenfiles, warc
from siteloom.llm.queries import QUERIES, vocabulary

GOOD = ["house", "river", "small", "winter", "garden", "writes", "letter", "slowly"]


def documents():
    rng = random.Random(21)
    passage = "a passage of some length that several of the documents hold word for word, as notices do"
    rows = []
    for k in range(180):
        words = rng.choices(GOOD, k=rng.randint(5, 60))
        if k % 3 == 0:
            words = [w.upper() + "!!" for w in words]
        if k % 7 == 0:
            words.insert(rng.randint(0, len(words)), passage)
        rows.append((k, " ".join(words)))
    rows += [(180, None), (181, ""), (182, "Ünï 中文 <|endoftext|> don't\n\nstop."), (183, rows[4][1]), (184, rows[5][1] + " more")]
    return rows + [(185, "word " * 3000)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    rows = [(i, t, "en", "s", len(t or "")) for i, t in documents()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{root}/documents.parquet")
    labels = [(k, int(k % 3 > 0), 0) for k in range(0, 180)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    pages = [(k, f"http://h/{k}", f"<p>{k % 17}</p>" if k % 5 else None) for k in range(60)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{root}/pages.parquet")
    return str(root)


def run(spark, folder, name, **types):
    found = QUERIES[name](spark, folder)
    assert dict(found.dtypes) == types
    return found.collect()


def texts():
    return [(i, t or "") for i, t in documents()]


def test_op1(spark, folder):
    kinds = {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string"}
    rows = run(spark, folder, "op1_cws_fingerprints", **kinds, edited_fingerprint="string", near_edited="double", near_next="double")
    by = {r.doc_id: r for r in rows}
    ordered = texts()
    assert len(rows) == len(ordered)
    for (i, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert (by[i].n_chars, by[i].edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= by[i].near_edited <= 1 and 0 <= by[i].near_next <= 1
    assert by[183].fingerprint == by[4].fingerprint != by[5].fingerprint and by[180].fingerprint == by[181].fingerprint


def test_op2(spark, folder):
    kinds = {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"}
    rows = run(spark, folder, "op2_warc", **kinds)
    first = {}
    want = set()
    for k in range(60):
        data = (f"<p>{k % 17}</p>" if k % 5 else "").encode()
        of = first.setdefault(data, k)
        want.add((k, len(data), warc.base32(hashlib.sha1(data).digest()), "response" if of == k else "revisit", None if of == k else of))
    assert len(rows) == 60 and {tuple(r[c] for c in kinds) for r in rows} == want


def words_ids():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    return {i: [*made.encode(t, add_special_tokens=False).ids, 1] for i, t in texts()}


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op3(spark, folder):
    names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    rows = run(spark, folder, "op3_packing", **dict.fromkeys(names, "bigint"))
    pieces, places = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    for i, ids in words_ids().items():
        at = 0
        for r in sorted(pieces.pop(i), key=lambda r: r.start):
            assert (r.start, r.ids_crc32, r.doc_tokens) == (at, crc(ids[at : at + r.length]), len(ids))
            at += r.length
        assert at == len(ids)
    assert not pieces
    for some in places.values():
        at = 0
        for offset, length in sorted(some):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) <= sum(r.length for r in rows) / 2048 + 2


def test_op4(spark, folder):
    import base64

    import tiktoken

    with open(vocabulary("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = run(spark, folder, "op4_byte_bpe", doc_id="bigint", n_tokens="bigint", ids_sha256="string", decoded_sha256="string")
    want = set()
    for i, t in texts():
        ids = library.encode_ordinary(t)
        joined = ",".join(map(str, ids)).encode()
        want.add((i, len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert len(rows) == len(want) and set(map(tuple, rows)) == want


def test_op5(spark, folder):
    rows = run(spark, folder, "op5_token_files", doc_id="bigint", start="bigint", n_tokens="bigint", ids_crc32="bigint")
    start, want = 0, set()
    for i, ids in sorted(words_ids().items()):
        want.add((i, start, len(ids), crc(ids)))
        start += len(ids)
    assert len(rows) == len(want) and set(map(tuple, rows)) == want


def test_op6(spark, folder):
    import zstandard

    rows = run(spark, folder, "op6_quality", doc_id="bigint", held_out="boolean", score="double", predicted="int")
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    model = quality.train(docs, labels)
    assert model.fitted

    def size(dictionary, data):
        made = zstandard.ZstdCompressionDict(dictionary)
        packer = zstandard.ZstdCompressor(level=3, dict_data=made, write_content_size=False, write_checksum=False, write_dict_id=False)
        return sum(len(packer.compress(data[k : k + 512])) for k in range(0, len(data), 512))

    assert len(rows) == len(texts())
    by = {r.doc_id: r for r in rows}
    for i, t in texts():
        data = t.encode()
        a, b, n = size(model.good, data), size(model.bad, data), len(data)
        difference, known = 10 * (b - a) / max(a + b, 1), n / (n + 300)
        share = math.log((a + b) / 2 / max(n, 1) + 0.02) if n else 0.0
        x = [1.0, difference, share, difference * known, min(share + 1.6, 0) * known]
        score = 1 / (1 + math.exp(-sum(u * v for u, v in zip(model.weights, x, strict=True))))
        assert math.isclose(by[i].score, score, rel_tol=1e-9)
        assert by[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and by[i].predicted == int(score >= 0.7)
    told = [r for r in rows if r.held_out and r.doc_id < 180]
    assert sum(r.predicted == (r.doc_id % 3 > 0) for r in told) > 0.9 * len(told)


def test_op8(spark, folder):
    from test_search_operators import brute_scores

    kinds = {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint"}
    rows = run(spark, folder, "op8_ngram_model", **kinds, base_score="double", score="double")
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in texts()}
    train = [t for i, t in texts() if not held[i]]
    split = {i: [*t.encode().translate(common.LOWER).split(), None] for i, t in texts()}
    counts = Counter(w for i, t in split.items() if not held[i] for w in t)
    n, v = sum(counts.values()), len(counts)
    want = dict(zip(split, brute_scores(train, [t for _, t in texts()]), strict=True))
    assert len(rows) == len(want)
    for r in rows:
        words = split[r.doc_id]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(words), sum(w in counts for w in words), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert abs(r.score - want[r.doc_id]) < 0.03 * len(words) + 1e-6


def test_op10(spark, folder):
    from test_search_operators import brute_repeats

    kinds = {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"}
    rows = run(spark, folder, "op10_repeated_strings", **kinds)
    want = Counter()
    for (i, n, gone, runs, kept), many in brute_repeats(documents(), 50).items():
        want[(i, n, gone, runs, hashlib.sha256(kept).hexdigest())] += many
    assert Counter(map(tuple, rows)) == want


def test_pipeline_rejects_and_packs(spark, folder):
    import corpus_pipeline
    from test_search_operators import brute_near, brute_repeats

    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    model = quality.train(docs, labels)
    score = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    good = [(i, t) for i, t in documents() if score[i] >= quality.CUT]
    assert 60 < len(good) < 140
    near = brute_near(good)
    distinct = [(i, t) for i, t in good if near[i][1] == i]
    left = {i: kept.decode("utf-8", "ignore") for i, _, _, _, kept in brute_repeats(distinct, 50)}
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    want = {i: [*made.encode(t, add_special_tokens=False).ids, 1] for i, t in left.items()}
    pieces, places = defaultdict(list), defaultdict(int)
    for r in corpus_pipeline.run(spark, folder).collect():
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32))
        places[r.sequence_id] += r.length
    got = {i: sorted(some) for i, some in pieces.items()}
    assert set(got) == set(want)
    for i, ids in want.items():
        at = 0
        for start, length, check in got[i]:
            assert (start, check) == (at, crc(ids[at : at + length]))
            at += length
        assert at == len(ids)
    assert max(places.values()) <= 2048


@pytest.mark.parametrize("write", ["tokens", "archives"])
def test_files_are_written_once(spark, tmp_path, monkeypatch, write):
    """No sort above the writing job: Spark would run it once more to sample its rows."""
    plans, kind = [], type(spark.range(1))
    collect = kind.collect

    def watched(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return collect(df)

    monkeypatch.setattr(kind, "collect", watched)
    rows = spark.createDataFrame([(k, f"text {k}", "u", "<p>") for k in range(40)], "doc_id long, text string, url string, html string")
    if write == "tokens":
        tokenfiles.write(rows, str(tmp_path), vocabulary("word_bpe_49k.json"), rows=10)
    else:
        warc.write(rows.withColumnRenamed("doc_id", "page_id"), str(tmp_path), rows=10)
    writing = [p for p in plans if "InPandas" in p or "InArrow" in p][-1]
    assert "rangepartitioning" not in writing.split("MapIn")[0]
