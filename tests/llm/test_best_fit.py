"""Best-fit packing: ids as the library's, places without gap or overlap, few sequences."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from siteloom.llm import bestfit, bytewords, queries

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, task int, bin int, at string, piece string"


def library():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(VOCABULARY)
    return lambda text: made.encode(text, add_special_tokens=False).ids


def odd_texts():
    rng = random.Random(6)
    parts = [" ", "  ", "\n", "\n\n", "\t", "　", "\x1c", "\x85", "\x00", ".", ",", "!", "a", "The", "é", "中", "23", "'s", "<|endoftext|>", "don't", " ", "🙂"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(3000)]
    words = ["The", "and.", "Élan,", "naïve", "x,y.", "don't", "...", "中文", "end.\nNew"]
    return texts + [" ".join(rng.choices(words, k=rng.randint(1, 400))) for _ in range(60)] + ["", "a" * 50_000, "word " * 30_000]


def test_ids_are_the_librarys():
    assert bytewords.by_words(VOCABULARY)
    encode, want = bytewords.Encoder(VOCABULARY, limit=500), library()
    texts = odd_texts()
    for start in range(0, len(texts), 100):
        some = texts[start : start + 100]
        assert [run.tolist() for run in encode.ids(some)] == [want(text) for text in some]
    tokens = [token.decode() for token in bytewords.ranks(VOCABULARY) if token.decode(errors="ignore").encode() == token]
    assert [run.tolist() for run in encode.ids(tokens)] == [want(token) for token in tokens]
    assert not bytewords.by_words(public_tokenizers.path("word_bpe_49k.json"))


def check(rows, documents, size):
    """Pieces against the documents' ids, and places; gives the number of sequences."""
    encode = library()
    want = defaultdict(list)
    for doc, text in documents:
        want[doc].append([*encode(text or ""), 0])
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    assert set(got) == set(want)
    for doc, runs in want.items():
        pieces = []
        for ids in runs:
            head = (len(ids) - 1) % size + 1
            for k, (a, b) in enumerate(zip([0, *range(head, len(ids), size)], [*range(head, len(ids) + 1, size)], strict=True)):
                pieces.append((k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
        assert sorted(pieces) == sorted(got[doc])
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for some in places.values():
        at = 0
        for offset, length in sorted(some):
            assert offset == at
            at += length
        assert at <= size
    return len(places)


def documents():
    rng = random.Random(9)
    rows = [(k, " ".join(rng.choices(["a", "word", "Élan.", "x,y"], k=rng.randint(1, 60)))) for k in range(300)]
    return rows + [(300, None), (301, ""), (302, "  \n"), (303, "long " * 900), (5, rows[5][1]), (6, "another"), (None, "none"), (None, None)]


@pytest.mark.parametrize(("bins", "group"), [(10_000, 10_000), (8, 20), (2, 5)])
def test_packing(spark, bins, group):
    made = documents()
    df = spark.createDataFrame([(*r, 1, 2, "a", "p") for r in made], SCHEMA).repartition(6)
    cut = bestfit.pieces(df, VOCABULARY, 128).withColumn("ids_crc32", F.crc32("ids"))
    cut = cut.withColumns({"task": F.lit("t"), "_task": F.lit(1), "bin": F.lit(2), "at": F.lit(3), "to": F.lit(4)})
    packed = bestfit.pack(cut, 128, bins, group)
    assert packed.columns == [*cut.columns, "sequence_id", "offset"]
    rows = packed.collect()
    assert {(r.task, r["_task"], r.bin, r["at"], r.to) for r in rows} == {("t", 1, 2, 3, 4)}
    used, least = check(rows, made, 128), -(-sum(r.length for r in rows) // 128)
    assert used <= (1.05 if bins > 1000 else 1.25) * least + 2


def test_packer_closes_the_fullest():
    packer = bestfit.Packer(10, 2)
    assert [packer.put(n) for n in (6, 7)] == [(0, 0), (1, 0)]
    assert packer.put(3) == (1, 7)  # fills bin 1, which closes
    assert packer.put(8) == (2, 0)
    assert packer.put(5) == (3, 0)  # bin 2 is the fullest and closes
    assert packer.put(2) == (0, 6)  # 4 and 5 are free: the tighter one
    assert packer.put(2) == (0, 8)
    assert sorted(packer.left()[0]) == [3]


def test_refusals_and_empty(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    cut = bestfit.pieces(nothing, VOCABULARY)
    assert bestfit.pack(cut).collect() == []
    replaced = bestfit.pack(spark.createDataFrame([(5, "x", 7)], "length long, Offset string, sequence_id int"))
    assert [tuple(r) for r in replaced.select("length", "offset").collect()] == [(5, 0)]
    with pytest.raises(Exception, match="not between"):
        bestfit.pack(spark.createDataFrame([(3000,)], "length long")).collect()


def test_query(spark, tmp_path):
    made = documents() + [(400, "very long " * 5000)]
    spark.createDataFrame(made, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.QUERIES["op12_best_fit"](spark, str(tmp_path))
    assert found.dtypes == [(c, "bigint") for c in ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")]
    rows = found.collect()
    assert check(rows, made, 2048) == -(-sum(r.length for r in rows) // 2048)
