"""Token id files: one zstandard frame a document, one dictionary for all.

A shard ``part-NNNNN.ids`` holds the documents of one id slice in ascending order:

    8 bytes  magic ``SLIDS001``
    frames   each document's ids (little-endian, 2 or 4 bytes each), compressed alone with
             the shared dictionary
    index    a row a document: id, frame's offset (int64), its size, number of ids (uint32)
    footer   dictionary's SHA-256 (32 bytes), offset of the index, documents (uint64),
             bytes an id (uint64)

so a single document is read by its index row and one frame. The dictionary is trained on
the serialized ids of ``sample`` documents (those of least hash; of long ones ``WINDOWS`` windows from all
places, 4,096 ids together) and stored once under its hash. A task writes its shard under a temporary name and renames
it when it is whole; shards depend on the rows alone, so a repeated task writes the same
file. ``manifest.json`` is written last, names each shard with its counts, and alone makes
the files valid.

Slices go by rows and bytes. Null texts count as empty, null ids come first (stored as the lowest long, read as null),
rows that repeat an id are ordered by text; an id with more rows than a slice takes has several, dealt by a hash of the text. A very long text is one frame, which its task holds
whole. Other columns are left out, whatever their names. An empty table gives a manifest without shards.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteloom.llm import common, wordtokens

MAGIC = b"SLIDS001"
END = 1
INDEX = np.dtype([("id", "<i8"), ("at", "<i8"), ("size", "<u4"), ("ids", "<u4")])
SAMPLE, SAMPLE_IDS, WINDOWS, DICTIONARY_BYTES, LEVEL = 1000, 4096, 8, 64 * 1024, 3


def _documents(df: DataFrame) -> DataFrame:
    docs = df.select(common.ids("doc_id").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    return docs.withColumn("tie", F.xxhash64("text"))


def windows(ids: np.ndarray) -> np.ndarray:
    """All ids of a document, or windows at even distances of a long one."""
    if len(ids) <= SAMPLE_IDS:
        return ids
    width = SAMPLE_IDS // WINDOWS
    starts = np.arange(WINDOWS) * (len(ids) - width) // (WINDOWS - 1)
    return ids[(starts[:, None] + np.arange(width)).ravel()]


def train(df: DataFrame, vocabulary: str, end: int = END, sample: int = SAMPLE) -> bytes:
    """The shared dictionary; empty if the sample is too small to train one."""
    import zstandard

    def serialized(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = wordtokens.encoder(vocabulary)
        for batch in batches:
            runs = encode.ids(batch["text"].tolist())
            yield pd.DataFrame({"ids": [windows(wordtokens.with_end(r, end)).tobytes() for r in runs]})

    docs = _documents(df).withColumn("rank", F.xxhash64("key", "text"))
    # The sample is chosen by hashes alone; its texts are found by them, equal rows once.
    chosen = docs.select("rank", "key").orderBy("rank", "key").limit(sample).distinct()
    texts = docs.join(F.broadcast(chosen), ["rank", "key"], "left_semi").select("text").distinct()
    samples = [r[0] for r in texts.mapInPandas(serialized, "ids binary").collect()]
    samples.sort(key=lambda x: (hashlib.sha256(x).digest(), x))  # training depends on the order
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _loaded(dictionary: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def write(df: DataFrame, folder: str, vocabulary: str, end: int = END, rows: int = common.SLICE_ROWS) -> dict:
    """Write the shards of ``doc_id, text`` and the manifest; gives the manifest."""
    docs = _documents(df)
    dictionary = train(df, vocabulary, end)
    digest = hashlib.sha256(dictionary).digest()
    files, root = common.filesystem(folder)
    files.create_dir(root, recursive=True)
    with files.open_output_stream(f"{root}/dictionary-{digest.hex()}") as out:
        out.write(dictionary)
    each = common.SLICE_BYTES // rows  # so a slice has ``rows`` rows at most, or SLICE_BYTES of text
    sized = docs.select("key", "tie", (F.octet_length("text") + each).cast("long").alias("size"))
    total = sized.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    splits = common.cuts(sized, total, common.SLICE_BYTES)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        encode = wordtokens.encoder(vocabulary)
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=_loaded(dictionary), write_content_size=True)
        out = None
        index: list[tuple[int, int, int, int]] = []
        at, width, number = len(MAGIC), np.dtype(encode.dtype).itemsize, 0
        files, root = common.filesystem(folder)
        temporary = f"{root}/.tmp-{uuid.uuid4().hex}"
        try:
            for batch in batches:
                texts, keys = batch["text"].tolist(), batch["key"].tolist()
                if out is None and keys:
                    number = int(batch["slice"].iloc[0])
                    out = files.open_output_stream(temporary)
                    out.write(MAGIC)
                for a, b in common.portions(texts):
                    for key, run in zip(keys[a:b], encode.ids(texts[a:b]), strict=True):
                        run = wordtokens.with_end(run, end)
                        frame = compressor.compress(run.astype(run.dtype.newbyteorder("<")).tobytes())
                        out.write(frame)
                        index.append((key, at, len(frame), len(run)))
                        at += len(frame)
            if out is None:
                return
            rows = np.array(index, INDEX)
            out.write(rows.tobytes())
            out.write(digest + np.array([at, len(rows), width], "<u8").tobytes())
        finally:
            if out is not None:
                out.close()
        name = f"part-{number:05d}.ids"
        files.move(temporary, f"{root}/{name}")
        yield pd.DataFrame(
            {"slice": [number], "name": [name], "docs": [len(rows)], "tokens": [int(rows["ids"].sum(dtype="int64"))], "bytes": [at]}
        )

    shards = common.dealt(docs, splits, ["key", "text"]).mapInPandas(
        work, "slice int, name string, docs long, tokens long, bytes long"
    )
    # A small row for each shard. They are sorted here: a sort in Spark would sample its input, and so write it twice.
    done = sorted((r.asDict() for r in shards.collect()), key=lambda r: r["slice"])
    manifest = {"dictionary": digest.hex(), "end": end, "shards": done}
    with files.open_output_stream(f"{root}/.tmp-manifest") as out:
        out.write(json.dumps(manifest).encode())
    files.move(f"{root}/.tmp-manifest", f"{root}/manifest.json")
    return manifest


def _footer(file) -> tuple[bytes, int, int, int]:
    file.seek(file.size() - 56)
    tail = file.read(56)
    return tail[:32], *map(int, np.frombuffer(tail[32:], "<u8"))


def _index(file) -> tuple[bytes, np.ndarray, int]:
    digest, at, docs, width = _footer(file)
    file.seek(at)
    return digest, np.frombuffer(file.read(docs * INDEX.itemsize), INDEX), width


def lookup(folder: str, name: str, doc_id: int) -> list[np.ndarray]:
    """The ids of one document of a shard, by its index (a list, as ids may repeat)."""
    import zstandard

    files, root = common.filesystem(folder)
    with files.open_input_file(f"{root}/{name}") as file:
        digest, rows, width = _index(file)
        with files.open_input_file(f"{root}/dictionary-{digest.hex()}") as stored:
            reader = zstandard.ZstdDecompressor(dict_data=_loaded(stored.read()))
        found = []
        for row in rows[np.searchsorted(rows["id"], doc_id) : np.searchsorted(rows["id"], doc_id, side="right")]:
            file.seek(int(row["at"]))
            found.append(np.frombuffer(reader.decompress(file.read(int(row["size"]))), f"<u{width}"))
        return found


def read(spark: SparkSession, folder: str) -> DataFrame:
    """All documents of a folder: ``doc_id, start, n_tokens, ids`` (ids as unsigned 32-bit)."""
    files, root = common.filesystem(folder)
    with files.open_input_stream(f"{root}/manifest.json") as file:
        manifest = json.loads(file.read())
    shards, start = [], 0
    for shard in manifest["shards"]:
        shards.append((len(shards), shard["name"], start))
        start += shard["tokens"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        files, root = common.filesystem(folder)
        for batch in batches:
            for name, base in zip(batch["name"].to_pylist(), batch["base"].to_pylist(), strict=True):
                with files.open_input_file(f"{root}/{name}") as file:
                    digest, rows, width = _index(file)
                    if digest.hex() != manifest["dictionary"]:
                        raise ValueError(f"{name} belongs to another dictionary")
                    with files.open_input_file(f"{root}/dictionary-{digest.hex()}") as stored:
                        reader = zstandard.ZstdDecompressor(dict_data=_loaded(stored.read()))
                    starts = base + np.cumsum(rows["ids"], dtype="int64") - rows["ids"]
                    file.seek(len(MAGIC))
                    for a in range(0, len(rows), 500):
                        part = rows[a : a + 500]
                        blobs = [
                            np.frombuffer(reader.decompress(file.read(int(size))), f"<u{width}").astype("<u4").tobytes()
                            for size in part["size"]
                        ]
                        keys = part["id"].astype("int64")
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(keys, mask=keys == common.LOWEST),
                                pa.array(starts[a : a + 500]),
                                pa.array(part["ids"].astype("int64")),
                                pa.array(blobs, "binary"),
                            ],
                            ["doc_id", "start", "n_tokens", "ids"],
                        )

    names = spark.createDataFrame(shards, "number int, name string, base long")
    spread = names.repartitionById(max(1, len(shards)), F.col("number"))
    return spread.mapInArrow(work, "doc_id long, start long, n_tokens long, ids binary")
