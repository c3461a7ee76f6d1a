"""WARC archives: a deterministic sharded writer, and a reader.

Records are range-sorted by page id into slices (``common.borders``); a task writes the
archives of its slice, ``part-SSSSS-NNNN.warc.gz``, one gzip member a record, and starts a
new file when the next record would pass ``roll`` compressed bytes. Headers and digests are
made anew from the payload. A payload that occurs more than once is stored with its smallest
page id and the other rows become ``revisit`` records; payloads under ``least`` bytes are
always stored. Nothing in a record depends on the run, so a repeated task writes the same
bytes; it writes under a temporary name and renames the whole file. ``manifest.json`` is
written last and names each file with its records, bytes and SHA-256: readers use nothing
that it does not name.

A null payload is empty. A null id comes first and is read as null. Of rows with equal id and
payload the first is the response. Record ids are version-8 UUIDs that hold the page id and
the number of the row among those of its id. A null URL is written as ``urn:page:ID``; control
characters and spaces of a URL are percent-encoded. A very long payload is one record, which its task holds whole; files are
rolled between records. Other columns are left out, whatever their names. An empty table gives no archives.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteloom.llm import common

ROLL = 64 << 20
DATE = "2000-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(key: int, row: int) -> str:
    """A version-8 UUID of 48 bits of row number and 64 bits of page id."""
    low = key & (1 << 64) - 1
    return str(uuid.UUID(int=(row & (1 << 48) - 1) << 80 | 8 << 76 | low >> 62 << 64 | 2 << 62 | low & (1 << 62) - 1))


def page_of(record: str) -> int:
    """The page id in a record id."""
    bits = uuid.UUID(record).int
    low = (bits >> 64 & 3) << 62 | bits & (1 << 62) - 1
    return low - (1 << 64) if low >> 63 else low


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in headers)
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def member(key: int, row: int, url: str | None, payload: bytes, digest: bytes, refers_to: int | None) -> bytes:
    """A response record, or a revisit of another page's payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if refers_to is None else head
    target = quote(url, safe="!#$%&'()*+,/:;=?@[]~-._|{}\\^`\"<>", encoding="utf-8") if url else f"urn:page:{key}"
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:uuid:{record_id(key, row)}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{base32(digest)}"),
        ("WARC-Block-Digest", f"sha1:{base32(hashlib.sha1(block).digest())}"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        headers += [("WARC-Profile", REVISIT), ("WARC-Refers-To", f"<urn:uuid:{record_id(refers_to, 0)}>")]
    return _member(headers, block)


class _Archives:
    """The files of one slice; each is renamed when it is whole."""

    def __init__(self, folder: str, number: int, roll: int):
        (self.files, self.root), self.number, self.roll = common.filesystem(folder), number, roll
        self.done: list[tuple[str, int, int, str]] = []
        self.out = None

    def add(self, data: bytes) -> None:
        if self.out is not None and self.size + len(data) > self.roll and self.records:
            self.close()
        if self.out is None:
            self.name = f"part-{self.number:05d}-{len(self.done):04d}.warc.gz"
            self.temporary = f"{self.root}/.tmp-{uuid.uuid4().hex}"
            self.out, self.size, self.records, self.digest = self.files.open_output_stream(self.temporary, compression=None), 0, 0, hashlib.sha256()
            block = f"software: siteloom\r\nformat: WARC/1.1\r\nisPartOf: {self.name}\r\n".encode()
            named = uuid.uuid5(uuid.NAMESPACE_URL, self.name)
            self._put(
                _member(
                    [
                        ("WARC-Type", "warcinfo"),
                        ("WARC-Record-ID", f"<urn:uuid:{named}>"),
                        ("WARC-Date", DATE),
                        ("WARC-Filename", self.name),
                        ("Content-Type", "application/warc-fields"),
                        ("Content-Length", str(len(block))),
                    ],
                    block,
                )
            )
        self._put(data)
        self.records += 1

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.digest.update(data)
        self.size += len(data)

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        self.out = None
        self.files.move(self.temporary, f"{self.root}/{self.name}")
        self.done.append((self.name, self.records, self.size, self.digest.hexdigest()))


def write(df: DataFrame, folder: str, least: int = 0, roll: int = ROLL, rows: int = common.SLICE_ROWS) -> dict:
    """Write ``page_id, url, html`` as archives and a manifest; gives the manifest.

    Equal payloads are found on (id, SHA-1) rows: digests are counted before they are
    shuffled, so a payload that many pages share is one row a task. Revisits join the pages
    in their slice's sort order; the payloads are shuffled once.
    """
    pages = df.select(
        common.ids("page_id").alias("key"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"),
    )
    splits = common.borders(pages.select("key"), "key", rows)
    narrow = pages.where(F.length("payload") >= least).select("key", F.unhex(F.sha1("payload")).alias("digest"))
    first = narrow.groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = narrow.join(first, "digest").where("key != first").dropDuplicates(["key", "digest"])
    both = pages.withColumns({"kind": F.lit(1), "digest": F.lit(None).cast("binary"), "first": F.lit(None).cast("long")})
    both = both.unionByName(again.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    files, root = common.filesystem(folder)
    files.create_dir(root, recursive=True)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives = current = None
        row, firsts, seen = 0, {}, set()
        for batch in batches:
            columns = [batch.column(n) for n in ("slice", "key", "kind", "url", "payload", "digest", "first")]
            for k in range(batch.num_rows):
                number, key, kind, url, payload, digest, first = (c[k].as_py() for c in columns)
                archives = archives or _Archives(folder, number, roll)
                if key != current:
                    current, row, firsts, seen = key, 0, {}, set()
                if kind == 0:
                    firsts[digest] = first
                    continue
                digest = hashlib.sha1(payload).digest()
                refers = firsts.get(digest, key if digest in seen else None)
                if len(payload) >= least:
                    seen.add(digest)
                archives.add(member(key, row, url, payload, digest, refers))
                row += 1
        if archives:
            archives.close()
            names, records, sizes, digests = zip(*archives.done, strict=True) if archives.done else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(names)), pa.array(list(records), "int64"), pa.array(list(sizes), "int64"), pa.array(list(digests))],
                ["name", "records", "bytes", "sha256"],
            )

    shards = common.sliced(both, "key", splits, ["key", "kind", "payload", "url"]).mapInArrow(
        work, "name string, records long, bytes long, sha256 string"
    )
    # A row for each file. They are sorted here: a sort in Spark would sample its input, and so write it twice.
    manifest = {"files": sorted((r.asDict() for r in shards.collect()), key=lambda r: r["name"])}
    with files.open_output_stream(f"{root}/.tmp-manifest") as out:
        out.write(json.dumps(manifest).encode())
    files.move(f"{root}/.tmp-manifest", f"{root}/manifest.json")
    return manifest


def _members(file) -> Iterator[bytes]:
    """The unpacked gzip members of a stream."""
    left = b""
    while left or (left := file.read(1 << 20)):
        packer, parts = zlib.decompressobj(31), []
        while not packer.eof:
            if not left and not (left := file.read(1 << 20)):
                raise ValueError("the archive ends within a record")
            parts.append(packer.decompress(left))
            left = packer.unused_data
        yield b"".join(parts)


def parse(data: bytes) -> dict | None:
    """The row of a record, its digests tested; None for other kinds of records."""
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    kind = headers["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    block = rest[: int(headers["Content-Length"])]
    if f"sha1:{base32(hashlib.sha1(block).digest())}" != headers["WARC-Block-Digest"]:
        raise ValueError(f"block digest of {headers['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or base32(hashlib.sha1(payload).digest()) != digest):
        raise ValueError(f"payload of {headers['WARC-Record-ID']}")
    page = page_of(headers["WARC-Record-ID"][10:-1])
    refers = page_of(headers["WARC-Refers-To"][10:-1]) if kind == "revisit" else common.LOWEST
    return {
        "page_id": None if page == common.LOWEST else page,
        "url": headers["WARC-Target-URI"],
        "record_type": kind,
        "payload_bytes": size,
        "payload_digest": digest,
        "refers_to": None if refers == common.LOWEST else refers,
        "payload": payload if kind == "response" else None,
    }


SCHEMA = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
    "refers_to long, payload binary"
)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """All records of the archives that the manifest names (``payload`` is null for revisits)."""
    files, root = common.filesystem(folder)
    with files.open_input_stream(f"{root}/manifest.json") as file:
        listed = [(k, f["name"]) for k, f in enumerate(json.loads(file.read())["files"])]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = common.filesystem(folder)
        for batch in batches:
            for name in batch["name"]:
                with files.open_input_stream(f"{root}/{name}", compression=None) as file:
                    rows, size = [], 0
                    for data in _members(file):
                        if row := parse(data):
                            rows.append(row)
                            size += len(data)
                        if size > 4 << 20:
                            yield _frame(rows)
                            rows, size = [], 0
                    yield _frame(rows)

    named = spark.createDataFrame(listed, "number int, name string")
    return named.repartitionById(max(1, len(listed)), F.col("number")).mapInPandas(work, SCHEMA)


def _frame(rows: list[dict]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[part.split()[0] for part in SCHEMA.split(", ")], dtype=object)
    return frame.astype({"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64"})
