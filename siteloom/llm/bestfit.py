"""Best-fit packing of whole documents, online and in bounded space.

Only a document of more than ``size`` ids is cut: its first piece takes what is left over, all others
are ``size`` long. Pieces go, in the order in which their task reads them, to one of at most ``bins``
open bins. A bitset holds a bit for each amount of free space that some open bin has, so the tightest
bin that fits is its lowest bit at or above the piece's length. A piece that fits nowhere opens a bin;
if ``bins`` are open then, the fullest one closes first. Of each ``bins / 2`` pieces the longest
arrive first, which leaves the short ones to fill gaps.

*Tasks.* Each task packs what it reads: nothing is shuffled to be packed, and its memory is one batch
and the open bins. What is open when a task ends (``bins`` bins at most, the emptiest it had) is packed on:
those bins count as pieces as long as they are filled, are dealt into groups of ``GROUP`` bins and
go through the same packer, round by round, until one group is left. A round leaves ``bins`` bins of
each ``GROUP``, so two or three rounds serve any number of tasks. The packed rows are written
before that, so a lost task or another order of reading cannot tell two steps different things.

Null texts count as empty and hold the end id alone. Rows that repeat an id, and rows without one, are
documents of their own. Equal rows go to places of their own. A very long text is cut into
many rows; its ids are held once. An empty table gives no rows. ``pack`` keeps all columns, but
replaces those called ``sequence_id`` or ``offset``; a length that is not between 1 and ``size`` is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from siteloom.llm import bytewords, common
from siteloom.session import materialise

SIZE, END = 2048, 0
BINS, GROUP = 8192, 1 << 17


def pieces(df: DataFrame, vocabulary: str, size: int = SIZE, end: int = END) -> DataFrame:
    """Each document's ids with ``end`` after them: ``doc_id, piece, start, length, ids``.

    ``ids`` holds little-endian unsigned 32-bit integers; other columns are left out.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = bytewords.encoder(vocabulary)
        for batch in batches:
            for first, texts in common.text_portions(batch["text"]):
                runs = [np.append(run, run.dtype.type(end)).astype("<u4") for run in encode.ids(texts)]
                sizes = np.array([len(run) for run in runs], "int64")
                counts = -(-sizes // size)
                rows = np.repeat(np.arange(len(runs)), counts)
                number = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
                head = (sizes - (counts - 1) * size)[rows]  # the length of the first piece
                starts = np.where(number > 0, head + (number - 1) * size, 0)
                lengths = np.where(number > 0, size, head)
                parts = [
                    runs[k][a : a + n].tobytes() for k, a, n in zip(rows.tolist(), starts.tolist(), lengths.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].take(pa.array(rows + first)),
                        pa.array(number, "int64"),
                        pa.array(starts, "int64"),
                        pa.array(lengths, "int64"),
                        pa.array(parts, "binary"),
                    ],
                    ["doc_id", "piece", "start", "length", "ids"],
                )

    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return docs.mapInArrow(work, "doc_id long, piece long, start long, length long, ids binary")


class Packer:
    """At most ``bins`` open bins of ``size``; bins are numbered in the order of their opening."""

    def __init__(self, size: int = SIZE, bins: int = BINS):
        self.size, self.bins = size, bins
        self.free = 0  # bit f: some open bin has f left
        self.open: list[list[int]] = [[] for _ in range(size + 1)]  # open bins by what they have left
        self.used = self.count = 0

    def put(self, length: int) -> tuple[int, int]:
        """The bin that takes ``length`` and the place in it."""
        fits = self.free >> length
        if fits:
            left = length + (fits & -fits).bit_length() - 1
            number = self.open[left].pop()
            if not self.open[left]:
                self.free ^= 1 << left
            self.used -= 1
        else:
            if self.used >= self.bins:
                fullest = (self.free & -self.free).bit_length() - 1
                self.open[fullest].pop()
                if not self.open[fullest]:
                    self.free ^= 1 << fullest
                self.used -= 1
            left, number = self.size, self.count
            self.count += 1
        rest = left - length
        if rest:  # a full bin is closed
            self.open[rest].append(number)
            self.free |= 1 << rest
            self.used += 1
        return number, self.size - left

    def put_all(self, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``put`` for each of a batch, of every ``bins / 2`` the longest first."""
        bins, places = np.empty(len(lengths), "int64"), np.empty(len(lengths), "int64")
        order = np.lexsort((-lengths, np.arange(len(lengths)) // max(1, self.bins // 2)))
        for k, length in zip(order.tolist(), lengths[order].tolist(), strict=True):
            bins[k], places[k] = self.put(length)
        return bins, places

    def left(self) -> tuple[list[int], list[int]]:
        """The bins that are still open and what fills them."""
        pairs = [(n, self.size - f) for f, some in enumerate(self.open) for n in some]
        return [n for n, _ in pairs], [f for _, f in pairs]


def _number(task: int, bins) -> np.ndarray:
    return (np.asarray(bins, "int64") + (np.int64(task) << 32)).astype("int64")


def _merged(open_: DataFrame, groups: int, round_: int, size: int, bins: int) -> DataFrame:
    """One more round: ``bin, fill`` become ``bin, to, at`` and, with null ``bin``, the bins left open."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, group = Packer(size, bins), None
        for batch in batches:
            if batch.num_rows:
                group = batch["task"][0].as_py()
                numbers, places = packer.put_all(batch["fill"].to_numpy())
                to = _number(group, numbers) + (round_ << 56)
                yield pa.RecordBatch.from_arrays([batch["bin"], pa.array(to), pa.array(places)], ["bin", "to", "at"])
        if group is not None:
            numbers, fills = packer.left()
            to = _number(group, numbers) + (round_ << 56)
            none = pa.nulls(len(to), pa.int64())
            yield pa.RecordBatch.from_arrays([none, pa.array(to), pa.array(fills, "int64")], ["bin", "to", "at"])

    dealt = open_.withColumn("task", F.pmod(F.xxhash64("bin"), F.lit(groups)).cast("int"))
    dealt = dealt.repartitionById(groups, F.col("task")).sortWithinPartitions(F.desc("fill"), "bin")
    return materialise(dealt.select("task", "bin", "fill").mapInArrow(work, "bin long, to long, at long"))


def pack(df: DataFrame, size: int = SIZE, bins: int = BINS, group: int = GROUP) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` from 1 to ``size``."""
    df = df.select(*(f"`{c}`" for c in df.columns if c.lower() not in ("sequence_id", "offset")))
    task, bin_, at = (common.fresh(df, name) for name in ("task", "bin", "at"))
    at_length = next(k for k, c in enumerate(df.columns) if c.lower() == "length")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, number, fields = Packer(size, bins), None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            number, lengths = batch.column(batch.num_columns - 1)[0].as_py(), batch.column(at_length).cast(pa.int64())
            lengths = lengths.fill_null(0).to_numpy()
            if lengths.min() < 1 or lengths.max() > size:
                raise ValueError(f"a length is not between 1 and {size}")
            kept = batch.columns[:-1]
            fields = batch.schema
            numbers, places = packer.put_all(lengths)
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(_number(number, numbers)), pa.array(places), pa.array(np.zeros(len(places), "bool"))],
                [*fields.names[:-1], bin_, at, task],
            )
        if number is not None:
            numbers, fills = packer.left()
            blank = [pa.nulls(len(fills), fields.field(k).type) for k in range(len(fields) - 1)]
            marks = pa.array(np.ones(len(fills), "bool"))
            yield pa.RecordBatch.from_arrays(
                [*blank, pa.array(_number(number, numbers)), pa.array(fills, "int64"), marks], [*fields.names[:-1], bin_, at, task]
            )

    plain = StructType([StructField(f.name, f.dataType, True) for f in df.schema.fields])
    for name in (bin_, at):
        plain = plain.add(name, LongType())
    packed = materialise(df.withColumn(task, F.spark_partition_id()).mapInArrow(work, plain.add(task, "boolean")))
    rows = packed.where(~F.col(task)).drop(task)
    # The bins that tasks left open: BINS rows a task, however many rows it read.
    open_ = packed.where(F.col(task)).select(F.col(bin_).alias("bin"), F.col(at).alias("fill"))
    moved, number = None, 0
    while True:
        many, number = open_.count(), number + 1
        if not many:
            break
        groups = -(-many // group)
        merged = _merged(open_, groups, number, size, bins)
        step = merged.where(F.col("bin").isNotNull())
        if moved is None:
            moved = step
        else:  # the bins that moved before and moved again
            again = step.select(F.col("bin").alias("to"), F.col("to").alias("next"), F.col("at").alias("more"))
            moved = moved.join(again, "to", "left").select(
                "bin", F.coalesce("next", "to").alias("to"), (F.col("at") + F.coalesce("more", F.lit(0))).alias("at")
            )
            moved = materialise(moved)
        if groups == 1:
            break
        open_ = merged.where(F.col("bin").isNull()).select(F.col("to").alias("bin"), F.col("at").alias("fill"))
    if moved is None:
        return rows.withColumnsRenamed({bin_: "sequence_id", at: "offset"})
    moved = moved.withColumnsRenamed({"bin": bin_, "to": "_to_" + bin_, "at": "_at_" + at})
    joined = rows.join(moved, bin_, "left")
    return joined.select(
        *df.columns,
        F.coalesce("_to_" + bin_, bin_).alias("sequence_id"),
        (F.col(at) + F.coalesce("_at_" + at, F.lit(0))).alias("offset"),
    )
