"""Packing of token runs into sequences by shortest-pack-first over the length histogram.

A document's ids are cut into pieces of the sequence size and a rest. The histogram of piece
lengths (at most ``size`` numbers, whatever the data) goes to the driver, where lengths are
placed longest first: each goes to the pattern with the least filled space that still fits
it, for as many sequences as that pattern has; what is left opens new patterns. Patterns
have counts, so the work depends on the number of lengths and not of documents. The patterns
come back to the pieces by rank: the pieces of a length, in order of (doc_id, start), take
the places that the patterns have for that length, one after the other.

Null texts count as empty. A document with no ids and no end id has no piece. Rows that
repeat an id are documents of their own; their pieces may interleave in rank only, and equal
rows take places of their own. A very long text has as many pieces as it needs. ``pieces`` leaves other columns out,
``pack`` keeps them under any name but those of its results. An empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siteloom.llm import common, wordtokens
from siteloom.session import materialise

SIZE = 2048
END = 1


def pieces(df: DataFrame, vocabulary: str, size: int = SIZE, end: int = END) -> DataFrame:
    """Cut each document's ids, with ``end`` after them: ``doc_id, start, length, ids, doc_tokens``.

    ``ids`` holds little-endian unsigned 32-bit integers.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = wordtokens.encoder(vocabulary)
        for batch in batches:
            names, texts = batch["doc_id"], batch["text"].to_pylist()
            for a, b in common.portions(texts):
                runs = [wordtokens.with_end(r, end).astype("<u4") for r in encode.ids(texts[a:b])]
                rows, starts, lengths, blobs, totals = [], [], [], [], []
                for k, run in enumerate(runs):
                    for start in range(0, len(run), size):
                        part = run[start : start + size]
                        rows.append(a + k)
                        starts.append(start)
                        lengths.append(len(part))
                        blobs.append(part.tobytes())
                        totals.append(len(run))
                yield pa.RecordBatch.from_arrays(
                    [
                        names.take(pa.array(rows, "int64")),
                        pa.array(starts, "int64"),
                        pa.array(lengths, "int64"),
                        pa.array(blobs, "binary"),
                        pa.array(totals, "int64"),
                    ],
                    ["doc_id", "start", "length", "ids", "doc_tokens"],
                )

    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return docs.mapInArrow(work, "doc_id long, start long, length long, ids binary, doc_tokens long")


def patterns(histogram: dict[int, int], size: int = SIZE) -> list[tuple[list[int], int]]:
    """Packing patterns with their counts: ``([lengths], sequences)``.

    ``open_[total]`` lists the patterns that are filled to ``total``. A length goes to the
    lowest total that is filled at all and leaves room.
    """
    open_: dict[int, list[list]] = defaultdict(list)
    for length in sorted(histogram, reverse=True):
        left, grown = histogram[length], []
        while left:
            total = next((t for t in sorted(open_) if t + length <= size), None)
            if total is None:
                grown.append([[length], left])
                left = 0
            else:
                entry = open_[total].pop()
                if not open_[total]:
                    del open_[total]
                take = min(left, entry[1])
                left -= take
                # More of this length may fit on top, so the grown pattern is open at once.
                open_[total + length].append([[*entry[0], length], take])
                if entry[1] > take:
                    open_[total].append([entry[0], entry[1] - take])
        for lengths, count in grown:
            # A new pattern of short pieces takes several of the same length.
            fit = size // length
            if count // fit:
                open_[fit * length].append([lengths * fit, count // fit])
            if count % fit:
                open_[count % fit * length].append([lengths * (count % fit), 1])
    return [(lengths, count) for total in sorted(open_, reverse=True) for lengths, count in open_[total]]


def places(found: list[tuple[list[int], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: the first rank of each run of places, its first sequence, its offset."""
    made: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    filled: dict[int, int] = defaultdict(int)
    base = 0
    for lengths, count in found:
        offset = 0
        for length in lengths:
            made[length].append((filled[length], base, offset))
            filled[length] += count
            offset += length
        base += count
    return {length: tuple(np.array(rows, "int64").T) for length, rows in made.items()}


def pack(df: DataFrame, size: int = SIZE, order: tuple[str, ...] = ("doc_id", "start")) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` from 1 to ``size``.

    Input columns of those two names are replaced, all others stay. Ranks within a length are made over range slices of
    (length, order), so a length that most rows share spans many tasks: a slice counts its rows by length, and the
    counts of the slices before it (one small row for each slice and length) are added.
    """
    df = df.select(*(f"`{c}`" for c in df.columns if c.lower() not in ("sequence_id", "offset")))
    slice_, row, many, first, before = (common.fresh(df, name) for name in ("slice", "row", "n", "first", "before"))
    ordering = ["length", *order]
    # Written once: range borders are sampled from the rows, which else would be made twice.
    ranged = materialise(df).repartitionByRange(*ordering).sortWithinPartitions(*ordering)
    rows = materialise(ranged.withColumn(slice_, F.spark_partition_id()).withColumn(row, F.monotonically_increasing_id()))
    counts = rows.groupBy("length", slice_).agg(F.count("*").alias(many), F.min(row).alias(first))
    earlier = Window.partitionBy("length").orderBy(slice_).rowsBetween(Window.unboundedPreceding, -1)
    counts = materialise(counts.withColumn(before, F.coalesce(F.sum(many).over(earlier), F.lit(0))))
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum(many)).collect()}  # at most `size` rows
    where = places(patterns(histogram, size))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rank = (batch.pop(row) - batch.pop(first) + batch.pop(before)).to_numpy("int64")
            batch = batch.drop(columns=slice_)
            sequence, offset = np.zeros(len(batch), "int64"), np.zeros(len(batch), "int64")
            lengths = batch["length"].to_numpy("int64")
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                begin, base, off = where[int(length)]
                run = np.searchsorted(begin, rank[at], side="right") - 1
                sequence[at], offset[at] = base[run] + rank[at] - begin[run], off[run]
            yield batch.assign(sequence_id=sequence, offset=offset)

    # Rows of a (length, slice) are next to each other in their slice, so a row's number less the first is its rank.
    joined = rows.join(counts.drop(many), ["length", slice_]).select(*(f"`{c}`" for c in rows.columns), first, before)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return joined.mapInPandas(work, f"{kept}, sequence_id long, offset long")
