"""Ordered slices, shared files and word memos that several operators use."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from siteloom.session import checkpoint_dir

SLICE_ROWS, SLICE_BYTES, SLICE_KEYS = 8192, 1 << 26, 20
LOWEST = -(2**63)
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def scratch(df: DataFrame, kind: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{checkpoint_dir(df.sparkSession)}/siteloom/{kind}-{uuid.uuid4().hex}"


def filesystem(path: str):
    """pyarrow's file system for a path or URI, and the path in it."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    return fs.LocalFileSystem(), path


def ids(column: str) -> Column:
    """An id as a long; null ids come first and count as the lowest long."""
    return F.coalesce(F.col(column).cast("long"), F.lit(LOWEST))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while f"_{name}" in taken:
        name = f"_{name}"
    return f"_{name}"


def borders(df: DataFrame, key: str, rows: int = SLICE_ROWS) -> list[int]:
    """Split points of ``key`` (a long) for slices of about ``rows`` rows.

    They come from the keys whose hash falls under a bound, about 20 a slice, so the same
    table always has the same slices and the driver holds 20 longs a slice at most.
    """
    count = df.count()
    slices = max(1, -(-count // rows))
    every = max(1, count // (slices * 20))
    found = df.where(F.pmod(F.xxhash64(key), F.lit(every)) == 0).select(key).collect() if slices > 1 else []
    sample = sorted(row[0] for row in found)
    return sorted({sample[k * len(sample) // slices] for k in range(1, slices)}) if sample else []


def slice_of(key: Column, splits: list[int]) -> Column:
    """The number of the slice that ``key`` falls into."""
    edges = np.array(splits, dtype="int64")

    @F.pandas_udf(IntegerType())
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, keys.to_numpy("int64"), side="right").astype("int32"))

    return place(key)


def sliced(df: DataFrame, key: str, splits: list[int], order: list[str], name: str = "slice") -> DataFrame:
    """One partition a slice, each sorted; ``name`` holds the slice's number."""
    placed = df.withColumn(name, slice_of(F.col(key), splits))
    return placed.repartitionById(len(splits) + 1, F.col(name)).sortWithinPartitions(*order)


def cuts(df: DataFrame, total: int, most: int) -> list[tuple[int, int]]:
    """Split points ``(key, tie)`` for slices of ``most`` bytes or little more.

    ``df`` holds the longs ``key``, ``tie`` (a hash of the row's text) and ``size``, of which ``total`` is the sum. The
    rows of a key stay together, but a key that fills more than a slice has slices of its own, dealt by ``tie``
    (rows alike in both stay together). Rows are sampled by their size, about ``SLICE_KEYS`` a slice, so many small
    rows weigh as much as a few large ones, and repeated rows are added up before they reach the driver.
    """
    slices = -(-total // most)
    if slices <= 1:
        return []
    step = max(1, total // (slices * SLICE_KEYS))
    taken = df.where(F.pmod(F.xxhash64("key", "tie"), F.lit(step)) < F.col("size"))
    weighed = taken.groupBy("key", "tie").agg(F.sum(F.greatest("size", F.lit(step))).alias("weight"))
    found = sorted(tuple(row) for row in weighed.collect())
    splits, filled, start = [], 0, 0
    while start < len(found):
        key, end = found[start][0], start
        while end < len(found) and found[end][0] == key:
            end += 1
        weight = sum(row[2] for row in found[start:end])
        if weight > most:
            splits.append((key, LOWEST))
            within = 0
            for _, tie, one in found[start:end]:
                if within and within + one > most:
                    splits.append((key, max(tie, LOWEST + 1)))
                    within = 0
                within += one
            if key < 2**63 - 1:
                splits.append((key + 1, LOWEST))
            filled = 0
        else:
            if filled and filled + weight > most:
                splits.append((key, LOWEST))
                filled = 0
            filled += weight
        start = end
    return sorted(set(splits))


def places(keys: np.ndarray, ties: np.ndarray, splits: list[tuple[int, int]]) -> np.ndarray:
    """The number of the slice of :func:`cuts` that each row falls into."""
    edges = np.array(splits, "int64").reshape(-1, 2)
    place = np.searchsorted(edges[:, 0], keys, side="left")
    stop = np.searchsorted(edges[:, 0], keys, side="right")
    for key in np.unique(keys[stop > place]):
        at = np.flatnonzero(keys == key)
        low, high = place[at[0]], stop[at[0]]
        place[at] += np.searchsorted(edges[low:high, 1], ties[at], side="right")
    return place.astype("int32")


def first_places(splits: list[tuple[int, int]]) -> np.ndarray:
    """For each slice the first one that holds its key: slices of one key have the same."""
    own = np.array([True, *(tie == LOWEST for _, tie in splits)])
    return np.maximum.accumulate(np.where(own, np.arange(len(own)), 0)).astype("int64")


def dealt(df: DataFrame, splits: list[tuple[int, int]], order: list[str], name: str = "slice") -> DataFrame:
    """One partition for each slice of :func:`cuts`, sorted; ``name`` holds the slice's number."""

    @F.pandas_udf(IntegerType())
    def place(keys: pd.Series, ties: pd.Series) -> pd.Series:
        return pd.Series(places(keys.to_numpy("int64"), ties.to_numpy("int64"), splits))

    placed = df.withColumn(name, place("key", "tie"))
    return placed.repartitionById(len(splits) + 1, F.col(name)).sortWithinPartitions(*order)


class Memo:
    """Codes of words and, by code, runs of a flat array, for a bounded number of words.

    ``encode`` turns a list of new words into a list of integer lists.
    """

    def __init__(self, encode: Callable[[list[str]], list], dtype: str, limit: int = 400_000):
        self.encode, self.dtype, self.limit = encode, dtype, limit
        self.clear()

    def clear(self) -> None:
        self.codes: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, self.dtype)
        self.ends = np.zeros(1 << 16, "int64")
        self.used = 0

    def learn(self, words: list[str]) -> None:
        new = list(dict.fromkeys(w for w in words if w not in self.codes))
        if not new:
            return
        if len(self.codes) + len(new) > self.limit and self.codes:
            self.clear()
            new = list(dict.fromkeys(words))
        runs = self.encode(new)
        sizes = np.fromiter(map(len, runs), "int64", len(runs))
        first, n = len(self.codes), int(sizes.sum())
        while self.used + n > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while first + len(new) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.flat[self.used : self.used + n] = np.concatenate([np.asarray(run, self.dtype) for run in runs])
        self.ends[first + 1 : first + 1 + len(new)] = self.used + np.cumsum(sizes)
        self.used += n
        self.codes.update(zip(new, range(first, first + len(new)), strict=True))

    def runs(self, words: list[str]) -> np.ndarray:
        """The runs of all words, one after the other."""
        return self.runs_of([words])[0]

    def runs_of(self, texts: list[list[str]]) -> list[np.ndarray]:
        words = [w for text in texts for w in text]
        try:
            codes = list(map(self.codes.__getitem__, words))
        except KeyError:
            self.learn(words)
            codes = list(map(self.codes.__getitem__, words))
        at = np.array(codes, "int64")
        starts = self.ends[at]
        sizes = self.ends[at + 1] - starts
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.flat[np.arange(total) + np.repeat(starts - (ends - sizes), sizes)]
        cuts = np.concatenate([[0], ends])[np.cumsum([0, *map(len, texts)])]
        return [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def portions(texts: list, size: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` characters in all (one long text is a range of its own)."""
    start = total = 0
    for k, text in enumerate(texts):
        if k > start and total + len(text) > size:
            yield start, k
            start, total = k, 0
        total += len(text)
    if start < len(texts):
        yield start, len(texts)


def text_portions(texts: pa.Array, size: int = 1_000_000) -> Iterator[tuple[int, list[str]]]:
    """A string column in parts of about ``size`` bytes: the first row and the texts of each.

    Only one part is held as Python strings at a time.
    """
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    for start, end in portions(list(map(range, sizes.tolist())), size):
        yield start, texts.slice(start, end - start).to_pylist()
    # Workers serve one stage after another and would keep what Arrow held for the largest batch.
    pa.default_memory_pool().release_unused()


def lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """An Arrow list column from numpy arrays."""
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype("int32")
    flat = np.concatenate(values) if values else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) over an array of uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), "uint64", len(words))
