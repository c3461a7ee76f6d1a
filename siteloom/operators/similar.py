"""Groups of pages that may reach a threshold of similarity, without pairs of ids.

Each page has a *parity sketch*: a bit for each bucket of hashes, set if an odd number of its units falls there. Units
that two pages share cancel, so two sketches differ in at most as many bits as units stand in one page alone. That
bound is certain, whatever the hashes are: pages beyond it cannot reach the threshold. Pages of a key are compared by
sketches, block by block; what a block gives is no pair but each page's first link, so rows grow with the
pages. Components of these links are the groups: two pages of different groups are below the threshold.

A group may be a chain of pages of which few reach the threshold with each other. So the pairs that are asked for within it
pass the same bound once more, by sketches of one length (:func:`pairs`).

Where texts are compared by blocks of letters, the units are their grams with repeats, cut in the task. Bits then only
choose pairs: such a link is confirmed by the grams themselves, as a few chance links would make one group of a large key.

Comparisons are pages x pages of their key and of a neighbouring length, a few machine words each, in blocks of
bounded size that are dealt out over all tasks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteloom.session import materialise

# Pages of one side of a block; bits of a sketch; bytes of one comparison.
SLICE = 1024
LEAST_BITS, MOST_BITS = 64, 1 << 15
CHUNK = 1 << 24
# Bytes of one side of a block.
SLICE_BYTES = 1 << 25
# Bits of a sketch of one length for all pages.
PAIR_BITS = 1 << 11
# Letters of a gram of a text, bits of its sketch for each gram, and the most of them.
GRAM, GRAM_BITS, MOST_GRAM_BITS = 8, 4, 1 << 20

SKETCHED = "page_id long, size long, sketch binary"


def sketch(units: np.ndarray, times: int = 1, most: int = MOST_BITS, least: int = LEAST_BITS) -> bytes:
    """The parity sketch of an array of 64-bit hashes, with ``times`` as many bits as hashes or more, ``least`` to ``most``."""
    bits = least
    while bits < min(times * len(units), most):
        bits *= 2
    odd = np.bincount((units & (bits - 1)).astype("int64"), minlength=bits) & 1
    return np.packbits(odd.astype("uint8"), bitorder="little").tobytes()


def sketches(rows: DataFrame, least: int = LEAST_BITS, most: int = MOST_BITS) -> DataFrame:
    """``page_id, size, sketch`` of rows ``page_id, units`` (distinct units, hashed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = batch.column(1)
            flat, ends = units.values.to_numpy(zero_copy_only=False), units.offsets.to_numpy()
            sizes = np.diff(ends).astype("int64")
            made = [sketch(flat[a:b], 1, most, least) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(made, pa.binary())], ["page_id", "size", "sketch"])

    return rows.select("page_id", F.coalesce("units", F.array().cast("array<bigint>")).alias("units")).mapInArrow(run, SKETCHED)


def _grams(points: np.ndarray) -> np.ndarray:
    """A hash of each gram of a text, in order."""
    n = max(0, len(points) - GRAM + 1)
    found = np.zeros(n, "uint64")
    for k in range(GRAM):
        found = found * np.uint64(0x9E3779B97F4A7C15) + points[k : k + n]
    found = (found ^ (found >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return found ^ (found >> np.uint64(32))


def _anchors(points: np.ndarray) -> int:
    """How many letters of a text the matcher of the standard library takes as anchors."""
    counts = np.unique(points, return_counts=True)[1]
    return int(counts[counts <= len(points) // 100 + 1].sum()) if len(points) >= 200 else len(points)


def texts(rows: list[bytes]) -> tuple[list[bytes], np.ndarray, Callable]:
    """Sketches of the grams of texts, their numbers of anchors, and how many grams two of them hold alone."""
    points = [np.frombuffer(row.decode("utf-8", "replace").encode("utf-32-le"), "uint32").astype("uint64") for row in rows]
    made = [sketch(_grams(p), GRAM_BITS, MOST_GRAM_BITS) for p in points]
    anchors = np.array([_anchors(p) for p in points])
    del points

    @lru_cache(maxsize=64)
    def counted(k: int) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(_grams(np.frombuffer(rows[k].decode("utf-8", "replace").encode("utf-32-le"), "uint32").astype("uint64")), return_counts=True)

    def alone(one: int, other: int) -> int:
        (grams, n), (asked, m) = counted(one), counted(other)
        if not len(grams) or not len(asked):
            return int(n.sum() + m.sum())
        at = np.minimum(np.searchsorted(grams, asked), len(grams) - 1)
        shared = np.where(grams[at] == asked, np.minimum(n[at], m), 0).sum()
        return int(n.sum() + m.sum() - 2 * shared)

    return made, anchors, alone


def apart_by_blocks(threshold: float) -> Callable:
    """The most grams that two texts may hold alone whose matching blocks reach the threshold, by lengths and anchors.

    Every block but the one at the start of both texts holds an anchor of the earlier text, and a letter of one text at least
    lies between two blocks. So blocks are few, and each end of one breaks ``GRAM - 1`` grams at most.
    """
    edge = GRAM - 1

    def most(one: np.ndarray, other: np.ndarray, anchors: np.ndarray, other_anchors: np.ndarray) -> np.ndarray:
        both = one + other
        free = (1 - threshold) * both + 1e-6  # letters outside of all blocks
        breaks = np.minimum(np.maximum(anchors, other_anchors), free)
        bound = np.maximum(one - edge, 0) + np.maximum(other - edge, 0) - both + free + 2 * edge * (1 + breaks)
        return np.where(np.abs(one - other) <= free, bound, -1.0)

    return most


def _folded(rows: list[bytes], width: int) -> np.ndarray:
    """Sketches as rows of ``width`` words; longer ones fold, as buckets are the low bits of a hash."""
    words = np.frombuffer(b"".join(rows), "uint64").reshape(len(rows), -1)
    while words.shape[1] > width:
        half = words.shape[1] // 2
        words = words[:, :half] ^ words[:, half:]
    return words


def _least_labels(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """The least label that is reachable by links ``a, b``."""
    while True:
        least = np.minimum(label[a], label[b])
        now = label.copy()
        np.minimum.at(now, a, least)
        np.minimum.at(now, b, least)
        now = np.minimum(now, now[now])
        if (now == label).all():
            return label
        label = now


def _confirmed(label: np.ndarray, a: np.ndarray, b: np.ndarray, confirm: Callable) -> np.ndarray:
    """The labels with those of the links ``a, b`` that are confirmed; links within a component are not asked for."""
    least = label.tolist()

    def first(k: int) -> int:
        while least[k] != k:
            least[k] = least[least[k]]
            k = least[k]
        return k

    for one, other in zip(a.tolist(), b.tolist()):
        x, y = first(one), first(other)
        if x != y and confirm(one, other):
            least[max(x, y)] = min(x, y)
    return np.array([first(k) for k in range(len(least))])


def linked(
    size: np.ndarray, made: list[bytes], left: np.ndarray, right: np.ndarray, new: np.ndarray, apart: Callable, confirm: Callable | None = None
) -> np.ndarray:
    """For each page of a block the first page of its component, by the bound on the sketches.

    ``apart`` takes places of pages in the block. ``confirm`` is asked for pages that sketches would link.
    """
    n = len(size)

    def joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return _least_labels(n, a, b, label) if confirm is None else _confirmed(label, a, b, confirm)

    label = np.arange(n)
    words = np.array([len(m) // 8 for m in made])
    for width in np.unique(words):
        ones = np.flatnonzero(words == width)
        many = np.flatnonzero(words >= width)
        many = many[np.argsort(size[many], kind="stable")]
        table = np.empty((len(many), width), "uint64")
        for w in np.unique(words[many]):
            at = np.flatnonzero(words[many] == w)
            table[at] = _folded([made[k] for k in many[at]], int(width))
        place = np.empty(n, "int64")
        place[many] = np.arange(len(many))
        ones = ones[np.argsort(size[ones], kind="stable")]
        step = max(1, CHUNK // (8 * int(width) * len(many)))
        for k in range(0, len(ones), step):
            some = ones[k : k + step]
            # A pair within one width is met from its later page.
            first = int(place[some[0]])
            one, other = some[:, None], many[None, first:]
            asked = ((left[one] & right[other]) | (right[one] & left[other])) & (new[one] | new[other]) & (place[other] > place[one])
            most = apart(one, other)
            asked &= (np.abs(size[one] - size[other]) <= most) & (label[one] != label[other])
            i, j = np.nonzero(asked)
            if not len(i):
                continue
            if 4 * len(i) < asked.size or 64 * width > MOST_BITS:  # few: word by word for those alone
                for p in range(0, len(i), CHUNK // 64):
                    x, y = i[p : p + CHUNK // 64], j[p : p + CHUNK // 64]
                    for q in range(0, int(width), 32):  # ends early where a part of the bits is beyond the bound
                        part = np.bitwise_count(table[place[some[x]], q : q + 32] ^ table[first + y, q : q + 32]).sum(axis=1, dtype="int64")
                        total = part if q == 0 else total[stay] + part
                        stay = total <= most[x, y]
                        x, y = x[stay], y[stay]
                    if len(x):
                        label = joined(label, some[x], many[first + y])
            else:
                differ = np.bitwise_count(table[place[some]][:, None, :] ^ table[None, first:, :]).sum(axis=2, dtype="int64")
                x, y = np.nonzero(asked & (differ <= most))
                if len(x):
                    label = joined(label, some[x], many[first + y])
    return label


def _whole_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole runs from batches that are sorted by their first column."""
    held: list[pa.RecordBatch] = []  # rows of a run that may go on in the next batch
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.column(0).to_numpy()
        new_from = int(np.searchsorted(at, at[-1]))  # the last run starts here, as rows are sorted
        if held and held[-1].column(0)[-1].as_py() == at[-1]:
            held.append(batch)
            continue
        yield pa.Table.from_batches([*held, batch.slice(0, new_from)])
        held = [batch.slice(new_from)]
    if held:
        yield pa.Table.from_batches(held)


def _links(runs: DataFrame, apart: Callable, read: Callable | None = None) -> DataFrame:
    """``a, b`` from rows ``run, page_id, is_new, side, size, sketch`` (side: 1 left, 2 right, 3 both).

    With ``read`` the rows hold what it makes sketches of.
    """

    def label(size: np.ndarray, made: list[bytes], *sides: np.ndarray) -> np.ndarray:
        if read is None:
            return linked(size, made, *sides, lambda one, other: apart(size[one], size[other]))
        made, anchors, alone = read(made)

        def most(one, other):
            return apart(size[one], size[other], anchors[one], anchors[other])

        return linked(size, made, *sides, most, lambda one, other: alone(one, other) <= most(one, other))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settled(table: pa.Table) -> Iterator[pa.RecordBatch]:
            at, page = table["run"].to_numpy(), table["page_id"].to_numpy()
            size, side = table["size"].to_numpy(), table["side"].to_numpy()
            new, made = table["is_new"].to_numpy(), table["sketch"].to_pylist()
            borders = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1), len(at)]
            ones, others = [], []
            for a, b in zip(borders[:-1], borders[1:]):
                if b - a < 2:
                    continue
                first = label(size[a:b], made[a:b], (side[a:b] & 1) > 0, (side[a:b] & 2) > 0, new[a:b])
                moved = np.flatnonzero(first != np.arange(b - a))
                ones.append(page[a:b][moved])
                others.append(page[a:b][first[moved]])
            if ones:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ones)), pa.array(np.concatenate(others))], ["a", "b"])

        for table in _whole_runs(batches):
            yield from settled(table)

    dealt = runs.repartition("run").sortWithinPartitions("run")
    return dealt.select("run", "page_id", "is_new", "side", "size", "sketch").mapInArrow(run, "a long, b long")


def near_rows(
    size: np.ndarray, table: np.ndarray, order: np.ndarray, bands: np.ndarray | None, later: np.ndarray, kept: np.ndarray, apart: Callable
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs of ``later`` and ``kept`` rows of a key that the bound on sketches of one length allows.

    ``order`` tells which page comes first. Pairs that share one of ``bands`` are left out.
    """
    step = max(1, CHUNK // (8 * len(kept)))
    for k in range(0, len(later), step):
        one, other = later[k : k + step, None], kept[None, :]
        asked = (order[other] < order[one]) & (np.abs(size[one] - size[other]) <= apart(size[one], size[other]))
        i, j = np.nonzero(asked)
        for p in range(0, len(i), CHUNK // 256):
            x, y = later[k + i[p : p + CHUNK // 256]], kept[j[p : p + CHUNK // 256]]
            if bands is not None:
                first = ~(bands[x] == bands[y]).any(axis=1)
                x, y = x[first], y[first]
            near = np.bitwise_count(table[x] ^ table[y]).sum(axis=1, dtype="int64") <= apart(size[x], size[y])
            if near.any():
                yield x[near], y[near]


def pairs(rows: DataFrame, apart: Callable) -> DataFrame:
    """``page_id, orig_id, orig_new, key`` of rows ``key, _salt, side, page_id, is_new, size, sketch, before``.

    Side 1 are later pages, side 2 those they are compared with; sketches are of one length. ``before`` are the bands
    before the key's own (or NULL): a pair counts at the first band that it shares.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _whole_runs(batches):
            if not whole.num_rows:
                continue
            page, new, side, size = (whole[name].to_numpy() for name in ("page_id", "is_new", "side", "size"))
            table = np.frombuffer(b"".join(whole["sketch"].to_pylist()), "uint64").reshape(len(page), -1)
            before = whole["before"].to_pylist()
            # Runs are hashes, so the keys themselves tell where the next one starts.
            at, key, salt = (whole[name].to_numpy() for name in ("run", "key", "_salt"))
            moved = (at[1:] != at[:-1]) | (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])
            borders = [0, *(np.flatnonzero(moved) + 1), len(page)]
            # Rows of one page have one place, so that none of them comes before another.
            by = np.lexsort((page, new))
            order = np.empty(len(page), "int64")
            order[by] = np.cumsum(np.concatenate([[False], (page[by][1:] != page[by][:-1]) | (new[by][1:] != new[by][:-1])]))
            ones, others, n = [], [], 0

            def found() -> pa.RecordBatch:
                x, y = np.concatenate(ones), np.concatenate(others)
                taken = [pa.array(page[x]), pa.array(page[y]), pa.array(new[y]), pa.array(key[x], pa.string())]
                return pa.RecordBatch.from_arrays(taken, ["page_id", "orig_id", "orig_new", "key"])

            for a, b in zip(borders[:-1], borders[1:]):
                later = np.flatnonzero((side[a:b] == 1) & new[a:b])
                kept = np.flatnonzero(side[a:b] == 2)
                if not len(later) or not len(kept):
                    continue
                bands = np.array(before[a:b], "int64") if before[a] else None
                for x, y in near_rows(size[a:b], table[a:b], order[a:b], bands, later, kept, apart):
                    ones.append(a + x)
                    others.append(a + y)
                    n += len(x)
                    if n >= CHUNK // 64:
                        yield found()
                        ones, others, n = [], [], 0
            if n:
                yield found()

    dealt = rows.withColumn("run", F.xxhash64("key", "_salt")).repartition("run").sortWithinPartitions("run", "key", "_salt")
    return dealt.select("run", "key", "_salt", "side", "page_id", "is_new", "size", "sketch", "before").mapInArrow(run, "page_id long, orig_id long, orig_new boolean, key string")


def _toward(edges: DataFrame) -> DataFrame:
    """Every page's larger neighbours become neighbours of its least one."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    moved = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.where("a != b").distinct()


def _down(edges: DataFrame) -> DataFrame:
    """Every page and its smaller neighbours become neighbours of the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a != b")
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``page_id, group`` (the least page reachable) for the pages of links ``a, b``, in rounds until nothing moves."""
    edges = materialise(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        edges = materialise(_down(_toward(edges)))
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            ends = edges.select(F.col("b").alias("page_id"), F.col("b").alias("group")).distinct()
            return edges.select(F.col("a").alias("page_id"), F.col("b").alias("group")).unionByName(ends)
        before = state


def groups(keyed: DataFrame, sketched: DataFrame, apart: Callable, least_ratio: float, read: Callable | None = None) -> DataFrame:
    """``page_id, group`` of pages that may reach the threshold with another one of a key; others are left out.

    ``keyed`` holds ``page_id, key, is_new``, ``apart`` gives the most units that two pages of given sizes may hold
    alone, and ``least_ratio`` the least smaller-to-larger ratio of sizes. Pages of a large key that may match lie in one
    band of sizes or in neighbours. With ``read``, ``sketched`` holds what sketches are made of in the task.
    """
    width = -math.log(least_ratio) * (1 + 1e-6) or 1e-9 if least_ratio > 0 else math.inf
    rows = materialise(keyed.select("page_id", "is_new", F.xxhash64("key").alias("key")).join(sketched.select("page_id", "size", F.octet_length("sketch").alias("bytes")), "page_id"))
    slices = F.greatest(F.ceil(F.count("*") / SLICE), F.ceil(F.sum("bytes") / SLICE_BYTES)).cast("int")
    keys = rows.groupBy("key").agg((slices > 1).alias("_large"))
    banded = rows.join(keys, "key").withColumn("band", F.when(F.col("_large"), F.floor(F.log(F.col("size") + 1) / F.lit(width))).otherwise(F.lit(0)))
    cells = materialise(banded.groupBy("key", "band", "_large").agg(slices.alias("n")))

    def beside(step: int, name: str) -> DataFrame:
        return cells.where("_large").select("key", (F.col("band") + step).alias("band"), F.col("n").alias(name))

    around = cells.join(beside(1, "below"), ["key", "band"], "left").join(beside(-1, "above"), ["key", "band"], "left").fillna(0, ["below", "above"])
    mine = banded.drop("_large", "bytes").join(around, ["key", "band"]).withColumn("slice", F.pmod(F.xxhash64("page_id"), "n").cast("int"))

    def run(band: Column, one: Column, step: int, other: Column) -> Column:
        return F.xxhash64("key", band, one, F.lit(step), other).alias("run")

    # Within the band: (slice, slice) for both at once, then slices in order; then with the next band as the left side.
    def each(count: Column, row: Callable[[Column], Column]) -> Column:
        return F.transform(F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>")), row)

    def row(where: Column, side: Column) -> Column:
        return F.struct(where, side.cast("int").alias("side"))

    band, own = F.col("band"), F.col("slice")
    inside = each(F.col("n"), lambda k: row(run(band, F.least(own, k), 0, F.greatest(own, k)), F.when(k == own, 3).when(own < k, 1).otherwise(2)))
    up = each(F.col("above"), lambda k: row(run(band, own, 1, k), F.lit(1)))
    down = each(F.col("below"), lambda k: row(run(band - 1, k, 1, own), F.lit(2)))
    runs = mine.select("page_id", "is_new", F.inline(F.concat(inside, up, down)))
    return components(_links(runs.join(sketched, "page_id"), apart, read))
