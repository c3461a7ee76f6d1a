"""Vocabulary, MinHash vectors and band signatures of texts.

A text becomes rows of units (3-character shingles by default). They meet the
vocabulary in a broadcast join and one ``min`` aggregate per hash function,
whose partial step runs where the text was read: one row per text is shuffled.
Shingles and characters are cut, and minima taken, over whole Arrow batches; other units
come from their own Column expression.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siteloom.functions.text import WIDTHS, shingles

# The minimum over no units, the band mask, the number of vocabulary units.
SENTINEL = 2**31 - 1
BAND_MASK = 6
VOCABULARY_SIZE = 5181

PRIME = 2**31 - 1
MAX_BROADCAST_UNITS = 1_000_000
# Characters that are counted at once.
PORTION = 1 << 20
NOTHING = 2**63 - 1
# Bytes of a vocabulary's hashes that go to the tasks as one table.
TABLE_BYTES = 1 << 24


def hash_parameters(count: int, seed: int = 7) -> list[tuple[int, int]]:
    """``(a, b)`` of ``count`` hash functions ``(a * idx + b) % PRIME``, drawn once from a seed."""
    draw = random.Random(seed)
    return [(draw.randrange(1, PRIME), draw.randrange(PRIME)) for _ in range(count)]


def hash_family(count: int, seed: int = 7) -> list[Callable[[Column], Column]]:
    """Hash functions over vocabulary indices; in 64 bits there is no overflow below index 2**31."""

    def function(a: int, b: int) -> Callable[[Column], Column]:
        return lambda idx: (F.lit(a) * idx + F.lit(b)) % F.lit(PRIME)

    return [function(a, b) for a, b in hash_parameters(count, seed)]


def sum_and_mask(values: list[Column]) -> Column:
    """The default band hash: the sum of the band's values XOR a fixed mask."""
    return reduce(lambda left, right: left + right, values).bitwiseXOR(F.lit(BAND_MASK).cast("long"))


@dataclass(frozen=True)
class Scheme:
    """How texts become signatures.

    Either ``hash_funcs`` (Column to Column, over the unit's index) or
    ``num_hash`` must be given. ``num_bands`` must divide the number of hash
    functions. ``band_hasher`` maps the list of a band's values to one Column and
    ``shingle`` maps a text Column to an array of units.
    """

    num_bands: int
    num_hash: int | None = None
    hash_funcs: list[Callable[[Column], Column]] | None = None
    band_hasher: Callable[[list[Column]], Column] = sum_and_mask
    shingle: Callable[[Column], Column] = shingles
    seed: int = 7
    functions: list[Callable[[Column], Column]] = field(init=False, repr=False)

    def __post_init__(self):
        if not self.hash_funcs and self.num_hash is None:
            raise ValueError("give hash_funcs or num_hash")
        functions = self.hash_funcs or hash_family(self.num_hash, self.seed)
        if self.num_bands < 1 or not functions or len(functions) % self.num_bands:
            raise ValueError(f"{len(functions)} hash functions cannot be split into {self.num_bands} equal bands")
        object.__setattr__(self, "functions", list(functions))


def units(docs: DataFrame, text: str = "text", shingle: Callable[[Column], Column] = shingles) -> DataFrame:
    """One row ``gram`` per unit of every text."""
    return docs.select(F.explode(shingle(F.col(text))).alias("gram"))


def _codes(text: bytes, width: int) -> np.ndarray:
    """The windows of ``width`` (1 to 3) characters of a text in UTF-8 as numbers, 21 bits a character."""
    points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), "uint32").astype("int64")
    codes = points[: max(0, len(points) - width + 1)]
    for k in range(1, width):
        codes = (codes << 21) | points[k : len(points) - width + 1 + k]
    return codes


def _grams(codes: np.ndarray, width: int) -> list[str]:
    points = np.stack([(codes >> 21 * k) & 0x1FFFFF for k in reversed(range(width))], axis=1).astype("<u4")
    joined = points.tobytes().decode("utf-32-le")
    return [joined[k : k + width] for k in range(0, len(joined), width)]


def _distinct_units(docs: DataFrame, keep: list[str], text: str, shingle: Callable[[Column], Column]) -> DataFrame:
    """``keep`` and ``grams``, the distinct units of each text; NULL for none."""
    width = WIDTHS.get(shingle)
    if width is None:
        return docs.select(*keep, F.array_distinct(shingle(F.col(text))).alias("grams"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            step = 1000
            for k in range(0, batch.num_rows, step):
                found = [None if t is None else _grams(np.unique(_codes(t, width)), width) for t in texts.slice(k, step).to_pylist()]
                columns = [c.slice(k, step) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.list_(pa.string()))], [*keep, "grams"])

    rows = docs.select(*keep, F.col(text).cast("binary").alias("_bytes"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("grams", T.ArrayType(T.StringType()))])
    return rows.mapInArrow(cut, schema)


def _code(gram: Column, width: int) -> Column:
    """:func:`_codes` of a unit; NULL for units of another width."""
    points = [F.ascii(F.substring(gram, k + 1, 1)).cast("long") for k in range(width)]
    return F.when(F.length(gram) == width, reduce(lambda code, point: F.shiftleft(code, 21).bitwiseOR(point), points))


def _distinct_codes(docs: DataFrame, keep: list[str], text: str, width: int) -> DataFrame:
    """:func:`_distinct_units` as numbers."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            step = 1000
            for k in range(0, batch.num_rows, step):
                some = texts.slice(k, step)
                found = [np.empty(0, "int64") if t is None else np.unique(_codes(t, width)) for t in some.to_pylist()]
                ends = np.cumsum([0, *map(len, found)]).astype("int32")
                grams = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found), pa.int64()), mask=some.is_null())
                yield pa.RecordBatch.from_arrays([*[c.slice(k, step) for c in batch.columns[:-1]], grams], [*keep, "grams"])

    rows = docs.select(*keep, F.col(text).cast("binary").alias("_bytes"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("grams", T.ArrayType(T.LongType()))])
    return rows.mapInArrow(cut, schema)


def _counts(docs: DataFrame, text: str, shingle: Callable[[Column], Column]) -> DataFrame:
    """``(gram, n)`` of all units; counted by portions first where a text is cut into characters."""
    width = WIDTHS.get(shingle)
    if width is None:
        return units(docs, text, shingle).groupBy("gram").agg(F.count("*").alias("n"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(held: list[np.ndarray]) -> pa.RecordBatch:
            codes, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(_grams(codes, width), pa.string()), pa.array(n, pa.int64())], ["gram", "n"])

        held, size = [], 0
        for batch in batches:
            for one in batch.column(0):
                codes = _codes(one.as_py(), width)
                for k in range(0, len(codes), PORTION):
                    held.append(codes[k : k + PORTION])
                    size += len(held[-1])
                    if size >= PORTION:
                        yield counted(held)
                        held, size = [], 0
        if held:
            yield counted(held)

    rows = docs.select(F.col(text).cast("binary").alias("_bytes")).where("_bytes IS NOT NULL")
    return rows.mapInArrow(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def vocabulary(
    docs: DataFrame,
    size: int = VOCABULARY_SIZE,
    text: str = "text",
    shingle: Callable[[Column], Column] = shingles,
) -> DataFrame:
    """``(gram, idx, n)``: the ``size`` most frequent units, numbered from 0 by frequency, then text."""
    counts = _counts(docs, text, shingle)
    top = counts.orderBy(F.desc("n"), "gram").limit(size)
    # Only the ``size`` rows of the vocabulary reach this window.
    place = F.row_number().over(Window.orderBy(F.desc("n"), "gram")) - 1
    return top.select("gram", place.cast("long").alias("idx"), "n")


def _sized(vocab: DataFrame) -> DataFrame:
    """Ask for a broadcast of a vocabulary only if it is small enough."""
    small = vocab.limit(MAX_BROADCAST_UNITS + 1).count() <= MAX_BROADCAST_UNITS
    return F.broadcast(vocab) if small else vocab


def encode(
    docs: DataFrame,
    vocab: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: Callable[[Column], Column] = shingles,
) -> DataFrame:
    """``(doc_id, idx)``: the set of vocabulary indices of each text; unknown units are dropped."""
    grams = _distinct_units(docs, [doc_id], text, shingle).select(doc_id, F.explode("grams").alias("gram"))
    return grams.join(_sized(vocab.select("gram", "idx")), "gram").select(doc_id, "idx")


def encoded_sets(encoded: DataFrame, *, doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, indices)`` as sorted arrays, each at most as long as the vocabulary."""
    return encoded.groupBy(doc_id).agg(F.array_sort(F.collect_set("idx")).alias("indices"))


def _table(hashed: DataFrame, count: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Sorted indices of a vocabulary and their hashes, from ``idx, hashes``; None if that is too much for a task."""
    most = TABLE_BYTES // (8 * count)
    found = hashed.where("hashes IS NOT NULL").distinct().limit(most + 1).collect()
    if len(found) > most:
        return None
    found = sorted((r.idx, r.hashes) for r in found)
    values = np.frombuffer(b"".join(bytes(h) for _, h in found), ">i8").reshape(-1, count).astype("int64")
    return np.array([idx for idx, _ in found], "int64"), values


def _smallest(rows: DataFrame, keep: list[str], count: int, table: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """``keep`` and the least ``_h0``, ``_h1``, … of ``hashes`` in rows that follow each other with equal ``keep``.

    With ``table`` the rows hold indices, whose hashes stand there.
    """
    names = [f"_h{k}" for k in range(count)]

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ends = [pc.run_end_encode(batch.column(k)).run_ends.to_numpy() for k in range(len(keep))]
            starts = np.concatenate([[0], np.unique(np.concatenate(ends))[:-1]]).astype("int64")
            known = np.flatnonzero(batch.column(len(keep)).is_valid().to_numpy(zero_copy_only=False))
            found = np.full((len(starts), count), NOTHING, "int64")
            if len(known):
                run = np.searchsorted(starts, known, "right") - 1
                first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
                packed = batch.column(len(keep))
                if table is not None:
                    values = table[1][np.searchsorted(table[0], packed.drop_null().to_numpy())]
                else:
                    ends_at = np.frombuffer(packed.buffers()[1], "int32")[packed.offset : packed.offset + len(packed) + 1]
                    values = np.frombuffer(packed.buffers()[2], "uint8")[ends_at[0] : ends_at[-1]].view(">i8").reshape(-1, count).astype("int64")
                found[run[first]] = np.minimum.reduceat(values, first, axis=0)
            columns = [batch.column(k).take(pa.array(starts)) for k in range(len(keep))]
            columns += [pa.array(found[:, k], pa.int64(), mask=found[:, k] == NOTHING) for k in range(count)]
            yield pa.RecordBatch.from_arrays(columns, [*keep, *names])

    rows = rows.select(*keep, "hashes")
    fields = [T.StructField(f.name, f.dataType) for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(least, T.StructType([*fields, *[T.StructField(name, T.LongType()) for name in names]]))


def dense(
    docs: DataFrame,
    vocab: DataFrame,
    scheme: Scheme,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: list[str] = [],
) -> DataFrame:
    """``(doc_id, has_units, dense)`` plus the ``carry`` columns (numbers of the document).

    A text without known units gets the sentinel in every place.
    """
    count = len(scheme.functions)
    # Hashed here once per vocabulary unit, not once per unit of every text.
    hashes = [hash_of(F.col("idx")).cast("long") for hash_of in scheme.functions]
    # One value a unit, 8 bytes a function, as rows of many columns are slow to join and to hand over.
    packed = F.unhex(F.concat(*[F.lpad(F.hex(value), 16, "0") for value in hashes]))
    width = WIDTHS.get(scheme.shingle)
    gram = F.col("gram") if width is None else _code(F.col("gram"), width)
    table = _table(vocab.select(F.col("idx").cast("long").alias("idx"), packed.alias("hashes")), count)
    # A small vocabulary's hashes go to the tasks once, and rows bring the place of their unit's hashes there.
    hashes = packed if table is None else F.when(packed.isNotNull(), F.col("idx").cast("long"))
    hashed = _sized(vocab.select(gram.alias("gram"), hashes.alias("hashes")))
    once = _distinct_units(docs, [doc_id, *carry], text, scheme.shingle) if width is None else _distinct_codes(docs, [doc_id, *carry], text, width)
    grams = once.select(doc_id, *carry, F.explode_outer("grams").alias("gram"))
    smallest = _smallest(grams.join(hashed, "gram", "left"), [doc_id, *carry], count, table).groupBy(doc_id).agg(
        *[F.max(name).alias(name) for name in carry],
        *[F.min(f"_h{k}").alias(f"_h{k}") for k in range(count)],
    )
    values = [F.coalesce(f"_h{k}", F.lit(SENTINEL).cast("long")) for k in range(count)]
    return smallest.select(doc_id, *carry, F.col("_h0").isNotNull().alias("has_units"), F.array(*values).alias("dense"))


def signatures(
    docs: DataFrame,
    vocab: DataFrame,
    scheme: Scheme,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: list[str] = [],
) -> DataFrame:
    """Adds ``bands`` (one number per band) and ``sig`` (the bands as text) to :func:`dense`."""
    vectors = dense(docs, vocab, scheme, doc_id=doc_id, text=text, carry=carry)
    width = len(scheme.functions) // scheme.num_bands
    values = [F.col("dense")[k] for k in range(len(scheme.functions))]
    bands = [scheme.band_hasher(values[start : start + width]) for start in range(0, len(values), width)]
    signed = vectors.withColumn("bands", F.array(*bands))
    return signed.withColumn("sig", F.array_join(F.col("bands").cast("array<string>"), "-"))
