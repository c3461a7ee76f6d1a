"""Document fingerprints by consistent weighted sampling.

The terms of a text are its words (split at white space) and a term's weight is its count.
For each of ``samples`` draws every term has fixed random numbers that depend on the term
alone: r and c from Gamma(2, 1) and b uniform. Its weight is snapped to a step
t = floor(ln w / r + b), and the term with the least c * exp(-r (t - b) - r) is drawn. Two
texts draw the same (term, t) with a probability equal to their generalised Jaccard
similarity, sum of minima over sum of maxima of the weights. Each draw is kept in 16 bits,
which adds at most 2**-16 to the rate.

Null texts count as empty. A text without words has the fingerprint ``""``; it is like
(1.0) another such text and unlike (0.0) all others. Equal texts have equal fingerprints; rows that repeat
an id are documents of their own. A very long text counts whole, its different words held once. Other columns are left
out, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from siteloom.llm import common

SAMPLES = 128


def _draws(terms: np.ndarray, counts: np.ndarray, samples: int) -> tuple[np.ndarray, np.ndarray]:
    """By (term, count) and draw: ln of the cost, and 16 bits that name (term, t)."""
    seeds = common.mix(np.arange(1, samples + 1, dtype="uint64") * np.uint64(0x9E3779B97F4A7C15))
    costs = np.empty((len(terms), samples), "float32")
    names = np.empty((len(terms), samples), ">u2")
    half = np.float32(0.5)
    weights = np.log(counts.astype("float32"))[:, None]
    for k in range(0, len(terms), 256):  # blocks that stay in the processor's cache
        at = slice(k, k + 256)
        bits = common.mix(terms[at, None] ^ seeds[None, :])
        more = common.mix(bits + np.uint64(0x9E3779B97F4A7C15))
        one, two = bits.view("uint16").reshape(*bits.shape, 4), more.view("uint32").reshape(*more.shape, 2)
        # Gamma(2, 1) is -ln(u v) for uniform u, v
        r = (one[..., 0] + half) * (one[..., 1] + half)
        r *= np.float32(2.0**-32)
        r = -np.log(r, out=r)
        c = (two[..., 0] + half) * np.float32(2.0**-32) * ((one[..., 2] + half) * np.float32(2.0**-16))
        np.minimum(c, np.float32(1 - 2.0**-24), out=c)
        c = np.log(-np.log(c, out=c), out=c)
        b = (one[..., 3] + half) * np.float32(2.0**-16)
        t = np.floor(weights[at] / r + b)
        costs[at] = c - r * (t - b) - r
        names[at] = two[..., 1] + t.astype("int32").view("uint32") * np.uint32(0x9E3779B1) & np.uint32(0xFFFF)
    return costs, names


def signatures(texts: list[str], samples: int = SAMPLES) -> list[np.ndarray | None]:
    """The 16-bit draws of each text; None for a text without words."""
    out: list[np.ndarray | None] = []
    every = np.arange(samples)
    for start, end in common.portions(texts, 3_000_000):
        codes: dict[str, int] = {}
        pairs = []
        for text in texts[start:end]:
            row = np.array([codes.setdefault(w, len(codes)) for w in text.split()], "int64")
            used, counts = np.unique(row, return_counts=True)
            pairs.append(used << 32 | counts)
        distinct, places = np.unique(np.concatenate(pairs), return_inverse=True)
        hashes = common.word_hashes(list(codes))
        costs, names = _draws(hashes[distinct >> 32], distinct & 0xFFFFFFFF, samples)
        cuts = np.cumsum([0, *map(len, pairs)])
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            rows = places[a:b]
            out.append(names[rows[costs[rows].argmin(axis=0)], every] if b > a else None)
    return out


def text_of(signature: np.ndarray | None) -> str:
    return "" if signature is None else signature.tobytes().hex()


def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
    """The share of equal draws."""
    if a is None or b is None:
        return float(a is b)
    return float(np.mean(a == b))


def fingerprint(df: DataFrame, text: str = "text", name: str = "fingerprint", samples: int = SAMPLES) -> DataFrame:
    """Add the fingerprint of a text column (4 hex digits a draw); no shuffle."""

    @F.pandas_udf(StringType())
    def made(texts: pd.Series) -> pd.Series:
        return pd.Series([text_of(s) for s in signatures(texts.fillna("").tolist(), samples)], dtype=object)

    return df.withColumn(name, made(F.col(text)))


def likeness_of(a: str, b: str):
    """A column: the likeness of two fingerprint columns (null if either is null)."""

    @F.pandas_udf("double")
    def near(left: pd.Series, right: pd.Series) -> pd.Series:
        def one(x, y):
            if x is None or y is None:
                return None
            if not x or not y:
                return float(x == y)
            return float(np.mean(np.frombuffer(bytes.fromhex(x), ">u2") == np.frombuffer(bytes.fromhex(y), ">u2")))

        return pd.Series([one(x, y) for x, y in zip(left, right, strict=True)], dtype="float64")

    return near(F.col(a), F.col(b))


def with_next(df: DataFrame, rows: int = common.SLICE_ROWS) -> DataFrame:
    """Slices of ``doc_id, text`` in id order, each ended by the first row of the next slice.

    Ties of an id are ordered by text. The last slice is ended by the first row of all.
    ``own`` is false for such an added row.
    """
    docs = df.select("doc_id", common.ids("doc_id").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    splits = common.borders(docs, "key", rows)
    placed = docs.withColumn("slice", common.slice_of(F.col("key"), splits))
    firsts = sorted((r["slice"], r["key"]) for r in placed.groupBy("slice").agg(F.min("key").alias("key")).collect())
    before = {key: firsts[k - 1][0] for k, (_, key) in enumerate(firsts)}  # one entry a slice
    table = df.sparkSession.createDataFrame(list(before.items()), "key long, slice int")
    edges = placed.drop("slice").join(F.broadcast(table), "key")
    both = placed.withColumn("own", F.lit(True)).unionByName(edges.withColumn("own", F.lit(False)))
    return both.repartitionById(len(splits) + 1, F.col("slice")).sortWithinPartitions(F.desc("own"), "key", "text")


def edited(df: DataFrame, rows: int = common.SLICE_ROWS, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness.

    The edited text replaces the last floor(n / 2) code points by the first as many of the
    next text in id order (all, if it has fewer; the first text follows the last).
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # the last row so far: it waits for its next text
        for batch in batches:
            texts = batch["text"].tolist()
            for start, end in common.portions(texts):
                rows = list(zip(batch["doc_id"][start:end], texts[start:end], batch["own"][start:end], strict=True))
                rows = [*([held] if held else []), *rows]
                held = rows[-1]
                if len(rows) > 1:
                    yield results(rows)

    def results(rows: list) -> pd.DataFrame:
        own = [k for k in range(len(rows) - 1) if rows[k][2]]
        new = []
        for k in own:
            text, half = rows[k][1], len(rows[k][1]) // 2
            new.append(text[: len(text) - half] + rows[k + 1][1][:half])
        both = signatures([r[1] for r in rows] + new, samples)
        marks, changed = both[: len(rows)], both[len(rows) :]
        return pd.DataFrame(
            {
                "doc_id": pd.array([rows[k][0] for k in own], dtype="Int64"),
                "n_chars": np.array([len(rows[k][1]) for k in own], "int64"),
                "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in new],
                "fingerprint": [text_of(marks[k]) for k in own],
                "edited_fingerprint": [text_of(m) for m in changed],
                "near_edited": np.array([likeness(marks[k], m) for k, m in zip(own, changed, strict=True)], "float64"),
                "near_next": np.array([likeness(marks[k], marks[k + 1]) for k in own], "float64"),
            }
        )

    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return with_next(df, rows).select("doc_id", "text", "own").mapInPandas(work, schema)
