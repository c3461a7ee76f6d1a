"""Exact top-k by inner product: an impact-ordered index, read score at a time.

Candidates are dealt into blocks of about ``block`` rows. A block's index holds, for every
dimension, its rows in order of their value there (the impact), cut into ``levels`` posting
segments of equal size; a segment's quantised impacts are its highest and lowest value. A
query takes segments in descending order of query weight x impact over all dimensions, in
rounds, and adds what they give to the scores of their rows. After a round the best rows so
far are scored exactly: the k-th of them is a bound that members must reach. A row can still
get, from each dimension in which it was not read, at most what the next segment gives. The rounds stop when this upper bound is under the bound for all but a few rows, or
all is read; those possible members are then scored exactly. No row is left out without
that proof.

The query set is written once to the shared folder and each block's task reads it in parts,
so neither side is broadcast or shuffled against the other. Each block gives its best k of
each query; the best k of those follow.

Components x become floor(scale * x). Vectors that are null or hold null, NaN or infinite
components take no part. Vectors of unequal length count as padded with zeros. Scores are
exact 64-bit integers. Where a query's scores in a block may pass 2**53, its rows are all scored in integers; a score
beyond 64 bits counts as the nearest that is not, and so does a component.
Rows that repeat an id are rows of their own; a query leaves out all rows of its own id. Equal scores are
ranked by id. An empty table gives no rows; other columns are left out, whatever their names, and texts play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siteloom.llm import common
from siteloom.session import materialise

BLOCK, LEVELS, QUERIES = 2048, 16, 256
ROUNDS = (0.0, 0.4, 0.55, 0.7, 1.0)  # shares of the segments read by the end of each round


def integers(df: DataFrame, scale: float = 256.0) -> DataFrame:
    """``vec_id, vector``: the rows that take part, their components as integers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = df.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.forall("embedding", finite))
    return rows.select("vec_id", F.transform("embedding", lambda x: F.floor(x * scale)).alias("vector"))


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of ``width`` integers, shorter vectors padded with zeros."""
    offsets, flat = vectors.offsets.to_numpy(), vectors.values.to_numpy(zero_copy_only=False).astype("int64")
    out = np.zeros((len(vectors), width), "int64")
    sizes = np.diff(offsets)
    rows = np.repeat(np.arange(len(vectors)), sizes)
    out[rows, np.arange(offsets[0], offsets[-1]) - np.repeat(offsets[:-1], sizes)] = flat[offsets[0] : offsets[-1]]
    return out


def products(rows: np.ndarray, query: np.ndarray, bound: float) -> np.ndarray:
    """Exact inner products of integers; ``bound`` is at least the size of any."""
    if bound < 2**53:
        return (rows.astype("float64") @ query.astype("float64")).astype("int64")
    if bound < 2**62:
        return rows @ query
    exact = rows.astype(object) @ query.astype(object)
    return np.array([min(max(score, -(2**63)), 2**63 - 1) for score in exact], "int64")


class Index:
    """The impact-ordered postings of a block of rows."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, levels: int = LEVELS):
        self.ids, self.whole, self.rows = ids, rows, rows.astype("float64")  # these are exact to 2**53
        self.most = float(np.abs(self.rows).max()) if rows.size else 0.0
        n = len(rows)
        self.order = np.argsort(rows, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(self.rows.T, self.order, axis=1)  # by dimension, ascending
        self.cuts = np.unique(np.linspace(0, n, min(levels, n) + 1).astype("int64"))
        self.low, self.high = self.values[:, self.cuts[:-1]], self.values[:, self.cuts[1:] - 1]

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best ``k`` rows, ties to the smaller id."""
        (n, _), segments = self.rows.shape, len(self.cuts) - 1
        whole, query = query, query.astype("float64")
        bound = self.most * float(np.abs(query).sum())
        if bound >= 2**53:  # partial scores are no longer exact, so every row is scored in integers
            possible = np.flatnonzero(self.ids != own)
            exact = products(self.whole[possible], whole, bound)
            chosen = np.lexsort((self.ids[possible], -exact.astype(object)))[:k] if len(possible) else possible
            return self.ids[possible][chosen], exact[chosen]
        dims = np.flatnonzero(query)
        weights, up = query[dims], query[dims] > 0
        others = self.ids != own
        possible = np.flatnonzero(others)
        if len(possible) > k:
            # By dimension, the segments' quantised gains from the best on.
            gains = np.where(up[:, None], (weights[:, None] * self.high[dims])[:, ::-1], weights[:, None] * self.low[dims])
            order = np.argsort(-gains.ravel(), kind="stable")
            score, read, bound = np.zeros(n), np.zeros(len(dims), "int64"), -np.inf
            unread = np.full(n, len(dims))
            for start, end in zip(ROUNDS[:-1], ROUNDS[1:], strict=True):
                taken = order[int(start * len(order)) : int(end * len(order))]
                now = read + np.bincount(taken // segments, minlength=len(dims))
                ahead, behind = self.cuts[segments - now], self.cuts[segments - read]
                first, last = np.where(up, ahead, self.cuts[read]), np.where(up, behind, self.cuts[now])
                parts = [slice(a, b) for a, b in zip(first.tolist(), last.tolist(), strict=True)]
                rows = np.concatenate([self.order[d, x] for d, x in zip(dims, parts, strict=True)])
                got = np.concatenate([self.values[d, x] for d, x in zip(dims, parts, strict=True)])
                sizes = last - first
                score += np.bincount(rows, got * np.repeat(weights, sizes), minlength=n)
                read = now
                unread -= np.bincount(rows, minlength=n)
                tried = possible[np.argpartition(-score[possible], k - 1)[: 2 * k]]
                bound = max(bound, np.partition(self.rows[tried] @ query, -k)[-k])
                # No segment that is left gives more than the next one.
                following = gains.ravel()[order[int(end * len(order))]] if end < 1 else 0.0
                upper = score + following * unread
                left = np.flatnonzero(others & (upper >= bound))
                if len(left) <= max(4 * k, n // 10):
                    possible = left
                    break
        exact = self.rows[possible] @ query
        chosen = np.lexsort((self.ids[possible], -exact))[:k]
        return self.ids[possible][chosen], exact[chosen].astype("int64")


def search(df: DataFrame, k: int = 5, every: int = 50, scale: float = 256.0, block: int = BLOCK) -> DataFrame:
    """The best ``k`` rows of each query (ids divisible by ``every``): ``query_id, rank, vec_id, score``."""
    spark = df.sparkSession
    vectors = materialise(integers(df, scale))
    count, width = vectors.agg(F.count("*"), F.max(F.size("vector"))).first()
    blocks, width = max(1, -(-count // block)), width or 0
    queries = common.scratch(df, "queries")
    asked = vectors.where(F.col("vec_id") % every == 0).select("vec_id", "vector")
    asked.write.option("parquet.block.size", 1 << 20).parquet(queries)

    def batches_of_queries() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        files, root = common.filesystem(queries)
        from pyarrow import fs

        for info in sorted(files.get_file_info(fs.FileSelector(root)), key=lambda x: x.path):
            if info.path.endswith(".parquet"):
                with files.open_input_file(info.path) as file:
                    for batch in pq.ParquetFile(file).iter_batches(QUERIES, columns=["vec_id", "vector"]):
                        yield batch.column(0).to_numpy(), matrix(batch.column(1), width)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        ids, rows = [], []
        for batch in batches:
            ids.append(batch.column(0).to_numpy())
            rows.append(matrix(batch.column(1), width))
        if not ids or not sum(map(len, ids)):
            return
        index = Index(np.concatenate(ids), np.concatenate(rows))
        for names, asked_rows in batches_of_queries():
            found = [index.top(q, own, k) for own, q in zip(names, asked_rows, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(names, [len(f[0]) for f in found])),
                    pa.array(np.concatenate([f[0] for f in found])),
                    pa.array(np.concatenate([f[1] for f in found])),
                ],
                ["query_id", "vec_id", "score"],
            )

    dealt = vectors.select(F.col("vec_id").cast("long"), "vector").repartitionById(
        blocks, F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    )
    best = dealt.mapInArrow(work, "query_id long, vec_id long, score long")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
