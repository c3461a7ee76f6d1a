"""Quality scores by compression.

Two zstandard dictionaries are trained, one on windows of texts labelled good and one on
windows of texts labelled bad. A whole text is cut into windows of 512 bytes and each is
compressed with either dictionary; d is the difference of the two summed sizes over their
sum. A logistic model fitted on other labelled texts makes d, its product with a weight
for the text's length (short texts say little) and the compressed share of the text
(a word repeated over and over shrinks to nothing under both) a probability of label 1.

Fitting uses a bounded sample: ``labels`` rows of least hash, ``documents`` of each class
for the dictionaries and ``calibration`` of any class for the model; the two do not
overlap. Labels that are null or that contradict each other are left out. Without usable
labels of both classes every text scores the share of label 1 (0.5 without any label).

Null texts count as empty; an empty text has a score as any other, and so has a very long one: it is
scored whole, window by window. Equal texts have equal scores, rows that repeat an id are scored one by one. An
empty table gives no rows. Labels, language, source and id are no inputs of a score; a column of the name that
the score takes is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteloom.llm import common

DOCUMENTS, CALIBRATION = 1500, 4000
WINDOWS, WINDOW_CHARS, WINDOW = 1500, 2048, 512
DICTIONARY_BYTES, LEVEL = 110 * 1024, 3
CUT = 0.7


@dataclass
class Model:
    good: bytes
    bad: bytes
    weights: list[float]  # of a constant and the four features; of the constant alone if nothing could be fitted

    @property
    def fitted(self) -> bool:
        return len(self.weights) > 1


def compressors(model: Model) -> list:
    """One for each dictionary; a task makes them once."""
    import zstandard

    made = []
    for data in (model.good, model.bad):
        dictionary = zstandard.ZstdCompressionDict(data)
        dictionary.precompute_compress(level=LEVEL)
        made.append(
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False
            )
        )
    return made


def features(made: list, texts: list[str]) -> np.ndarray:
    """A row of four features a text, by the two ``compressors``."""
    good, bad = (c.compress for c in made)
    rows = np.zeros((len(texts), 3))
    for k, text in enumerate(texts):
        data = text.encode()
        parts = [data[at : at + WINDOW] for at in range(0, len(data), WINDOW)]
        rows[k] = sum(len(good(p)) for p in parts), sum(len(bad(p)) for p in parts), len(data)
    a, b, size = rows.T
    difference = 10 * (b - a) / np.maximum(a + b, 1)
    share = np.log((a + b) / 2 / np.maximum(size, 1) + 0.02) * (size > 0)
    known = size / (size + 300)
    return np.stack([difference, share, difference * known, np.minimum(share + 1.6, 0) * known], axis=1)


def scores(model: Model, texts: list[str], made: list | None = None) -> np.ndarray:
    logit = np.full(len(texts), model.weights[0])
    if model.fitted:
        logit = logit + features(made or compressors(model), texts) @ np.array(model.weights[1:])
    return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> list[float]:
    x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
    w = np.zeros(x.shape[1])
    for _ in range(40):  # Newton's steps
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        slope = x.T @ (p - y) / len(y) + ridge * w
        bend = (x * (p * (1 - p))[:, None]).T @ x / len(y) + ridge * np.eye(len(w))
        w = w - np.linalg.solve(bend, slope)
    return w.tolist()


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the ids whose CRC-32 (of the id as text) leaves 2 when divided by 4."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, documents: int = DOCUMENTS, calibration: int = CALIBRATION) -> Model:
    """Fit on the labelled rows that are not held out."""
    import zstandard

    told = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("_most"))
        .where("quality = _most")
        .select(F.col("doc_id").alias("_id"), "quality", F.xxhash64("doc_id").alias("_hash"))
    )
    fit = F.pmod("_hash", F.lit(2)) == 0
    least = lambda rows, n: rows.orderBy("_hash", "_id").limit(n)
    # At most 2 * documents + calibration small rows, so they may be broadcast.
    chosen = least(told.where(fit & (F.col("quality") == 1)), documents).unionByName(
        least(told.where(fit & (F.col("quality") == 0)), documents)
    )
    texts = docs.select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("text"))
    windows = texts.join(F.broadcast(chosen), "_id").select(
        "quality",
        F.explode(F.transform(F.sequence(F.lit(0), F.floor(F.length("text") / WINDOW_CHARS)), lambda k: F.substr("text", k * WINDOW_CHARS + 1, F.lit(WINDOW_CHARS)))).alias("part"),
    ).where("part != ''")
    dictionaries = []
    for quality in (1, 0):
        found = windows.where(F.col("quality") == quality).select("part").orderBy(F.xxhash64("part"), "part").limit(WINDOWS)
        samples = [r[0].encode() for r in found.collect()]  # WINDOWS x WINDOW_CHARS characters at most
        try:
            dictionaries.append(zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes())
        except (zstandard.ZstdError, ValueError):
            # Too few windows to train on: they are the dictionary themselves.
            dictionaries.append(b"".join(samples)[-DICTIONARY_BYTES:])
    model = Model(*dictionaries, [0.0])
    tests = texts.join(F.broadcast(least(told.where(~fit), calibration)), "_id").select("text", "quality", "_hash")

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = compressors(model)
        for batch in batches:
            for start, texts in common.text_portions(batch.column(0)):
                rows, part = features(made, texts), batch.slice(start, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows.tolist(), pa.list_(pa.float64())), part.column(1).cast("int32"), part.column(2)], ["x", "y", "h"]
                )

    found = tests.mapInArrow(measured, "x array<double>, y int, h long").orderBy("h").limit(calibration).collect()
    y = np.array([r["y"] for r in found], "float64")
    if not len(y) or y.min() == y.max() or not all(dictionaries):
        share = (y.sum() + 0.5) / (len(y) + 1)
        return Model(*dictionaries, [float(np.log(share / (1 - share)))])
    return Model(*dictionaries, _logistic(np.array([r["x"] for r in found]), y))


def score(df: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """Add the score of a text column (it replaces a column of that name); no shuffle."""
    fields = [f for f in df.schema.fields if f.name != name]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = compressors(model)
        for batch in batches:
            at = batch.schema.names.index(text)
            for start, texts in common.text_portions(batch.column(at)):
                part = batch.slice(start, len(texts))
                found = scores(model, [t or "" for t in texts], made)
                columns = [part.column(part.schema.names.index(f.name)) for f in fields]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found)], [f.name for f in fields] + [name])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return df.mapInArrow(work, f"{kept}, {name} double")
