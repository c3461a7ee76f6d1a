"""The corpus pipeline: quality, near duplicates, repeated strings, packing.

``STAGES`` lists the stages; each takes ``(spark, docs, sf_dir)`` and all but the last return
the columns of ``docs``, extra ones included. ``run`` writes each stage's rows as Parquet in the
shared folder and reads them back for the next.

Null texts count as empty. Rows that repeat an id count as one document where documents are told apart by
id; of equal texts that with the least id stays. Very long texts are scored, compared and packed whole (the third stage's memory
for them is told in its module). Extra columns stay until the last stage, whatever their names. Empty tables pass through
all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteloom.llm import common, hamming, packing, prefixfree, quality
from siteloom.llm.queries import table, vocabulary
from siteloom.session import materialise


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the quality classifier accepts; it learns from the labels of its documents."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    if not model.fitted:  # no labels to tell good from bad: nothing is rejected
        return docs
    name = common.fresh(docs, "score")
    return quality.score(docs, model, name=name).where(F.col(name) >= quality.CUT).select(*docs.columns)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near duplicates."""
    return hamming.kept(docs)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 50 bytes that a smaller document has.

    A character of which a part was removed goes as a whole; ``n_chars`` (where there is one) is counted anew.
    """
    return prefixfree.cleaned(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts' token ids in sequences of 2048: a row for each piece."""
    cut = packing.pieces(docs, vocabulary("word_bpe_49k.json"))
    rows = cut.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return packing.pack(rows)


STAGES = [("quality", good), ("near duplicates", distinct), ("repeated strings", unrepeated), ("packing", packed)]

#: SQL has no form of the first stage; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
