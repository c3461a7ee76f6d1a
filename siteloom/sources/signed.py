"""A persistent index of stored pages by signature.

For each stored page the index holds its key (the signature; for a text without vocabulary units what
its exact copies share), length and fingerprints in a :class:`~siteloom.sources.keyed.KeyTable` bucketed by key, and
its text in a folder partitioned by batch and by ``part``, a hash of the key. A batch of new pages asks which stored
pages share its keys: the index stays where it lies, only the batch's distinct keys are shuffled. Texts are
then read from the parts that hold a contested key, and from no other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siteloom.operators.dedup import DESCRIBED, copy_key, described
from siteloom.operators.minhash import Scheme
from siteloom.sources.keyed import BATCH, KeyTable

SIGNED = "page_id long, key string, sig string, has_units boolean, n_chars long, print1 long, print2 long"
TEXTS = "page_id long, key string, text string"
PARTS = 256


def index_key() -> Column:
    """What pages that may be duplicates of each other share."""
    return F.when(F.col("has_units"), F.col("sig")).otherwise(F.concat(F.lit("#"), copy_key()))


class SignatureIndex:
    """The index below ``path``; ``buckets`` and ``parts`` count only where the folder is new.

    ``texts`` of the pages are stored here, unless a store keeps them by part itself: then ``stored`` is a function that
    takes a list of parts and gives rows ``page_id, key, text, part, batch_id`` of these parts.
    """

    def __init__(self, spark: SparkSession, path: str, vocab: DataFrame, scheme: Scheme, *, buckets: int | None = None, parts: int = PARTS, stored=None):
        self.spark, self.path, self.vocab, self.scheme = spark, path.rstrip("/"), vocab, scheme
        self.table = KeyTable(spark, f"{self.path}/signature", SIGNED, "key", buckets)
        layout = KeyTable(spark, f"{self.path}/parts", "parts int", "parts", 1)
        if layout.read().isEmpty():
            layout.write(spark.createDataFrame([(parts,)], "parts int"), 0)
        self.parts = layout.read().first()[0]
        self.stored = stored or self._own

    def part(self, key: str = "key") -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.parts)).cast("int")

    def describe(self, pages: DataFrame, *, page_id: str = "page_id", text: str = "text") -> DataFrame:
        """What the index holds of pages, and their ``part``."""
        rows = described(pages, self.vocab, self.scheme, page_id=page_id, text=text)
        return rows.withColumn("key", index_key()).withColumn("part", self.part())

    def add(self, described_pages: DataFrame, batch_id: int) -> None:
        """Store the rows of ``describe`` for pages that are kept."""
        self.table.write(described_pages, batch_id)

    def add_texts(self, described_pages: DataFrame, pages: DataFrame, batch_id: int) -> None:
        """Store the texts ``page_id, text`` of described pages by part."""
        rows = described_pages.select("page_id", "key", "part").join(pages.select("page_id", "text"), "page_id")
        dealt = rows.select("page_id", "key", "text", "part").repartition("part").sortWithinPartitions("part", "key")
        dealt.write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/text/{BATCH}={int(batch_id)}")

    def append(self, pages: DataFrame, batch_id: int) -> None:
        """Describe ``page_id, text`` and store both; a batch that is run again replaces its own rows."""
        found = self.describe(pages)
        self.add_texts(found, pages, batch_id)
        self.add(found, batch_id)

    def hits(self, signed: DataFrame, before: int | None = None) -> DataFrame:
        """The stored pages that share a key with a described one, described as those are."""
        keys = signed.select(index_key().alias("key")).distinct()
        held = self.table.read(before).join(keys, "key", "left_semi")
        return held.withColumn("bands", F.array().cast("array<bigint>")).select(*DESCRIBED)

    def _own(self, parts: list[int]) -> DataFrame:
        try:
            table = self.spark.read.schema(f"{TEXTS}, {BATCH} long, part int").parquet(f"{self.path}/text")
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], f"{TEXTS}, {BATCH} long, part int")
        return table.where(F.col("part").isin(parts))

    def texts(self, wanted: DataFrame, before: int | None = None) -> DataFrame:
        """``page_id, text`` of stored pages ``page_id, key``, read from the parts of their keys."""
        # At most ``parts`` numbers reach the driver.
        parts = [row[0] for row in wanted.select(self.part().alias("part")).distinct().collect()]
        table = self.stored(parts)
        if before is not None:
            table = table.where(F.col(BATCH) < before)
        return table.join(wanted.select("page_id"), "page_id", "left_semi").select("page_id", "text")
