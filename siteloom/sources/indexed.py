"""A corpus store whose appends do not read what is stored.

:class:`IndexedStore` has the tables of :class:`~siteloom.sources.tables.CorpusStore` and beside them two indexes: the ids of
all pages with a second hash of their URLs (16 bytes a page, bucketed by id), and, with a scheme, the signatures of the
kept pages (:class:`~siteloom.sources.signed.SignatureIndex`). Pages are appended in numbered batches: a batch is
seen when all of it is written, and one that is run again replaces what it had written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteloom.operators.dedup import DECISION, THRESHOLD, Similarity, dedup_signed, duplicate_links
from siteloom.operators.integrity import keep_first
from siteloom.operators.minhash import Scheme
from siteloom.session import materialise
from siteloom.sources.keyed import BATCH, KeyTable
from siteloom.sources.signed import PARTS, SignatureIndex
from siteloom.sources.tables import CLEARED, SCHEMAS, CorpusStore, schema, stamped_pages


class IndexedStore(CorpusStore):
    """The store below ``root``; ``buckets`` and ``parts`` count only where it is new."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        vocab: DataFrame | None = None,
        scheme: Scheme | None = None,
        *,
        buckets: int | None = None,
        parts: int = PARTS,
    ):
        super().__init__(spark, root)
        self.keys = KeyTable(spark, f"{self.root}/index/page_key", "id long, check long", "id", buckets)
        self.done = KeyTable(spark, f"{self.root}/index/done", "batch long", "batch", 1)
        self.index = None
        if scheme is not None:
            self.index = SignatureIndex(spark, f"{self.root}/index", vocab, scheme, buckets=buckets, parts=parts, stored=self._texts)

    def last_batch(self) -> int:
        """The number of the last whole batch; -1 if there is none."""
        return self.done.read().agg(F.coalesce(F.max("batch"), F.lit(-1))).first()[0]

    def truncate(self) -> None:
        """Empty link, image, page_data, page and site and the indexes; batch numbers go on."""
        for name in CLEARED:
            empty = self.spark.createDataFrame([], schema(name))
            if name == "page":
                empty = empty.withColumns({BATCH: F.lit(0).cast("long"), "part": F.lit(0)})
                empty.write.mode("overwrite").partitionBy(BATCH, "part").parquet(self.path(name))
            else:
                empty.write.mode("overwrite").parquet(self.path(name))
        self.keys.clear()
        if self.index is not None:
            self.index.table.clear()

    def _pages(self) -> DataFrame:
        columns = SCHEMAS["page"].replace(" not null", "")
        return self.spark.read.schema(f"{columns}, {BATCH} long, part int").parquet(self.path("page"))

    def _texts(self, parts: list[int]) -> DataFrame:
        held = self._pages().where(F.col("part").isin(parts) & F.col("html_content").isNotNull())
        return held.select(F.col("id").alias("page_id"), F.col("html_content").alias("text"), BATCH, "part")

    def read(self, table: str) -> DataFrame:
        if table != "page":
            return super().read(table)
        return self._pages().where(F.col(BATCH) <= self.last_batch()).select(*schema("page").names)

    def batch(self, batch_id: int) -> DataFrame:
        """The pages that a batch stored."""
        return self._pages().where(F.col(BATCH) == batch_id).select(*schema("page").names)

    def add_pages(
        self,
        pages: DataFrame,
        batch_id: int | None = None,
        *,
        similarity: Similarity | None = None,
        threshold: float = THRESHOLD,
    ) -> DataFrame:
        """Append pages whose URL is not stored, the first of each URL; gives ``(page_id, orig_id, score)`` of duplicates.

        With a scheme each page with content gets its signature as ``lsh_hash``; with ``similarity`` as well, pages are
        compared with the kept ones: duplicates become DUPLICATE, lose their content, and are linked from
        their original. Pages without a URL are not stored. Two URLs of one id are an error. Of all stored pages
        only ids and hashes are read, and the texts of contested signatures.
        """
        batch = self.last_batch() + 1 if batch_id is None else batch_id
        names = schema("page").names
        rows = keep_first(
            stamped_pages(pages.where(F.col("url").isNotNull())), "url", ["accessed_time", *sorted(set(names) - {"url", "accessed_time"})]
        )
        rows = materialise(rows.withColumn("check", F.xxhash64(F.lit(1), "url")))
        met = materialise(self.met(rows, batch))
        twice = rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")
        clash = met.where(F.col("check") != F.col("stored")).select("id").unionByName(twice).first()
        if clash is not None:
            raise ValueError(f"two URLs have the id {clash[0]}")
        fresh = rows.join(met.select("id"), "id", "left_anti")
        duplicates = self.spark.createDataFrame([], DECISION)
        if self.index is not None:
            fresh = materialise(fresh)
            bodies = fresh.where(F.col("html_content").isNotNull()).select(F.col("id").alias("page_id"), F.col("html_content").alias("text"))
            described = materialise(self.index.describe(bodies))
            if similarity is not None:
                duplicates = materialise(
                    dedup_signed(bodies, self.index, before=batch, signed=described, similarity=similarity, threshold=threshold)
                )
            marks = described.join(duplicates, "page_id", "left").select(
                F.col("page_id").alias("id"), "sig", "part", F.col("orig_id").isNotNull().alias("twin")
            )
            twin = F.coalesce("twin", F.lit(False))
            fresh = fresh.join(marks, "id", "left").withColumns(
                {
                    "lsh_hash": F.coalesce("sig", "lsh_hash"),
                    "page_type_code": F.when(twin, "DUPLICATE").otherwise(F.col("page_type_code")),
                    "html_content": F.when(~twin, F.col("html_content")),
                    "part": F.coalesce("part", F.lit(0)),
                }
            )
        else:
            fresh = fresh.withColumn("part", F.lit(0))
        dealt = fresh.select(*names, "part").repartition("part").sortWithinPartitions("part", "lsh_hash")
        dealt.write.mode("overwrite").partitionBy("part").parquet(f"{self.path('page')}/{BATCH}={int(batch)}")
        self.keys.write(rows.join(met.select("id"), "id", "left_anti"), batch)
        if self.index is not None:
            self.index.add(described.join(duplicates.select("page_id"), "page_id", "left_anti"), batch)
            self.add_links(duplicate_links(duplicates))
        self.done.write(self.spark.createDataFrame([(batch,)], "batch long"), batch)
        return duplicates

    def met(self, rows: DataFrame, before: int) -> DataFrame:
        """``id, check, stored``: rows ``id, check`` whose id an earlier batch stored, with the hash stored."""
        known = self.keys.read(before).select("id", F.col("check").alias("stored"))
        return known.join(rows.select("id", "check"), "id")
