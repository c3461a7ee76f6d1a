"""Pages that arrive as files: each batch is tested against the stored pages and appended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siteloom.operators.dedup import dedup_signed, duplicate_links, mark
from siteloom.operators.minhash import Scheme
from siteloom.session import materialise
from siteloom.sources.keyed import KeyTable
from siteloom.sources.signed import SignatureIndex

ARRIVALS = "page_id long, url string, html string"
STORED = f"{ARRIVALS}, page_type_code string, batch_id long"
LINKS = "from_page long, to_page long, batch_id long"


def _stored(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    # The empty frame stands in while no batch has been written.
    empty = spark.createDataFrame([], ddl)
    try:
        return spark.read.schema(ddl).parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return empty


def stored_pages(spark: SparkSession, store: str) -> DataFrame:
    return _stored(spark, f"{store}/page", STORED)


def stored_links(spark: SparkSession, store: str) -> DataFrame:
    return _stored(spark, f"{store}/link", LINKS)


def start(
    spark: SparkSession,
    source: str,
    store: str,
    checkpoint: str,
    vocab: DataFrame,
    scheme: Scheme,
    *,
    max_files: int = 1000,
    **options,
) -> StreamingQuery:
    """Process all files of ``source`` that were not processed yet, in batches, then stop.

    A batch writes its own folder (``batch_id=…``) in overwrite mode and reads
    only those of earlier batches, so a batch that is run again
    after a failure gives the same rows once. Kept pages go to an index of signatures, with which
    later batches are compared: stored pages are not signed again, and texts are read of contested signatures only.
    A URL that is stored already, and all but the first page of a URL in the batch, are left out.
    """
    index = SignatureIndex(spark, f"{store}/index", vocab, scheme)
    known = KeyTable(spark, f"{store}/known", "id long, check long", "id")

    def process(batch: DataFrame, batch_id: int) -> None:
        hashed = batch.withColumns({"id": F.xxhash64("url"), "check": F.xxhash64(F.lit(1), "url")})
        named, bare = hashed.where(F.col("url").isNotNull()), hashed.where(F.col("url").isNull())
        first = named.groupBy("url").agg(F.min_by(F.struct("page_id", "html", "id", "check"), "page_id").alias("p")).select("url", "p.*")
        unseen = first.join(known.read(batch_id).select("id", "check"), ["id", "check"], "left_anti")
        new = materialise(unseen.unionByName(bare))
        pages = new.select("page_id", "url", "html")
        bodies = pages.select("page_id", F.coalesce("html", F.lit("")).alias("text"))
        described = materialise(index.describe(bodies))
        duplicates = materialise(dedup_signed(bodies, index, before=batch_id, signed=described, **options))
        kept = described.join(duplicates.select("page_id"), "page_id", "left_anti")
        folder = f"batch_id={batch_id}"
        mark(pages, duplicates).write.mode("overwrite").parquet(f"{store}/page/{folder}")
        duplicate_links(duplicates).write.mode("overwrite").parquet(f"{store}/link/{folder}")
        index.add_texts(kept, bodies, batch_id)
        index.add(kept, batch_id)
        known.write(new.where(F.col("url").isNotNull()), batch_id)

    stream = spark.readStream.schema(ARRIVALS).option("maxFilesPerTrigger", max_files).parquet(source)
    return (
        stream.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
