"""Fetched pages that arrive as files go to all tables of a store, batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from siteloom.plans.ingest import FETCHED, ingest
from siteloom.session import materialise
from siteloom.sources.indexed import IndexedStore


def start(store: IndexedStore, source: str, checkpoint: str, *, max_files: int = 1000, **options) -> StreamingQuery:
    """Ingest all files of ``source`` that were not yet, in batches, then stop; ``options`` go to :func:`ingest`.

    The stream's batch numbers are the store's, so the stream is the store's one writer. A batch that failed is
    run again under its number and replaces what it had written.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        ingest(store, materialise(batch), batch_id=batch_id, **options)

    stream = store.spark.readStream.schema(FETCHED).option("maxFilesPerTrigger", max_files).parquet(source)
    return (
        stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
