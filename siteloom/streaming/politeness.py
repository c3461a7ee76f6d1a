"""A fetch plan for URLs that arrive in batches, polite across batches and restarts.

What outlives a batch lies in two key tables below the plan's folder: the last planned access of each host, and the hashes of
all planned URLs. A batch reads those written before it where they lie, plans its new URLs, and writes the plan, then
the URLs and the hosts under its number. Run again after a failure it overwrites just these.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siteloom.functions import urls
from siteloom.operators import robots as R
from siteloom.operators.frontier import schedule_after
from siteloom.session import materialise
from siteloom.sources.keyed import BATCH, KeyTable

ARRIVALS = "url string, seen_at long"
PLANNED = "host string, url string, crawl_delay int, fetch_at long"


class FetchPlan:
    """The plan below ``folder``; ``buckets`` counts only where it is new."""

    def __init__(self, spark: SparkSession, folder: str, robots: DataFrame | None = None, *, buckets: int | None = None):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.hosts = KeyTable(spark, f"{self.folder}/hosts", "host string, last_access long", "host", buckets)
        self.known = KeyTable(spark, f"{self.folder}/known", "id long, check long", "id", buckets)
        self.delays = None if robots is None else materialise(R.policies(robots).select("host", "crawl_delay"))

    def last_access(self, before: int) -> DataFrame:
        """``(host, last_access)`` after the batches before a number; accesses only grow, so the greatest is the last."""
        return self.hosts.read(before).groupBy("host").agg(F.max("last_access").alias("last_access"))

    def add(self, arrivals: DataFrame, batch_id: int) -> DataFrame:
        """Plan the URLs ``url, seen_at`` (seconds) of a batch that no earlier one had; gives ``PLANNED``."""
        named = arrivals.where(F.col("url").isNotNull()).groupBy("url").agg(F.min("seen_at").alias("seen_at"))
        named = named.withColumns({"id": F.xxhash64("url"), "check": F.xxhash64(F.lit(1), "url")})
        new = materialise(named.join(self.known.read(batch_id).select("id", "check"), ["id", "check"], "left_anti"))
        planned = materialise(schedule_after(new.select("url", "seen_at"), self.last_access(batch_id), self.delays))
        planned.write.mode("overwrite").parquet(f"{self.folder}/plan/{BATCH}={int(batch_id)}")
        self.known.write(new, batch_id)
        self.hosts.write(planned.groupBy("host").agg(F.max("fetch_at").alias("last_access")), batch_id)
        return planned

    def planned(self) -> DataFrame:
        """``PLANNED`` and ``batch_id`` of all batches."""
        return self.spark.read.schema(f"{PLANNED}, {BATCH} long").parquet(f"{self.folder}/plan")

    def start(self, source: str, checkpoint: str, *, max_files: int = 1000) -> StreamingQuery:
        """Plan all files of ``source`` that were not yet, in batches, then stop."""

        def process(batch: DataFrame, batch_id: int) -> None:
            self.add(materialise(batch), batch_id)

        stream = self.spark.readStream.schema(ARRIVALS).option("maxFilesPerTrigger", max_files).parquet(source)
        return (
            stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
