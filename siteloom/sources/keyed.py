"""Append-only tables that lie in the order in which they are joined.

A :class:`KeyTable` is a folder of parquet files bucketed by a key and partitioned by the number of the batch that
wrote them. A join on the key reads it as it lies: only the other side is shuffled. A batch that is run
again after a failure overwrites its own partition, and readers name the batches that they want, so half a batch is
never seen. Any session that reaches the folder can attach it; the number of buckets is stored beside it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "batch_id"


def buckets_for(spark: SparkSession, rows: int, row_bytes: int = 100, bucket_bytes: int = 128 << 20) -> int:
    """Buckets of about ``bucket_bytes``, and no fewer than the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows * row_bytes // bucket_bytes))


class KeyTable:
    """``columns`` (a DDL string) by ``key``; ``buckets`` counts only where the folder is new."""

    def __init__(self, spark: SparkSession, path: str, columns: str, key: str, buckets: int | None = None):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.schema = T.StructType.fromDDL(columns)
        self.name = f"siteloom_{hashlib.md5(self.path.encode()).hexdigest()}"
        try:
            self.buckets = spark.read.schema("buckets int").parquet(f"{self.path}_layout").first()[0]
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            spark.createDataFrame([(self.buckets,)], "buckets int").coalesce(1).write.parquet(f"{self.path}_layout")
        self._attach()

    def _attach(self) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")  # an external table: its files stay
        self.spark.sql(
            f"CREATE TABLE {self.name} ({columns}, {BATCH} BIGINT) USING parquet PARTITIONED BY ({BATCH}) "
            f"CLUSTERED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )
        try:
            self.spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")
        except Exception as error:
            if "FileNotFoundException" not in str(error):
                raise  # else nothing has been written yet

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Store the rows of a batch, in place of what it stored before."""
        self.write_dealt(rows.repartition(self.buckets, self.key), batch_id)

    def write_dealt(self, rows: DataFrame, batch_id: int, append: bool = False) -> None:
        """:meth:`write` for rows that are partitioned by the key already.

        Rows that are worked out of this table itself can only be appended.
        """
        view, session = f"{self.name}_rows", rows.sparkSession  # a stream's batches have a session of their own
        rows.select(*self.schema.names).createOrReplaceTempView(view)
        try:
            how = "INTO" if append else "OVERWRITE"
            session.sql(f"INSERT {how} TABLE {self.name} PARTITION ({BATCH} = {int(batch_id)}) SELECT * FROM {view}")
        finally:
            session.catalog.dropTempView(view)

    def read(self, before: int | None = None) -> DataFrame:
        """The rows of all batches, or of those before a number."""
        table = self.spark.table(self.name)
        return table if before is None else table.where(F.col(BATCH) < before)

    def at(self, batch_id: int) -> DataFrame:
        """The rows of one batch."""
        return self.spark.table(self.name).where(F.col(BATCH) == batch_id)

    def clear(self) -> None:
        """Empty all batches."""
        empty = self.spark.createDataFrame([], self.schema)
        for row in self.read().select(BATCH).distinct().collect():  # a number for each batch
            self.write_dealt(empty, row[0])

    def detach(self) -> None:
        """Forget the table in this session; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
