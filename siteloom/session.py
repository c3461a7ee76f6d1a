"""Sessions and lineage cuts.

Iterative jobs cut their lineage with files in the folder that the cluster
names in ``spark.checkpoint.dir``, so a lost executor costs one re-read and not
a recomputation of every earlier round.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benches on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("siteloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts.

    A local session without the setting gets a temporary folder. A cluster
    session without it is an error, as a machine-local folder is lost with its
    machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="siteloom-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back.

    Unlike a checkpoint the result has file statistics (so Spark can
    size its joins) and columns that a later step does not use are not read.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/siteloom/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, keys: list[str], least: int = 1) -> tuple[DataFrame, str]:
    """Write ``df`` as a table bucketed by ``keys``; gives the table and its name.

    Joins on all of ``keys`` then shuffle the other side only. Drop the table
    when the loop that needs it is over. There are as many buckets as shuffle partitions,
    or ``least``, which callers take from the bytes they know of.
    """
    spark = df.sparkSession
    buckets = max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))
    name = f"siteloom_{uuid.uuid4().hex}"
    (
        df.repartition(buckets, *keys)
        .write.bucketBy(buckets, *keys)
        .option("path", f"{checkpoint_dir(spark)}/siteloom/{name}")
        .saveAsTable(name)
    )
    return spark.table(name), name
