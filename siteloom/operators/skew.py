"""Joins on keys of which one may hold a large share of all rows.

The rows of a hot key are spread over several salts, chosen by a hash of the
row itself (a re-run of a lost task gives the same salt), and the matching rows
of the other side are repeated once per salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteloom.session import materialise

MIN_ROWS = 200_000


def hot_keys(df: DataFrame, key: str, min_rows: int = MIN_ROWS) -> DataFrame | None:
    """Keys with more than ``min_rows`` rows, with the number of salts each needs.

    The bound is a number of rows a task can take and does not grow with the table. None if the
    table is too small for a hot key.
    """
    if df.count() <= min_rows:
        return None
    return materialise(
        df.groupBy(F.col(key).alias("_hot"))
        .agg(F.count("*").alias("_rows"))
        .where(F.col("_rows") > min_rows)
        .select("_hot", F.ceil(F.col("_rows") / min_rows).cast("int").alias("_salts"))
    )


def salted(df: DataFrame, hot: DataFrame | None, key: str, by: list[Column]) -> DataFrame:
    """Add ``_salt``: 0 for ordinary keys, a hash of ``by`` for hot ones."""
    if hot is None:
        return df.withColumn("_salt", F.lit(0))
    salt = F.pmod(F.xxhash64(*by), F.coalesce("_salts", F.lit(1))).cast("int")
    return _with_salts(df, hot, key).withColumn("_salt", salt).drop("_hot", "_salts")


def repeated(df: DataFrame, hot: DataFrame | None, key: str) -> DataFrame:
    """Repeat each row once per salt of its key."""
    if hot is None:
        return df.withColumn("_salt", F.lit(0))
    salts = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    return _with_salts(df, hot, key).withColumn("_salt", F.explode(salts)).drop("_hot", "_salts")


def _with_salts(df: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    # The table is written out, so Spark knows its size and broadcasts it if it is small.
    return df.join(hot, F.col(key) == F.col("_hot"), "left")
