"""Order-dependent columns for groups of any size.

A window sorts a whole group in one task. Here the rows are range-partitioned
by group and order instead, so a large group spans many slices; each slice is
worked on alone and one small row per group and slice carries the state over
the slice borders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siteloom.session import materialise


def _slices(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    ranged = df.repartitionByRange(*group, *order)
    # Written out, as both users of the slices must see the same borders.
    return materialise(ranged.withColumn("_slice", F.spark_partition_id()))


def rank_in_group(df: DataFrame, group: list[str], order: list[str], name: str = "rank") -> DataFrame:
    """Number the rows of each group 1, 2, … in ``order`` (no column of ``group`` may be NULL)."""
    rows = _slices(df, group, order)
    keys = [*group, "_slice"]
    earlier = (
        Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        rows.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .select(*keys, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (
        rows.withColumn("_place", place)
        .join(offsets, keys)
        .withColumn(name, F.col("_place") + F.col("_before"))
        .drop("_slice", "_place", "_before")
    )


def previous_in_group(df: DataFrame, group: list[str], order: str, name: str = "previous") -> DataFrame:
    """The value of ``order`` in the row before, by group; NULL for the first row."""
    rows = _slices(df, group, [order])
    keys = [*group, "_slice"]
    ends = (
        rows.groupBy(*keys)
        .agg(F.max(order).alias("_end"))
        .select(*keys, F.lag("_end").over(Window.partitionBy(*group).orderBy("_slice")).alias("_carried"))
    )
    before = F.lag(order).over(Window.partitionBy(*keys).orderBy(order))
    return (
        rows.withColumn("_before", before)
        .join(ends, keys)
        .withColumn(name, F.coalesce("_before", "_carried"))
        .drop("_slice", "_before", "_carried")
    )
