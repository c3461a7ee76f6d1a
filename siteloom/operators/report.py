"""Corpus statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteloom.functions import urls


def totals(tables: dict[str, DataFrame]) -> DataFrame:
    """``(metric, value)``: the number of rows of each table."""
    counts = [
        df.agg(F.count("*").alias("value")).select(F.lit(name).alias("metric"), "value")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def per_page(items: DataFrame, page_id: str = "page_id") -> DataFrame:
    """``(n_pages, mean_items, max_items)`` over the pages that have at least one item."""
    counted = items.groupBy(page_id).agg(F.count("*").alias("_n"))
    return counted.agg(
        F.count("*").alias("n_pages"), F.avg("_n").alias("mean_items"), F.max("_n").alias("max_items")
    )


def type_share(items: DataFrame, by: str) -> DataFrame:
    """``(type, n, share)``: how often each type occurs."""
    counts = items.groupBy(F.col(by).alias("type")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("_total"))
    # The right side is one row.
    return counts.join(total, F.lit(True)).select("type", "n", (F.col("n") / F.col("_total")).alias("share"))


def bytes_by_type(items: DataFrame, by: str, size: str) -> DataFrame:
    """``(type, n, bytes)``: files and bytes per type."""
    return items.groupBy(F.col(by).alias("type")).agg(F.count("*").alias("n"), F.sum(size).alias("bytes"))


def bytes_of_files(page_data: DataFrame, files: DataFrame, by: str = "data_type_code") -> DataFrame:
    """``(type, n, bytes, n_missing)``: stored file rows with the sizes of their files, ``files(path, size)``, found by path."""
    sized = page_data.select(F.col(by).alias("type"), "path").join(files.select("path", "size"), "path", "left")
    return sized.groupBy("type").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count_if(F.col("size").isNull()).alias("n_missing")
    )


def pages_per_site(pages: DataFrame, url: str = "url") -> DataFrame:
    """``(host, n_pages)``, largest first."""
    counts = pages.groupBy(urls.host_key(url).alias("host")).agg(F.count("*").alias("n_pages"))
    return counts.orderBy(F.desc("n_pages"), "host")


def crawl_speed(pages: DataFrame, time: str = "accessed_time") -> DataFrame:
    """``(n_pages, seconds, pages_per_second)`` between the first and the last access."""
    passed = (F.max(time) - F.min(time)).cast("interval second").cast("decimal(20,6)").cast("double")
    timed = pages.agg(F.count("*").alias("n_pages"), passed.alias("seconds"))
    speed = F.when(F.col("seconds") > 0, F.col("n_pages") / F.col("seconds"))
    return timed.withColumn("pages_per_second", speed)
