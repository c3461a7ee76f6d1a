"""Lookups, unique keys and audits of the corpus tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteloom.functions import urls
from siteloom.sources.tables import CODES

# Foreign keys (table, column, referenced table, referenced column) and limits.
FOREIGN_KEYS = (
    ("image", "page_id", "page", "id"),
    ("link", "from_page", "page", "id"),
    ("link", "to_page", "page", "id"),
    ("page", "site_id", "site", "id"),
    ("page", "page_type_code", "page_type", "code"),
    ("page_data", "page_id", "page", "id"),
    ("page_data", "data_type_code", "data_type", "code"),
)
NOT_NULL = (
    ("site", "id"),
    ("page", "id"),
    ("page_data", "id"),
    ("image", "id"),
    ("link", "from_page"),
    ("link", "to_page"),
    ("data_type", "code"),
    ("page_type", "code"),
)
MAX_LENGTHS = (
    ("data_type", "code", 20),
    ("page_type", "code", 20),
    ("site", "domain", 500),
    ("page", "page_type_code", 20),
    ("page", "lsh_hash", 200),
    ("page", "url", 3000),
    ("page_data", "data_type_code", 20),
    ("image", "filename", 255),
    ("image", "content_type", 50),
)


def site_ids(pages: DataFrame, site: DataFrame, *, url: str = "url") -> DataFrame:
    """Add ``host`` and ``site_id``; NULL where the host is no stored domain."""
    keys = site.select(F.col("domain").alias("host"), F.col("id").alias("site_id"))
    return pages.withColumn("host", urls.authority(url)).join(keys, "host", "left")


def page_ids(lookups: DataFrame, page: DataFrame, *, url: str = "url") -> DataFrame:
    """Add ``id`` of the stored page with the URL; NULL where there is none."""
    keys = page.select(F.col("url").alias(url), "id")
    return lookups.join(keys, url, "left")


def keep_first(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key in ``order``, with all its columns.

    Only key and order are aggregated; of a key with many rows each task keeps
    one before the shuffle. ``order`` must tell the rows of a key apart: rows
    that are equal in it are reduced to one of them. Rows without a key are all
    kept, as a UNIQUE column may hold any number of NULLs.
    """
    unkeyed, rows = rows.where(F.col(key).isNull()), rows.where(F.col(key).isNotNull())
    first = rows.groupBy(key).agg(F.min(F.struct(*order)).alias("_first"))
    kept = first.select(F.col(key).alias("_key"), *[F.col(f"_first.{name}").alias(f"_{name}") for name in order])
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in order]
    matched = rows.join(kept, reduce(lambda a, b: a & b, same, F.col(key).eqNullSafe(F.col("_key"))), "left_semi")
    return matched.dropDuplicates([key, *order]).unionByName(unkeyed)


def key_violations(tables: dict[str, DataFrame], keys: list[tuple[str, list[str]]]) -> DataFrame:
    """``(constraint, value, n_rows)`` for values of PRIMARY KEY or UNIQUE columns that several rows hold; NULL passes."""

    def repeated(table: str, columns: list[str]) -> DataFrame:
        held = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
        many = tables[table].where(held).groupBy(*columns).agg(F.count("*").alias("n_rows")).where("n_rows > 1")
        value = F.concat_ws(",", *[F.col(c).cast("string") for c in columns])
        return many.select(F.lit(f"{table}({', '.join(columns)})").alias("constraint"), value.alias("value"), "n_rows")

    return reduce(DataFrame.unionByName, [repeated(*key) for key in keys if key[0] in tables])


def foreign_key_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """``(constraint, value, n_rows)`` for values that refer to no row; NULL passes."""

    def violations(table: str, column: str, target: str, target_column: str) -> DataFrame:
        values = tables[table].groupBy(F.col(column).alias("_v")).agg(F.count("*").alias("n_rows"))
        known = tables[target].select(F.col(target_column).alias("_v"))
        lost = values.where(F.col("_v").isNotNull()).join(known, "_v", "left_anti")
        name = F.lit(f"{table}.{column} -> {target}.{target_column}")
        return lost.select(name.alias("constraint"), F.col("_v").cast("string").alias("value"), "n_rows")

    checks = [violations(*key) for key in FOREIGN_KEYS if key[0] in tables and key[2] in tables]
    return reduce(DataFrame.unionByName, checks)


def code_violations(rows: DataFrame, column: str, codes: str) -> DataFrame:
    """``(value, n_rows)`` for values of ``column`` outside the code table; NULL passes."""
    values = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n_rows"))
    return values.where(~F.col("value").isin(*CODES[codes]))


def column_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """``(check, n_rows)``: NULL keys and texts longer than their column, one scan per table."""

    def counts(name: str) -> DataFrame:
        checks = {f"{name}.{column} is null": F.col(column).isNull() for table, column in NOT_NULL if table == name}
        for table, column, limit in MAX_LENGTHS:
            if table == name:
                checks[f"length({name}.{column}) > {limit}"] = F.length(column) > limit
        summed = tables[name].agg(*[F.count_if(test).alias(check) for check, test in checks.items()])
        pairs = [F.struct(F.lit(check).alias("check"), F.col(f"`{check}`").alias("n_rows")) for check in checks]
        return summed.select(F.inline(F.array(*pairs)))

    return reduce(DataFrame.unionByName, [counts(name) for name in tables])
