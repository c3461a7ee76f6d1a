"""Statistics of a directed link graph: ``vertices(v_no, label)``, ``edges(src, dst)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def site_edges(pages: DataFrame, site_id: str = "site_id", page_id: str = "page_id") -> DataFrame:
    """One edge from each site to each of its pages.

    The pages of a site stay rows: one site may hold too many for one list.
    """
    return pages.where(F.col(site_id).isNotNull()).select(F.col(site_id).alias("src"), F.col(page_id).alias("dst"))


def degrees(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """``(v_no, label, degree)``: arcs in and out, parallel arcs counted, 0 for lonely vertices."""
    # Counted per end first, so a hub is one row per task before the shuffle.
    ends = edges.select(F.explode(F.array("src", "dst")).alias("v_no"))
    counted = ends.groupBy("v_no").agg(F.count("*").alias("degree"))
    return vertices.join(counted, "v_no", "left").select(
        "v_no", "label", F.coalesce("degree", F.lit(0)).cast("long").alias("degree")
    )


def summary(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """``(n_vertices, n_arcs, mean_degree)``."""
    counted = vertices.agg(F.count("*").alias("n_vertices"))
    arcs = edges.agg(F.count("*").alias("n_arcs"))
    # Both sides are one row.
    both = counted.join(arcs, F.lit(True))
    mean = F.when(F.col("n_vertices") > 0, 2.0 * F.col("n_arcs") / F.col("n_vertices"))
    return both.select("n_vertices", "n_arcs", mean.alias("mean_degree"))


def top_hubs(vertices: DataFrame, edges: DataFrame, k: int = 1) -> DataFrame:
    """The ``k`` vertices of highest degree; equal degrees in label order."""
    return degrees(vertices, edges).orderBy(F.desc("degree"), "label", "v_no").limit(k)


def hub_sites(hubs: DataFrame, site: DataFrame, site_id: str = "site_id", name: str = "site_name") -> DataFrame:
    """Add the site name of hubs whose label is a site id, also one written as ``262.0``."""
    label = F.try_to_number("label", F.lit("999999999999999999D9999")).cast("long")
    names = site.select(F.col(site_id).cast("long").alias("_id"), F.col(name).alias("name"))
    return hubs.withColumn("_id", label).join(names, "_id", "left").drop("_id")


def hub_share(edges: DataFrame) -> DataFrame:
    """``(max_out_degree, n_arcs, share)``: the share of all arcs that leave the largest hub."""
    out = edges.groupBy("src").agg(F.count("*").alias("_out"))
    totals = out.agg(F.max("_out").alias("max_out_degree"), F.sum("_out").alias("n_arcs"))
    return totals.withColumn("share", F.col("max_out_degree") / F.col("n_arcs"))


def without_out_arcs(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Vertices that no arc leaves."""
    return vertices.join(edges.select(F.col("src").alias("v_no")), "v_no", "left_anti")
