"""Graphs in Pajek text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siteloom.operators.ordering import rank_in_group
from siteloom.operators.skew import hot_keys, repeated, salted
from siteloom.session import materialise

VERTEX = r'^\s*(\d+)\s+(?:"([^"]*)"|(\S+))'
ARC = r"^\s*(\d+)\s+(\d+)(?:\s+(\S+))?"


def _sectioned(spark: SparkSession, path: str) -> DataFrame:
    """``line, section``: each line with the last section line above it.

    Lines are numbered within a split of the file; the last section of each split, one
    small row, is carried on to the next ones.
    """
    read = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("no"),
    )
    lines = materialise(read.where(F.trim("line") != ""))
    head = F.when(F.startswith("line", F.lit("*")), F.lower(F.regexp_extract("line", r"^(\S+)", 1)))
    split = Window.partitionBy("file", "at")
    own = F.last(head, ignorenulls=True).over(split.orderBy("no"))
    ends = lines.groupBy("file", "at").agg(F.max_by(head, F.when(head.isNotNull(), F.col("no"))).alias("end"))
    earlier = Window.orderBy("file", "at").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("file", "at", F.last("end", ignorenulls=True).over(earlier).alias("carried"))
    placed = lines.select("line", "file", "at", head.isNotNull().alias("is_head"), own.alias("own")).join(carried, ["file", "at"])
    return placed.where(~F.col("is_head")).select("line", F.coalesce("own", "carried").alias("section"))


def read_pajek(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``vertices(v_no, label)`` and ``edges(src, dst, weight)`` by vertex number.

    A weight that is not given is 1. Lines whose numbers are missing or too long are left out.
    """
    lines = _sectioned(spark, path)
    number = lambda pattern, part: F.regexp_extract("line", pattern, part).try_cast("long")
    vertices = lines.where(F.col("section") == "*vertices").select(
        number(VERTEX, 1).alias("v_no"),
        F.concat(F.regexp_extract("line", VERTEX, 2), F.regexp_extract("line", VERTEX, 3)).alias("label"),
    )
    weight = F.regexp_extract("line", ARC, 3).try_cast("double")
    edges = lines.where(F.col("section").isin("*arcs", "*edges")).select(
        number(ARC, 1).alias("src"), number(ARC, 2).alias("dst"), F.coalesce(weight, F.lit(1.0)).alias("weight")
    )
    return vertices.dropna(subset=["v_no"]), edges.dropna(subset=["src", "dst"])


def write_pajek(edges: DataFrame, path: str) -> None:
    """Write ``edges(src, dst)`` of labels, optionally with ``weight``, as Pajek text.

    Vertices are numbered in label order. The part files, put together in name
    order, are the file.
    """
    weight = F.col("weight") if "weight" in edges.columns else F.lit(1.0)
    labelled = materialise(edges.select(F.col("src").cast("string"), F.col("dst").cast("string"), weight.alias("weight")))
    labels = labelled.select(F.col("src").alias("label")).unionByName(labelled.select(F.col("dst").alias("label")))
    numbered = rank_in_group(labels.distinct(), [], ["label"], "v_no").select("label", "v_no")
    quoted = F.when(F.col("label").rlike(r"\s"), F.concat(F.lit('"'), "label", F.lit('"'))).otherwise(F.col("label"))
    vertex_lines = numbered.select(
        F.lit(1).alias("section"),
        F.col("v_no").alias("first"),
        F.lit(0).cast("long").alias("second"),
        F.concat_ws(" ", "v_no", quoted, F.lit("0.0 0.0 ellipse")).alias("line"),
    )
    numbered = materialise(numbered)

    def with_number(rows: DataFrame, end: str, other: str, name: str) -> DataFrame:
        """Adds the number of one end; a label that very many arcs share is spread by their other end."""
        hot = hot_keys(rows, end)
        keys = repeated(numbered.select(F.col("label").alias(end), F.col("v_no").alias(name)), hot, end)
        return salted(rows, hot, end, [F.col(other)]).join(keys, [end, "_salt"]).drop("_salt")

    arcs = with_number(with_number(labelled, "src", "dst", "first"), "dst", "src", "second")
    arc_lines = arcs.select(
        F.lit(3).alias("section"),
        "first",
        "second",
        F.concat_ws(" ", "first", "second", "weight").alias("line"),
    )
    no_number = F.lit(0).cast("long")
    vertex_head = numbered.agg(F.count("*").alias("_n")).select(
        F.lit(0).alias("section"),
        no_number.alias("first"),
        no_number.alias("second"),
        F.concat(F.lit("*vertices "), F.col("_n")).alias("line"),
    )
    arc_head = edges.sparkSession.range(1).select(
        F.lit(2).alias("section"), no_number.alias("first"), no_number.alias("second"), F.lit("*arcs").alias("line")
    )
    everything = vertex_head.unionByName(vertex_lines).unionByName(arc_head).unionByName(arc_lines)
    everything.orderBy("section", "first", "second").select("line").write.text(path)
