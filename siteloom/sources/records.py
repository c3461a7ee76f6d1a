"""Records of delimited files whose quoted fields hold line ends, read in splits.

A line says little by itself: whether its end ends a record depends on the quotes before it. So each split of a
file is run through twice over its lines. The first pass finds, for both cases (the split starts within quotes or not),
whether it ends within quotes. These small rows, one a split, are put together file by file, which gives each
split's true start. The second pass cuts records at their true ends; what is open at the borders of splits
is a piece, and pieces of one record are joined. Nothing but borders and pieces is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siteloom.session import materialise

#: Splits of which a table is sent to all tasks; each is a row of some hundred bytes for 128 MB of text.
MOST_SPLITS = 200_000
WHOLE, TAIL, HEAD = range(3)
BLANKS = "".join(map(chr, range(33)))
BOM = "﻿"


def quote_end(escape: str) -> re.Pattern:
    """Matches up to the quote that ends a quoted field."""
    inner = r'(?:[^"]|"")*+' if escape == '"' else rf'(?:[^"{re.escape(escape)}]|{re.escape(escape)}.)*+'
    return re.compile(inner + '"', re.DOTALL)


def ends_inside(line: str, inside: bool, sep: str, end: re.Pattern) -> bool:
    """Whether a line that starts within quotes (``inside``) or at the start of a record ends within quotes."""
    if '"' not in line:
        return inside
    at = 0
    while True:
        if inside:
            found = end.match(line, at)
            if found is None:
                return True
            at, inside = found.end(), False
        elif line.startswith('"', at):
            at, inside = at + 1, True
            continue
        at = line.find(sep, at) + 1  # quotes within a field that does not start with one mean nothing
        if not at:
            return False


def trimmed(record: str, sep: str, end: re.Pattern) -> str:
    """A record without the blanks that end its fields, but for those within quotes."""
    out, at = [], 0
    while True:
        stop = at
        if record.startswith('"', at):
            found = end.match(record, at + 1)
            stop = found.end() if found else len(record)
        following = record.find(sep, stop)
        cut = len(record) if following < 0 else following
        out.append(record[at:stop] + record[stop:cut].rstrip(BLANKS))
        if following < 0:
            return sep.join(out)
        at = following + len(sep)


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[str]]]:
    """The lines of each batch by split; a split's lines come one after the other."""
    for batch in batches:
        lines, files, starts = (batch.column(k).to_pylist() for k in range(3))
        begin = 0
        for k in range(1, len(lines) + 1):
            if k == len(lines) or (files[k], starts[k]) != (files[begin], starts[begin]):
                yield (files[begin], starts[begin]), lines[begin:k]
                begin = k


def read_records(spark: SparkSession, path: str, *, sep: str = ";", escape: str = "\\", header: bool = False) -> DataFrame:
    """``record``: the text of each record, without its line end and without blanks that end a field outside quotes.

    Empty lines between records are left out. With ``header`` the first record of each file is left out. A quote that is never closed takes the rest of its file.
    """
    read = spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at")
    )
    end = quote_end(escape)

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, states = None, [False, True]

        def row() -> pa.RecordBatch:
            columns = [pa.array([split[0]]), pa.array([split[1]], "int64"), pa.array([states[0]]), pa.array([states[1]])]
            return pa.RecordBatch.from_arrays(columns, ["file", "at", "plain", "quoted"])

        for key, lines in _splits(batches):
            if key != split:
                if split is not None:
                    yield row()
                split, states = key, [False, True]
            for line in lines:
                if '"' in line:
                    states = [ends_inside(line, state, sep, end) for state in states]
        if split is not None:
            yield row()

    found = materialise(read.mapInArrow(both, "file string, at long, plain boolean, quoted boolean"))
    # A split either sets the state, or keeps it, or turns it: the last one that sets it counts, with the turns since.
    sets = F.col("plain") == F.col("quoted")
    turns = F.when(~sets & F.col("plain"), 1).otherwise(0)
    order = Window.partitionBy("file").orderBy("at")
    counted = found.withColumn("turned", F.sum(turns).over(order))
    last = F.last(F.when(sets, F.struct("plain", "turned")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    before = F.coalesce(F.lag("turned").over(order), F.lit(0))
    counted = counted.withColumns({"last": last, "before": before})
    state = (F.coalesce(F.col("last.plain").cast("int"), F.lit(0)) + F.col("before") - F.coalesce("last.turned", F.lit(0))) % 2 == 1
    starts = materialise(counted.select("file", "at", state.alias("inside")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, inside, held, kind, first = None, False, [], WHOLE, False
        rows: list[tuple] = []

        def close(open_: bool) -> None:
            nonlocal held, kind, first
            if held:
                text, piece = "\n".join(held), HEAD if open_ and kind == WHOLE else kind
                rows.append((*split, piece, trimmed(text, sep, end) if piece == WHOLE else text, first))
                first = False
            held, kind = [], WHOLE

        def flush() -> pa.RecordBatch:
            names = ["file", "at", "kind", "text", "first"]
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.bool_()]
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)
            rows.clear()
            return made

        def split_states() -> Iterator[tuple[tuple, list[str], bool]]:
            for batch in batches:
                states = batch.column(3).to_pylist()
                at = 0
                for key, lines in _splits(iter([batch])):
                    yield key, lines, states[at]
                    at += len(lines)

        for key, lines, state in split_states():
            if key != split:
                close(True)
                split, inside, first = key, state, key[1] == 0
                kind = TAIL if inside else WHOLE
            for line in lines:
                if not held and not inside and line.strip("\r") == "":
                    continue
                if first and not held:
                    line = line.removeprefix(BOM)
                inside = ends_inside(line, inside, sep, end)
                held.append(line)
                if not inside:
                    close(False)
            if len(rows) > 1000:
                yield flush()
        close(True)
        yield flush()

    if starts.count() <= MOST_SPLITS:
        beside = read.join(F.broadcast(starts), ["file", "at"]).select("line", "file", "at", "inside")
    else:
        numbered = read.withColumn("no", F.monotonically_increasing_id()).join(starts, ["file", "at"])
        beside = numbered.repartition("file", "at").sortWithinPartitions("file", "at", "no").select("line", "file", "at", "inside")
    pieces = materialise(beside.mapInArrow(cut, "file string, at long, kind int, text string, first boolean"))
    whole = pieces.where(F.col("kind") == WHOLE).select("text", "first")
    # At most two pieces a split: its tail of an earlier record, then the head of one that goes on.
    by_file = Window.partitionBy("file").orderBy("at", "kind")
    parts = pieces.where(F.col("kind") != WHOLE).withColumn("no", F.sum(F.when(F.col("kind") == HEAD, 1).otherwise(0)).over(by_file))
    gathered = parts.groupBy("file", "no").agg(
        F.sort_array(F.collect_list(F.struct("at", "kind", "text"))).alias("parts"), F.bool_or("first").alias("first")
    )

    @F.pandas_udf("string")
    def ended(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: trimmed(text, sep, end))

    joined = gathered.select(ended(F.array_join(F.transform("parts", lambda p: p.text), "\n")).alias("text"), "first")
    records = whole.unionByName(joined)
    if header:
        records = records.where(~F.col("first"))
    return records.select(F.col("text").alias("record"))
