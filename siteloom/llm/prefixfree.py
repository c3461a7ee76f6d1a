"""Removal of repeated byte strings by prefix-free parsing.

Each byte that is covered by a string of ``length`` (50) bytes which also starts in a document
with a smaller id is removed. Matches do not cross documents and are judged on the input.

*Parse.* A rolling hash over 16 bytes triggers the start of a phrase, so equal text is cut
alike wherever it stands. A phrase with the 49 bytes after it is a unit: it holds whole every
string that starts in the phrase. Units go by 128-bit BLAKE2b digests to the parts that own them (so
two units of one key are one string), and a part finds the least id of each. A unit that occurs in a smaller document is removed
as a whole: repeated text is settled phrase by phrase, whatever the number of its copies.
What is left are the first occurrences, the dictionary; the least document of any string
still holds it there, since a removed unit has a copy in a smaller document.

*Dictionary suffixes.* Suffixes of the dictionary are compared by their first 50 bytes, as
more does not matter. Strings alike have the same anchor (the least hash of the 24-byte
strings in them); an anchor that one document alone holds needs no comparison. Strings that
start next to each other and share their anchor travel as one run, to the part that owns the
anchor. The part sorts the suffixes of its runs, as the bytes they are: a suffix array of
its share of the dictionary, in which equal prefixes stand together and show the least document.
Runs of an anchor that very many documents hold are sent string by string instead, to parts
by the string's own hash, so a frequent line's edges spread over all parts.

Documents are cut by id into blocks of about ``block_bytes`` (so the number of a block tells
which ids are smaller), kept compressed in a table bucketed by block; each step groups
that table without a shuffle. Blocks send keys to parts and get back a flag for each, in the
same order, so no group of equal strings is ever gathered. A block sends a row to each
part that owns one of its keys, so at most a row a key; ``block_bytes`` may grow with the memory of the executors. Each answer
depends on the rows alone; lost tasks are run again.

Null texts count as empty. Rows that repeat an id are documents of equal id: neither is
smaller. An id with more rows than a block takes has blocks of its own, dealt by text, which count as one place. A null id
is the least. A very long text is a block of its own; it is hashed in windows of ``WINDOW`` bytes. ``cleaned`` gives all columns
of its input, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteloom.llm import common
from siteloom.session import bucketed, materialise

LENGTH = 50
TRIGGER, EVERY, ANCHOR = 16, 128, 24
BLOCK_BYTES, CHUNK_BYTES, PART_BYTES, BUCKET_BYTES = 1 << 20, 1 << 16, 1 << 24, 1 << 28
WINDOW, ROW_BYTES = 1 << 20, 64
RUN, MANY, MANY_BLOCKS = 256, 64, 256

_BASE = 0x9E3779B97F4A7C15 | 1
_TABLE = common.mix(np.arange(1, 257, dtype="uint64") * np.uint64(0xD1B54A32D192ED03))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) <= n:
        steps = np.full(n + 1, _BASE, "uint64")
        back = np.full(n + 1, pow(_BASE, -1, 1 << 64), "uint64")
        steps[0] = back[0] = 1
        _POWERS["up"], _POWERS["down"] = np.multiply.accumulate(steps), np.multiply.accumulate(back)
    return _POWERS["up"], _POWERS["down"]


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[: len(x) - span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


class Parsed:
    """A block of documents: phrases, and which strings of it are still open."""

    def __init__(self, ids: list[int], texts: list[str], length: int = LENGTH):
        order = self.order = sorted(range(len(ids)), key=lambda k: (ids[k], texts[k]))
        self.ids = np.array([ids[k] for k in order], "int64")
        self.length = length
        blobs = [texts[k].encode() for k in order]
        self.data = np.frombuffer(b"".join(blobs), "uint8")
        self.sizes = np.array([len(b) for b in blobs], "int64")
        self.ends = np.cumsum(self.sizes)
        self.begins = self.ends - self.sizes
        n = len(self.data)
        # Phrases start with documents and at triggers.
        found = [np.zeros(0, "int64")]
        for a in range(0, n - TRIGGER + 1, WINDOW):
            hashes = self.hashes(TRIGGER, a, min(a + WINDOW, n - TRIGGER + 1))
            found.append(a + np.flatnonzero(hashes % np.uint64(EVERY) == 0))
        at = np.concatenate(found)
        whole = at + TRIGGER <= self.ends[np.searchsorted(self.ends, at, side="right")] if len(at) else at
        starts = np.unique(np.concatenate([self.begins[self.sizes > 0], at[whole] if len(at) else at]))
        doc = np.searchsorted(self.ends, starts, side="right")
        stop = self.ends[doc]
        following = np.append(starts[1:], n)
        open_ = starts + length <= stop
        self.starts, self.doc = starts[open_], doc[open_]
        # The strings that start in the phrase: their first places and the end of the last.
        self.after = np.minimum(following, stop - length + 1)[open_]
        self.stops = np.minimum(following + length - 1, stop)[open_]

    def hashes(self, width: int, start: int, stop: int) -> np.ndarray:
        """Rolling hashes of the strings of ``width`` bytes at the places from ``start`` up to ``stop``."""
        data = self.data[start : stop + width - 1]
        n = len(data)
        if n < width:
            return np.zeros(0, "uint64")
        up, down = _powers(n)
        sums = np.concatenate([np.zeros(1, "uint64"), np.cumsum(_TABLE[data] * up[:n])])
        return common.mix((sums[width:] - sums[: n + 1 - width]) * down[: n + 1 - width])

    def units(self) -> tuple[np.ndarray, np.ndarray]:
        """The 16-byte key and the document's id of each unit."""
        data = memoryview(self.data)
        spans = zip(self.starts.tolist(), self.stops.tolist(), strict=True)
        keys = b"".join(hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in spans)
        return np.frombuffer(keys, "S16"), self.ids[self.doc]

    def settle(self, removed: np.ndarray) -> None:
        """Take out units; the strings of the others stay open, as runs that share an anchor."""
        self.removed = removed
        starts, after = self.starts[~removed], self.after[~removed]
        windows = [self._runs(starts, after, a) for a in range(0, len(self.data), WINDOW)]
        none = np.zeros(0, "int64"), np.zeros(0, "int64"), np.zeros(0, "uint64")
        self.runs, self.run_sizes, self.anchors = (np.concatenate(parts) for parts in zip(none, *windows, strict=True))
        self.run_doc = np.searchsorted(self.ends, self.runs, side="right")

    def _runs(self, starts: np.ndarray, after: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The open strings that start in a window: first places, sizes and anchors of their runs."""
        high = low + WINDOW
        phrases = slice(np.searchsorted(after, low, side="right"), np.searchsorted(starts, high))
        starts, after = np.maximum(starts[phrases], low), np.minimum(after[phrases], high)
        sizes = after - starts
        at = np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        if not len(at):
            return at, at, at.astype("uint64")
        # The last string that is asked for ends at most where the data does.
        width = self.length - ANCHOR + 1
        hashes = self.hashes(ANCHOR, low, min(high + width - 1, len(self.data) - ANCHOR + 1))
        least = _sliding_least(hashes, width)[at - low]
        new = np.concatenate([[True], (np.diff(at) != 1) | (least[1:] != least[:-1])])
        first = np.flatnonzero(new)
        # A run of more than RUN strings is cut.
        many = np.diff(np.append(first, len(at)))
        pieces = -(-many // RUN)
        first = np.repeat(first, pieces) + (np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * RUN
        return at[first], np.diff(np.append(first, len(at))), least[first] & np.uint64((1 << 48) - 1)


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part that owns each key."""
    if keys.dtype.kind == "u":
        place = keys
    else:  # a hash of the bytes
        width = keys.dtype.itemsize
        wide = np.zeros((len(keys), -(-width // 8) * 8), "uint8")
        wide[:, :width] = keys.view("uint8").reshape(-1, width) if len(keys) else 0
        place = np.zeros(len(keys), "uint64")
        for column in wide.view("uint64").T:
            place = common.mix(place + column)
    return ((place >> np.uint64(8)) % np.uint64(parts)).astype("int64")


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(data: bytes, count: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, "uint8"), count=count).astype("bool")


def _request(block: int, place: int, rows: list[tuple[int, bytes, bytes, bytes]]) -> pa.Table:
    parts, keys, sizes, notes = zip(*rows, strict=True) if rows else ((), (), (), ())
    columns = [pa.array(c, "int32") for c in ([block] * len(rows), [place] * len(rows), parts)]
    columns += [pa.array(c, "binary") for c in (keys, sizes, notes)]
    return pa.table(columns, names=["block", "place", "part", "keys", "sizes", "notes"])


class Keys:
    """Sorted distinct keys of a block, dealt out over parts."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray, parts: int):
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        first = _firsts(ordered)
        self.keys = ordered[first]
        self.counts = np.diff(np.append(first, len(keys)))
        self.of = np.zeros(len(keys), "int64")
        self.of[order] = np.repeat(np.arange(len(first)), self.counts)
        least = np.minimum.reduceat(ids[order], first) if len(keys) else ids
        self.later = ids > least[self.of]
        self.several = np.zeros(len(first), "bool")
        self.several[self.of[self.later]] = True
        part = _part(self.keys, parts)
        self.order = np.argsort(part, kind="stable")
        self.cuts = np.searchsorted(part[self.order], np.arange(parts + 1))

    def _shares(self) -> Iterator[tuple[int, np.ndarray]]:
        for p, (a, b) in enumerate(zip(self.cuts[:-1], self.cuts[1:], strict=True)):
            if b > a:
                yield p, self.order[a:b]

    def requests(self, block: int, place: int) -> pa.Table:
        """Keys of integers travel as 6 bytes."""
        rows = []
        for p, at in self._shares():
            keys = self.keys[at]
            data = keys.tobytes() if keys.dtype.kind != "u" else keys.view("uint8").reshape(-1, 8)[:, :6].tobytes()
            rows.append((p, data, b"", _bits(self.several[at]) + _bits(self.counts[at] >= MANY)))
        return _request(block, place, rows)

    def flags(self, replies: dict[int, bytes], kinds: int = 1) -> list[np.ndarray]:
        """The flags of each entry."""
        flags = np.zeros((kinds, len(self.keys)), "bool")
        for p, at in self._shares():
            flags[:, at] = _flags(replies[p], kinds * len(at)).reshape(kinds, -1)
        return [f[self.of] for f in flags]

    def repeats(self, replies: dict[int, bytes]) -> np.ndarray:
        """Whether a smaller document, of this block or another, has the key of each entry."""
        return self.flags(replies)[0] | self.later


class Strings:
    """The runs of a block whose strings have to be compared, dealt out over parts."""

    def __init__(self, parsed: Parsed, shared: np.ndarray, hot: np.ndarray, parts: int):
        runs, sizes, part = [], [], []
        calm = shared & ~hot
        runs.append(parsed.runs[calm])
        sizes.append(parsed.run_sizes[calm])
        part.append(_part(parsed.anchors[calm], parts))
        hot = shared & hot
        if hot.any():  # each string alone
            single = parsed.run_sizes[hot]
            at = np.repeat(parsed.runs[hot] - (np.cumsum(single) - single), single) + np.arange(int(single.sum()))
            rows = np.lib.stride_tricks.sliding_window_view(parsed.data, parsed.length)[at]
            runs.append(at)
            sizes.append(np.ones(len(at), "int64"))
            part.append(_part(np.ascontiguousarray(rows).view(f"S{parsed.length}").ravel(), parts))
        self.parsed, part = parsed, np.concatenate(part)
        order = np.argsort(part, kind="stable")
        self.runs, self.sizes = np.concatenate(runs)[order], np.concatenate(sizes)[order]
        self.cuts = np.searchsorted(part[order], np.arange(parts + 1))
        _, rank = np.unique(parsed.ids, return_inverse=True)  # rows of one id are equal in order
        self.rank = rank[np.searchsorted(parsed.ends, self.runs, side="right")] if len(self.runs) else self.runs

    def requests(self, block: int, place: int) -> pa.Table:
        rows = []
        for p, (a, b) in enumerate(zip(self.cuts[:-1], self.cuts[1:], strict=True)):
            if b > a:
                wide = self.sizes[a:b] + self.parsed.length - 1
                at = np.repeat(self.runs[a:b] - (np.cumsum(wide) - wide), wide) + np.arange(int(wide.sum()))
                sizes = self.sizes[a:b].astype("<u2").tobytes()
                rows.append((p, self.parsed.data[at].tobytes(), sizes, self.rank[a:b].astype("<u4").tobytes()))
        return _request(block, place, rows)

    def removed(self, replies: dict[int, bytes]) -> np.ndarray:
        """The places of the strings that a smaller document has."""
        out = [np.zeros(0, "int64")]
        for p, (a, b) in enumerate(zip(self.cuts[:-1], self.cuts[1:], strict=True)):
            if b > a:
                sizes = self.sizes[a:b]
                at = np.repeat(self.runs[a:b] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
                out.append(at[_flags(replies[p], len(at))])
        return np.concatenate(out)


def _firsts(ordered: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, "int64")


REQUEST = "block int, place int, part int, keys binary, sizes binary, notes binary"
REPLY = "block int, part int, kind string, flags binary"


def _judged(kind: str, length: int, places: np.ndarray, keys: list[bytes], sizes: list[bytes], notes: list[bytes]) -> list[bytes]:
    """Flags for each request of a part."""
    if kind == "string":
        counts = [np.frombuffer(x, "<u2").astype("int64") for x in sizes]
        data, runs = np.frombuffer(b"".join(keys), "uint8"), np.concatenate(counts)
        begins = np.cumsum(runs + length - 1) - (runs + length - 1)
        at = np.repeat(begins - (np.cumsum(runs) - runs), runs) + np.arange(int(runs.sum()))
        found = np.lib.stride_tricks.sliding_window_view(data, length)[at].view(f"S{length}").ravel()
        rank = np.concatenate([np.frombuffer(x, "<u4") for x in notes]).astype("int64")
        place = np.repeat(np.repeat(places.astype("int64") << 32, [len(c) for c in counts]) | rank, runs)
        ends = np.cumsum([int(c.sum()) for c in counts])
    else:
        width = 16 if kind == "unit" else 6
        lengths = np.array([len(k) // width for k in keys])
        found = np.frombuffer(b"".join(keys), f"S{width}")
        place, ends = np.repeat(places.astype("int64"), lengths), np.cumsum(lengths)
    order = np.argsort(found, kind="stable")  # for strings, the part's suffix array
    first = _firsts(found[order])
    sizes_ = np.diff(np.append(first, len(found)))
    flags = np.zeros((2, len(found)), "bool")
    if kind == "anchor":
        several, many = np.zeros(len(found), "bool"), np.zeros(len(found), "bool")
        for end, n, note in zip(ends, lengths, notes, strict=True):
            half = -(-n // 8)
            several[end - n : end], many[end - n : end] = _flags(note[:half], n), _flags(note[half:], n)
        flags[0, order] = np.repeat((sizes_ > 1) | np.logical_or.reduceat(several[order], first), sizes_)
        flags[1, order] = np.repeat((sizes_ > MANY_BLOCKS) | np.logical_or.reduceat(many[order], first), sizes_)
        return [_bits(flags[:, a:b].ravel()) for a, b in zip([0, *ends[:-1]], ends, strict=True)]
    flags[0, order] = place[order] > np.repeat(np.minimum.reduceat(place[order], first), sizes_)
    return [_bits(flags[0, a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def _owned(requests: DataFrame, kind: str, length: int) -> DataFrame:
    """Answer requests: for anchors whether several documents hold the key and whether very many do, else whether a smaller one does."""

    def judge(table: pa.Table) -> pa.Table:
        made = _judged(kind, length, table.column("place").to_numpy(), *(table.column(c).to_pylist() for c in ("keys", "sizes", "notes")))
        return pa.table(
            [table.column("block"), table.column("part"), pa.array([kind] * len(made)), pa.array(made, "binary")],
            names=["block", "part", "kind", "flags"],
        )

    return materialise(requests.groupBy("part").applyInArrow(judge, REPLY))


def _unpacked(table: pa.Table) -> pa.Table:
    """The rows of a block."""
    return pa.concat_tables([pa.ipc.open_stream(b).read_all() for b in table.column("rows").to_pylist()]).combine_chunks()


def _blocks(docs: DataFrame, splits: list[tuple[int, int]], buckets: int) -> tuple[DataFrame, str]:
    """A table bucketed by ``block``: ``rows`` holds some compressed rows of one block.

    They are kept small (about CHUNK_BYTES of text), as readers take rows by thousands.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            block = common.places(batch.column("id").to_numpy(), batch.column("tie").to_numpy(), splits)
            batch = batch.drop_columns("tie")
            size = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
            order = np.lexsort((size // CHUNK_BYTES, block))
            new = (np.diff(block[order]) != 0) | (np.diff(size[order] // CHUNK_BYTES) != 0)
            cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(order)] if len(order) else []
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                number = block[order[start]]
                part = batch.take(pa.array(order[start:end]))
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema, options=options) as writer:
                    writer.write_batch(part)
                blob = pa.array([sink.getvalue().to_pybytes()], "binary")
                yield pa.RecordBatch.from_arrays([pa.array([number], "int32"), blob], ["block", "rows"])

    return bucketed(docs.mapInArrow(work, "block int, rows binary"), ["block"], buckets)


class _Replies:
    def __init__(self, table: pa.Table):
        self.by: dict[str, dict[int, bytes]] = {}
        for part, kind, flags in zip(*(table.column(c).to_pylist() for c in ("part", "kind", "flags")), strict=True):
            self.by.setdefault(kind, {})[part] = flags

    def of(self, kind: str) -> dict[int, bytes]:
        return self.by.get(kind, {})


def repeated(df: DataFrame, length: int = LENGTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, starts, ends, kept`` of ``doc_id, text``.

    ``starts`` and ``ends`` hold the removed runs, ``kept`` the bytes that stay.
    """
    return _removed(df.select("doc_id", "text"), length, block_bytes).select(
        F.col("c0").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "starts", "ends", "kept"
    )


def cleaned(df: DataFrame, length: int = LENGTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``df`` with the repeated strings taken out of ``text``.

    A character that loses a part goes as a whole. ``n_chars``, if there is such a column, is
    counted anew; a null text stays null.
    """
    names = {name: f"c{k}" for k, name in enumerate(df.columns)}
    rows = _removed(df, length, block_bytes)

    @F.pandas_udf("string")
    def decoded(kept: pd.Series) -> pd.Series:
        return kept.map(lambda b: bytes(b).decode("utf-8", "ignore"))

    text = F.when(F.col(names["text"]).isNotNull(), F.col("decoded"))
    made = {name: F.col(c) for name, c in names.items()} | {"text": text}
    if "n_chars" in names:
        made["n_chars"] = F.length("decoded").cast(df.schema["n_chars"].dataType)
    return rows.withColumn("decoded", decoded("kept")).select(*(made[name].alias(name) for name in df.columns))


def _removed(df: DataFrame, length: int, block_bytes: int) -> DataFrame:
    """The columns of ``df`` under the names c0, c1, … and what is removed."""
    if length <= ANCHOR:
        raise ValueError(f"length must be above {ANCHOR}")
    carried = df.select(*(F.col(f"`{name}`").alias(f"c{k}") for k, name in enumerate(df.columns)))
    columns = carried.columns
    doc_id, text = (f"c{df.columns.index(name)}" for name in ("doc_id", "text"))
    docs = carried.withColumns({"id": common.ids(doc_id), "text": F.coalesce(text, F.lit(""))})
    docs = docs.withColumn("tie", F.xxhash64("text"))
    sized = docs.select(F.col("id").alias("key"), "tie", (F.octet_length("text") + ROW_BYTES).cast("long").alias("size"))
    total = sized.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    splits = common.cuts(sized, total, block_bytes)
    order = common.first_places(splits)
    # A part is one group in a task, so their number grows with the text.
    parts = max(2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_BYTES))
    stored, name = _blocks(docs, splits, -(-total // BUCKET_BYTES))

    def units(rows: pa.Table) -> tuple[Parsed, Keys]:
        parsed = Parsed(rows.column("id").to_pylist(), rows.column("text").to_pylist(), length)
        return parsed, Keys(*parsed.units(), parts)

    def anchored(rows: pa.Table, replies: _Replies) -> tuple[Parsed, Keys]:
        parsed, keys = units(rows)
        parsed.settle(keys.repeats(replies.of("unit")))
        return parsed, Keys(parsed.anchors, parsed.ids[parsed.run_doc], parts)

    def strings(rows: pa.Table, replies: _Replies) -> tuple[Parsed, Strings]:
        parsed, keys = anchored(rows, replies)
        return parsed, Strings(parsed, *keys.flags(replies.of("anchor"), 2), parts)

    def block_of(table: pa.Table) -> tuple[int, int]:
        """The number of a block, and the first block of its id."""
        block = table.column("block")[0].as_py()
        return block, int(order[block])

    def ask_units(table: pa.Table) -> pa.Table:
        return units(_unpacked(table))[1].requests(*block_of(table))

    def ask_anchors(table: pa.Table, replies: pa.Table) -> pa.Table:
        return anchored(_unpacked(table), _Replies(replies))[1].requests(*block_of(table))

    def ask_strings(table: pa.Table, replies: pa.Table) -> pa.Table:
        return strings(_unpacked(table), _Replies(replies))[1].requests(*block_of(table))

    def results(table: pa.Table, replies: pa.Table) -> pa.Table:
        docs, found = _unpacked(table), _Replies(replies)
        parsed, compared = strings(docs, found)
        n = len(parsed.data)
        change = np.zeros(n + 1, "int32")
        np.add.at(change, parsed.starts[parsed.removed], 1)
        np.add.at(change, parsed.stops[parsed.removed], -1)
        at = compared.removed(found.of("string"))
        np.add.at(change, at, 1)
        np.add.at(change, at + length, -1)
        gone = np.cumsum(change[:n]) > 0
        rows: dict[str, list] = {c: [] for c in ("n_removed", "starts", "ends", "kept")}
        for a, b in zip(parsed.begins, parsed.ends, strict=True):
            part = gone[a:b]
            turns = np.flatnonzero(np.diff(np.concatenate([[False], part, [False]]).astype("int8")))
            rows["n_removed"].append(int(part.sum()))
            rows["starts"].append(turns[::2])
            rows["ends"].append(turns[1::2])
            rows["kept"].append(parsed.data[a:b][~part].tobytes())
        return pa.table(
            [
                *docs.select(columns).take(pa.array(parsed.order, "int64")).columns,
                pa.array(parsed.sizes),
                pa.array(rows["n_removed"], "int64"),
                pa.array([len(s) for s in rows["starts"]], "int64"),
                common.lists(rows["starts"], pa.int64()),
                common.lists(rows["ends"], pa.int64()),
                pa.array(rows["kept"], "binary"),
            ],
            names=[*columns, "n_bytes", "n_removed", "n_spans", "starts", "ends", "kept"],
        )

    def step(function, replies: DataFrame, schema: str) -> DataFrame:
        return stored.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(function, schema)

    made = "n_bytes long, n_removed long, n_spans long, starts array<long>, ends array<long>, kept binary"
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in carried.schema.fields)
    try:
        replies = _owned(stored.groupBy("block").applyInArrow(ask_units, REQUEST), "unit", length)
        replies = replies.unionByName(_owned(step(ask_anchors, replies, REQUEST), "anchor", length))
        replies = replies.unionByName(_owned(step(ask_strings, replies, REQUEST), "string", length))
        return materialise(step(results, replies, f"{kinds}, {made}"))
    finally:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
