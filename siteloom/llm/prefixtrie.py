"""Trie of the beginnings that conversations share.

``rebuilt`` turns rows of turns into one row a conversation: its turns as 16-byte ids (of role and text),
one after the other, and the code points of each text. Compared as bytes, such paths are in the order of the trie.

*A shard* is a range of the rows in the order of (path, conversation). Its task puts the ids into a matrix,
``WINDOW`` turns at a time, padded where a row has ended, and sorts the rows with ``numpy.lexsort``; only
rows that go on enter the next window, so the memory goes with the turns and not with rows times the longest.
A mask of the columns in which a row differs from the one before, OR-accumulated from left to right, marks at each
depth the rows at which nodes start; ``reduceat`` over these starts gives a depth's members, and over children,
from the deepest depth up, the figures of subtrees.

*Between shards* only the nodes on the paths of a shard's first and last row can be shared. All others are
complete and leave the task as results. Those paths, with what the shard found for each of their nodes
(members, least member, and the figures of its complete children), are the rows of the next level, at
most two a shard, and go through the same function, level by level, until one shard is left.
So a node that a third of all conversations share is counted shard by shard and never gathered. The list
of conversations that end at a shared node is hashed in order from one text a shard, read as a stream.

Null conversation ids take no part. Turns are ordered by ``turn``, null first; equal ones by the id of
role and text, so that repeated rows are turns of their own. Null role or text counts as empty. Other columns are left out,
whatever their names. A conversation is one row (16 bytes a turn, and 4 for its length); texts of any length count
by their digest. An empty table has no conversation and gives no node, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteloom.session import materialise

SHARD_ROWS, SHARD_TURNS, WINDOW = 1 << 15, 1 << 20, 16
SHARE, LONGEST = 100, 6
NOTHING = hashlib.sha256(b"").hexdigest()
NODE, PATH, BLOCK, LINK = range(4)
NONE_YET = 2**63 - 1
PARTS = ["n", "low", "children", "leaves", "saved"]
FOUND = pa.schema(
    [("kind", pa.int32()), ("shard", pa.int64()), ("key", pa.binary()), ("parent_key", pa.binary())]
    + [(c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [("ends_sha256", pa.string()), ("first", pa.int64()), ("ids", pa.string())]
    + [("path", pa.binary()), ("chars", pa.list_(pa.int32()))]
    + [(c, pa.list_(pa.int64())) for c in PARTS]
)
FOUND_SQL = (
    "kind int, shard long, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, first long, ids string, path binary, "
    "chars array<int>, " + ", ".join(f"{c} array<long>" for c in PARTS)
)
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversations(df: DataFrame) -> DataFrame:
    """``conv_id, turns``: the turns of each conversation in order, as ``turn, id, chars``."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    turn = F.struct(F.col("turn"), F.unhex(F.substring(digest, 1, 32)).alias("id"), F.length(text).alias("chars"))
    rows = df.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(df: DataFrame, share: int = SHARE, longest: int = LONGEST) -> DataFrame:
    """``conv_id, path, chars``: each conversation with the beginning of the first one of its ``share``.

    Conversation c takes h = crc32(c as decimal) % ``longest`` turns of c - c % ``share`` in the place of its own
    first h. At most ``share`` conversations take from one, and less than ``longest`` turns of it.
    """
    made = materialise(conversations(df))
    own = made.withColumn("base", F.col("conv_id") - F.col("conv_id") % share)
    heads = made.where(F.col("conv_id") % share == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, max(1, longest - 1)).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string")) % longest).cast("int")
    rest = F.slice("turns", h + 1, F.size("turns"))
    whole = F.when(F.col("head").isNull(), rest).otherwise(F.concat(F.slice("head", F.lit(1), h), rest))
    joined = own.join(heads, "base", "left").select("conv_id", whole.alias("turns"))
    return joined.select(
        "conv_id",
        F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t.id)), "")).alias("path"),
        F.transform("turns", lambda t: t.chars).alias("chars"),
    )


class Shard:
    """Rows of a shard: their paths one after the other, and what is known of each path's nodes.

    ``parts`` is None for conversations, whose nodes each count one member, ``own``. Else it holds, for
    row r and depth d, at ``r + offsets[r] + d``, what an earlier level found.
    """

    def __init__(self, paths: list[bytes], chars: np.ndarray, own: np.ndarray, parts: dict[str, np.ndarray] | None = None):
        self.sizes = np.array([len(p) // 16 for p in paths], "int64")
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)])
        self.raw = b"".join(paths)
        self.turns = np.frombuffer(self.raw, ">u8").astype("uint64").reshape(-1, 2)
        self.chars, self.own, self.parts = chars, own, parts
        self._sorted()

    def _sorted(self) -> None:
        """Sort the rows and list, for each depth, its nodes: first row (in order) and sums."""
        n = len(self.sizes)
        self.order = np.arange(n)
        self.run = np.zeros(n, "bool")  # in order: the path is another than that of the row before
        active, group, base = np.arange(n), np.zeros(n, "int64"), 0
        self.nodes: list[dict[str, np.ndarray]] = [{}]
        while len(active):
            rows = self.order[active]
            width = int(min(WINDOW, self.sizes[rows].max() - base))
            columns = base + np.arange(width)
            real = columns < self.sizes[rows][:, None]
            at = np.where(real, self.offsets[rows][:, None] + columns, 0)
            matrix = np.where(real[:, :, None], self.turns[at], np.uint64(0)) if width else np.zeros((len(rows), 0, 2), "uint64")
            longer = self.sizes[rows] > base + width
            keys = [matrix[:, c, k] for c in range(width - 1, -1, -1) for k in (1, 0)]
            sort = np.lexsort([self.own[rows], longer, *keys, group])
            rows, matrix, group, longer = rows[sort], matrix[sort], group[sort], longer[sort]
            self.order[active] = rows
            changed = np.ones((len(rows), width), "bool")
            changed[1:] = (matrix[1:] != matrix[:-1]).any(axis=2) | (group[1:] != group[:-1])[:, None]
            starts = np.logical_or.accumulate(changed, axis=1)
            sizes = self.sizes[rows]
            if base == 0:
                self._depth(0, active, rows, np.zeros(1, "int64"))
                self.run[0] = sizes[0] == 0
            for j in range(width):
                inside = np.flatnonzero(sizes > base + j)
                begin = starts[inside, j]
                self._depth(base + j + 1, active[inside], rows[inside], np.flatnonzero(begin))
                ends = begin & (sizes[inside] == base + j + 1)
                self.run[active[inside][ends]] = True
            base += width
            group = np.cumsum(starts[:, -1])[longer] if width else group[longer]
            active = active[longer]

    def _depth(self, depth: int, at: np.ndarray, rows: np.ndarray, starts: np.ndarray) -> None:
        node = {"at": at[starts], "row": rows[starts]}
        if self.parts is None:
            node["n"] = np.diff(np.append(starts, len(rows)))
            node["low"] = np.minimum.reduceat(self.own[rows], starts)
            for part in PARTS[2:]:
                node[part] = np.zeros(len(starts), "int64")
        else:
            cells = rows + self.offsets[rows] + depth
            for part in PARTS:
                add = np.minimum if part == "low" else np.add
                node[part] = add.reduceat(self.parts[part][cells], starts)
        node["chars"] = self.chars[self.offsets[node["row"]] + depth - 1] if depth else np.zeros(len(starts), "int64")
        self.nodes[depth:] = [node]

    def climb(self, final: bool) -> None:
        """Sum children into their parents; nodes on the first and last path stay open unless ``final``."""
        first, last = self.sizes[self.order[0]], self.sizes[self.order[-1]]
        below = None
        for depth in range(len(self.nodes) - 1, -1, -1):
            node = self.nodes[depth]
            node["open"] = np.zeros(len(node["at"]), "bool")
            if not final:
                node["open"][0] |= first >= depth
                node["open"][-1] |= last >= depth
            if below is not None:
                parent = below["parent"] = np.searchsorted(node["at"], below["at"], side="right") - 1
                begin = np.flatnonzero(np.append(True, np.diff(parent) > 0))
                done = ~below["open"]
                for part, given in (("children", done), ("leaves", below["leaves"] * done), ("saved", below["saved"] * done)):
                    node[part][parent[begin]] += np.add.reduceat(given.astype("int64"), begin)
            whole = ~node["open"]
            node["leaves"][whole & (node["children"] == 0)] = 1
            node["saved"] += np.where(whole, (node["n"] - 1) * node["chars"], 0)
            below = node

    def key(self, row: int, depth: int) -> bytes:
        """Names the node at ``depth`` of a row's path."""
        start = 16 * int(self.offsets[row])
        return hashlib.sha256(self.raw[start : start + 16 * depth]).digest()

    def keys(self, row: int) -> list[bytes]:
        """The names of all nodes of a row's path."""
        made, digest = [], hashlib.sha256()
        made.append(digest.digest())
        for k in range(int(self.offsets[row]), int(self.offsets[row + 1])):
            digest.update(self.raw[16 * k : 16 * k + 16])
            made.append(digest.copy().digest())
        return made

    def ends(self) -> dict[int, str]:
        """For each first row (in order) of equal paths, the ids of those rows, as text."""
        begin = np.flatnonzero(self.run)
        ids = self.own[self.order].tolist()
        return {a: ",".join(map(str, ids[a:b])) for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(ids)], strict=True)}


def _batch(kind: int, rows: int, **columns) -> Iterator[pa.RecordBatch]:
    arrays = [
        pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in FOUND if f.name != "kind"
    ]
    whole = pa.RecordBatch.from_arrays([pa.array(np.full(rows, kind, "int32")), *arrays], FOUND.names)
    for start in range(0, rows, 20_000):
        yield whole.slice(start, 20_000)


def _climbed(shard: Shard, number: int, final: bool) -> Iterator[pa.RecordBatch]:
    """What a shard gives: complete nodes, open paths, texts of ids for the open nodes, and their names."""
    shard.climb(final)
    base = shard.parts is None
    texts = shard.ends() if base else {}
    names: dict[int, list[bytes]] = {}

    def name(row: int, depth: int) -> bytes:
        if row not in names:
            names[row] = shard.keys(row)
        return names[row][depth]

    above: dict[str, np.ndarray] | None = None
    for depth, node in enumerate(shard.nodes):
        at = np.flatnonzero(~node["open"])
        if len(at):
            parents = [None] * len(at) if above is None else above["low"][node["parent"][at]].tolist()
            parent_keys = [None] * len(at)
            if above is not None:
                for k in np.flatnonzero(above["open"][node["parent"][at]]).tolist():
                    parents[k] = None
                    parent_keys[k] = name(int(above["row"][node["parent"][at[k]]]), depth - 1)
            begins = node["at"][at].tolist()
            ending = shard.sizes[node["row"][at]] == depth
            ends = [
                hashlib.sha256(texts[b].encode()).hexdigest() if base and e else NOTHING for b, e in zip(begins, ending, strict=True)
            ]
            found = {
                "shard": np.full(len(at), number, "int64"),
                "parent_key": parent_keys,
                "conv_id": node["low"][at],
                "depth": np.full(len(at), depth, "int64"),
                "parent_conv_id": parents,
                "n_convs": node["n"][at],
                "n_children": node["children"][at],
                "n_leaves": node["leaves"][at],
                "saved_tokens": node["saved"][at],
                "ends_sha256": ends,
            }
            if not base:
                found["key"] = [name(int(row), depth) for row in node["row"][at]]
            yield from _batch(NODE, len(at), **found)
        above = node
    if final:
        return
    open_ = [[(depth, k) for depth, node in enumerate(shard.nodes) for k in [0] if node["open"][0] and node["at"][0] == 0]]
    first, last = int(shard.order[0]), int(shard.order[-1])
    seen = set(open_[0])
    tail = [(depth, len(shard.nodes[depth]["at"]) - 1) for depth in range(int(shard.sizes[last]) + 1)]
    if any(place not in seen for place in tail):
        open_.append(tail)
    for row, places in zip((first, last), open_, strict=False):
        mine = [place not in seen or row == first for place in places]
        parts = {
            part: [
                [
                    int(shard.nodes[depth][part][k]) if own else NONE_YET if part == "low" else 0
                    for own, (depth, k) in zip(mine, places, strict=True)
                ]
            ]
            for part in PARTS
        }
        a, b = int(shard.offsets[row]), int(shard.offsets[row + 1])
        yield from _batch(PATH, 1, shard=[number], path=[shard.raw[16 * a : 16 * b]], chars=[shard.chars[a:b].tolist()], **parts)
        if not base:
            continue
        keys = names.get(row) or shard.keys(row)
        new = [(keys[depth], depth, k) for own, (depth, k) in zip(mine, places, strict=True) if own]
        yield from _batch(LINK, len(new), shard=[number] * len(new), key=[key for key, _, _ in new])
        for key, depth, k in new:
            node = shard.nodes[depth]
            if shard.sizes[node["row"][k]] == depth:
                yield from _batch(BLOCK, 1, key=[key], first=[int(shard.own[node["row"][k]])], ids=[texts[int(node["at"][k])]])


def _gathered(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    some = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(some).combine_chunks() if some else None


def _flat(table: pa.Table, name: str) -> np.ndarray:
    flat = [chunk.flatten() for chunk in table[name].chunks]
    return np.concatenate([f.to_numpy(zero_copy_only=False) for f in flat]).astype("int64") if flat else np.zeros(0, "int64")


def _level(rows: DataFrame, base: bool, shards: int) -> DataFrame:
    """Shards of ``rows`` in the order of their paths, each climbed by one task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _gathered(batches)
        if table is None:
            return
        number = table["_shard"][0].as_py()
        parts = None if base else {part: _flat(table, part) for part in PARTS}
        own = table["conv_id"].to_numpy() if base else np.arange(len(table))
        yield from _climbed(Shard(table["path"].to_pylist(), _flat(table, "chars"), own, parts), number, shards == 1)

    second = "conv_id" if base else "shard"
    ranged = rows.repartitionByRange(shards, "path", second) if shards > 1 else rows.coalesce(1)
    columns = ["path", "chars", "conv_id"] if base else ["path", "chars", *PARTS]
    return materialise(ranged.select(*columns, F.spark_partition_id().cast("long").alias("_shard")).mapInArrow(work, FOUND_SQL))


def _hashed(blocks: DataFrame) -> DataFrame:
    """``key, ends``: the digest of a key's texts in order, joined by commas; they are read as a stream."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()])], ["key", "ends"])

        for batch in batches:
            for one, ids in zip(batch["key"], batch["ids"], strict=True):
                if one.as_py() != key:
                    if digest is not None:
                        yield row()
                    key, digest = one.as_py(), hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.as_py().encode())
        if digest is not None:
            yield row()

    ordered = blocks.select("key", "first", "ids").repartition("key").sortWithinPartitions("key", "first")
    return ordered.mapInArrow(work, "key binary, ends string")


def nodes(paths: DataFrame, rows: int = SHARD_ROWS, turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the trie of ``conv_id, path, chars`` (see ``rebuilt``); conversations are distinct."""
    level, base, found = materialise(paths), True, []
    while True:
        many, cells = level.agg(F.count("*"), F.coalesce(F.sum(F.size("chars").cast("long")), F.lit(0))).first()
        shards = max(1, -(-many // rows), -(-cells // turns))
        if not base and shards >= found[-1][1]:
            shards = 1  # paths longer than a shard: a few rows
        found.append((_level(level, base, shards), shards))
        if shards == 1:
            break
        level, base = found[-1][0].where(F.col("kind") == PATH), False
    lowest = found[0][0]
    complete = lowest.where(F.col("kind") == NODE)
    if len(found) == 1:
        return complete.select(*RESULT)
    upper = found[1][0]
    for more, _ in found[2:]:
        upper = upper.unionByName(more)
    upper = upper.where(F.col("kind") == NODE)
    low = upper.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_low"))
    ends = _hashed(lowest.where(F.col("kind") == BLOCK))
    shared = upper.join(ends, "key", "left").join(low, "parent_key", "left")
    shared = shared.withColumns(
        {"ends_sha256": F.coalesce("ends", F.lit(NOTHING)), "parent_conv_id": F.coalesce("parent_low", "parent_conv_id")}
    )
    # A shard's few open nodes get their least members first, so no parent is a hot key of all its children.
    links = lowest.where(F.col("kind") == LINK).select("shard", F.col("key").alias("parent_key")).join(low, "parent_key")
    under = complete.where(F.col("parent_key").isNotNull()).drop("parent_conv_id").join(links, ["shard", "parent_key"])
    under = under.withColumnRenamed("parent_low", "parent_conv_id")
    alone = complete.where(F.col("parent_key").isNull())
    return alone.select(*RESULT).unionByName(under.select(*RESULT)).unionByName(shared.select(*RESULT))


def trie(df: DataFrame) -> DataFrame:
    """The nodes of all rebuilt conversations of ``conv_id, turn, role, text``."""
    return nodes(rebuilt(df))
