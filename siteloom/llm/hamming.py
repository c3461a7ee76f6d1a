"""Near duplicates by a multi-index Hamming join of minwise signatures.

A document is the set of its distinct shingles of five words. Two documents are linked if
their Jaccard similarity is 0.75 or more; the link is confirmed on the whole sets.

*Classes.* Documents with equal sets are one class, so copies are folded before anything
is joined. A class has a signature of 80 symbols of 16 bits; symbols of two sets are equal
with the probability of their similarity.

*Index.* The signature distance (number of unequal symbols) of a linked pair is 20 on
average and above 39 with a probability of 1.3e-6 (1.4e-6 with the cut below). The signature is split into 20 chunks of four
symbols. By pigeonhole a pair at distance 39 or less has a chunk with at most one error, so
each chunk is entered four times, once without each symbol: every pair within the distance
meets at one of the 80 keys, for certain.

*Stars first.* The pairs at a key are not listed. Of each key's classes the one that shares
most keys with others (the middle of its group) is compared with the rest; confirmed links
give components. Only keys that still hold several components are worked on further: there
pairs of different components are compared. The classes of the key's main component and all
others are dealt by hash into blocks of about ``SLICE`` classes; each main block meets each other
block, and the other blocks meet in pairs, so a run has two blocks however large the key is. (The pairs of a
key are as many as before: a key of N classes without links has N * N / 2 of them, over as many runs
as it has pairs of blocks.) A pair counts at its first common key. So no link between components
is lost, and copies of one text never meet pair by pair.

Before sets are compared, a second signature of 512 symbols of 8 bits drops pairs that are below
the threshold by more than five standard deviations, at their key already.

Null and empty texts (and such without words) have no set and are linked with nothing. Rows
that repeat an id count as one document. A null id is the least; its component is null. Of equal texts
the least id stays. A very long text counts whole, with 8 bytes a word where its set is compared. ``kept`` gives all
columns of its input, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteloom.llm import common, graph, sketch
from siteloom.session import materialise

CHUNK, DISTANCE, SLICE, STAR = 4, 39, 1024, 256
MOST_PARTITIONS = 20_000
CHUNKS = sketch.SYMBOLS // CHUNK
LONG = 512


def sketches(df: DataFrame) -> DataFrame:
    """``id, n, print, signature, text_hash`` of ``doc_id, text``; ``print`` is a 128-bit hash of the set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, texts in common.text_portions(batch.column(1)):
                sets, b = sketch.shingles(texts), a + len(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array([len(s) for s in sets], "int64"),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], "binary"),
                        pa.array([sketch.signature(s).tobytes() if len(s) else None for s in sets], "binary"),
                        batch.column(2).slice(a, b - a),
                    ],
                    ["id", "n", "print", "signature", "text_hash"],
                )

    docs = df.select(common.ids("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    return docs.mapInArrow(work, "id long, n long, print binary, signature binary, text_hash long")


def _symbols(column: pa.Array, width: int, kind: str = "uint16") -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _slack(over: int, under: int) -> int:
    """Unequal symbols of two long signatures that a pair at the threshold hardly ever passes."""
    share = 1 - over / under
    return int(share * LONG + 5.5 * (share * (1 - share) * LONG) ** 0.5)


def _keys(symbols: np.ndarray) -> np.ndarray:
    """The keys of each signature: by chunk and left-out symbol, its number and the other three."""
    out = []
    wide = symbols.astype("int64")
    for chunk in range(CHUNKS):
        for left in range(CHUNK):
            a, b, c = (wide[:, chunk * CHUNK + k] for k in range(CHUNK) if k != left)
            out.append(np.int64(chunk * CHUNK + left) << 48 | a << 32 | b << 16 | c)
    return np.stack(out, axis=1)


def index(classes: DataFrame) -> DataFrame:
    """``key, id``: 80 rows a class."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                keys = _keys(_symbols(part.column(1), sketch.SYMBOLS))
                ids = np.repeat(part.column(0).to_numpy(), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids)], ["key", "id"])

    return classes.select("id", "signature").mapInArrow(work, "key long, id long")


def _linked(one: np.ndarray, two: np.ndarray, threshold: tuple[int, int]) -> bool:
    over, under = threshold
    shared = len(np.intersect1d(one, two, assume_unique=True))
    return under * shared >= over * (len(one) + len(two) - shared)


def _star(pairs: DataFrame, texts: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """The pairs ``middle, id`` whose sets pass ``threshold`` (a fraction): first by long signatures, then on whole sets.

    A middle's classes are dealt by hash into blocks of about ``STAR``; its signature and its text travel once a block.
    """
    slack = _slack(*threshold)
    # Only middles of more than one block: few rows, however many classes such a middle has.
    sizes = pairs.groupBy("middle").agg(F.ceil(F.count("*") / STAR).cast("long").alias("blocks")).where("blocks > 1")
    slice_ = F.pmod(F.xxhash64("id"), F.coalesce("blocks", F.lit(1))).alias("slice")
    dealt = pairs.join(sizes, "middle", "left").select("middle", "id", slice_)

    def blocks(rows: DataFrame, column: str) -> DataFrame:
        """``key, slice, first, id, <column>``: a block's middle, then its classes."""
        middles = rows.select("middle", "slice").distinct().select("middle", "slice", F.col("middle").alias("id"))
        both = middles.withColumn("later", F.lit(0)).unionByName(rows.select("middle", "slice", "id").withColumn("later", F.lit(1)))
        beside = both.join(texts.select("id", column), "id").select(F.col("middle").alias("key"), "slice", "later", "id", column)
        return beside.repartition("key", "slice").sortWithinPartitions("key", "slice", "later", "id")

    def with_middle(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
        """Parts of rows of one block, with the middle's row before them."""
        held = None
        for batch in batches:
            later = batch.column(2).to_numpy()
            cuts = np.flatnonzero(later == 0)
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                if start < end and not later[start]:
                    held, start = batch.slice(start, 1), start + 1
                if start < end:
                    yield held, batch.slice(start, end - start)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for middle, part in with_middle(batches):
            far = _symbols(part.column(4), LONG, "uint8") != _symbols(middle.column(4), LONG, "uint8")
            close = pa.array(far.sum(axis=1) <= slack)
            yield pa.RecordBatch.from_arrays([part.column(k).filter(close) for k in (0, 1, 3)], ["middle", "slice", "id"])

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, own = None, None
        for middle, part in with_middle(batches):
            if known != middle.column(0)[0].as_py():
                known, own = middle.column(0)[0].as_py(), sketch.shingles(middle.column(4).to_pylist())[0]
            for start, some in common.text_portions(part.column(4)):
                linked = pa.array([_linked(own, s, threshold) for s in sketch.shingles(some)])
                yield pa.RecordBatch.from_arrays([part.column(k).slice(start, len(some)).filter(linked) for k in (0, 3)], ["a", "b"])

    close = materialise(blocks(dealt, "long").mapInArrow(near, "middle long, slice long, id long"))
    return materialise(blocks(close, "text").mapInArrow(exact, "a long, b long"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each key and slice (the first two columns, by which rows are sorted)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, slices = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if held and (held[0].column(0)[0].as_py(), held[0].column(1)[0].as_py()) != (keys[0], slices[0]):
            yield pa.Table.from_batches(held)
            held = []
        edges = np.flatnonzero((np.diff(keys) != 0) | (np.diff(slices) != 0)) + 1
        cuts = [0, *edges.tolist(), batch.num_rows]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            held.append(batch.slice(start, end - start))
            if end < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def _by_key(rows: DataFrame, partitions: int) -> DataFrame:
    """Sorted by key and slice; dealt over ``partitions`` where the session has fewer."""
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(partitions, "key", "slice") if partitions > least else rows.repartition("key", "slice")
    return dealt.sortWithinPartitions("key", "slice", "id")


def _mixed(placed: DataFrame) -> DataFrame:
    """``key, most, mains, blocks, pairs`` of the keys with several components, of ``key, id, component``.

    ``most`` is the main component, ``mains`` and ``blocks`` are the numbers of its blocks and of the others'.
    """
    parts = placed.groupBy("key", "component").agg(F.count("*").alias("held"))
    mixed = parts.groupBy("key").agg(
        F.count("*").alias("parts"),
        F.sum("held").alias("size"),
        F.max("held").alias("main"),
        F.max_by("component", F.struct("held", "component")).alias("most"),
    )
    rest = F.col("size") - F.col("main")
    blocks = [F.ceil(size / SLICE).cast("long").alias(name) for name, size in (("mains", F.col("main")), ("blocks", rest))]
    pairs = (F.col("main") * rest + rest * rest / 2).cast("double").alias("pairs")
    return mixed.where("parts > 1").select("key", "most", *blocks, pairs)


def _dealt(placed: DataFrame, mixed: DataFrame) -> DataFrame:
    """``key, slice, side, inner, id, component``: the classes of each pair of blocks.

    Classes of different sides are compared, where ``inner`` holds those of a side as well: the slices of the first
    main block are where the other classes of one block meet each other.
    """
    first = lambda k: k == 0
    rows = placed.join(mixed, "key").withColumn("main", F.col("component") == F.col("most"))
    mains, blocks = F.col("mains"), F.col("blocks")
    own = F.pmod(F.xxhash64("id"), F.when(F.col("main"), mains).otherwise(blocks))
    rows = rows.withColumn("own", own)
    own = F.col("own")

    def place(slice_, side: int, inner):
        return F.struct(slice_.cast("long").alias("slice"), F.lit(side).alias("side"), inner.alias("inner"))

    def with_other(j):
        low, high = F.least(own, j), F.greatest(own, j)
        number = mains * blocks + low * blocks + high
        return F.when(own < j, place(number, 0, F.lit(False))).otherwise(place(number, 1, F.lit(False)))

    every = F.sequence(F.lit(0).cast("long"), blocks - 1)
    of_main = F.transform(every, lambda j: place(own * blocks + j, 0, first(own)))
    with_main = F.transform(F.sequence(F.lit(0).cast("long"), mains - 1), lambda k: place(k * blocks + own, 1, first(k)))
    with_others = F.transform(F.filter(every, lambda j: j != own), with_other)
    rows = rows.withColumn("at", F.explode(F.when(F.col("main"), of_main).otherwise(F.concat(with_main, with_others))))
    return rows.select("key", "at.slice", "at.side", "at.inner", "id", "component")


def _across(rows: DataFrame, threshold: tuple[int, int], partitions: int) -> DataFrame:
    """Classes of different components at a key and slice that are within the signature distances.

    Takes rows (key, slice, side, inner, id, component, n, signature, long) and gives a row (key, slice, id, others) for
    each class that has a partner; a pair is in the list of one of the two.
    """
    ratio, slack = threshold[0] / threshold[1], _slack(*threshold)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches):
            symbols = _symbols(run.column("signature"), sketch.SYMBOLS)
            longer = _symbols(run.column("long"), LONG, "uint8")
            ids, part, n, side = (run.column(c).to_numpy() for c in ("id", "component", "n", "side"))
            key, number, inner = (run.column(c)[0].as_py() for c in ("key", "slice", "inner"))
            partners: dict[int, list[int]] = {}
            for k in range(len(ids) - 1):
                rest = slice(k + 1, None)
                fit = part[rest] != part[k]
                fit &= np.minimum(n[rest], n[k]) >= ratio * np.maximum(n[rest], n[k])
                if not inner:
                    fit &= side[rest] != side[k]
                at = np.flatnonzero(fit) + k + 1
                at = at[(symbols[at] != symbols[k]).sum(axis=1) <= DISTANCE]
                at = at[(longer[at] != longer[k]).sum(axis=1) <= slack]
                for other, row in zip(at.tolist(), symbols[at] == symbols[k], strict=True):
                    hits = row.reshape(CHUNKS, CHUNK)
                    chunk = int(np.argmax(hits.sum(axis=1) >= CHUNK - 1))
                    left = 0 if hits[chunk].all() else int(np.argmin(hits[chunk]))
                    if chunk * CHUNK + left == key >> 48:
                        partners.setdefault(k, []).append(int(ids[other]))
                        partners.setdefault(other, [])
            if partners:
                count = len(partners)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([key] * count, "int64"),
                        pa.array([number] * count, "int64"),
                        pa.array(ids[list(partners)]),
                        pa.array(list(partners.values()), pa.list_(pa.int64())),
                    ],
                    ["key", "slice", "id", "others"],
                )

    return _by_key(rows, partitions).mapInArrow(work, "key long, slice long, id long, others array<long>")


def _confirm_at_key(rows: DataFrame, texts: DataFrame, threshold: tuple[int, int], partitions: int) -> DataFrame:
    """The pairs of ``_across`` whose sets pass: a set is made once at its key, not once a pair."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches):
            ids = run.column("id").to_pylist()
            sets = dict(zip(ids, sketch.shingles(run.column("text").to_pylist()), strict=True))
            found = [
                (a, b)
                for a, others in zip(ids, run.column("others").to_pylist(), strict=True)
                for b in others
                if _linked(sets[a], sets[b], threshold)
            ]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(side, "int64") for side in zip(*found, strict=True)], ["a", "b"])

    beside = rows.join(texts.select("id", "text"), "id").select("key", "slice", "id", "others", "text")
    return materialise(_by_key(beside, partitions).mapInArrow(work, "a long, b long"))


def near_duplicates(df: DataFrame, threshold: tuple[int, int] = (75, 100)) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, text_hash`` of ``doc_id, text``."""
    docs = df.select(common.ids("doc_id").alias("id"), "text")
    rows = materialise(sketches(df))
    classes = materialise(
        rows.where("n > 0").groupBy("print").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("signature").alias("signature"))
    )
    keys = index(classes)
    shared = keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = materialise(keys.join(shared, "key"))

    # The classes that meet another one, with their texts and long signatures.
    met = members.groupBy("id").agg(F.sum(F.col("size") - 1).alias("score"))
    wanted = met.join(classes, "id").select("id", "print")

    def lengthened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, texts in common.text_portions(batch.column(1)):
                part = batch.slice(a, len(texts))
                longer = [sketch.signature(s, LONG).astype("uint8").tobytes() for s in sketch.shingles(texts)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(longer, "binary")], ["id", "text", "long"])

    # One text of each class, told by its hash before whole texts are joined: they are shuffled once.
    hashes = rows.join(wanted, ["id", "print"]).groupBy("id").agg(F.min("text_hash").alias("text_hash"))
    hashed = docs.withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    found = hashed.join(hashes, ["id", "text_hash"]).dropDuplicates(["id", "text_hash"])
    texts = materialise(found.select("id", "text").mapInArrow(lengthened, "id long, text string, long binary"))

    # Stars: the middle of each key's classes with the rest.
    middle = members.join(met, "id").groupBy("key").agg(F.max_by("id", F.struct("score", -F.col("id"))).alias("middle"))
    star = members.join(middle, "key").where("id != middle").select("middle", "id").distinct()
    links = _star(materialise(star), texts, threshold)

    # Then what is left between components.
    first = graph.components(links)
    placed = members.join(first.withColumnRenamed("node", "id"), "id", "left").select(
        "key", "id", F.coalesce("component", "id").alias("component")
    )
    mixed = materialise(_mixed(placed))
    pairs = mixed.agg(F.coalesce(F.sum("pairs"), F.lit(0.0))).first()[0]
    partitions = min(MOST_PARTITIONS, int(pairs) // (2 * SLICE * SLICE) + 1)
    dealt = _dealt(placed, mixed)
    marks = materialise(classes.select("id", "n", "signature").join(texts.select("id", "long"), "id"))
    dealt = dealt.join(marks, "id").select("key", "slice", "side", "inner", "id", "component", "n", "signature", "long")
    more = _confirm_at_key(materialise(_across(dealt, threshold, partitions)), texts, threshold, partitions)

    final = graph.components(links.unionByName(more)).withColumnRenamed("node", "id")
    named = classes.join(final, "id", "left").select("print", F.coalesce("component", "id").alias("component"))
    least = F.lit(common.LOWEST)
    return rows.join(named, "print", "left").select(
        F.nullif("id", least).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.nullif(F.coalesce("component", "id"), least).alias("component_id"),
        (F.coalesce("component", "id") == F.col("id")).alias("kept"),
        "text_hash",
    )


def kept(df: DataFrame, threshold: tuple[int, int] = (75, 100)) -> DataFrame:
    """The rows of ``df`` (all columns) whose document stays; of equal rows one stays."""
    id_, hash_, stays = (common.fresh(df, name) for name in ("id", "hash", "stays"))
    found = near_duplicates(df, threshold).groupBy("doc_id", "text_hash").agg(F.max("kept").alias(stays))
    found = found.select(common.ids("doc_id").alias(id_), F.col("text_hash").alias(hash_), stays)
    rows = df.withColumns({id_: common.ids("doc_id"), hash_: F.xxhash64(F.coalesce("text", F.lit("")))})
    return rows.join(found.where(stays), [id_, hash_]).dropDuplicates([id_, hash_]).select(*df.columns)
