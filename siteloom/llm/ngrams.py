"""A trigram language model in a sharded Elias-Fano trie.

Tokens are the words of a text (A-Z lower-cased, split at ASCII white space) and an end. The
lowest level is the additive estimate p0 = (c + 0.1) / (N + 0.1 (V + 1)). Above it,

    p(d | b)    = c(b d) / (c(b) + k T(b)) + k T(b) / (c(b) + k T(b)) p0(d)
    p(d | a b)  = share(a b d) + rest(a b) p(d | b)

with T the number of different followers, share = c(a b d) / (c(a b) + T(a b)) and rest = T(a b) / (c(a b) + T(a b)).
Every trigram is stored, also those seen once. Numbers are rounded down, so what a
context gives to all words together is 1 at most.

The model is a set of files in the shared folder, each of bounded size and mapped to memory
where the folder allows it:

* the vocabulary, by word hash: sorted 64-bit hashes (of a seed under which no two training
  words collide), exact counts, numbers of followers; a word's rank is its number there.
* the trie, by bigram: contexts; pointers to their followers; the followers, relative to
  their context; pointers of each bigram to its followers in turn; and those. All are
  monotone and kept in Elias-Fano form, beside 16-bit counts and log10 shares of 8 bits (16 in
  shards that hold one too small for 8). A bigram's followers are found by its place in the trie.

Trie shards are split by counts of the first word, frequent words by second word as well. A
batch of texts looks up its words and n-grams in order, shard by shard, each by a successor search within the range of
its context: one select on the high bits, then a few low parts, read from the mapped file where they lie. No table is
unpacked, held whole or broadcast. Counting works alike: a batch sends each shard its n-grams once, with counts.

Null and empty texts have one token, the end. Rows that repeat an id, and equal texts, count and are scored one by
one. A very long text is a portion of its own, which its task holds whole. Columns other than id and text are left out,
whatever their names. An empty table trains a model without words, under which every word is unknown; scoring one
gives no rows.
"""

from __future__ import annotations

import functools
import json
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteloom.llm import common, eliasfano
from siteloom.session import materialise

START, END, FIRST = 0, 1, 2
BACKOFF = 3
SHARD_WORDS, SHARD_TOKENS, PORTION = 1 << 19, 2_000_000, 12_000_000
STEP = 40  # codes a decade


def held_out(doc_id: str = "doc_id") -> Column:
    """True for ids whose CRC-32 (of the id as text) is divisible by 10."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(10)) == 0, F.lit(False))


def _tokens(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(common.LOWER).split()


def _save(folder: str, name: str, parts: list[bytes]) -> None:
    files, root = common.filesystem(folder)
    temporary = f"{root}/.tmp-{uuid.uuid4().hex}"
    with files.open_output_stream(temporary) as out:
        for part in parts:
            out.write(part)
    files.move(temporary, f"{root}/{name}")


def _load(folder: str, name: str) -> memoryview:
    """A file's bytes: mapped where the file system is local, else read."""
    from pyarrow import fs

    files, root = common.filesystem(folder)
    if isinstance(files, fs.LocalFileSystem):
        return memoryview(pa.memory_map(f"{root}/{name}").read_buffer())
    with files.open_input_stream(f"{root}/{name}", compression=None) as file:
        return memoryview(file.read())


def _code(x: np.ndarray) -> np.ndarray:
    """log10 of numbers in (0, 1], rounded down to a fortieth."""
    return np.ceil(-np.log10(np.maximum(x, 1e-30)) * STEP - 1e-9).astype("int64")


def _number(code: np.ndarray) -> np.ndarray:
    return 10.0 ** (-code.astype("float64") / STEP)


def _count_code(c: np.ndarray) -> np.ndarray:
    """Counts in 16 bits: exact under 32768, then in steps of a thousandth, rounded down."""
    steps = np.floor(np.log(np.maximum(c, 32768) / 32768) / np.log(1.001))
    return np.where(c < 32768, c, np.minimum(32768 + steps, 65535)).astype("uint16")


def _count(code: np.ndarray) -> np.ndarray:
    wide = code.astype("float64")
    return np.where(wide < 32768, wide, np.floor(32768 * 1.001 ** np.maximum(wide - 32768, 0)))


@dataclass
class Model:
    folder: str
    seed: int = 0
    shift: int = 64
    vocabulary: dict[int, tuple[int, int]] = field(default_factory=dict)  # by shard: words, ranks before
    splits: list[int] = field(default_factory=list)
    shards: list[int] = field(default_factory=list)
    tokens: int = 0
    words: int = 0
    texts: int = 0
    starters: int = 0

    @property
    def width(self) -> int:
        return sum(n for n, _ in self.vocabulary.values()) + FIRST

    def base(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.1) / (self.tokens + 0.1 * (self.words + 1))

    def keys(self, words: list[bytes]) -> np.ndarray:
        hashed = functools.partial(xxhash.xxh3_64_intdigest, seed=self.seed)
        return np.fromiter(map(hashed, words), "uint64", len(words))

    def shard_of(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(self.shift)).astype("int64") if self.shift < 64 else np.zeros(len(keys), "int64")

    def look_up(self, words: list[bytes], followers: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number (-1 if unknown), count and followers of each word."""
        keys = self.keys(words)
        order = np.argsort(keys)
        ordered = keys[order]
        cuts = np.searchsorted(self.shard_of(ordered), [*range(1 << (64 - self.shift)), 1 << (64 - self.shift)])
        out = np.full(len(words), -1, "int64"), np.zeros(len(words), "int64"), np.zeros(len(words), "int64")
        for shard, (n, before) in self.vocabulary.items():
            asked, where = ordered[cuts[shard] : cuts[shard + 1]], order[cuts[shard] : cuts[shard + 1]]
            data = _load(self.folder, f"words-{shard}")
            known = np.frombuffer(data, "<u8", n)
            at = np.minimum(np.searchsorted(known, asked), n - 1)
            hit = known[at] == asked
            where, at = where[hit], at[hit]
            out[0][where] = at + before + FIRST
            out[1][where] = np.frombuffer(data, "<i8", n, 8 * n)[at]
            if followers:
                out[2][where] = np.frombuffer(_load(self.folder, f"followers-{shard}"), "<i8", n)[at]
        return out

    def batch(self, texts: list, followers: bool = True) -> dict[str, np.ndarray]:
        """All tokens of texts, one text after the other, a start before each."""
        codes: dict[bytes, int] = {}
        rows = [[codes.setdefault(w, len(codes)) for w in _tokens(t)] for t in texts]
        number, count, types = self.look_up(list(codes), followers)
        number = np.concatenate([number, [START, END]])
        count = np.concatenate([count, [self.texts, self.texts]])
        types = np.concatenate([types, [self.starters, 0]])
        n = len(codes)
        flat = np.fromiter((c for row in rows for c in (n, *row, n + 1)), "int64")
        text = np.repeat(np.arange(len(texts)), [len(r) + 2 for r in rows])
        return {"number": number[flat], "count": count[flat], "types": types[flat], "text": text}


def _bigrams(number: np.ndarray) -> np.ndarray:
    """The key of each token with the one before it; -1 for starts and unknown words."""
    before = np.concatenate([[-1], number[:-1]])
    return np.where((number > START) & (before >= 0) & (before != END), before << 32 | number, -1)


def _count_words(docs: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), "binary"), pa.array(list(counts.values()), "int64")], ["word", "c"]
            )
            counts.clear()
            return made

        for batch in batches:
            for _, texts in common.text_portions(batch.column(0)):
                for text in texts:
                    counts.update(_tokens(text))
                    if len(counts) > 500_000:
                        yield out()
        yield out()

    counted = docs.select("text").mapInArrow(work, "word binary, c long")
    return materialise(counted.groupBy("word").agg(F.sum("c").alias("c")))


def _store_words(model: Model, words: DataFrame) -> None:
    """Write the vocabulary under a seed without collisions."""
    for seed in range(16):
        model.seed = seed

        def hashed(batches: Iterator[pa.RecordBatch], seed: int = seed) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys = [xxhash.xxh3_64_intdigest(w, seed=seed) for w in batch.column(0).to_pylist()]
                signed = pa.array(np.array(keys, "uint64").view("int64"))
                yield pa.RecordBatch.from_arrays([signed, batch.column(1)], ["key", "c"])

        keyed = materialise(words.mapInArrow(hashed, "key long, c long"))
        if keyed.groupBy("key").count().where("count > 1").isEmpty():
            break
    else:
        raise ValueError("no seed tells the words apart")
    bits = max(0, (model.words // SHARD_WORDS).bit_length())
    model.shift = 64 - bits
    folder = model.folder

    def store(table: pa.Table) -> pa.Table:
        keys, counts = table.column("key").to_numpy().view("uint64"), table.column("c").to_numpy()
        order = np.argsort(keys)
        shard = table.column("shard")[0].as_py()
        _save(folder, f"words-{shard}", [keys[order].astype("<u8").tobytes(), counts[order].astype("<i8").tobytes()])
        return pa.table([pa.array([shard], "int32"), pa.array([len(keys)], "int64")], names=["shard", "n"])

    shard = F.shiftrightunsigned("key", model.shift).cast("int") if bits else F.lit(0)
    stored = keyed.withColumn("shard", shard).groupBy("shard").applyInArrow(store, "shard int, n long").collect()
    before = 0
    for number, n in sorted((r["shard"], r["n"]) for r in stored):
        model.vocabulary[number] = (n, before)
        before += n


def _splits(model: Model, words: DataFrame) -> list[int]:
    """Bigram keys that start the trie's shards: even in words, finer within frequent words."""
    shards = max(1, -(-model.tokens // SHARD_TOKENS))
    part = model.tokens / shards
    # At most `shards` words can have so many tokens.
    frequent = words.where(F.col("c") > part).collect() if shards > 1 else []
    found = {START: model.texts} if model.texts > part else {}
    for row, number in zip(frequent, model.look_up([bytes(r["word"]) for r in frequent], False)[0], strict=True):
        found[int(number)] = row["c"]
    splits = {k * model.width // shards << 32 for k in range(1, shards)}
    for number, count in found.items():
        pieces = -(-int(count) // int(part))
        splits |= {number << 32 | k * model.width // pieces for k in range(pieces)} | {number + 1 << 32}
    return sorted(splits)


def _ngrams(model: Model, docs: DataFrame) -> DataFrame:
    """``shard, grams``: the counted bigrams and trigrams of portions of texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splits = np.array(model.splits, "int64")
        for batch in batches:
            for _, texts in common.text_portions(batch.column(0), PORTION):
                number = model.batch(texts, followers=False)["number"]
                keys = _bigrams(number)
                at = np.flatnonzero(keys >= 0)
                pairs, place, counts = np.unique(keys[at], return_inverse=True, return_counts=True)
                where = np.full(len(keys), -1, "int64")
                where[at] = place
                third = at[where[at - 1] >= 0]
                triples, many = np.unique(where[third - 1] << 32 | number[third], return_counts=True)
                parents = triples >> 32
                shards = np.searchsorted(splits, pairs, side="right")
                names, blobs = [], []
                for shard in np.unique(shards):
                    lo, hi = np.searchsorted(shards, [shard, shard + 1])
                    x, y = np.searchsorted(parents, [lo, hi])
                    names.append(int(shard))
                    blobs.append(
                        eliasfano.squeeze(
                            [
                                np.diff(pairs[lo:hi], prepend=0),
                                counts[lo:hi],
                                np.diff(parents[x:y] - lo, prepend=0),
                                triples[x:y] & 0xFFFFFFFF,
                                many[x:y],
                            ]
                        )
                    )
                yield pa.RecordBatch.from_arrays([pa.array(names, "int32"), pa.array(blobs, "binary")], ["shard", "grams"])

    return docs.select("text").mapInArrow(work, "shard int, grams binary")


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(keys) else np.zeros(0, "int64")
    return ordered[first], np.add.reduceat(counts[order], first) if len(keys) else counts


def _store_trie(model: Model, grams: DataFrame) -> DataFrame:
    """Write the trie's shards; gives ``shard, word, followers`` by context."""
    folder, width = model.folder, model.width

    def store(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        sides: list[list[np.ndarray]] = [[], [], [], [], []]
        for blob in table.column("grams").to_pylist():
            steps, counts, parents, children, many = eliasfano.expand(blob)
            pairs = np.cumsum(steps)
            for side, values in zip(sides, (pairs, counts, pairs[np.cumsum(parents)], children, many), strict=True):
                side.append(values)
        pairs, counts, parents, children, many = map(np.concatenate, sides)
        pairs, counts = _summed(pairs, counts)
        triples, many = _summed(np.searchsorted(pairs, parents) << 32 | children, many)
        parents, children = triples >> 32, triples & 0xFFFFFFFF
        n = len(pairs)
        types = np.bincount(parents, minlength=n)
        total = np.bincount(parents, many, minlength=n) + types
        code = _code(many / total[parents])
        rest = _code(np.where(types > 0, types / np.maximum(total, 1), 1))
        wide = "u1" if max(code.max(initial=0), rest.max(initial=0)) <= 255 else "<u2"
        contexts, starts = np.unique(pairs >> 32, return_index=True)
        context = np.searchsorted(contexts, pairs >> 32)
        levels = [
            contexts,
            np.append(starts, n),
            context * width + (pairs & 0xFFFFFFFF),
            np.searchsorted(parents, np.arange(n + 1)),
            parents * width + children,
        ]
        numbers = [_count_code(counts), rest.astype(wide), code.astype(wide)]
        _save(folder, f"trie-{shard}", [eliasfano.encode(v) for v in levels] + [v.tobytes() for v in numbers])
        sizes = np.diff(np.append(starts, n))
        return pa.table(
            [pa.array([shard] * len(contexts), "int32"), pa.array(contexts), pa.array(sizes)],
            names=["shard", "word", "followers"],
        )

    return materialise(grams.groupBy("shard").applyInArrow(store, "shard int, word long, followers long"))


def _store_followers(model: Model, contexts: DataFrame) -> None:
    """Write each vocabulary shard's numbers of followers."""
    starts = np.array([before for _, before in model.vocabulary.values()], "int64") + FIRST
    names, folder, known = list(model.vocabulary), model.folder, model.vocabulary
    edges = F.lit(starts.tolist())  # a number a shard

    def store(table: pa.Table) -> pa.Table:
        place = table.column("place")[0].as_py()
        n, before = known[names[place]]
        values = np.zeros(n, "<i8")
        values[table.column("word").to_numpy() - before - FIRST] = table.column("followers").to_numpy()
        _save(folder, f"followers-{names[place]}", [values.tobytes()])
        return pa.table([pa.array([place], "int32")], names=["place"])

    place = F.size(F.filter(edges, lambda e: e <= F.col("word"))) - 1
    summed = contexts.groupBy("word").agg(F.sum("followers").alias("followers"))
    model.starters = (summed.where(F.col("word") == START).agg(F.sum("followers")).first()[0]) or 0
    placed = summed.where(F.col("word") >= FIRST).withColumn("place", place)
    written = {r[0] for r in placed.groupBy("place").applyInArrow(store, "place int").collect()}
    for k, name in enumerate(names):
        if k not in written:  # no word of it is ever followed: not possible, as an end follows each text
            _save(folder, f"followers-{name}", [bytes(8 * known[name][0])])


def train(docs: DataFrame, folder: str | None = None) -> Model:
    """Count the texts of ``docs`` and write the model's files."""
    model = Model(folder or common.scratch(docs, "ngrams"))
    files, root = common.filesystem(model.folder)
    files.create_dir(root, recursive=True)
    words = _count_words(docs)
    model.texts = docs.count()
    model.words, total = words.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
    model.tokens = total + model.texts
    if model.words:
        _store_words(model, words)
    if model.width >= 1 << 31:
        raise ValueError("more words than fit a bigram key")
    model.words += bool(model.texts)  # the end is a token as well
    model.splits = _splits(model, words)
    contexts = _store_trie(model, _ngrams(model, docs))
    model.shards = sorted(r[0] for r in contexts.select("shard").distinct().collect())
    _store_followers(model, contexts)
    stored = {k: v for k, v in vars(model).items() if k != "folder"}
    _save(model.folder, "manifest.json", [json.dumps(stored).encode()])
    return model


def load(folder: str) -> Model:
    stored = json.loads(bytes(_load(folder, "manifest.json")))
    stored["vocabulary"] = {int(k): tuple(v) for k, v in stored["vocabulary"].items()}
    return Model(folder, **stored)


def probabilities(model: Model, texts: list, made: dict[str, np.ndarray] | None = None) -> np.ndarray:
    """The probability of each token of texts (that of a start means nothing)."""
    made = made or model.batch(texts)
    number = made["number"]
    base = model.base(made["count"].astype("float64"))
    keys = _bigrams(number)
    at = np.flatnonzero(keys >= 0)
    pairs, place = np.unique(keys[at], return_inverse=True)
    where = np.full(len(keys), -1, "int64")
    where[at] = place
    # A token's trigram hangs below the bigram of the token before it.
    third = np.flatnonzero(number != START)
    third = third[where[third - 1] >= 0]
    third = third[np.argsort(where[third - 1], kind="stable")]
    parent = where[third - 1]
    count, rest, share = np.zeros(len(pairs)), np.ones(len(pairs)), np.zeros(len(third))
    edges = np.concatenate([[0], np.searchsorted(pairs, model.splits), [len(pairs)]]).astype("int64")
    width = model.width
    for shard in model.shards:
        lo, hi = edges[shard], edges[shard + 1]
        if lo == hi:
            continue
        data, stop = _load(model.folder, f"trie-{shard}"), 0
        levels = []
        for _ in range(5):
            levels.append(eliasfano.Sequence(data, stop))
            stop = levels[-1].end
        contexts, starts, second, pointers, children = levels
        n, m = second.n, children.n
        size = (len(data) - stop - 2 * n) // (n + m)  # bytes a share
        wide = f"<u{size}"
        asked = pairs[lo:hi]
        firsts, of = np.unique(asked >> 32, return_inverse=True)
        context, known = contexts.successor(firsts)
        begin = np.where(known, starts.values(np.where(known, context, 0)), 0)
        end = np.where(known, starts.values(np.where(known, context + 1, 0)), 0)
        found, hit = second.successor(context[of] * width + (asked & 0xFFFFFFFF), begin[of], end[of])
        there = np.minimum(found, n - 1)
        count[lo:hi] = np.where(hit, _count(np.frombuffer(data, "<u2", n, stop)[there]), 0)
        rest[lo:hi] = np.where(hit, _number(np.frombuffer(data, wide, n, stop + 2 * n)[there]), 1)
        # Of a bigram in the trie, its place; then the followers that its pointers span.
        x, y = np.searchsorted(parent, [lo, hi])
        mine = parent[x:y] - lo
        ok = hit[mine]
        bigram, word = found[mine[ok]], number[third[x:y][ok]]
        if m:
            spans, span = np.unique(bigram, return_inverse=True)
            begin, end = pointers.values(spans), pointers.values(spans + 1)
            child, same = children.successor(bigram * width + np.maximum(word, 0), begin[span], end[span])
            same &= word >= END
            codes = np.frombuffer(data, wide, m, stop + (2 + size) * n)
            share[x + np.flatnonzero(ok)[same]] = _number(codes[child[same]])
    before = np.maximum(np.arange(len(number)) - 1, 0)
    seen, types = made["count"][before].astype("float64"), BACKOFF * made["types"][before].astype("float64")
    grown = np.maximum(seen + types, 1)
    own = np.zeros(len(number))
    own[at] = count[place]
    # An unknown word before gives the base alone.
    p = np.where((number[before] >= 0) & (seen + types > 0), own / grown + types / grown * base, base)
    p[third] = share + rest[parent] * p[third]
    return p


def score_texts(model: Model, texts: list) -> dict[str, np.ndarray]:
    """``n_tokens, n_known, base_score, score`` of each text."""
    made = model.batch(texts)
    text, token = made["text"], made["number"] != START
    p, base = probabilities(model, texts, made), model.base(made["count"].astype("float64"))
    total = lambda x: np.bincount(text[token], x[token].astype("float64"), minlength=len(texts))
    return {
        "n_tokens": total(np.ones(len(text))).astype("int64"),
        "n_known": total(made["count"] > 0).astype("int64"),
        "base_score": total(np.log10(base)),
        "score": total(np.log10(np.maximum(p, 1e-300))),
    }


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of ``doc_id, text``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, texts in common.text_portions(batch.column(1), PORTION):
                made, n = score_texts(model, texts), len(texts)
                columns = [batch.column(0).slice(a, n), pa.array(made["n_tokens"]), pa.array(made["n_known"])]
                columns += [pa.array(np.full(n, model.tokens, "int64")), pa.array(made["base_score"]), pa.array(made["score"])]
                yield pa.RecordBatch.from_arrays(
                    columns, ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(work, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
