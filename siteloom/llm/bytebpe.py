"""Byte-level BPE as a monoid, encoded and decoded by tree reduction.

Encodings of byte strings form a monoid: ``join`` gives the encoding of two neighbours from
their encodings. A string is halved until a leaf is short, leaves are merged directly, and
neighbours are joined up the tree. A join encodes the bytes of the last tokens of the left
and the first tokens of the right side anew and lets this window grow until the tokens at
its edges are stable. That is so if each pair (token outside, token inside) encodes to
itself: a row of tokens is the encoding of its bytes exactly if all its neighbouring pairs
are, given that each token of the vocabulary encodes to itself (``reachable`` tests it).

A text is cut by the vocabulary's pattern, and its matches are encoded separately, so above
matches the join is plain concatenation. A match never spans a space that follows a
character other than white space; text is cut there and each such word encoded once.

The vocabulary is a file of ranks (base64 of the token, rank) at a path that all machines
have. Null texts count as empty and give no ids. Special tokens are ordinary text. Rows are encoded one by
one, so ties and repeated ids change nothing. A very long text, and a very long match in it, is encoded
whole. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteloom.llm import common

LEAF = 16
RUN = re.compile(r"\s ")


class Bpe:
    def __init__(self, path: str, pattern: str):
        import regex
        import tiktoken

        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        # The library's white space is the Unicode property.
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        plain = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})
        self.merge = plain._encode_single_piece  # merges of a short string of bytes
        self.stable = functools.lru_cache(1 << 18)(self._stable)
        self.match = functools.lru_cache(1 << 16)(self._match)
        self.memo = common.Memo(self._words, "uint16" if max(self.ranks.values()) < 1 << 16 else "uint32", 200_000)

    def reachable(self) -> bool:
        """True if merging the bytes of each token gives that token (tried without the look-up of whole tokens)."""
        return all(self._merged(token) == [rank] for token, rank in self.ranks.items())

    def _merged(self, data: bytes) -> list[int]:
        parts = [bytes([b]) for b in data]
        while len(parts) > 1:
            found = [(self.ranks.get(a + b, 1 << 60), k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            rank, k = min(found)
            if rank == 1 << 60:
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return [self.ranks[p] for p in parts]

    def _stable(self, a: int, b: int) -> bool:
        return self.merge(self.tokens[a] + self.tokens[b]) == [a, b]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of both sides' bytes, given the encoding of each."""
        if not left or not right:
            return left or right
        i = j = 1
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            window = self.merge(b"".join(self.tokens[t] for t in left[len(left) - i :] + right[:j]))
            before = i == len(left) or self.stable(left[-i - 1], window[0])
            after = j == len(right) or self.stable(window[-1], right[j])
            if before and after:
                return left[: len(left) - i] + window + right[j:]
            i, j = (i if before else 2 * i), (j if after else 2 * j)

    def encode_bytes(self, data: bytes) -> list[int]:
        if len(data) <= LEAF:
            return self.merge(data) if data else []
        half = len(data) // 2
        return self.join(self.encode_bytes(data[:half]), self.encode_bytes(data[half:]))

    def _match(self, match: str) -> list[int]:
        return self.encode_bytes(match.encode())

    def _words(self, words: list) -> list[list[int]]:
        found, match = self.pattern.findall, self.match
        texts = (word[0] if isinstance(word, tuple) else " " + word for word in words)
        return [[t for m in found(text) for t in (match(m) if len(m) < 64 else self._match(m))] for text in texts]

    def _cut(self, text: str) -> list:
        """The text's words: plain ones lack their leading space, a text's start is a tuple."""
        words = text.split(" ")
        if text[:1] == " " or RUN.search(text):
            merged, open_ = [words[0]], words[0] == "" or words[0][-1].isspace()
            for word in words[1:]:
                if open_:
                    merged[-1] += " " + word
                else:
                    merged.append(word)
                open_ = word == "" or word[-1].isspace()
            words = merged
        words[0] = (words[0],)
        return words

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self.memo.runs_of([self._cut(text) if text else [] for text in texts])

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of ids, concatenated up a tree of halves."""
        if len(ids) <= 4096:
            return b"".join(map(self.tokens.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


@functools.lru_cache(maxsize=2)
def bpe(path: str, pattern: str) -> Bpe:
    return Bpe(path, pattern)


def _mapped(df: DataFrame, source: str, added: list[tuple[str, str]], made) -> DataFrame:
    """Add columns that ``made`` gives for portions of a column; no shuffle.

    Only a portion of a batch is ever unpacked to Python values.
    """
    names = {name for name, _ in added}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index(source)
            kept = [k for k, column in enumerate(batch.schema.names) if column not in names]
            column = batch.column(at)
            measure = pc.list_value_length if pa.types.is_list(column.type) else pc.binary_length
            sizes = pc.fill_null(measure(column), 0).to_numpy(zero_copy_only=False)
            for a, b in common.portions(list(map(range, sizes.tolist())), 1_000_000):
                part = batch.slice(a, b - a)
                columns = [part.column(k) for k in kept] + made(part.column(at))
                yield pa.RecordBatch.from_arrays(columns, [batch.schema.names[k] for k in kept] + [n for n, _ in added])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in names]
    return df.mapInArrow(work, ", ".join(fields + [f"{name} {kind}" for name, kind in added]))


def encode(
    df: DataFrame, vocabulary: str, pattern: str, text: str = "text", name: str = "ids", decoded: str | None = None
) -> DataFrame:
    """Add the ids of a text column (it replaces a column of that name).

    ``decoded`` names a further column for the bytes that the ids decode to.
    """

    def made(texts: pa.Array) -> list[pa.Array]:
        table = bpe(vocabulary, pattern)
        runs = table.encode([t or "" for t in texts.to_pylist()])
        column = common.lists([r.astype("int32") for r in runs], pa.int32())
        if decoded is None:
            return [column]
        return [column, pa.array([table.decode(r.tolist()) for r in runs], "binary")]

    return _mapped(df, text, [(name, "array<int>"), *([(decoded, "binary")] if decoded else [])], made)


def decode(df: DataFrame, vocabulary: str, pattern: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Add the bytes of a column of ids (null ids give null)."""

    def made(runs: pa.Array) -> list[pa.Array]:
        table = bpe(vocabulary, pattern)
        return [pa.array([None if run is None else table.decode(run) for run in runs.to_pylist()], "binary")]

    return _mapped(df, ids, [(name, "binary")], made)
