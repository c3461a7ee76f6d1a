"""Monotone integer sequences in Elias-Fano form, and quantised numbers, as bytes."""

from __future__ import annotations

import struct

import numpy as np
import zstandard


def encode(values: np.ndarray) -> bytes:
    """A non-decreasing sequence of non-negative integers.

    The high parts are a unary bit vector with a one for each value, the low parts stand packed behind it.
    """
    values = values.astype("uint64")
    n = len(values)
    if not n:
        return struct.pack("<QQQ", 0, 0, 0)
    low = min((int(values[-1]) // n).bit_length(), 56)
    high = (values >> np.uint64(low)).astype("int64") + np.arange(n)
    bits = np.zeros(-(-(int(high[-1]) + 1) // 64) * 64, "uint8")
    bits[high] = 1
    unary = np.packbits(bits, bitorder="little").tobytes()
    parts = []
    for start in range(0, n, 1 << 16):
        wide = values[start : start + (1 << 16)].astype("<u8").view("uint8").reshape(-1, 8)
        parts.append(np.packbits(np.unpackbits(wide, axis=1, count=low, bitorder="little"), bitorder="little").tobytes())
    packed = b"".join(parts)
    return struct.pack("<QQQ", n, low, len(unary)) + unary + packed.ljust(_packed_size(n, low), b"\0")


def _packed_size(n: int, low: int) -> int:
    """Bytes of the low parts: whole words, and one more, as eight bytes are read from any place."""
    return -(-n * low // 64) * 8 + 8 if n else 0


def _select(words: np.ndarray, before: np.ndarray, rank: np.ndarray, ones: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the bits of given ranks, and whether there is such a bit; ``before`` counts those before each word."""
    at = np.searchsorted(before, rank, side="right") - 1
    inside = at < len(words)
    word = words[np.minimum(at, len(words) - 1)]
    word = word if ones else ~word
    left, place = rank - before[at], 64 * at
    for width in (32, 16, 8, 4, 2, 1):
        count = np.bitwise_count(word & np.uint64((1 << width) - 1)).astype("int64")
        past = left >= count
        left = left - count * past
        place = place + width * past
        word = np.where(past, word >> np.uint64(width), word)
    return place, inside


class Sequence:
    """A sequence as it lies in a buffer; only what is asked for is read, beside a count of ones for each 64 bits of the high parts."""

    def __init__(self, data: memoryview, at: int = 0):
        self.n, self.low, size = struct.unpack_from("<QQQ", data, at)
        at += 24
        self.words = np.frombuffer(data, "<u8", size // 8, at)
        at += size
        self.end = at + _packed_size(self.n, self.low)
        self.packed = np.frombuffer(data, "uint8", self.end - at, at)
        self.ones = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype="int64")])
        self.zeros = 64 * np.arange(len(self.ones)) - self.ones

    def _low(self, index: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(index), "int64")
        bit = index * self.low
        eight = np.lib.stride_tricks.sliding_window_view(self.packed, 8)[bit >> 3].view("<u8").ravel()
        return ((eight >> (bit & 7).astype("uint64")) & np.uint64((1 << self.low) - 1)).astype("int64")

    def _under(self, high: np.ndarray) -> np.ndarray:
        """How many values have a smaller high part: the place of a zero, less the zeros before it."""
        zero = np.maximum(high - 1, 0)
        place, inside = _select(self.words, self.zeros, zero, False)
        return np.where(high <= 0, 0, np.where(inside, place - zero, self.n))

    def values(self, index: np.ndarray) -> np.ndarray:
        """The values at some places."""
        if not self.n:
            return np.zeros(len(index), "int64")
        place, _ = _select(self.words, self.ones, index, True)
        return (place - index) << self.low | self._low(index)

    def successor(self, asked: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The place of the least value that is not under each asked one, and whether it is the asked one.

        ``first`` and ``last`` bound the places (to those of a context). Only values of the same high part are compared.
        """
        if not self.n:
            return np.zeros(len(asked), "int64"), np.zeros(len(asked), "bool")
        high, target = asked >> self.low, asked & ((1 << self.low) - 1)
        a, b = self._under(high), self._under(high + 1)
        if first is not None:
            a, b = np.maximum(a, first), np.minimum(b, last)
            b = np.maximum(a, b)
        stop = b
        while len(open_ := np.flatnonzero(a < b)):
            middle = (a[open_] + b[open_]) >> 1
            under = self._low(middle) < target[open_]
            a[open_] = np.where(under, middle + 1, a[open_])
            b = b.copy() if b is stop else b
            b[open_] = np.where(under, b[open_], middle)
        same = a < stop
        return a, same & (self._low(np.minimum(a, self.n - 1)) == target)


def decode(data: memoryview, at: int = 0) -> tuple[np.ndarray, int]:
    """The sequence (as int64) at a place in a buffer, and the place after it."""
    made = Sequence(data, at)
    return made.values(np.arange(made.n)), made.end


def squeeze(arrays: list[np.ndarray]) -> bytes:
    """Arrays of integers for the network: bytes of equal weight together, compressed."""
    packer = zstandard.ZstdCompressor(level=1)
    parts = [struct.pack("<Q", len(arrays))]
    for a in arrays:
        wide = np.ascontiguousarray(a.astype("<i8").view("uint8").reshape(-1, 8).T)
        data = packer.compress(wide.tobytes())
        parts += [struct.pack("<QQ", len(a), len(data)), data]
    return b"".join(parts)


def expand(data: bytes) -> list[np.ndarray]:
    reader = zstandard.ZstdDecompressor()
    (count,), at, out = struct.unpack_from("<Q", data), 8, []
    for _ in range(count):
        n, size = struct.unpack_from("<QQ", data, at)
        wide = np.frombuffer(reader.decompress(data[at + 16 : at + 16 + size], max_output_size=8 * n + 1), "uint8")
        out.append(np.ascontiguousarray(wide.reshape(8, n).T).view("<i8").ravel())
        at += 16 + size
    return out
