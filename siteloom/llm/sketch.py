"""Word shingles of whole texts, and their minwise signatures."""

from __future__ import annotations

import numpy as np

from siteloom.llm import common

WORDS = 5
SYMBOLS = 80

_STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], "uint64")


def shingles(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text.

    A-Z are lower-cased and words are split at ASCII white space. A text with fewer words
    has one shingle, its whole sequence; a text without words has none.
    """
    split = [text.encode().translate(common.LOWER).split() for text in texts]
    codes: dict[bytes, int] = {}
    rows = [np.array([codes.setdefault(w, len(codes)) for w in row], "int64") for row in split]
    hashes = common.word_hashes(list(codes))
    return [of_hashes(hashes[row], words) for row in rows]


def of_hashes(row: np.ndarray, words: int) -> np.ndarray:
    n = len(row)
    if not n:
        return row
    width = min(n, words)
    total = np.full(n - width + 1, width, "uint64")
    for k in range(width):
        total = common.mix(total + row[k : n - width + 1 + k] * _STEPS[k % len(_STEPS)])
    return np.unique(total)


def signature(found: np.ndarray, symbols: int = SYMBOLS) -> np.ndarray:
    """The least hash under each of ``symbols`` functions, in 16 bits each."""
    factors = common.mix(np.arange(1, symbols + 1, dtype="uint64") * _STEPS[0]) | np.uint64(1)
    least = np.full(symbols, np.iinfo("uint64").max, "uint64")
    for k in range(0, len(found), 512):
        part = found[k : k + 512]
        np.minimum(least, (part[None, :] * factors[:, None]).min(axis=1), out=least)
    return (common.mix(least) >> np.uint64(48)).astype("uint16")
