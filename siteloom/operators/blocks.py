"""Matching blocks of two texts, as the standard library's matcher finds them, up to the point where a ratio is out of reach.

Where frequent letters are no anchors, the longest match begins as the longest run of rare letters that both texts hold
(the first in the later text, then in the earlier one) and is extended by any letters. Runs are short and few, so they are
looked up by length in arrays, in place of a step for each pair of equal letters.
"""

from __future__ import annotations

from collections.abc import Callable
from difflib import SequenceMatcher
from heapq import heappop, heappush

import numpy as np

# Longer runs of rare letters (a script of many letters, say) go to the standard library's matcher.
MOST_RUN = 24


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "uint32")


def _equal(one: np.ndarray, other: np.ndarray) -> int:
    """How many letters agree from the start."""
    size, at, step = min(len(one), len(other)), 0, 64
    while at < size:
        end = min(at + step, size)
        differ = one[at:end] != other[at:end]
        if differ.any():
            return at + int(differ.argmax())
        at, step = end, 2 * step
    return size


class Blocks:
    """Matching blocks of many later texts with one earlier text."""

    def __init__(self, earlier: str, autojunk: bool):
        self.b, self.autojunk = earlier, autojunk
        self.matcher: SequenceMatcher | None = None
        self.rare = None
        if autojunk and len(earlier) >= 200:
            self.points = _points(earlier)
            letters, counts = np.unique(self.points, return_counts=True)
            self.rare = letters[counts <= len(earlier) // 100 + 1]
            self.places = self._places(self.points)

    def _places(self, points: np.ndarray) -> np.ndarray:
        """The number of the rare letter at each place, or -1."""
        if not len(self.rare):
            return np.full(len(points), -1, "int64")
        at = np.minimum(np.searchsorted(self.rare, points), len(self.rare) - 1)
        return np.where(self.rare[at] == points, at, -1)

    def _runs(self, later: np.ndarray) -> list | None:
        """For each length the common runs of rare letters: places and numbers in both texts, and how many there are; None if too long."""
        sides = (self._places(later), self.places)
        at = [np.flatnonzero(side >= 0) for side in sides]
        keys = [side[p] for side, p in zip(sides, at)]
        found: list = []
        while True:
            common = np.intersect1d(*keys)
            if not len(common):
                return found
            if len(found) == MOST_RUN:
                return None
            for k in (0, 1):
                place = np.minimum(np.searchsorted(common, keys[k]), len(common) - 1)
                stays = common[place] == keys[k]
                at[k], keys[k] = at[k][stays], place[stays]
            found.append((at[0], keys[0], at[1], keys[1], len(common)))
            for k in (0, 1):
                end = at[k] + len(found)
                inside = end < len(sides[k])
                at[k], keys[k], end = at[k][inside], keys[k][inside], end[inside]
                goes_on = sides[k][end] >= 0
                at[k], keys[k] = at[k][goes_on], keys[k][goes_on] * len(self.rare) + sides[k][end[goes_on]]

    def _finder(self, later: str) -> tuple[Callable, int]:
        """``(alo, ahi, blo, bhi, top)`` to the longest match ``(i, j, k, run)`` of a gap whose runs have ``top`` letters at most."""
        points = runs = None
        if self.rare is not None:
            points = _points(later)
            runs = self._runs(points)
        if runs is None:
            if self.matcher is None:
                self.matcher = SequenceMatcher(None, "", self.b, self.autojunk)
            self.matcher.set_seq1(later)
            return lambda alo, ahi, blo, bhi, top: (*self.matcher.find_longest_match(alo, ahi, blo, bhi), top), 1

        def find(alo: int, ahi: int, blo: int, bhi: int, top: int) -> tuple[int, int, int, int]:
            i, j, run = alo, blo, 0
            for k in range(top, 0, -1):
                a_at, a_key, b_at, b_key, n = runs[k - 1]
                a = slice(*np.searchsorted(a_at, (alo, ahi - k + 1)))
                b = slice(*np.searchsorted(b_at, (blo, bhi - k + 1)))
                if a.start >= a.stop or b.start >= b.stop:
                    continue
                known = np.zeros(n, bool)
                known[b_key[b]] = True
                hits = known[a_key[a]]
                first = int(hits.argmax())
                if hits[first]:
                    i, run = int(a_at[a][first]), k
                    j = int(b_at[b][int((b_key[b] == a_key[a][first]).argmax())])
                    break
            back = _equal(points[alo:i][::-1], self.points[blo:j][::-1])
            size = back + run + _equal(points[i + run : ahi], self.points[j + run : bhi])
            return i - back, j - back, size, run

        return find, len(runs)

    def letters(self, later: str, need: float) -> int | None:
        """The letters in all matching blocks; None if below ``need``. The largest gaps come first."""
        find, top = self._finder(later)
        found, left = 0, min(len(later), len(self.b))
        gaps = [(-left, 0, len(later), 0, len(self.b), top)]
        while gaps:
            size, alo, ahi, blo, bhi, top = heappop(gaps)
            i, j, k, run = find(alo, ahi, blo, bhi, top)
            found, left = found + k, left + size
            if k and run:  # without an anchor the rest of the gap has no match
                for gap in ((alo, i, blo, j), (i + k, ahi, j + k, bhi)):
                    if size := min(gap[1] - gap[0], gap[3] - gap[2]):
                        heappush(gaps, (-size, *gap, run))
                        left += size
            if found + left < need:
                return None
        return found
