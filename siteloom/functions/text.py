"""Units of a text as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shingles(text: Column | str, width: int = 3) -> Column:
    """All overlapping ``width``-character pieces of a text, in order, case kept.

    One pattern looks ahead for a piece and moves on by one character, so the
    cost grows with the length. (Taking ``substring`` at each place would walk
    the text from its start every time.)
    """
    if width < 1:
        raise ValueError("width must be at least 1")
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(text, F.lit(rf"(?s)(?=(.{{{width}}}))."), F.lit(1))


def characters(text: Column | str) -> Column:
    """The characters of a text."""
    return shingles(text, 1)


# The widths of the units above, for jobs that cut whole batches of texts at once.
WIDTHS = {shingles: 3, characters: 1}


def jaccard(left: Column, right: Column) -> Column:
    """Size of the intersection over size of the union of two sets, as arrays; 1.0 if both are empty."""
    shared = F.size(F.array_intersect(left, right))
    total = F.size(left) + F.size(right)
    return F.when(total == 0, F.lit(1.0)).otherwise(shared / (total - shared))
