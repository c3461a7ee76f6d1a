"""Near-duplicate pages: candidates by signature, verified by similarity.

A page is a duplicate if an earlier page that is kept shares a key with it (the whole
signature, or with ``any_band`` one of its bands) and has a similarity of at least the
threshold; pages are taken in id order and stored pages come before new ones. Groups of one
key may be large, so pairs are never formed within a whole group:

1. exact copies are folded into their first page by a fingerprint;
2. per round, the first few undecided pages of each key are settled among
   themselves (a bounded number of pairs), and
3. all others of the key are compared only with those of them that are kept.

The work grows with (pages) x (kept pages of their key), as it must: a page
is a duplicate or not only by comparison with the kept ones.

Pairs are pairs of ids, with lengths and letter counts as bounds of the similarity. Only
what passes these is verified: then a text travels once for each block of pages that
it is compared with, never once a pair.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siteloom.functions.text import jaccard, shingles
from siteloom.operators import similar
from siteloom.operators.blocks import Blocks
from siteloom.operators.minhash import Scheme, signatures
from siteloom.operators.skew import MIN_ROWS, hot_keys, repeated, salted
from siteloom.session import materialise

# Fixed value: the similarity from which a page is a duplicate.
THRESHOLD = 0.9
BLOCK = 32
MAX_BLOCK = 256
# A block by sketches goes up to so many pages, while no key has more than so many pairs of them.
MOST_BLOCK, BLOCK_PAIRS = 4096, 1 << 11
# A group of the verification: a sixteenth of a key's kept pages, and as many later ones as make about so many pairs.
KEPT_BLOCKS, GROUP_PAIRS = 16, 128
LETTERS = "etaoinshrdlucmfwypvbgkjqxz 0123456789.,-"

DECISION = "page_id long, orig_id long, score double"
DESCRIBED = ["page_id", "n_chars", "print1", "print2", "has_units", "bands", "sig"]


@dataclass(frozen=True)
class Similarity:
    """A similarity of two pages.

    ``prepare`` turns a lower-cased text into what is compared, once per page.
    ``score`` takes (later, earlier, threshold) and may give NULL for pairs that
    cannot reach the threshold. ``length_ratio`` gives, for a threshold, the
    least shorter-to-longer length ratio that can reach it (0 if lengths say nothing).
    ``profile`` counts what a prepared text is made of, and ``reach`` gives the highest
    score that two profiles allow. ``units`` are the hashes of a set that the similarity is bound by: ``apart`` gives,
    for a threshold, the most units that two sets of given sizes may hold alone (:mod:`siteloom.operators.similar`), and
    ``units_ratio`` the least smaller-to-larger ratio of their sizes; pairs are bound by them too, in place of ``profile``
    and ``reach``. ``texts`` makes such sketches of prepared texts
    instead, with sizes in letters (:func:`siteloom.operators.similar.texts`).
    """

    score: Callable[[Column, Column, float], Column]
    length_ratio: Callable[[float], float]
    prepare: Callable[[Column], Column] = lambda text: text
    profile: Callable[[Column], Column] = lambda text: F.array(F.lit(0))
    reach: Callable[[Column, Column], Column] = lambda later, earlier: F.lit(1.0)
    units: Callable[[Column], Column] | None = None
    apart: Callable[[float], Callable] | None = None
    units_ratio: Callable[[float], float] = lambda t: 0.0
    texts: Callable | None = None


def letter_counts(text: Column) -> Column:
    """How often each of ``LETTERS`` occurs, and how often any other character."""
    counts = [F.length(text) - F.length(F.replace(text, F.lit(letter), F.lit(""))) for letter in LETTERS]
    return F.array(*counts, F.length(text) - reduce(lambda a, b: a + b, counts))


def _common(one: Column, two: Column) -> Column:
    """At most so many characters of two texts can be paired off."""
    return reduce(lambda a, b: a + b, [F.least(one[k], two[k]) for k in range(len(LETTERS) + 1)])


def _total(one: Column) -> Column:
    return reduce(lambda a, b: a + b, [one[k] for k in range(len(LETTERS) + 1)])


def _letters_of_ratio(later: Column, earlier: Column) -> Column:
    both = _total(later) + _total(earlier)
    return F.when(both == 0, F.lit(1.0)).otherwise(2 * _common(later, earlier) / both)


def _letters_of_edits(later: Column, earlier: Column) -> Column:
    longest = F.greatest(_total(later), _total(earlier))
    return F.when(longest == 0, F.lit(1.0)).otherwise(_common(later, earlier) / longest)


def matching_blocks(autojunk: bool) -> Similarity:
    """Ratcliff-Obershelp ratio; ``autojunk`` as in the standard library's matcher.

    With it, letters that make up more than a hundredth of a text of 200 characters or more are no anchors, so one
    changed letter may give 0.0 there. Without it long texts are slow. The Jaccard form has no such switch.

    With it, blocks are few, as each but the first holds an anchor; so texts must share most of their longer grams, and pages
    of a key are split into groups by them (:func:`siteloom.operators.similar.apart_by_blocks`).
    Without it, twice the longest common subsequence over both lengths is a bound; it takes one step of whole-text bit
    arithmetic a character and spares most pairs the matcher. Blocks are sought in the largest gaps first, until
    the letters that are left cannot reach the threshold (:mod:`siteloom.operators.blocks`).
    """

    # Nested, so that the function travels to the workers by value.
    def score(later: Column, earlier: Column, threshold: float = 0.0) -> Column:
        @F.pandas_udf("double")
        def ratio(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            held: dict = {"text": None}

            def places(b: str) -> dict[str, int]:
                """A bit for each place at which a letter stands."""
                found: dict[str, list[int]] = {}
                for k, letter in enumerate(b):
                    found.setdefault(letter, []).append(k)
                masks = {}
                for letter, at in found.items():
                    bits = bytearray(len(b) // 8 + 1)
                    for k in at:
                        bits[k >> 3] |= 1 << (k & 7)
                    masks[letter] = int.from_bytes(bits, "little")
                return masks

            def common(a: str, masks: dict[str, int], size: int, need: float) -> bool:
                """Whether the longest common subsequence may have ``need`` letters or more."""
                full = (1 << size) - 1
                state = full
                for k, letter in enumerate(a):
                    if mask := masks.get(letter):
                        step = state & mask
                        state = ((state + step) | (state - step)) & full
                    if k & 255 == 255 and size - state.bit_count() + len(a) - k - 1 < need:
                        return False
                return size - state.bit_count() >= need

            def one(a: str, b: str) -> float | None:
                if held["text"] != b:  # pairs of one earlier page follow each other
                    held.update(text=b, masks=places(b) if threshold and not autojunk else None, blocks=None)
                need = threshold * (len(a) + len(b)) / 2 - 1e-6
                if held["masks"] is not None and not common(a, held["masks"], len(b), need):
                    return None
                if held["blocks"] is None:
                    held["blocks"] = Blocks(b, autojunk)
                found = held["blocks"].letters(a, need)
                if found is None:
                    return None
                return 2.0 * found / (len(a) + len(b)) if a or b else 1.0

            for a_texts, b_texts in batches:
                yield pd.Series([one(a, b) for a, b in zip(a_texts, b_texts)], dtype="float64")

        return ratio(later, earlier)

    # At most all of the shorter text matches: 2 * short / (short + long) >= t.
    def lengths(t: float) -> float:
        return t / (2 - t)

    split = {"apart": similar.apart_by_blocks, "units_ratio": lengths, "texts": similar.texts} if autojunk else {}
    return Similarity(score, lengths, profile=letter_counts, reach=_letters_of_ratio, **split)


def levenshtein_ratio() -> Similarity:
    """1 - edits / longer length, on the JVM side."""

    def score(later: Column, earlier: Column, threshold: float = 0.0) -> Column:
        longest = F.greatest(F.length(later), F.length(earlier))
        return F.when(longest == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(later, earlier) / longest)

    return Similarity(score, lambda t: t, profile=letter_counts, reach=_letters_of_edits)


def shingle_jaccard(shingle: Callable[[Column], Column] = shingles) -> Similarity:
    """Jaccard similarity of the sets of shingles, on the JVM side."""

    # Nested, so that the function travels to the workers by value.
    def apart(threshold: float) -> Callable:
        # Sets of sizes m and n share t / (1 + t) * (m + n) at least; a hair more, as it is computed in doubles.
        share = (1 - threshold) / (1 + threshold)
        return lambda one, other: (one + other) * share + 1e-6

    return Similarity(
        lambda later, earlier, threshold=0.0: jaccard(later, earlier),
        lambda t: 0.0,
        lambda text: F.array_distinct(shingle(text)),
        units=lambda found: F.transform(found, lambda unit: F.xxhash64(unit)),
        apart=apart,
        units_ratio=lambda t: t,
    )


def signature_keys(sigs: DataFrame, match: str = "full") -> DataFrame:
    """``(…, key)``: what candidates must share, for texts that have units.

    ``full`` is the whole signature; ``any_band`` gives one row per band.
    """
    known = sigs.where("has_units")
    if match == "full":
        return known.withColumn("key", F.col("sig"))
    if match == "any_band":
        banded = known.select("*", F.posexplode("bands").alias("no", "_band"))
        return banded.withColumn("key", F.concat_ws(":", "no", "_band")).drop("_band")
    raise ValueError(f"match must be 'full' or 'any_band', not {match!r}")


def candidate_groups(sigs: DataFrame, match: str = "full", page_id: str = "page_id") -> DataFrame:
    """``(key, n_pages, first_id, n_pairs)`` of every key that at least two pages share.

    Tells what a verification would cost without forming any pair.
    """
    grouped = signature_keys(sigs, match).groupBy("key").agg(
        F.count("*").alias("n_pages"), F.min(page_id).alias("first_id")
    )
    pairs = (F.col("n_pages") * (F.col("n_pages") - 1) / 2).cast("long")
    return grouped.where(F.col("n_pages") > 1).withColumn("n_pairs", pairs)


def _length_band(n_chars: Column, least_ratio: float) -> Column:
    """Texts whose lengths allow the threshold lie in the same band or in neighbours."""
    if least_ratio <= 0:
        return F.lit(0)
    width = -math.log(least_ratio) * (1 + 1e-6) or 1e-9
    return F.floor(F.log(n_chars + 1) / width).cast("int")


def _sketched_candidates(later: DataFrame, kept: DataFrame, similarity: Similarity, threshold: float, hot_rows: int) -> DataFrame:
    """:func:`_candidates` by sketches, which are compared behind one exchange before a pair becomes a row."""
    hot = hot_keys(later, "key", min_rows=hot_rows)
    before = F.lit(None).cast("array<bigint>")
    if "no" in later.columns:
        before = F.slice("bands", 1, F.col("no"))
        if later.schema["bands"].dataType != T.ArrayType(T.LongType(), later.schema["bands"].dataType.containsNull):
            before = F.transform(before, lambda band: F.xxhash64(band))

    def side(rows: DataFrame, n: int) -> DataFrame:
        return rows.select("key", "_salt", F.lit(n).alias("side"), F.col("page_id").cast("long"), "is_new", "profile.size", "profile.sketch", before.alias("before"))

    one = side(salted(later.where("is_new"), hot, "key", [F.col("page_id")]), 1)
    return similar.pairs(one.unionByName(side(repeated(kept, hot, "key"), 2)), similarity.apart(threshold))


def _candidates(later: DataFrame, kept: DataFrame, similarity: Similarity, threshold: float, hot_rows: int) -> DataFrame:
    """Pairs ``(page_id, orig_id, orig_new, key)`` of later pages with kept ones of their key that the bounds allow.

    Both sides are rows of ids, lengths and letter counts or sketches; texts stay where they are.
    """
    if similarity.units is not None:
        return _sketched_candidates(later, kept, similarity, threshold, hot_rows)
    least = similarity.length_ratio(threshold)
    reach = F.array(F.lit(0)) if least <= 0 else F.array(F.lit(-1), F.lit(0), F.lit(1))
    hot = hot_keys(later, "key", min_rows=hot_rows)
    banded = ["bands", "no"] if "no" in later.columns else []
    left = salted(later.select("page_id", "key", "is_new", "n_chars", "band", "profile", *banded), hot, "key", [F.col("page_id")])
    right = repeated(kept, hot, "key").select(
        "key",
        "_salt",
        F.explode(F.transform(reach, lambda step: F.col("band") + step)).alias("band"),
        F.col("page_id").alias("orig_id"),
        F.col("is_new").alias("orig_new"),
        F.col("n_chars").alias("_orig_chars"),
        F.col("profile").alias("_orig_profile"),
        *([F.col("bands").alias("_orig_bands")] if banded else []),
    )
    comes_first = F.struct("orig_new", "orig_id") < F.struct("is_new", "page_id")
    short = F.least("n_chars", "_orig_chars")
    long = F.greatest("n_chars", "_orig_chars")
    # The same bound as the bands, without their slack; a hair below, as it is computed in doubles.
    possible = (short >= long * (least - 1e-9)) & (
        similarity.reach(F.col("profile"), F.col("_orig_profile")) >= threshold - 1e-9
    )
    if banded:  # a pair that shares several bands counts at the first of them
        alike = F.zip_with("bands", "_orig_bands", lambda a, b: a == b)
        possible = possible & (F.array_position(alike, True) == F.col("no") + 1)
    pairs = left.where("is_new").join(right, ["key", "_salt", "band"]).where(comes_first & possible)
    return pairs.select("page_id", "orig_id", "orig_new", "key")


def _verify(pairs: DataFrame, texts: DataFrame, similarity: Similarity, threshold: float) -> DataFrame:
    """The pairs ``(page_id, orig_id, orig_new, key, score)`` that reach the threshold.

    Pairs are dealt into groups: some of a key's kept pages and some of the later ones. Each page's text goes to
    a group once; the pairs are put together there, behind the exchange.
    """
    group = ["key", "kept", "slice"]
    pairs = pairs.withColumn("kept", F.pmod(F.xxhash64("orig_id"), F.lit(KEPT_BLOCKS)).cast("int"))
    sizes = pairs.groupBy("key", "kept").agg(F.ceil(F.count("*") / GROUP_PAIRS).cast("int").alias("_slices"))
    dealt = pairs.join(sizes, ["key", "kept"]).withColumn("slice", F.pmod(F.xxhash64("page_id"), "_slices").cast("int"))
    dealt = materialise(dealt.select(*group, "page_id", "orig_id", "orig_new"))
    later = dealt.groupBy(*group, "page_id").agg(F.collect_list("orig_id").alias("partners"))
    earlier = dealt.select(*group, "orig_id", "orig_new").distinct()
    bodies = texts.select("page_id", "text")
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = earlier.join(bodies.select(F.col("page_id").alias("orig_id"), F.col("text").alias("_orig_text")), "orig_id")
    right = later.join(bodies, "page_id")
    # A sorted join, so that the pairs of one earlier page follow each other.
    beside = left.repartition(tasks, *group).join(right.repartition(tasks, *group).hint("merge"), group)
    # The score comes out of a generator, so that the filter on it does not score every pair a second time.
    scored = beside.where(F.array_contains("partners", F.col("orig_id"))).select(
        "page_id",
        "orig_id",
        "orig_new",
        "key",
        F.explode(F.array(similarity.score(F.col("text"), F.col("_orig_text"), threshold))).alias("score"),
    )
    return scored.where(F.col("score") >= threshold)


def _settle_blocks(pairs: DataFrame) -> DataFrame:
    """Decisions within the blocks: a page with a kept earlier partner is a duplicate of the first such."""

    # The pairs within one block of one key, ids only.
    def settle(rows: pd.DataFrame) -> pd.DataFrame:
        found, duplicates = [], set()
        ordered = rows.sort_values(["page_id", "orig_new", "orig_id"])
        for page_id, partners in ordered.groupby("page_id", sort=True):
            for orig_id, score in zip(partners["orig_id"], partners["score"]):
                if orig_id not in duplicates:
                    duplicates.add(page_id)
                    found.append((page_id, orig_id, score))
                    break
        return pd.DataFrame(found, columns=["page_id", "orig_id", "score"]).astype(
            {"page_id": "int64", "orig_id": "int64", "score": "float64"}
        )

    return pairs.groupBy("key").applyInPandas(settle, DECISION)


def _first_match(pairs: DataFrame) -> DataFrame:
    first = F.min_by(F.struct("orig_id", "score"), F.struct("orig_new", "orig_id"))
    return pairs.groupBy("page_id").agg(first.alias("_m")).select("page_id", "_m.orig_id", "_m.score")


def _decide(members: DataFrame, texts: DataFrame, similarity: Similarity, threshold: float, block: int, hot_rows: int) -> DataFrame:
    """Rounds over blocks of the first undecided pages of each signature."""

    def compare(later: DataFrame, kept: DataFrame) -> DataFrame:
        return _verify(_candidates(later, kept, similarity, threshold, hot_rows), texts, similarity, threshold)

    # With this filter Spark keeps only the first rows per key before it shuffles.
    place = F.row_number().over(Window.partitionBy("key").orderBy("is_new", "page_id"))
    decisions = []
    undecided = members.select("page_id", "key", "is_new")
    while True:
        chosen = undecided.withColumn("_place", place).where(F.col("_place") <= block)
        heads = materialise(members.join(chosen.select("page_id"), "page_id", "left_semi"))
        settled = materialise(_settle_blocks(compare(heads, heads)))
        decisions.append(settled)
        rest = undecided.join(heads.select("page_id"), "page_id", "left_anti")
        if rest.isEmpty():
            break
        kept = heads.join(settled, "page_id", "left_anti")
        later = members.join(rest.select("page_id"), "page_id", "left_semi")
        matched = materialise(_first_match(compare(later, kept)))
        decisions.append(matched)
        undecided = materialise(rest.join(matched, "page_id", "left_anti"))
        if undecided.isEmpty():
            break
        block = min(2 * block, MAX_BLOCK)
    return reduce(DataFrame.unionByName, decisions)


def _decide_any(members: DataFrame, texts: DataFrame, similarity: Similarity, threshold: float, block: int, hot_rows: int) -> DataFrame:
    """Rounds for pages that lie in several keys, so that no key decides alone.

    The verified pairs are a graph, and the kept pages its first independent set in page order. A page is *ready*
    if it is among the first ``block`` undecided pages of all its keys: then every undecided page that comes
    before it and shares a key stands in one of those blocks. A ready page without a verified pair among them
    is kept, as the kept pages of earlier rounds were all compared with it. New kept pages are compared with all later ones
    of their keys; those are duplicates. A duplicate's original may still become an earlier page that is kept
    in a later round, so duplicates go on to be compared with kept pages before their original.

    The first undecided page is always ready, so each round decides some. Where sketches leave few pairs in a block, as in a
    long chain of pages that are hardly alike, the next block is four times as large: so rounds are few.
    """

    def compare(later: DataFrame, kept: DataFrame) -> DataFrame:
        return _candidates(later, kept, similarity, threshold, hot_rows)

    ids = ["page_id", "orig_id"]
    stored = members.where(~F.col("is_new"))
    matched = materialise(_first_match(_verify(compare(members, stored), texts, similarity, threshold)))
    # (page_id, orig_id, score, final): stored pages come first, so those originals stand.
    found = matched.withColumn("final", F.lit(True))
    new = members.where("is_new")
    undecided = materialise(new.select("page_id").distinct().join(matched, "page_id", "left_anti"))
    place = F.row_number().over(Window.partitionBy("key").orderBy("page_id"))
    tested = None  # pairs of undecided pages that were verified, with their score or NULL
    while not undecided.isEmpty():
        open_ = new.join(undecided, "page_id", "left_semi")
        keys = open_.groupBy("page_id").agg(F.count("*").alias("_keys"))
        blocks = open_.select("page_id", "key").withColumn("_place", place).where(F.col("_place") <= block)
        heads = materialise(blocks.select("page_id", "key"))
        full = heads.groupBy("page_id").agg(F.count("*").alias("_held"))
        ready = materialise(keys.join(full, "page_id").where("_held = _keys").select("page_id"))
        head_rows = open_.join(heads, ["page_id", "key"], "left_semi")
        pairs = compare(head_rows.join(ready, "page_id", "left_semi"), head_rows)
        if tested is not None:
            pairs = pairs.join(tested.select(*ids), ids, "left_anti")
        pairs = materialise(pairs)
        busiest = pairs.groupBy("key").count()
        edges = materialise(pairs.select(*ids).join(_verify(pairs, texts, similarity, threshold).select(*ids, "score"), ids, "left"))
        if tested is not None:
            edges = edges.unionByName(tested)
        linked = edges.where(F.col("score").isNotNull()).select("page_id")
        kept = materialise(ready.join(linked, "page_id", "left_anti"))
        # Kept pages with all later pages of their keys: undecided ones, and duplicates of a later original.
        later_ids = undecided.join(kept, "page_id", "left_anti").withColumn("_before", F.lit(None).cast("long"))
        loose = found.where(~F.col("final")).select("page_id", F.col("orig_id").alias("_before"))
        asked = materialise(later_ids.unionByName(loose))
        pairs = compare(new.join(asked, "page_id", "left_semi"), new.join(kept, "page_id", "left_semi"))
        pairs = pairs.join(asked, "page_id").where(F.col("_before").isNull() | (F.col("orig_id") < F.col("_before"))).drop("_before")
        fresh = materialise(pairs.join(edges.select(*ids), ids, "left_anti"))
        hits = _verify(fresh, texts, similarity, threshold).select(*ids, "score").unionByName(
            edges.where(F.col("score").isNotNull()).join(kept.withColumnRenamed("page_id", "orig_id"), "orig_id", "left_semi").select(*ids, "score")
        )
        matches = hits.groupBy("page_id").agg(F.min_by(F.struct("orig_id", "score"), "orig_id").alias("_m"))
        matches = materialise(matches.select("page_id", "_m.orig_id", "_m.score", F.lit(False).alias("final")))
        found = materialise(found.join(matches, "page_id", "left_anti").unionByName(matches))
        undecided = materialise(undecided.join(kept, "page_id", "left_anti").join(matches, "page_id", "left_anti"))
        both = edges.join(undecided, "page_id", "left_semi")
        tested = materialise(both.join(undecided.withColumnRenamed("page_id", "orig_id"), "orig_id", "left_semi").select(*ids, "score"))
        sparse = similarity.units is not None and busiest.where(F.col("count") > BLOCK_PAIRS).isEmpty()
        block = min(4 * block, MOST_BLOCK) if sparse else min(2 * block, MAX_BLOCK)
    return found.select("page_id", "orig_id", "score")


def described(pages: DataFrame, vocab: DataFrame, scheme: Scheme, *, page_id: str = "page_id", text: str = "text") -> DataFrame:
    """What is known of a page without its text: ``page_id, n_chars, print1, print2, has_units, bands, sig``.

    ``print1`` and ``print2`` are hashes of the lower-cased text.
    """
    lowered = F.lower("text")
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(text).alias("text")).withColumns(
        {"n_chars": F.length(lowered).cast("long"), "print1": F.xxhash64(lowered), "print2": F.xxhash64(F.lit(1), lowered)}
    )
    return signatures(rows, vocab, scheme, doc_id="page_id", carry=["n_chars", "print1", "print2"]).select(*DESCRIBED)


def copy_key() -> Column:
    """Equal for pages of equal lower-cased text."""
    return F.concat_ws("/", "sig", "n_chars", "print1", "print2")


def _grouped(slim: DataFrame, prepared: DataFrame, similarity: Similarity, threshold: float) -> DataFrame:
    """Pages that may have a partner, their keys split into groups that no pair at the threshold crosses."""
    if similarity.texts is None:
        sketched = similar.sketches(prepared.select("page_id", similarity.units(F.col("text")).alias("units")))
    else:
        sketched = prepared.select("page_id", F.length("text").cast("long").alias("size"), F.col("text").cast("binary").alias("sketch"))
    found = similar.groups(slim, materialise(sketched), similarity.apart(threshold), similarity.units_ratio(threshold), similarity.texts)
    keyed = slim.join(found, "page_id").withColumn("key", F.concat_ws("@", "key", "group")).drop("group")
    shared = keyed.groupBy("key").agg(F.count("*").alias("_n"), F.bool_or("is_new").alias("_any"))
    return keyed.join(shared.where((F.col("_n") > 1) & F.col("_any")), "key", "left_semi")


def _duplicates(
    sigs: DataFrame,
    texts_of: Callable[[DataFrame], DataFrame],
    match: str,
    similarity: Similarity,
    threshold: float,
    block: int,
    hot_rows: int,
) -> DataFrame:
    """Decisions on described pages with ``is_new``; ``texts_of`` gives (page_id, text) for rows (page_id, is_new, key)."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    if block < 1:
        raise ValueError("block must be at least 1")
    sigs = sigs.withColumn("_copy", copy_key())

    # 1. Exact copies: (page_id, rep_id, is_new). New pages fold into the first new one, which
    # still meets all stored pages; texts without units meet nothing else, so they fold
    # into stored ones as well.
    sided = sigs.select("page_id", "is_new", "_copy", (F.col("has_units") & F.col("is_new")).alias("_side"))
    groups = sided.groupBy("_copy", "_side").agg(
        F.min_by("page_id", F.struct("is_new", "page_id")).alias("rep_id"), F.count("*").alias("_n")
    )
    shared = groups.where(F.col("_n") > 1).select("_copy", "_side", "rep_id")
    hot = hot_keys(sigs, "_copy", min_rows=hot_rows)
    copies = materialise(
        salted(sided, hot, "_copy", [F.col("page_id")])
        .join(repeated(shared, hot, "_copy"), ["_copy", "_side", "_salt"])
        .where(F.col("page_id") != F.col("rep_id"))
        .select("page_id", "rep_id", "is_new")
    )

    # 2. Pages that share a key with another page, with their texts.
    keyed = signature_keys(sigs.join(copies, "page_id", "left_anti"), match)
    contested_keys = keyed.groupBy("key").agg(F.count("*").alias("_n"), F.bool_or("is_new").alias("_any"))
    contested = keyed.join(contested_keys.where((F.col("_n") > 1) & F.col("_any")), "key", "left_semi")
    banded = ["bands", "no"] if match == "any_band" else []
    # The key stays as it is in ``asked``: the index of stored texts goes by it.
    slim = materialise(contested.select("page_id", "key", F.col("key").alias("asked"), "is_new", "n_chars", *banded))

    def prepared_of(slim: DataFrame) -> DataFrame:
        wanted = slim.select("page_id", "is_new").distinct() if banded else slim.select("page_id", "is_new", F.col("asked").alias("key"))
        return wanted.join(texts_of(wanted), "page_id").select("page_id", similarity.prepare(F.lower("text")).alias("text"))

    if similarity.units is not None or similarity.texts is not None:
        slim = materialise(_grouped(slim, prepared_of(slim), similarity, threshold))
    prepared = prepared_of(slim)
    # One table: rounds read its small columns, and texts only where pairs are verified.
    if similarity.units is None:
        texts = materialise(prepared.withColumn("profile", similarity.profile(F.col("text"))))
        profiles = texts.select("page_id", "profile")
    else:
        texts = materialise(prepared)
        sketched = similar.sketches(texts.select("page_id", similarity.units(F.col("text")).alias("units")), similar.PAIR_BITS, similar.PAIR_BITS)
        profiles = sketched.select("page_id", F.struct("size", "sketch").alias("profile"))
    band = _length_band(F.col("n_chars"), similarity.length_ratio(threshold))
    members = materialise(slim.drop("asked").withColumn("band", band).join(profiles, "page_id"))

    # 3. Decide.
    decide = _decide if match == "full" else _decide_any
    decided = decide(members, texts, similarity, threshold, block, hot_rows)
    followed = copies.where("is_new").join(decided.withColumnRenamed("page_id", "rep_id"), "rep_id", "left").select(
        "page_id",
        F.coalesce("orig_id", "rep_id").alias("orig_id"),
        F.coalesce("score", F.lit(1.0)).alias("score"),
    )
    return decided.select("page_id", "orig_id", "score").unionByName(followed)


def near_duplicates(
    pages: DataFrame,
    vocab: DataFrame,
    scheme: Scheme,
    *,
    history: DataFrame | None = None,
    similarity: Similarity,
    match: str = "full",
    threshold: float = THRESHOLD,
    block: int = BLOCK,
    hot_rows: int = MIN_ROWS,
    page_id: str = "page_id",
    text: str = "text",
) -> DataFrame:
    """``(page_id, orig_id, score)`` of the duplicates among ``pages``.

    With ``history`` (stored pages that were kept, same columns) the pages are a
    new batch: they are compared with the stored ones and with each other. ``match`` says what candidates
    share: the ``full`` signature or ``any_band`` of it. Texts without any vocabulary unit share one signature, so only
    their exact copies count. ``similarity`` has no default: :func:`shingle_jaccard` is the one to start with.
    """

    def columns(df: DataFrame) -> DataFrame:
        return df.select(F.col(page_id).alias("page_id"), F.col(text).alias("text"))

    def signed(df: DataFrame, is_new: bool) -> DataFrame:
        return described(columns(df), vocab, scheme).withColumn("is_new", F.lit(is_new))

    sigs, everything = signed(pages, True), columns(pages)
    if history is not None:
        sigs, everything = sigs.unionByName(signed(history, False)), everything.unionByName(columns(history))
    return _duplicates(materialise(sigs), lambda wanted: everything, match, similarity, threshold, block, hot_rows)


def dedup_signed(
    new: DataFrame,
    index,
    *,
    before: int | None = None,
    signed: DataFrame | None = None,
    similarity: Similarity,
    threshold: float = THRESHOLD,
    block: int = BLOCK,
    hot_rows: int = MIN_ROWS,
    page_id: str = "page_id",
    text: str = "text",
) -> DataFrame:
    """:func:`dedup_batch` against a :class:`siteloom.sources.signed.SignatureIndex` of the stored pages.

    Stored pages are neither read nor signed again: the batch's keys meet the index where it lies, and texts are
    read only from the parts that hold a contested key. ``before`` leaves out batches from that number on.
    ``signed`` gives the new pages as the index describes them, if that is done already.
    """
    columns = new.select(F.col(page_id).alias("page_id"), F.col(text).alias("text"))
    signed = (materialise(described(columns, index.vocab, index.scheme)) if signed is None else signed).select(*DESCRIBED)
    hits = index.hits(signed, before)
    sigs = signed.withColumn("is_new", F.lit(True)).unionByName(hits.withColumn("is_new", F.lit(False)))

    def texts_of(wanted: DataFrame) -> DataFrame:
        stored = wanted.where(~F.col("is_new")).select("page_id", "key")
        return columns.unionByName(index.texts(stored, before).select("page_id", "text"))

    return _duplicates(materialise(sigs), texts_of, "full", similarity, threshold, block, hot_rows)


def mark(pages: DataFrame, duplicates: DataFrame, *, page_id: str = "page_id", content: str = "html") -> DataFrame:
    """Pages with ``page_type_code`` HTML or DUPLICATE; duplicates lose their content."""
    marks = duplicates.select(F.col("page_id").alias(page_id), F.lit("DUPLICATE").alias("_mark"))
    joined = pages.join(marks, page_id, "left")
    kept = F.when(F.col("_mark").isNull(), F.col(content))
    return joined.withColumns({"page_type_code": F.coalesce("_mark", F.lit("HTML")), content: kept}).drop("_mark")


def duplicate_links(duplicates: DataFrame) -> DataFrame:
    """``link`` rows from each original to its duplicates."""
    return duplicates.select(F.col("orig_id").alias("from_page"), F.col("page_id").alias("to_page"))


def followed_links(links: DataFrame, duplicates: DataFrame) -> DataFrame:
    """Links without those on duplicate pages, which are not followed."""
    return links.join(duplicates.select("page_id"), "page_id", "left_anti")


def dedup_batch(new: DataFrame, history: DataFrame, vocab: DataFrame, scheme: Scheme, **options) -> DataFrame:
    """Duplicates among newly arrived pages, against the kept stored pages and each other."""
    return near_duplicates(new, vocab, scheme, history=history, **options)


def duplicate_report(pages: DataFrame, duplicates: DataFrame) -> DataFrame:
    """``(n_pages, n_duplicates, n_originals)``."""
    totals = duplicates.agg(
        F.count("*").alias("n_duplicates"), F.count_distinct("orig_id").alias("n_originals")
    )
    counted = pages.agg(F.count("*").alias("n_pages"))
    # Both sides are one row.
    return counted.join(totals, F.lit(True))
