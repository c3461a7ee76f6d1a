"""Queries of near-duplicate detection over the documents."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog import derived as D
from catalog.registry import query
from siteloom.functions.text import characters
from siteloom.operators import dedup, minhash
from siteloom.operators.ordering import rank_in_group
from siteloom.session import checkpoint_dir, materialise
from siteloom.sources.signed import SignatureIndex

VOCAB = 2000
SCHEME = minhash.Scheme(num_bands=8, num_hash=32)
HISTORY = 3  # every third document is a stored one

GRAMS = """grams AS (
  SELECT doc_id, substr(text, i, 3) AS gram FROM (SELECT doc_id, text, unnest(range(1, length(text) - 1)) AS i FROM documents))"""
TOP = f"""{GRAMS}, vocab AS MATERIALIZED (
  SELECT gram, (row_number() OVER (ORDER BY n DESC, gram) - 1)::BIGINT AS idx, n
  FROM (SELECT gram, count(*) AS n FROM grams GROUP BY 1 ORDER BY n DESC, gram LIMIT {VOCAB}))"""
ENCODED = f"""{TOP}, encoded AS (SELECT DISTINCT doc_id, idx FROM grams JOIN vocab USING (gram))"""
PARAMETERS = minhash.hash_parameters(32)
HASHED = ", ".join(f"({a} * idx + {b}) % {minhash.PRIME} AS h{k}" for k, (a, b) in enumerate(PARAMETERS))
DENSE = f"""{TOP}, hashed AS MATERIALIZED (SELECT gram, {HASHED} FROM vocab), dense AS (
  SELECT d.doc_id, {', '.join(f"coalesce(min(h{k}), {minhash.SENTINEL})::BIGINT AS h{k}" for k in range(32))}
  FROM documents d LEFT JOIN (SELECT doc_id, hashed.* FROM (SELECT DISTINCT doc_id, gram FROM grams) JOIN hashed USING (gram)) e ON e.doc_id = d.doc_id GROUP BY 1)"""
BANDS = ", ".join("xor(" + " + ".join(f"h{k}" for k in range(4 * band, 4 * band + 4)) + ", 6)" for band in range(8))
SIGNED = f"""{DENSE}, signed AS (
  SELECT doc_id, h0 < {minhash.SENTINEL} AS has_units, [{BANDS}] AS bands FROM dense), sigs AS MATERIALIZED (
  SELECT doc_id, has_units, bands, array_to_string(bands, '-') AS sig FROM signed)"""


def _vocab(spark, sf):
    return materialise(minhash.vocabulary(D.documents(spark, sf), VOCAB))


def _signatures(spark, sf):
    return minhash.signatures(D.documents(spark, sf), _vocab(spark, sf), SCHEME)


@query(f"WITH {GRAMS} SELECT gram, count(*) AS n FROM grams GROUP BY 1")
def shingle_counts(spark, sf):
    return minhash.units(D.documents(spark, sf)).groupBy("gram").agg(F.count("*").alias("n"))


@query("""SELECT gram, count(*) AS n FROM (
    SELECT substr(text, i, 1) AS gram FROM (SELECT text, unnest(range(1, length(text) + 1)) AS i FROM documents)) GROUP BY 1""")
def character_counts(spark, sf):
    units = minhash.units(D.documents(spark, sf), shingle=characters)
    return units.groupBy("gram").agg(F.count("*").alias("n"))


@query(f"WITH {TOP} SELECT gram, idx, n FROM vocab")
def vocab_top(spark, sf):
    return minhash.vocabulary(D.documents(spark, sf), VOCAB)


@query(f"WITH {ENCODED} SELECT doc_id, count(*) AS n, sum(idx)::BIGINT AS idx_sum, max(idx) AS idx_max FROM encoded GROUP BY 1")
def encoded_documents(spark, sf):
    encoded = minhash.encode(D.documents(spark, sf), _vocab(spark, sf))
    return encoded.groupBy("doc_id").agg(
        F.count("*").alias("n"), F.sum("idx").alias("idx_sum"), F.max("idx").alias("idx_max")
    )


@query(f"WITH {DENSE} SELECT doc_id, {', '.join(f'h{k}' for k in range(32))} FROM dense")
def minhash_vectors(spark, sf):
    vectors = minhash.dense(D.documents(spark, sf), _vocab(spark, sf), SCHEME)
    return vectors.select("doc_id", *[F.col("dense")[k].alias(f"h{k}") for k in range(32)])


@query(f"WITH {SIGNED} SELECT doc_id, has_units, sig FROM sigs")
def band_signatures(spark, sf):
    return _signatures(spark, sf).select("doc_id", "has_units", "sig")


@query(f"""WITH {SIGNED} SELECT sig AS key, count(*) AS n_pages, min(doc_id) AS first_id, (count(*) * (count(*) - 1) // 2)::BIGINT AS n_pairs
  FROM sigs WHERE has_units GROUP BY 1 HAVING count(*) > 1""")
def lsh_candidates(spark, sf):
    return dedup.candidate_groups(_signatures(spark, sf), page_id="doc_id")


@query(f"""WITH {SIGNED}, b AS (SELECT doc_id, unnest(bands) AS band, generate_subscripts(bands, 1) - 1 AS no FROM sigs WHERE has_units)
  SELECT no || ':' || band AS key, count(*) AS n_pages, min(doc_id) AS first_id, (count(*) * (count(*) - 1) // 2)::BIGINT AS n_pairs
  FROM b GROUP BY 1 HAVING count(*) > 1""")
def lsh_band_candidates(spark, sf):
    return dedup.candidate_groups(_signatures(spark, sf), "any_band", page_id="doc_id")


# --- verified duplicates -----------------------------------------------------------------------------


def _pages(spark, sf):
    return D.documents(spark, sf).select(F.col("doc_id").alias("page_id"), "text")


def _duplicates(spark, sf, **options):
    return dedup.near_duplicates(_pages(spark, sf), _vocab(spark, sf), SCHEME, **options)


def _verified(score: str, is_new: str) -> str:
    """All verified pairs within a signature by brute force, then the greedy pass in page order."""
    return f"""WITH RECURSIVE {SIGNED}, base AS (
  SELECT d.doc_id AS id, lower(d.text) AS t, s.sig, s.has_units, {is_new} AS is_new,
    CASE WHEN count(*) OVER (PARTITION BY s.sig) > 1 THEN
      list_distinct(list_transform(range(1, length(t) - 1), lambda i: substr(t, i, 3))) ELSE [] END AS g
  FROM documents d JOIN sigs s USING (doc_id)), placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY sig ORDER BY is_new, id) AS pos FROM base), scored AS MATERIALIZED (
  SELECT b.id AS later, a.pos, a.id, {score} AS score FROM placed b JOIN placed a ON a.sig = b.sig AND a.pos < b.pos
  WHERE b.is_new AND (b.has_units OR a.t = b.t)), pairs AS MATERIALIZED (
  SELECT later, list({{'pos': pos, 'id': id, 'score': score}} ORDER BY pos) AS partners FROM scored WHERE score >= 0.9 GROUP BY later), walk AS (
  SELECT sig, 0::BIGINT AS pos, []::BIGINT[] AS kept, NULL::BIGINT AS id, NULL::BIGINT AS orig, NULL::DOUBLE AS score FROM (SELECT DISTINCT sig FROM placed)
  UNION ALL
  SELECT sig, pos, CASE WHEN hit IS NULL THEN list_append(kept, id) ELSE kept END, id, hit.id, hit.score FROM (
    SELECT p.sig, p.pos, w.kept, p.id, list_filter(coalesce(q.partners, []), lambda x: list_contains(w.kept, x.id))[1] AS hit
    FROM walk w JOIN placed p ON p.sig = w.sig AND p.pos = w.pos + 1 LEFT JOIN pairs q ON q.later = p.id)), duplicates AS (
  SELECT id AS page_id, orig AS orig_id, score FROM walk WHERE orig IS NOT NULL)"""


# Levenshtein over whole texts is quadratic in their length, so the SQL check uses shingle sets.
JACCARD = """(CASE WHEN a.t = b.t OR (a.g = [] AND b.g = []) THEN 1.0
    ELSE len(list_intersect(a.g, b.g)) / (len(a.g) + len(b.g) - len(list_intersect(a.g, b.g))) END)"""
FOUND = _verified(JACCARD, "true")


@query()
def near_duplicates(spark, sf):
    """By matching blocks, which SQL does not have; tests compare it with brute force."""
    return _duplicates(spark, sf, similarity=dedup.matching_blocks(autojunk=True))


@query(f"{FOUND} SELECT page_id, orig_id, round(score, 6) AS score FROM duplicates")
def near_duplicates_jaccard(spark, sf):
    found = _duplicates(spark, sf, similarity=dedup.shingle_jaccard())
    return found.withColumn("score", F.round("score", 6))


LEVENSHTEIN = "(CASE WHEN greatest(length(a.t), length(b.t)) = 0 THEN 1.0 ELSE 1 - levenshtein(a.t, b.t) / greatest(length(a.t), length(b.t)) END)"


# The turns of conversations, each followed by a copy with some more letters, stand in for documents. SQL counts edits in
# bytes, so other letters than ASCII become one sign.
TURNS = """WITH RECURSIVE documents AS (
  SELECT row_number() OVER (ORDER BY conv_id, turn, role, copy, text) AS doc_id, text FROM (
    SELECT conv_id, turn, role, unnest([0, 1]) AS copy,
      regexp_replace(coalesce(text, ''), '[^\x00-\x7F]', '?', 'g') || unnest(['', ' and.']) AS text FROM conversations)), """


@query(f"{TURNS}{_verified(LEVENSHTEIN, 'true').removeprefix('WITH RECURSIVE ')} SELECT page_id, orig_id, round(score, 6) AS score FROM duplicates")
def near_duplicates_levenshtein(spark, sf):
    """Turns of conversations by edits over whole texts."""
    plain = F.regexp_replace(F.coalesce("text", F.lit("")), "[^\\x00-\\x7F]", "?")
    turns = spark.read.parquet(f"{sf}/conversations.parquet").withColumn("text", plain)
    copies = F.array(*[F.struct(F.lit(k).alias("copy"), F.concat("text", F.lit(end)).alias("text")) for k, end in ((0, ""), (1, " and."))])
    both = turns.select("conv_id", "turn", "role", F.inline(copies))
    pages = materialise(rank_in_group(both, [], ["conv_id", "turn", "role", "copy", "text"], "page_id").select("page_id", "text"))
    vocab = materialise(minhash.vocabulary(pages, VOCAB))
    found = dedup.near_duplicates(pages, vocab, SCHEME, similarity=dedup.levenshtein_ratio())
    return found.withColumn("score", F.round("score", 6))


@query(f"{FOUND} SELECT orig_id AS from_page, page_id AS to_page FROM duplicates")
def duplicate_links(spark, sf):
    return dedup.duplicate_links(_duplicates(spark, sf, similarity=dedup.shingle_jaccard()))


@query(f"""{FOUND} SELECT doc_id AS page_id, CASE WHEN d.page_id IS NULL THEN 'HTML' ELSE 'DUPLICATE' END AS page_type_code,
  CASE WHEN d.page_id IS NULL THEN text END AS text FROM documents LEFT JOIN duplicates d ON d.page_id = doc_id""")
def duplicate_pages(spark, sf):
    found = _duplicates(spark, sf, similarity=dedup.shingle_jaccard())
    return dedup.mark(_pages(spark, sf), found, content="text").select("page_id", "page_type_code", "text")


@query(f"""{FOUND} SELECT (SELECT count(*) FROM documents) AS n_pages, count(*) AS n_duplicates, count(DISTINCT orig_id) AS n_originals FROM duplicates""")
def duplicate_report(spark, sf):
    found = _duplicates(spark, sf, similarity=dedup.shingle_jaccard())
    return dedup.duplicate_report(_pages(spark, sf), found)


@query(f"""{_verified(JACCARD, f'doc_id % {HISTORY} <> 0')} SELECT page_id, orig_id, round(score, 6) AS score FROM duplicates""")
def dedup_batch(spark, sf):
    pages = _pages(spark, sf)
    stored = F.col("page_id") % HISTORY == 0
    found = dedup.dedup_batch(
        pages.where(~stored), pages.where(stored), _vocab(spark, sf), SCHEME, similarity=dedup.shingle_jaccard()
    )
    return found.withColumn("score", F.round("score", 6))


@query(f"""{_verified(JACCARD, f'doc_id % {HISTORY} <> 0')} SELECT page_id, orig_id, round(score, 6) AS score FROM duplicates""")
def dedup_batch_signed(spark, sf):
    """The stored documents come in two batches to an index of signatures; the new ones meet the index alone."""
    pages = _pages(spark, sf)
    stored = pages.where(F.col("page_id") % HISTORY == 0)
    index = SignatureIndex(spark, f"{checkpoint_dir(spark)}/siteloom/{uuid.uuid4().hex}", _vocab(spark, sf), SCHEME, parts=32)
    index.append(stored.where(F.col("page_id") % 2 == 0), 0)
    index.append(stored.where(F.col("page_id") % 2 == 1), 1)
    found = dedup.dedup_signed(pages.where(F.col("page_id") % HISTORY != 0), index, similarity=dedup.shingle_jaccard())
    return found.withColumn("score", F.round("score", 6))


def _verified_any(score: str) -> str:
    """All verified pairs that share a band (or, without units, a text) by brute force, then the greedy pass over all pages."""
    return f"""WITH RECURSIVE {SIGNED}, base AS MATERIALIZED (
  SELECT d.doc_id AS id, lower(d.text) AS t, s.bands, s.has_units, list_distinct(list_transform(range(1, length(t) - 1), lambda i: substr(t, i, 3))) AS g,
    row_number() OVER (ORDER BY doc_id) AS pos FROM documents d JOIN sigs s USING (doc_id)), banded AS (
  SELECT id, unnest(bands) AS band, generate_subscripts(bands, 1) AS no FROM base WHERE has_units), cand AS MATERIALIZED (
  SELECT DISTINCT x.id AS a, y.id AS b FROM banded x JOIN banded y ON x.no = y.no AND x.band = y.band AND x.id < y.id
  UNION SELECT x.id, y.id FROM base x JOIN base y ON x.t = y.t AND x.id < y.id), scored AS MATERIALIZED (
  SELECT b.id AS later, a.pos, a.id, {score} AS score FROM cand c JOIN base a ON a.id = c.a JOIN base b ON b.id = c.b), pairs AS MATERIALIZED (
  SELECT later, list({{'pos': pos, 'id': id, 'score': score}} ORDER BY pos) AS partners FROM scored WHERE score >= 0.9 GROUP BY later), linked AS MATERIALIZED (
  SELECT p.id, coalesce(q.partners, []) AS partners, row_number() OVER (ORDER BY p.id) AS step FROM base p LEFT JOIN pairs q ON q.later = p.id
  WHERE q.later IS NOT NULL OR p.id IN (SELECT id FROM scored WHERE score >= 0.9)), walk AS (
  SELECT 0::BIGINT AS step, []::BIGINT[] AS kept, NULL::BIGINT AS id, NULL::BIGINT AS orig, NULL::DOUBLE AS score
  UNION ALL
  SELECT step, CASE WHEN hit IS NULL THEN list_append(kept, id) ELSE kept END, id, hit.id, hit.score FROM (
    SELECT p.step, w.kept, p.id, list_filter(p.partners, lambda x: list_contains(w.kept, x.id))[1] AS hit
    FROM walk w JOIN linked p ON p.step = w.step + 1)), duplicates AS (
  SELECT id AS page_id, orig AS orig_id, score FROM walk WHERE orig IS NOT NULL)"""


@query(f"{_verified_any(JACCARD)} SELECT page_id, orig_id, round(score, 6) AS score FROM duplicates")
def near_duplicates_any_band(spark, sf):
    """Candidates share a band; a page lies in up to eight keys, so decisions are made over the graph of pairs."""
    found = _duplicates(spark, sf, similarity=dedup.shingle_jaccard(), match="any_band")
    return found.withColumn("score", F.round("score", 6))
