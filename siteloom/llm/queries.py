"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteloom.llm import (
    bestfit,
    bytebpe,
    common,
    cws,
    hamming,
    ngrams,
    packing,
    prefixfree,
    prefixtrie,
    quality,
    tokenfiles,
    topk,
    warc,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def vocabulary(name: str) -> str:
    """The path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op1_cws_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints of each text and of its edited text, with their likeness."""
    return cws.edited(table(spark, sf, "documents"))


# SHA-1 as bare base32: five hex digits are four of its 32 characters.
OP2_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), d AS (
  SELECT page_id, payload_bytes, h, min(page_id) OVER (PARTITION BY h) AS first,
    array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform(range(4), lambda j:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             1 + ((('0x' || substr(h, CAST(5 * i + 1 AS INTEGER), 5))::BIGINT >> CAST(15 - 5 * j AS INTEGER)) & 31)::INTEGER, 1)), '')), '')
      AS payload_digest
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM d
"""


@query(OP2_SQL)
def op2_warc(spark: SparkSession, sf: str) -> DataFrame:
    """Each page's record, as read back from the archives."""
    pages = table(spark, sf, "pages")
    folder = common.scratch(pages, "warc")
    warc.write(pages, folder)
    return warc.read(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op3_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of 2048 tokens."""
    cut = packing.pieces(table(spark, sf, "documents"), vocabulary("word_bpe_49k.json"))
    rows = cut.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return packing.pack(rows)


@query()
def op4_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of each text's ids and of the bytes that they decode to."""
    import public_tokenizers

    parts = vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return bytebpe.encode(docs, *parts, decoded="decoded").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op5_token_files(spark: SparkSession, sf: str) -> DataFrame:
    """Each document's ids, as read back from the files."""
    docs = table(spark, sf, "documents")
    folder = common.scratch(docs, "ids")
    tokenfiles.write(docs, folder, vocabulary("word_bpe_49k.json"))
    return tokenfiles.read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query()
def op6_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Each text's quality score, learnt from the labels that are not held out."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf, "labels"))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= quality.CUT).cast("int").alias("predicted")
    )


OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vector FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.vector, c.vector), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query(OP7_SQL)
def op7_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The five best inner products of each query vector."""
    return topk.search(table(spark, sf, "embeddings"))


@query()
def op8_ngram_model(spark: SparkSession, sf: str) -> DataFrame:
    """Each text's log10 probability under the model of the texts that are not held out."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = ngrams.train(docs.where(~ngrams.held_out()))
    scored = ngrams.score(docs, model).withColumn("held_out", ngrams.held_out())
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


# Links and the least id reachable by them, over all pairs of documents that share a shingle.
OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS items
  FROM w
), u AS (SELECT doc_id, unnest(items) AS item FROM s),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM u a JOIN u b ON a.item = b.item AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN s x ON a = x.doc_id JOIN s y ON b = y.doc_id
  WHERE 100 * n >= 75 * (len(x.items) + len(y.items) - n)
), edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS node, doc_id AS seen FROM s UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.seen = e.a),
least AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
SELECT doc_id, CAST(len(items) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM s JOIN least ON doc_id = node
"""


@query(OP9_SQL)
def op9_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Each document's component under links of similarity 0.75."""
    return hamming.near_duplicates(table(spark, sf, "documents")).drop("text_hash")


@query()
def op10_repeated_strings(spark: SparkSession, sf: str) -> DataFrame:
    """What is removed of each text, as a smaller document has it in 50 bytes or more."""
    found = prefixfree.repeated(table(spark, sf, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op11_whitening(spark: SparkSession, sf: str) -> DataFrame:
    """Each vector's whitened components, with the figures of the fit."""
    return whitening.whiten(table(spark, sf, "embeddings"))


@query()
def op12_best_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Pieces of all documents, whole ones wherever they fit, in as few sequences as best fit needs."""
    cut = bestfit.pieces(table(spark, sf, "documents"), vocabulary("byte_bpe_50k.json"))
    return bestfit.pack(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


# CRC-32 of the decimal id bit by bit; each conversation and depth with its node, named by (least member, depth).
OP13_SQL = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
    substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32)) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
    lambda x: list_transform(range(8), lambda i: (ascii(x) >> i::INTEGER) & 1)))),
    lambda s, b: xor(s >> 1, (xor(s, b) & 1) * 3988292384)), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), b AS (
  SELECT c.conv_id, 0 AS part, k, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND k <= h
  UNION ALL SELECT c.conv_id, 1, k, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND k > h
), p AS (
  SELECT c.conv_id, coalesce(list({'r': role, 't': text} ORDER BY part, k) FILTER (role IS NOT NULL), []) AS turns
  FROM c LEFT JOIN b USING (conv_id) GROUP BY c.conv_id
), m AS (
  SELECT conv_id, d, len(turns) AS size, turns[d].t AS last, min(conv_id) OVER w AS node, count(*) OVER w AS n
  FROM p, unnest(range(0, len(turns) + 1)) AS u(d) WINDOW w AS (PARTITION BY d, turns[1:d])
), v AS (
  SELECT node, d, any_value(n) AS n, CASE WHEN d = 0 THEN 0 ELSE any_value(length(last)) END AS chars,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = d), '') AS ends
  FROM m GROUP BY node, d
), e AS (
  SELECT v.*, m.node AS parent FROM v LEFT JOIN m ON m.conv_id = v.node AND m.d = v.d - 1
), k AS (SELECT parent, d - 1 AS d, count(*) AS children FROM e WHERE d > 0 GROUP BY ALL),
f AS (SELECT e.*, coalesce(children, 0) AS children FROM e LEFT JOIN k ON k.parent = e.node AND k.d = e.d),
s AS (
  SELECT m.node, m.d, sum(CASE WHEN children = 0 THEN 1 ELSE 0 END) AS leaves, sum((f.n - 1) * chars) AS saved
  FROM f JOIN m ON m.conv_id = f.node AND m.d <= f.d GROUP BY m.node, m.d
)
SELECT f.node AS conv_id, f.d AS depth, parent AS parent_conv_id, n AS n_convs, children AS n_children,
  CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(ends) AS ends_sha256
FROM f JOIN s ON s.node = f.node AND s.d = f.d
"""


@query(OP13_SQL)
def op13_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations."""
    return prefixtrie.trie(table(spark, sf, "conversations"))
