"""Registered queries of the operators, and the SQL of those that DuckDB can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from usagelens.llm import (bpe, hardneg, imatch, merkle, mixing, neardup, packing, quality, secret_scan, sharding, tokenfile,
                           topk, warc)
from usagelens.llm.common import table

Builder = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def _secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return secret_scan.findings(docs, secret_scan.train(docs))


def _near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(_documents(spark, sf_dir), words=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def _hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a seventh of the labels moved on by one, so that near rows of other labels exist."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hardneg.hard_negatives(vectors, F.col("id") % 100 == 0)


def queries() -> dict[str, Builder]:
    return {
        "op1_nbsvm_quality": _quality,
        "op2_byte_shards": lambda s, d: sharding.byte_shards(_documents(s, d)),
        "op3_packing": lambda s, d: packing.pack_documents(_documents(s, d)),
        "op4_hyperminhash": _near_duplicates,
        "op5_secret_scan": _secrets,
        "op6_mix": lambda s, d: mixing.mix(_documents(s, d)).select(
            "doc_id", "size", "source_size", "target", "taken", F.col("draws.shard").alias("shards")),
        "op7_imatch": lambda s, d: imatch.fingerprints(_documents(s, d)),
        "op8_warc_derivatives": lambda s, d: warc.derive(warc.responses(table(s, d, "pages"))),
        "op9_exact_topk": lambda s, d: topk.top_k(table(s, d, "embeddings"), F.col("id") % 50 == 0, 5),
        "op10_rans_tokens": lambda s, d: tokenfile.token_digests(_documents(s, d)),
        "op11_segment_tree_bpe": lambda s, d: bpe.round_trip_digests(_documents(s, d)),
        "op12_merkle_manifest": lambda s, d: merkle.verified_manifest(_documents(s, d)),
        "op13_hard_negatives": _hard_negatives,
    }


TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""


# CRC-32 by bytes, from its 256-entry table, which is made from the polynomial.
SHARDS_SQL = """
WITH t AS (
  SELECT list(list_reduce(list_concat([i], range(8)), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384)
                                                                        ELSE a >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
d AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size,
         xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
             list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT))),
             lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)]))) AS text_crc32
  FROM documents, t),
o AS (
  SELECT *, SUM(size) OVER w - size AS start_byte, SUM(size) OVER () AS total FROM d
  WINDOW w AS (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING)),
s AS (SELECT *, CAST((2 * start_byte + size) * 16 // (2 * total) AS INTEGER) AS shard FROM o)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY start_byte) - 1 AS slot,
       CAST(NULL AS INTEGER) AS grown_shard, CAST(start_byte AS BIGINT) AS start_byte
FROM s
"""

NEAR_DUPLICATES_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
           lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
           ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
  FROM w),
x AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * COUNT(*) >= 80 * (a.n + b.n - COUNT(*))),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM s
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, len(s.s) AS n_shingles, r.c AS component_id, s.doc_id = r.c AS kept
FROM s JOIN (SELECT a, MIN(b) AS c FROM reach GROUP BY a) r ON s.doc_id = r.a
"""


MERKLE_SQL = """
WITH RECURSIVE t AS (
  SELECT list(list_reduce(list_concat([i], range(8)), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384)
                                                                        ELSE a >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
d AS (
  SELECT doc_id, source,
         concat(coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                coalesce(strlen(lang) || ':' || lang, '-'),
                coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head, text,
         CASE WHEN xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
                list_transform(regexp_extract_all(hex(encode(CAST(doc_id AS VARCHAR))), '..'), lambda h: CAST('0x' || h AS BIGINT))),
                lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)]))) % 5 = 0
              THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS claim
  FROM documents, t),
l AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(claim) || ':' || claim, '-')) AS claimed
  FROM d),
p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM l),
up AS (
  SELECT source, 0 AS height, list(leaf ORDER BY pos) AS nodes FROM p GROUP BY source
  UNION ALL
  SELECT source, height + 1, list_transform(range(0, len(nodes), 16), lambda i: sha256(array_to_string(nodes[i + 1:i + 16], '')))
  FROM up WHERE len(nodes) > 1),
s AS (
  SELECT source, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place
  FROM up WHERE len(nodes) = 1),
top AS (
  SELECT 0 AS height, list(subroot ORDER BY place) AS nodes FROM s
  UNION ALL
  SELECT height + 1, list_transform(range(0, len(nodes), 16), lambda i: sha256(array_to_string(nodes[i + 1:i + 16], '')))
  FROM top WHERE len(nodes) > 1),
r AS (SELECT nodes[1] AS root FROM top WHERE len(nodes) = 1),
spot AS (
  SELECT p.*, s.subroot, s.place, r.root
  FROM p JOIN s ON p.source IS NOT DISTINCT FROM s.source, r),
step AS (
  SELECT a.source AS s, a.pos AS q, u.height AS step, u.nodes, a.pos // CAST(power(16, u.height) AS BIGINT) AS i
  FROM spot a JOIN up u ON a.source IS NOT DISTINCT FROM u.source WHERE len(u.nodes) > 1
  UNION ALL
  SELECT a.source, a.pos, 1000 + u.height, u.nodes, a.place // CAST(power(16, u.height) AS BIGINT)
  FROM spot a, top u WHERE len(u.nodes) > 1),
pair AS (
  SELECT s, q, step, array_to_string(nodes[i // 16 * 16 + 1:i], '') AS lefts,
         array_to_string(nodes[i + 2:i // 16 * 16 + 16], '') AS rights
  FROM step),
path AS (SELECT s, q, list(lefts ORDER BY step) AS lefts, list(rights ORDER BY step) AS rights FROM pair GROUP BY s, q),
fold AS (
  SELECT doc_id, leaf, subroot, root, coalesce(lefts, []) AS lefts, coalesce(rights, []) AS rights, claimed AS node, 1 AS i
  FROM spot LEFT JOIN path ON spot.source IS NOT DISTINCT FROM path.s AND spot.pos = path.q
  UNION ALL
  SELECT doc_id, leaf, subroot, root, lefts, rights, sha256(lefts[i] || node || rights[i]), i + 1
  FROM fold WHERE i <= len(lefts))
SELECT doc_id, leaf, subroot, root,
       sha256(array_to_string(list_transform(range(1, len(lefts) + 1), lambda k: lefts[k] || rights[k]), '')) AS proof_sha256,
       node AS folded_root, node = root AS verified
FROM fold WHERE i > len(lefts)
"""

HARD_NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT *, row_number() OVER () AS no FROM v WHERE vec_id % 100 = 0),
s AS (
  SELECT a.no, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.e, c.e) AS BIGINT) AS score
  FROM a JOIN v c ON a.vec_id <> c.vec_id AND len(a.e) = len(c.e)),
p AS (
  SELECT no, vec_id AS positive_id, score AS positive_score, place
  FROM (SELECT *, row_number() OVER (PARTITION BY no ORDER BY score DESC, vec_id) AS place FROM s WHERE same)
  WHERE place <= 5),
n AS (
  SELECT s.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.no, p.place ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.no = p.no AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_byte_shards": SHARDS_SQL, "op4_hyperminhash": NEAR_DUPLICATES_SQL, "op9_exact_topk": TOP_K_SQL,
            "op12_merkle_manifest": MERKLE_SQL, "op13_hard_negatives": HARD_NEGATIVES_SQL}
