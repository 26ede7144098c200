"""The registered queries of this subpackage, each over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.decontaminate import contaminated
from starloom.llm.fingerprint import fingerprints
from starloom.llm.hard_negatives import hard_negatives, shifted_label
from starloom.llm.ngram_join import ngram_join
from starloom.llm.packing import pack
from starloom.llm.quality import classify
from starloom.llm.secret_scan import scan_secrets
from starloom.llm.tables import read
from starloom.llm.token_count import count_tokens
from starloom.llm.token_files import read_token_files, write_token_files
from starloom.llm.topk import top_k
from starloom.llm.url_filter import judge_urls
from starloom.llm.warc import archive_round_trip
from starloom.llm.whitening import whiten
from starloom.session import scratch_dir


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(read(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages have no time of capture; their ids stand in for it, in seconds."""
    path = f"{scratch_dir(spark)}/warc"
    captures = archive_round_trip(read(spark, sf_dir, "pages"), path, seconds=F.col("page_id"))
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: (verdict, host, path) of the query's rules, fixed values.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's label is that of the document of its number."""
    pages, labels = read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels")
    return judge_urls(pages, labels, URL_RULES, min_support=0.002)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark)}/token_files"
    write_token_files(read(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(spark, path)


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh id takes the next of the ten labels."""
    vectors = read(spark, sf_dir, "embeddings")
    return hard_negatives(vectors, label=shifted_label(F.col("vec_id"), F.col("label")))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = [op1_decontamination, op2_ngram_join, op3_packing, op4_secret_scan, op5_quality, op6_token_counts, op7_warc, op8_url_filter, op9_token_files, op10_top_k]
    registered += [op11_hard_negatives, op12_fingerprints, op13_whitening]
    return {query.__name__: query for query in registered}


_NGRAM_JOIN_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), g AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda k: array_to_string(words[k:k + 3], ' '))) END AS grams
  FROM w
), s AS (SELECT doc_id, unnest(grams) AS gram FROM g),
n AS (SELECT doc_id, CAST(len(grams) AS BIGINT) AS n_shingles FROM g),
few AS (SELECT gram FROM s GROUP BY gram HAVING count(*) > 1),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id < b.doc_id
  WHERE a.gram IN (SELECT gram FROM few) GROUP BY ALL
), pairs AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * shared >= 85 * (x.n_shingles + y.n_shingles - shared)
), links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT n.doc_id, n.n_shingles, c.component_id FROM n JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = n.doc_id
"""

_WARC_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), f AS (SELECT payload_digest, max(page_id) AS first FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
  CASE WHEN f.first IS NULL OR f.first = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest
"""

_TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS row FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.row, c.row) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 10
"""

_HARD_NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS row
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id, CAST(list_dot_product(a.row, c.row) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 50 = 0 AND c.vec_id <> a.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
  FROM s WHERE same
), n AS (
  SELECT p.anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
  WHERE place <= 5 AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""

_FINGERPRINTS_SQL = r"""
WITH n AS (
  SELECT doc_id, coalesce(text, '') AS text, lead(coalesce(text, '')) OVER w AS after, first_value(coalesce(text, '')) OVER w AS first
  FROM documents WINDOW w AS (ORDER BY doc_id)
), e AS (
  SELECT doc_id, text, coalesce(after, first) AS next,
    substring(text, 1, length(text) - length(text) // 2) || substring(coalesce(after, first), 1, length(text) // 2) AS edited
  FROM n
), w AS (
  SELECT x, list_filter(string_split_regex(x, '[\x20\x09-\x0D]+'), lambda y: y <> '') AS words
  FROM (SELECT text AS x FROM e UNION SELECT edited FROM e)
), h AS (
  SELECT x, CASE WHEN len(words) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(
    range(1, greatest(len(words) - 4, 1) + 1), lambda k: md5(array_to_string(words[k:k + 4], ' '))))) END AS hashes
  FROM w
), k AS (
  SELECT x, CASE WHEN len(list_filter(hashes, lambda y: y < '1')) >= 16 THEN list_filter(hashes, lambda y: y < '1') ELSE hashes[1:16] END AS kept
  FROM h
), f AS (
  SELECT x, kept, CASE WHEN len(kept) < 16 THEN 'g' WHEN len(kept) = 16 THEN greatest(kept[16], '1') ELSE '1' END AS reach FROM k
), c AS (
  SELECT doc_id, text, edited, a.kept AS own, b.kept AS changed, m.kept AS others,
    list_filter(a.kept, lambda y: y <= least(a.reach, b.reach)) AS own_b, list_filter(a.kept, lambda y: y <= least(a.reach, m.reach)) AS own_m
  FROM e JOIN f a ON a.x = text JOIN f b ON b.x = edited JOIN f m ON m.x = next
)
SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256,
  array_to_string(own, ',') AS fingerprint, array_to_string(changed, ',') AS edited_fingerprint,
  CASE WHEN own = changed THEN 1.0 WHEN len(own_b) = 0 THEN 0.0 ELSE CAST(len(list_intersect(own_b, changed)) AS DOUBLE) / len(own_b) END AS near_edited,
  CASE WHEN own = others THEN 1.0 WHEN len(own_m) = 0 THEN 0.0 ELSE CAST(len(list_intersect(own_m, others)) AS DOUBLE) / len(own_m) END AS near_next
FROM c
"""


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that it can express; the others have tests against brute force."""
    return {
        "op2_ngram_join": _NGRAM_JOIN_SQL,
        "op7_warc": _WARC_SQL,
        "op10_top_k": _TOP_K_SQL,
        "op11_hard_negatives": _HARD_NEGATIVES_SQL,
        "op12_fingerprints": _FINGERPRINTS_SQL,
    }
