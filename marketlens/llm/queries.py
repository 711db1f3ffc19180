"""The registered queries of this subpackage, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlens.llm import decontaminate, html_text, near_dup, packing, pieces, repair, sharding, suffixes, token_store, toxicity, variants, voronoi, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of 1024 tokens. A null text is empty and takes its end id; an empty table gives no rows."""
    return packing.packed_documents(_table(spark, sf_dir, "documents"))


def op2_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count and component of every document. Null, empty and blank texts are linked with nothing; equal texts are linked."""
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_voronoi_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best rows of every query vector. Vectors that are null or hold null or non-finite components take no part; ties go to the smaller id."""
    return voronoi.nearest(_table(spark, sf_dir, "embeddings"))


def op4_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to and read from archives. A null page has an empty payload; of equal payloads the smallest id is the response."""
    return warc.round_trip(spark, _table(spark, sf_dir, "pages"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document without its repeated passages. A null text is empty; repeated rows count as copies of each other."""
    return suffixes.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents. Null and empty texts have no windows; rows that repeat an id are taken together."""
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_jump_hash_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document. A null text has 16 bytes; equal texts stay together only where their keys say so."""
    return sharding.assign_shards(_table(spark, sf_dir, "documents"))


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document written to and read from token files. A null text has its end id alone."""
    return token_store.round_trip(spark, _table(spark, sf_dir, "documents"))


def op9_factorization_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document. Null and empty texts get the score of no terms."""
    return toxicity.toxic_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_template_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page. A null or empty page has an empty text."""
    return html_text.main_texts(_table(spark, sf_dir, "pages"))


def op11_trie_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words and forms. Null texts hold no words, ties go to the smaller word."""
    return variants.spelling_groups(_table(spark, sf_dir, "documents"))


def op12_sentencepiece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of ids, spans and decoded text of every document. A null text counts as empty; rows are kept one by one."""
    return pieces.round_trip_digests(_table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation. Nulls count as one space; rows of one turn follow role and text."""
    return repair.repair_report(_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_minhash_near_dup": op2_minhash_near_dup,
    "op3_voronoi_top_k": op3_voronoi_top_k,
    "op4_warc_round_trip": op4_warc_round_trip,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_template_decontamination": op6_template_decontamination,
    "op7_jump_hash_sharding": op7_jump_hash_sharding,
    "op8_token_store": op8_token_store,
    "op9_factorization_toxicity": op9_factorization_toxicity,
    "op10_template_html_text": op10_template_html_text,
    "op11_trie_spelling_groups": op11_trie_spelling_groups,
    "op12_sentencepiece_round_trip": op12_sentencepiece_round_trip,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE: dict[str, str] = {
    "op3_voronoi_top_k": """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, d.vec_id,
         CAST(list_sum([q.e[i] * d.e[i] FOR i IN range(1, len(q.e) + 1)]) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10
""",
    "op4_warc_round_trip": """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_page FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN first_page END AS refers_to
FROM f
""",
}
