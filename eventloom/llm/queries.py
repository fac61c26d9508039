"""Registered queries of the subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.common import prepare, table
from eventloom.llm.exact_dedup import dedup_decisions
from eventloom.llm.hard_negatives import hard_negatives
from eventloom.llm.licenses import license_scan
from eventloom.llm.mixing import mix
from eventloom.llm.ngram_join import join_components
from eventloom.llm.packing import pack_documents
from eventloom.llm.quality import quality_scores
from eventloom.llm.simhash import simhash_components
from eventloom.llm.spelling import spelling_forms
from eventloom.llm.suffix_dedup import remove_repeats
from eventloom.llm.token_counts import token_counts
from eventloom.llm.topk_search import top_k
from eventloom.llm.warc import archive_pages

#: Vocabulary files of public tokenizers; they stay where they are installed.
WORD_BPE = "word_bpe_49k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return remove_repeats(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_file(PIECE_VOCABULARY))


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "times")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return archive_pages(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return license_scan(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return dedup_decisions(table(spark, sf_dir, "documents"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return join_components(table(spark, sf_dir, "documents"), words=3, percent=90)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_file(WORD_BPE))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spelling_forms(table(spark, sf_dir, "documents"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash_components(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_topk_search": op3_topk_search,
    "op4_mixing": op4_mixing,
    "op5_warc": op5_warc,
    "op6_quality": op6_quality,
    "op7_licenses": op7_licenses,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_ngram_join": op9_ngram_join,
    "op10_packing": op10_packing,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_spelling": op12_spelling,
    "op13_simhash": op13_simhash,
}

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {5 * i + 1}, 5))::INTEGER >> {shift}) & 31) + 1, 1)" for i in range(8) for shift in (15, 10, 5, 0)
)

ORACLES: dict[str, str] = {
    "op3_topk_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
        )
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
        FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
    """,
    "op5_warc": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
        w AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM p)
        SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
               CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> top THEN top END AS refers_to
        FROM w
    """,
    "op8_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
        ), p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT anchor_id, positive_id, row_number() OVER w ::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER w <= 10
    """,
}
