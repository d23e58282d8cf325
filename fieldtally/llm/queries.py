"""One query per operator over its whole given table."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.llm import (
    binary_codes, byte_bpe, hard_negatives, licenses, mixing, near_copies, piece_bpe, pii, ranked_search,
    sliced_topk, statements as sql, token_counts, token_files, toxicity,
)
from fieldtally.llm.common import staging_path, table


def op1_binary_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary_codes.near_vectors(table(spark, sf_dir, "embeddings"))


def language_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The labelled table of the mixing query: the language of labelled rows."""
    return labels.select("doc_id").distinct().join(
        docs.select("doc_id", F.col("lang").alias("domain")), "doc_id")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labelled = language_labels(docs, table(spark, sf_dir, "labels"))
    return mixing.mix(docs, labelled).select("doc_id", "n_tokens", "copies", "domain", "rate")


def op3_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.classify(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model).select(
        "doc_id", "held_out", "score", "predicted", "n_passages")


def op5_sliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return sliced_topk.top_k(vectors, vectors.where("vec_id % 100 = 0"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "token_files")
    token_files.write_segments(table(spark, sf_dir, "documents"), path)
    return token_files.document_digests(token_files.read_segments(spark, path))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    crf = pii.train(pii.labelled_table(spark))
    return pii.scan_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), crf).drop("text")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digest_documents(table(spark, sf_dir, "documents"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_documents(table(spark, sf_dir, "documents")).drop("notices")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.mine(vectors, vectors.where("vec_id % 100 = 0"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.digest_documents(table(spark, sf_dir, "documents"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_binary_codes": op1_binary_codes,
        "op2_mixing": op2_mixing,
        "op3_near_copies": op3_near_copies,
        "op4_toxicity": op4_toxicity,
        "op5_sliced_topk": op5_sliced_topk,
        "op6_token_files": op6_token_files,
        "op7_pii": op7_pii,
        "op8_token_counts": op8_token_counts,
        "op9_byte_bpe": op9_byte_bpe,
        "op10_licenses": op10_licenses,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_ranked_search": op12_ranked_search,
        "op13_piece_bpe": op13_piece_bpe,
    }


def statements() -> dict[str, str]:
    """SQL where it can express an operator over whole tables."""
    return {
        "op5_sliced_topk": sql.SLICED_TOPK,
        "op11_hard_negatives": sql.HARD_NEGATIVES,
        "op12_ranked_search": sql.RANKED_SEARCH,
    }
