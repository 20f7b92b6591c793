"""Registered queries of this subpackage: thin digests over the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopscope.llm.importance import resampled
from shopscope.llm.mixing import mixture, sized
from shopscope.llm.ngram_join import ngram_components
from shopscope.llm.oracle import ORACLE  # noqa: F401
from shopscope.llm.packing import best_fit_packing
from shopscope.llm.phrase_index import contamination, hit_words
from shopscope.llm.pii import pii_digest
from shopscope.llm.posting_lists import nearest
from shopscope.llm.recompression import repeat_digest
from shopscope.llm.shared import table
from shopscope.llm.sorted_passes import near_vectors
from shopscope.llm.subword_classifier import quality
from shopscope.llm.token_count import token_counts
from shopscope.llm.token_files import token_files
from shopscope.llm.vector_codes import codebooks_sha256, compressed, with_label_errors


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(spark, table(spark, sf_dir, "documents"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"))


def op4_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op5_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents")).withColumn("over_limit", F.col("n_tokens") > 2048)


def op6_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digest(table(spark, sf_dir, "documents"))


def op7_subword_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_pii_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digest(table(spark, sf_dir, "documents"))


def op9_sorted_projection_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(sized(table(spark, sf_dir, "documents")))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = compressed(table(spark, sf_dir, "embeddings"), "label")
    return with_label_errors(codes).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit, items = hit_words(F.col("spans")), F.col("items")
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_posting_lists": op4_posting_lists,
    "op5_token_count": op5_token_count,
    "op6_recompression": op6_recompression,
    "op7_subword_classifier": op7_subword_classifier,
    "op8_pii_candidates": op8_pii_candidates,
    "op9_sorted_projection_passes": op9_sorted_projection_passes,
    "op10_source_mixing": op10_source_mixing,
    "op11_vector_codes": op11_vector_codes,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_phrase_index": op13_phrase_index,
}
