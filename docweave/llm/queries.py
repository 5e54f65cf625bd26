"""The queries of this subpackage, by name, and SQL where it can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sql
from .tokenise import public_path

RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import jaccard_components

    return jaccard_components(_table(spark, sf_dir, "documents"), 4, 85, 100)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import remove_repeats

    out = remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"), 20)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op5_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk import top_k, whole_vectors

    vectors = whole_vectors(_table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where("vec_id % 20 = 0"), 20)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    return pack_documents(_table(spark, sf_dir, "documents"), public_path("word_bpe_49k.json"), 0, 2048, spaces_matter=False, payload="ids_crc32")


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_output import output_directory, read_token_files, write_token_files

    docs = _table(spark, sf_dir, "documents")
    return read_token_files(write_token_files(docs, public_path("byte_bpe_50k.json"), 2, output_directory(spark)), with_ids=False)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import filter_urls

    return filter_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), RULES).select("page_id", "host", "path", "rule", "verdict")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm_scoring import score_documents

    return score_documents(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontamination import find_leaks

    return find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import dedup_lines

    out = dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import score_quality, train_quality

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    kept_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = train_quality(docs, _table(spark, sf_dir, "labels").where(~kept_out))
    return score_quality(docs, model, 0.7).select("doc_id", kept_out.alias("held_out"), "score", "predicted")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op9_line_dedup": op9_line_dedup,
    "op10_quality_classifier": op10_quality_classifier,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_top_k_search": op5_top_k_search,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_token_output": op7_token_output,
    "op8_url_filter": op8_url_filter,
}
SQL: dict[str, str] = {"op3_ngram_jaccard_join": sql.OP3, "op4_substring_dedup": sql.OP4, "op5_top_k_search": sql.OP5, "op8_url_filter": sql.op8(RULES)}
