"""A corpus pipeline of five stages, each by one operator of ``docweave.llm``.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; all but the last return the columns of
``documents``. Rows of equal ids are judged by id where a stage decides on documents; null texts count as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm._spark import delete, fresh_path, intermediates
from docweave.llm.decontamination import decontaminate
from docweave.llm.line_dedup import dedup_lines
from docweave.llm.ngram_join import jaccard_components
from docweave.llm.packing import pack_documents
from docweave.llm.quality import score_quality, train_quality
from docweave.llm.tokenise import public_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model accepts; it learns from the labelled ones outside the held-out quarter."""
    kept_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = train_quality(docs, _table(spark, sf_dir, "labels").where(~kept_out))
    return score_quality(docs, model, 0.7).where("predicted = 1").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated and near-repeated lines; those that lost all their lines go, ``n_chars`` follows."""
    out = dedup_lines(docs)
    left = (F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return out.where(left).withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")).select(*COLUMNS)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group linked by five-word shingles at 0.8 or more."""
    groups = jaccard_components(docs, 5, 80, 100)
    goes = groups.where("component_id <> doc_id").select(F.col("doc_id").alias("_goes")).distinct()
    return docs.join(goes, docs["doc_id"] == goes["_goes"], "left_anti").select(*COLUMNS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage within the edit budget of a benchmark item."""
    return decontaminate(docs, _table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of 2048."""
    return pack_documents(docs, public_path("word_bpe_49k.json"), 0, 2048, spaces_matter=False, payload="ids_crc32")


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]
#: Tokenising, boosted trees and MinHash are beyond SQL; tests/llm compares the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written to the shared folder and read again. What a stage stored on
    its way, and the table of the stage before it, are deleted when its own is written."""
    docs, before = _table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        path = fresh_path(spark, "stage")
        with intermediates(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete(spark, before)
        docs, before = spark.read.schema(docs.schema).parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
