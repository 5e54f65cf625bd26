"""Explicit schemas of the process tables and of nested values. All times are without a zone."""

from __future__ import annotations

from pyspark.sql import types as T

DOCUMENT_TYPES = ("document", "page", "block")

INPUT = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("document_type", T.StringType(), False),
        T.StructField("created", T.TimestampNTZType()),
        T.StructField("input_file", T.StringType()),
    ]
)
OUTPUT = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("input_id", T.LongType(), False),
        T.StructField("ocr_output_file", T.StringType()),
        T.StructField("ocr_confidence", T.DoubleType()),
        T.StructField("list_replacement_output_file", T.StringType()),
        T.StructField("pii_scrubber_output_file", T.StringType()),
        T.StructField("pii_scrubber_confidence_file", T.StringType()),
    ]
)
METADATA = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("input_id", T.LongType(), False),
        T.StructField("subject_id", T.StringType()),
        T.StructField("year_in_study", T.IntegerType()),
        T.StructField("visit_date", T.TimestampNTZType()),
        T.StructField("extracted_date", T.TimestampNTZType()),
    ]
)
TABLES = {"transcription_input": INPUT, "transcription_output": OUTPUT, "transcription_metadata": METADATA}

BOX = T.StructType([T.StructField(c, T.IntegerType()) for c in ("x", "y", "w", "h")])
OCR_RESULT = T.StructType(
    [
        T.StructField("content", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("page", T.IntegerType()),
        T.StructField("block", T.IntegerType()),
    ]
)
SPAN = T.StructType(
    [
        T.StructField("entity", T.StringType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def check_document_type(value: str) -> str:
    """``value`` if it is a known granularity; ValueError before anything is written otherwise."""
    if value not in DOCUMENT_TYPES:
        raise ValueError(f"document type {value!r}: use one of {', '.join(DOCUMENT_TYPES)}")
    return value
