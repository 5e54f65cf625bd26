"""Work queues of the stages over the process tables, and paging."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import is_pdf, text_input


def ocr_queue(inputs: DataFrame, outputs: DataFrame, document_type: str) -> DataFrame:
    """PDF inputs of a type without output, or whose output has no OCR file yet."""
    out = outputs.select(F.col("id").alias("output_id"), "input_id", "ocr_output_file")
    wanted = inputs.where(is_pdf(F.col("input_file")) & (F.col("document_type") == document_type))
    return wanted.join(out, wanted["id"] == out["input_id"], "left").where("ocr_output_file is null").select("id", "input_file", "output_id")


def replace_queue(inputs: DataFrame, outputs: DataFrame, document_type: str) -> DataFrame:
    """Outputs with an OCR file; replaced ones stay in, so that lists can follow each other."""
    return _with_ocr(inputs, outputs, document_type)


def scrub_queue(inputs: DataFrame, outputs: DataFrame, document_type: str) -> DataFrame:
    """Outputs with an OCR file that aren't scrubbed yet."""
    return _with_ocr(inputs, outputs.where("pii_scrubber_output_file is null"), document_type)


def _with_ocr(inputs: DataFrame, outputs: DataFrame, document_type: str) -> DataFrame:
    ready = outputs.where("ocr_output_file is not null").withColumn("text_file", text_input(F.col("list_replacement_output_file"), F.col("ocr_output_file")))
    wanted = inputs.where(F.col("document_type") == document_type).select(F.col("id").alias("_id"), "input_file")
    return ready.join(wanted, ready["input_id"] == wanted["_id"]).select("id", "input_id", "input_file", "ocr_output_file", "text_file")


def mine_queue(outputs: DataFrame, metadata: DataFrame) -> DataFrame:
    """Outputs with each metadata row that has no visit date yet; outputs without metadata pass with a null subject."""
    m = metadata.select(F.col("input_id").alias("_input"), "subject_id", "visit_date")
    joined = outputs.join(m, outputs["input_id"] == m["_input"], "left").where("visit_date is null")
    return joined.select("id", "input_id", "subject_id", "ocr_output_file", "pii_scrubber_confidence_file")


def page(queue: DataFrame, limit: int | None, offset: int = 0, order: str = "id") -> DataFrame:
    """A page of a queue in the order of its ids; no limit gives all from the offset on, and neither the queue as it is."""
    if limit is None and not offset:
        return queue
    out = queue.orderBy(order)
    if offset:
        out = out.offset(offset)
    return out if limit is None else out.limit(limit)
