"""The stages over the catalog: register, transcribe, replace, scrub, mine. Each builds its plan from the queues and
operators, writes its texts, and then the new version of its table."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..functions import dates as D
from ..functions import paths as P
from ..functions import pii
from ..functions.replace import replace_strings
from ..operators import match, ner, ocr, queues
from ..operators.upsert import numbered, upsert_pairs
from ..schemas import check_document_type
from ..sources.files import list_files, read_each, write_texts
from ..sources.lists import keyed_values, read_list, read_targets
from ..sources.store import materialised


log = logging.getLogger("docweave")


class Outcome(NamedTuple):
    done: int
    failed: int


class Results(NamedTuple):
    """Rows that a stage made, from how many files, and how many failed."""

    rows: DataFrame
    done: int
    failed: int


def _report(failures: DataFrame, path: str) -> int:
    """Log the first failures; how many there are."""
    for r in failures.select(F.col(path).alias("path"), "error").limit(20).collect():
        log.error("%s: %s", r.path, r.error)
    return failures.count()


def registrations(files: DataFrame, document_type: str, created: datetime) -> DataFrame:
    """(input_file, document_type, created, subject_id) of files (path, directory) whose directory names a subject."""
    subject = P.subject_id(F.col("directory"))
    rows = files.select(F.col("path").alias("input_file"), F.lit(document_type).alias("document_type"), F.lit(created).cast("timestamp_ntz").alias("created"), subject.alias("subject_id"))
    return rows.where("subject_id is not null")


def placeholders(inputs: DataFrame) -> DataFrame:
    """A metadata row for each input (id, subject_id), its dates still to be found."""
    nothing = {"year_in_study": "int", "visit_date": "timestamp_ntz", "extracted_date": "timestamp_ntz"}
    return inputs.select(F.col("id").alias("input_id"), "subject_id", *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()])


def register(catalog: Catalog, root: str, document_type: str = "document", created: datetime | None = None, again: bool = False) -> int:
    """Register the files below ``root``; known ones (path and type) are passed over unless ``again``. Returns how many."""
    found = registrations(list_files(catalog.spark, root), document_type, created or datetime.now())
    inputs, metadata = catalog.read("transcription_input"), catalog.read("transcription_metadata")
    if not again:
        found = match.pairs_not_in(found, inputs, ["input_file", "document_type"])
    fresh = materialised(numbered(found, inputs))
    added = {"transcription_input": fresh, "transcription_metadata": numbered(placeholders(fresh), metadata)}
    catalog.commit({table: catalog.appended(table, rows) for table, rows in added.items()})
    return fresh.count()


def transcribe(catalog: Catalog, output_to: str, document_type: str = "document", chunk_size: int | None = 1000, offset: int = 0, engine: Callable[[], ocr.OcrEngine] = ocr.LibraryOcrEngine) -> Results:
    """OCR of the queue: a text file for each result, the last result of an input in its output row. Returns all results;
    inputs that failed stay in the queue."""
    check_document_type(document_type)
    inputs, outputs = catalog.read("transcription_input"), catalog.read("transcription_output")
    queue = materialised(queues.page(queues.ocr_queue(inputs, outputs, document_type), chunk_size, offset))
    every = materialised(ocr.run_ocr(queue, engine, document_type))
    broken = every.where("error is not null").select(F.col("id").alias("_id"), "error").join(queue.select("id", "input_file"), F.col("id") == F.col("_id"))
    failed, raw = _report(broken, "input_file"), every.where("error is null")
    results = ocr.document_rollup(raw) if document_type == "document" else raw.drop("error")
    named = results.join(queue.select(F.col("id").alias("_id"), "input_file", "output_id"), F.col("id") == F.col("_id"))
    named = materialised(named.withColumn("path", transcript_path(output_to, document_type)).drop("_id"))
    write_texts(named, "path", "content")
    last = named.groupBy("id", "output_id").agg(F.max_by(F.struct("path", "confidence"), F.struct("page", "block")).alias("x")).select("id", "output_id", "x.*")
    _update_outputs(catalog, last.select(F.col("id").alias("input_id"), "output_id", F.col("path").alias("ocr_output_file"), F.col("confidence").alias("ocr_confidence")))
    return Results(named, queue.count() - failed, failed)


def _subject() -> Column:
    """The folder of an input's texts: its subject, so that equal file names of two subjects don't meet."""
    return F.coalesce(P.subject_id(P.dirname(F.col("input_file"))), F.lit("none"))


def transcript_path(root: str, document_type: str) -> Column:
    """The text file of a result (input_file, page, block)."""
    name = F.concat_ws("-", P.stem(F.col("input_file")), F.col("page"), F.col("block"))
    return P.output_path(root, "unstructured_text", document_type, F.concat(_subject(), F.lit("/"), name, F.lit(".txt")))


def rewritten(rows: DataFrame, root: str, column: str, document_type: str, change: Callable, record: Callable | None = None) -> DataFrame:
    """``rows`` (input_file, ocr_output_file, text) with the changed text (new) and its path, and with ``record`` the same of
    the confidence record."""
    name = F.concat(_subject(), F.lit("/"), P.stem(F.col("ocr_output_file")), F.lit(".txt"))
    out = rows.withColumns({"path": P.output_path(root, column, document_type, name), "new": change(F.col("text"))})
    if record is None:
        return out
    name = F.concat(_subject(), F.lit("/confidence-"), P.stem(F.col("ocr_output_file")), F.lit(".json"))
    return out.withColumns({"record_path": P.output_path(root, "pii_scrubber_confidence_file", document_type, name), "record": F.to_json(record(F.col("text")), {"pretty": "true"})})


def _update_outputs(catalog: Catalog, changes: DataFrame) -> None:
    """Set the columns of ``changes`` in the rows of its output_id; rows without one are inserted."""
    outputs = catalog.read("transcription_output")
    changes = materialised(changes)
    columns = [c for c in changes.columns if c not in ("output_id", "input_id")]
    old = changes.where("output_id is not null").select(F.col("output_id").alias("_id"), *[F.col(c).alias(f"_{c}") for c in columns])
    joined = outputs.join(old, outputs["id"] == old["_id"], "left")
    updated = joined.select(*[F.when(F.col("_id").isNotNull(), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in outputs.columns])
    new = changes.where("output_id is null").select("input_id", *[F.col(c) if c in columns else F.lit(None).cast(outputs.schema[c].dataType).alias(c) for c in outputs.columns if c not in ("id", "input_id")])
    catalog.write("transcription_output", updated.unionByName(numbered(new, outputs).select(*outputs.columns)))


def replace(catalog: Catalog, data_file: str, key_column: str, replacement: str, output_dir: str, document_type: str = "document", chunk_size: int | None = 1000, offset: int = 0) -> Outcome:
    """Replace the listed strings in the queue's texts (the last replaced text if there is one). Returns how many, and how many failed."""
    targets = read_targets(catalog.spark, data_file, key_column)
    queue = queues.page(queues.replace_queue(catalog.read("transcription_input"), catalog.read("transcription_output"), document_type), chunk_size, offset)
    return _rewrite(catalog, queue, output_dir, "list_replacement_output_file", document_type, lambda t: replace_strings(t, targets, replacement), None)


def scrub(
    catalog: Catalog, output_to: str, document_type: str = "document", chunk_size: int | None = 1000, offset: int = 0, threshold: float = pii.DEFAULT_THRESHOLD,
    classifier: Callable[[], ner.TokenClassifier] | None = None, settings: ner.NerSettings | None = None,
) -> Outcome:
    """Redact the queue's texts and write their confidence records. Returns how many, and how many failed.

    ``classifier`` makes a model (once in each Python worker) whose spans, by ``settings``, join those of the patterns.
    """
    queue = queues.page(queues.scrub_queue(catalog.read("transcription_input"), catalog.read("transcription_output"), document_type), chunk_size, offset)
    spans = F.col("model_spans") if classifier else None
    prepare = (lambda rows: ner.classify(rows, classifier, settings)) if classifier else None
    return _rewrite(catalog, queue, output_to, "pii_scrubber_output_file", document_type, lambda t: pii.scrub(t, threshold, spans)[0], lambda t: pii.scrub(t, threshold, spans)[1], prepare)


def _rewrite(catalog: Catalog, queue: DataFrame, root: str, column: str, document_type: str, change: Callable, record: Callable | None, prepare: Callable | None = None) -> Outcome:
    read = materialised(read_each(queue, "text_file"))
    joined = read.where("error is null").drop("error")
    joined = prepare(joined) if prepare else joined
    rows = materialised(rewritten(joined, root, column, document_type, change, record))
    changes = {column: F.col("path")} | ({} if record is None else {"pii_scrubber_confidence_file": F.col("record_path")})
    write_texts(rows, "path", "new")
    if record is not None:
        write_texts(rows, "record_path", "record")
    _set_columns(catalog, rows, changes)
    return Outcome(rows.count(), _report(read.where("error is not null"), "text_file"))


def _set_columns(catalog: Catalog, rows: DataFrame, changes: dict) -> None:
    outputs = catalog.read("transcription_output")
    new = rows.select(F.col("id").alias("_id"), *[v.alias(f"_{k}") for k, v in changes.items()])
    joined = outputs.join(new, outputs["id"] == new["_id"], "left")
    catalog.write("transcription_output", joined.select(*[F.coalesce(f"_{c}", c).alias(c) if c in changes else F.col(c) for c in outputs.columns]))


def mine(catalog: Catalog, visit_tsv: str, profile_tsv: str, as_of: datetime, search_text: bool = False, threshold: int = 3, chunk_size: int | None = None, offset: int = 0) -> Results:
    """Match the dates of the queue's files with known visits and upsert the pairs; returns them. Files that can't be read have
    no dates.

    Visits and bounds come from the lists by subject; dates from the confidence records' strings and, ``search_text``, from
    the OCR texts' lines, in this order. Visit and profile cells are themselves parsed, within the default bounds.
    """
    spark = catalog.spark
    queue = materialised(queues.page(queues.mine_queue(catalog.read("transcription_output"), catalog.read("transcription_metadata")), chunk_size, offset))
    subjects = queue.where("subject_id is not null").select(F.col("subject_id").alias("id")).distinct()

    def cells(rows: DataFrame, column: str) -> DataFrame:
        return D.cell_dates(keyed_values(rows, subjects, column), as_of)

    visits = cells(read_list(spark, visit_tsv), "visit_date").select(F.col("id").alias("subject_id"), F.col("date").alias("visit")).distinct()
    profile = read_list(spark, profile_tsv)
    birth = cells(profile, "birth_date").groupBy("id").agg(F.min_by("date", "pos").alias("birth"))
    death = cells(profile, "death_date").groupBy("id").agg(F.min_by("date", "pos").alias("death"))
    bounds = subjects.join(birth, "id", "left").join(death, "id", "left").withColumnRenamed("id", "subject_id")
    files = [F.struct(F.col("pii_scrubber_confidence_file").alias("path"), F.lit(0).alias("rank"))]
    if search_text:
        files.append(F.struct(F.col("ocr_output_file").alias("path"), F.lit(1).alias("rank")))
    wanted_files = queue.select("subject_id", "input_id", F.explode(F.array(*files)).alias("f")).select("subject_id", "input_id", "f.*").where("path is not null")
    texts = materialised(read_each(wanted_files.select("path").distinct()))
    keyed = wanted_files.join(D.file_dates(texts.where("error is null").drop("error"), as_of), "path")
    bounded = keyed.join(bounds, "subject_id", "left").where(D.within(F.col("date"), F.col("birth"), F.col("death"), as_of))
    wanted = queue.select("subject_id", "input_id").distinct().join(visits, "subject_id")
    pairs = match.first_match(bounded, wanted, threshold, ["rank", "pos"], ["subject_id", "input_id"], "visit", "date")
    pairs = materialised(pairs.select("subject_id", "input_id", F.col("visit").alias("visit_date"), F.col("date").alias("extracted_date")))
    catalog.write("transcription_metadata", upsert_pairs(catalog.read("transcription_metadata"), pairs))
    failed = _report(texts.where("error is not null"), "path")
    return Results(pairs, texts.count() - failed, failed)


STAGES: Sequence[str] = ("register", "transcribe", "replace", "scrub", "mine")
