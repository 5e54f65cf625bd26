"""Path parts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SUBJECT = "094-[0-9]{6}"


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def dirname(path: Column) -> Column:
    """Everything before the last slash; empty without one."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def stem(path: Column) -> Column:
    """File name without its last extension; leading dots belong to the name."""
    return F.regexp_replace(basename(path), r"(?<=[^.])\.[^.]*$", "")


def extension(path: Column) -> Column:
    """The last extension with its dot, or empty."""
    return F.regexp_extract(basename(path), r"[^.](\.[^.]*)$", 1)


def subject_id(directory: Column, pattern: str = SUBJECT) -> Column:
    """The first subject id in a directory path; null without one."""
    return F.nullif(F.regexp_extract(directory, f"({pattern})", 1), F.lit(""))


def is_pdf(path: Column) -> Column:
    return path.ilike("%.pdf")


def text_input(replaced: Column, ocr: Column) -> Column:
    """The replaced file if there is one, else the OCR file; empty counts as none."""
    return F.coalesce(F.nullif(replaced, F.lit("")), F.nullif(ocr, F.lit("")))


def output_path(root: str, kind: str, document_type: str | Column, name: Column) -> Column:
    """``{root}/{kind}/{document_type}/{name}``."""
    folder = F.lit(document_type) if isinstance(document_type, str) else document_type
    return F.concat_ws("/", F.lit(root.rstrip("/")), F.lit(kind), folder, name)
