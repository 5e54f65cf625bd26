"""Command line: one subcommand for each stage and for the tables. ``python -m docweave.cli --catalog DIR COMMAND …``"""

from __future__ import annotations

import argparse
import importlib
import logging
from collections.abc import Sequence
from datetime import datetime

from .catalog import OPERATIONS, Catalog
from .functions.pii import DEFAULT_THRESHOLD, WRAPPER_THRESHOLD
from .operators.ner import NerSettings
from .schemas import DOCUMENT_TYPES

log = logging.getLogger("docweave")


def factory(name: str):
    """What ``package.module:name`` names: something to call for an engine or a classifier."""
    module, _, attribute = name.partition(":")
    if not attribute:
        raise argparse.ArgumentTypeError(f"{name!r} isn't of the form package.module:name")
    try:
        return getattr(importlib.import_module(module), attribute)
    except (ImportError, AttributeError) as e:
        raise argparse.ArgumentTypeError(str(e)) from e


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="docweave", description=__doc__)
    top.add_argument("--catalog", required=True, help="folder of the process tables")
    top.add_argument("--debug", action="store_true", help="log plans and progress")
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, *positional: str, paged: bool = False, chunk: int | None = 1000):
        p = sub.add_parser(name)
        for x in positional:
            p.add_argument(x)
        if paged:
            p.add_argument("--chunk-size", type=int, default=chunk)
            p.add_argument("--offset", type=int, default=0)
        return p

    command("register", "path").add_argument("--document-type", default="document")
    command("tables").add_argument("operation", choices=OPERATIONS)
    transcribe = command("transcribe", "output_to", paged=True)
    transcribe.add_argument("--document-type", default="document", choices=DOCUMENT_TYPES)
    transcribe.add_argument("--engine", type=factory, default=None, help="package.module:name of an OCR engine")
    command("replace", "data_file", "key_column", "replacement", "output_dir", paged=True).add_argument("--document-type", default="document")
    scrub = command("scrub", "output_to", paged=True)
    scrub.add_argument("--document-type", default="document")
    scrub.add_argument("--threshold", type=float, default=DEFAULT_THRESHOLD)
    scrub.add_argument("--strict-profile", action="store_true", help=f"threshold {WRAPPER_THRESHOLD}")
    scrub.add_argument("--config", default=None, help="settings of the classifier's labels and windows (.json or .yaml)")
    scrub.add_argument("--classifier", type=factory, default=None, help="package.module:name of a token classifier")
    mine = command("mine", paged=True, chunk=None)
    mine.add_argument("--visit-dates", required=True)
    mine.add_argument("--profiles", required=True)
    mine.add_argument("--search-texts", action="store_true")
    mine.add_argument("--days", type=int, default=3)
    mine.add_argument("--as-of", type=datetime.fromisoformat, default=None)
    return top


def main(arguments: Sequence[str] | None = None, spark=None) -> int:
    a = parser().parse_args(arguments)
    logging.basicConfig(level=logging.DEBUG if a.debug else logging.INFO)
    if spark is None:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.appName("docweave").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    from .plans import stages

    catalog = Catalog(spark, a.catalog)
    if a.command == "tables":
        catalog.run(a.operation)
    elif a.command == "register":
        log.info("registered %d", stages.register(catalog, a.path, a.document_type))
    elif a.command == "transcribe":
        _, done, failed = stages.transcribe(catalog, a.output_to, a.document_type, a.chunk_size, a.offset, *([a.engine] if a.engine else []))
        return _said("transcribed", done, failed)
    elif a.command == "replace":
        done, failed = stages.replace(catalog, a.data_file, a.key_column, a.replacement, a.output_dir, a.document_type, a.chunk_size, a.offset)
        return _said("replaced", done, failed)
    elif a.command == "scrub":
        threshold = WRAPPER_THRESHOLD if a.strict_profile else a.threshold
        settings = NerSettings.load(a.config) if a.config else None
        done, failed = stages.scrub(catalog, a.output_to, a.document_type, a.chunk_size, a.offset, threshold, a.classifier, settings)
        return _said("scrubbed", done, failed)
    else:
        _, done, failed = stages.mine(catalog, a.visit_dates, a.profiles, a.as_of or datetime.now(), a.search_texts, a.days, a.chunk_size, a.offset)
        return _said("read", done, failed)
    return 0


def _said(what: str, done: int, failed: int) -> int:
    """Log the counts; the exit code, 1 if a file failed."""
    log.info("%s %d, failed %d", what, done, failed)
    return int(failed > 0)


if __name__ == "__main__":
    raise SystemExit(main())
