"""OCR results at document, page and block level, and the interface of an OCR engine.

An engine turns one path into results; the roll-ups work on a table of page or block results wherever it comes from.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import check_document_type

RESULT_DDL = "id long, content string, confidence double, page int, block int, error string"


class OcrEngine(ABC):
    """Made once in each Python worker; ``results`` gives a mapping (content, confidence, page, block) for each unit."""

    @abstractmethod
    def results(self, path: str, document_type: str) -> Iterator[dict]: ...


class LibraryOcrEngine(OcrEngine):
    """Pages through pdf2image and tesserocr, where these are installed."""

    def __init__(self) -> None:
        try:
            import pdf2image
            import tesserocr
        except ImportError as e:
            raise ImportError("OCR needs the packages pdf2image and tesserocr") from e
        self._pages, self._tesserocr = pdf2image.convert_from_path, tesserocr

    def results(self, path: str, document_type: str) -> Iterator[dict]:
        with self._tesserocr.PyTessBaseAPI() as api:
            for page, image in enumerate(self._pages(path), 1):
                api.SetImage(image)
                if document_type != "block":
                    yield {"content": api.GetUTF8Text(), "confidence": float(api.MeanTextConf()), "page": page, "block": 0}
                    continue
                for block, (_, box, _, _) in enumerate(api.GetComponentImages(self._tesserocr.RIL.TEXTLINE, True), 1):
                    api.SetRectangle(box["x"], box["y"], box["w"], box["h"])
                    yield {"content": api.GetUTF8Text(), "confidence": float(api.MeanTextConf()), "page": page, "block": block}


def run_ocr(inputs: DataFrame, engine: Callable[[], OcrEngine], document_type: str) -> DataFrame:
    """(id, content, confidence, page, block, error) of ``inputs`` (id, input_file): pages, or blocks for ``block``.

    A file that fails gives one row with its error and no content; the others go on.
    """
    check_document_type(document_type)

    def recognise(batches):
        import pandas as pd

        made = engine()
        for batch in batches:
            for key, path in zip(batch["id"], batch["input_file"]):
                try:
                    rows = [{"id": key, **r, "error": None} for r in made.results(path, document_type)]
                except Exception as e:  # noqa: BLE001  any file may be broken in its own way
                    rows = [{"id": key, "content": None, "confidence": None, "page": None, "block": None, "error": str(e)}]
                if rows:
                    yield pd.DataFrame(rows)

    return inputs.select("id", "input_file").mapInPandas(recognise, RESULT_DDL)


def document_rollup(pages: DataFrame, key: str = "id") -> DataFrame:
    """One row for each document with a usable page (text, and confidence above 0): mean confidence, the usable pages'
    texts in order with a new-line before each, page 1, block 1."""
    usable = pages.where((F.length("content") > 0) & (F.col("confidence") > 0))
    parts = F.array_sort(F.collect_list(F.struct("page", "content")))
    return usable.groupBy(key).agg(
        F.concat_ws("", F.transform(parts, lambda p: F.concat(F.lit("\n"), p["content"]))).alias("content"),
        F.avg("confidence").alias("confidence"),
        F.lit(1).alias("page"),
        F.lit(1).alias("block"),
    )


def page_results(pages: DataFrame, key: str = "id") -> DataFrame:
    """Every page as it is, block 0."""
    return pages.select(key, "content", "confidence", "page", F.lit(0).alias("block"))


def block_results(pages: DataFrame, lines: str = "lines", key: str = "id") -> DataFrame:
    """A row for each text line of a page's array ``lines`` (content, confidence), page and block from 1."""
    return pages.select(key, "page", F.posexplode(lines).alias("n", "x")).select(key, F.col("x.content").alias("content"), F.col("x.confidence").alias("confidence"), "page", (F.col("n") + 1).alias("block"))


def last_result(results: DataFrame, key: str = "id") -> DataFrame:
    """The result of the last page and block only, as one output row for each input keeps."""
    chosen = F.max_by(F.struct("content", "confidence", "page", "block"), F.struct("page", "block"))
    return results.groupBy(key).agg(chosen.alias("x")).select(key, "x.*")


def confidence_metrics(results: DataFrame, threshold: float, width: float = 10.0) -> DataFrame:
    """(bin, n, n_low): results by confidence in bins of ``width``, and how many of them lie below ``threshold``."""
    low = F.floor(F.col("confidence") / width).cast("int")
    return results.groupBy(low.alias("bin")).agg(F.count("*").alias("n"), F.count_if(F.col("confidence") < threshold).alias("n_low"))
