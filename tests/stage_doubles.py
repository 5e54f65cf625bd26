"""An engine and a classifier that stand for real ones."""

from __future__ import annotations

from docweave.operators.ner import TokenClassifier
from docweave.operators.ocr import OcrEngine


class Reader(OcrEngine):
    def results(self, path, document_type):
        if "broken" in path:
            raise OSError("broken file")
        with open(path) as f:
            yield {"content": f.read(), "confidence": 80.0, "page": 1, "block": 0}


class Names(TokenClassifier):
    def classify(self, texts):
        return [[("STAFF", a, b, 0.9) for a, b in self.tokens(t) if t[a:b] == "Smith"] for t in texts]
