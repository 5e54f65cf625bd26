"""Spans by a token classifier: the engine's settings, overlapping windows over long texts, and merging.

The classifier itself is whatever ``TokenClassifier`` a caller brings; one is made in each Python worker.
"""

from __future__ import annotations

import json
import re
from abc import ABC, abstractmethod
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..functions.pii import IGNORED_LABELS, LABELS, LOW_SCORE

_TOKEN = re.compile(r"\S+")
#: Texts whose spans a worker holds at a time, and windows in one call of the classifier.
_TEXTS, _WINDOWS = 64, 256
Span = tuple[str, int, int, float]


@dataclass(frozen=True)
class NerSettings:
    """How labels become entities and how long texts are cut: windows of ``window`` tokens of the classifier that share
    ``stride`` tokens."""

    labels: Mapping[str, str] = field(default_factory=lambda: dict(LABELS))
    ignored: Sequence[str] = IGNORED_LABELS
    low_score: Mapping[str, float] = field(default_factory=lambda: dict(LOW_SCORE))
    window: int = 384
    stride: int = 16
    expand: bool = True

    def __post_init__(self) -> None:
        if not 0 <= self.stride < self.window:
            raise ValueError("the stride must be smaller than the window")

    @classmethod
    def load(cls, path: str) -> NerSettings:
        """From a .json file, or a .yaml or .yml file where a YAML reader is installed; keys are the fields' names."""
        with open(path, encoding="utf-8") as f:
            if path.endswith(".json"):
                return cls(**json.load(f))
            if path.endswith((".yaml", ".yml")):
                try:
                    import yaml
                except ImportError as e:
                    raise ImportError("reading YAML needs the package pyyaml; JSON works without") from e
                return cls(**yaml.safe_load(f))
        raise ValueError(f"{path}: settings are .json, .yaml or .yml")


class TokenClassifier(ABC):
    def tokens(self, text: str) -> list[tuple[int, int]]:
        """(start, end) of the model's tokens in order, by which windows are measured; words, unless the model says otherwise."""
        return [(m.start(), m.end()) for m in _TOKEN.finditer(text)]

    @abstractmethod
    def classify(self, texts: Sequence[str]) -> list[list[Span]]:
        """For each text its (label, start, end, score), places in characters."""


def windows(text: str, size: int, stride: int, tokens: Sequence[tuple[int, int]] | None = None) -> list[tuple[int, str]]:
    """(place, part) of a text cut into windows of ``size`` tokens that share ``stride`` tokens; one window if it is short.
    ``tokens``: their (start, end); words if not given."""
    words = [(m.start(), m.end()) for m in _TOKEN.finditer(text)] if tokens is None else tokens
    out, i = [], 0
    while i < len(words):
        a, b = words[i][0], words[min(i + size, len(words)) - 1][1]
        out.append((a, text[a:b]))
        if i + size >= len(words):
            break
        i += size - stride
    return out


def merged(spans: Sequence[Span], text: str, settings: NerSettings) -> list[Span]:
    """Entities of labelled spans: ignored labels go, spans grow to whole words, overlapping ones of one entity join with
    the higher score, scores of unreliable entities are scaled."""
    out: list[Span] = []
    known = [(settings.labels.get(x, x), a, b, s) for x, a, b, s in spans if x not in settings.ignored]
    if settings.expand:
        grown = []
        for e, a, b, s in known:
            while a > 0 and not text[a - 1].isspace() and text[a - 1].isalnum():
                a -= 1
            while b < len(text) and text[b].isalnum():
                b += 1
            grown.append((e, a, b, s))
        known = grown
    for e, a, b, s in sorted(known, key=lambda x: (x[0], x[1], x[2])):
        if out and out[-1][0] == e and a < out[-1][2]:
            out[-1] = (e, out[-1][1], max(b, out[-1][2]), max(s, out[-1][3]))
        else:
            out.append((e, a, b, s))
    return sorted(((e, a, b, s * settings.low_score.get(e, 1.0)) for e, a, b, s in out), key=lambda x: (x[1], x[2], x[0]))


def _spans(model: TokenClassifier, texts: Sequence[str], settings: NerSettings) -> list[list[Span]]:
    """Merged spans of each text; the model gets ``_WINDOWS`` windows at a time, and only labels that count are kept."""
    raw: list[list[Span]] = [[] for _ in texts]
    waiting: list[tuple[int, int, str]] = []

    def classify_waiting() -> None:
        for (k, place, _), own in zip(waiting, model.classify([part for _, _, part in waiting])):
            raw[k].extend((x, a + place, b + place, s) for x, a, b, s in own if x not in settings.ignored)
        waiting.clear()

    for k, text in enumerate(texts):
        for place, part in windows(text, settings.window, settings.stride, model.tokens(text)):
            waiting.append((k, place, part))
            if len(waiting) == _WINDOWS:
                classify_waiting()
    if waiting:
        classify_waiting()
    return [merged(spans, text, settings) for spans, text in zip(raw, texts)]


def classify(texts: DataFrame, classifier: Callable[[], TokenClassifier], settings: NerSettings | None = None, column: str = "text") -> DataFrame:
    """``texts`` with ``model_spans``, as ``functions.pii.detect`` takes them; null texts have none.

    A worker holds the spans of ``_TEXTS`` texts and the classifier's answers for ``_WINDOWS`` windows, however large a batch is.
    """
    chosen = settings or NerSettings()
    rows = texts.drop("model_spans")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    schema = f"{fields}, model_spans array<struct<entity:string,start:int,end:int,score:double>>"
    at = rows.columns.index(column)

    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("entity", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        model = classifier()
        for batch in batches:
            for i in range(0, batch.num_rows, _TEXTS):
                part = batch.slice(i, _TEXTS)
                found = _spans(model, [t or "" for t in part.column(at).to_pylist()], chosen)
                spans = pa.array([[{"entity": e, "start": a, "end": b, "score": s} for e, a, b, s in own] for own in found], kind)
                yield pa.RecordBatch.from_arrays([*part.columns, spans], names=[*part.schema.names, "model_spans"])

    return rows.mapInArrow(run, schema)
