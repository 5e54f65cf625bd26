"""Personal data: detection by patterns, filtering, conflict resolution, redaction and the confidence record.

Spans count characters (code points) from 0 and end exclusively. Statistical entities (names, places, organisations) need a
model: pass ``model_spans``, any column of spans made by one, and they take part like the others.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: (entity, pattern, score, check). ASCII guards instead of word boundaries, whose meaning differs between engines.
RECOGNISERS: tuple[tuple[str, str, float, str | None], ...] = (
    ("EMAIL_ADDRESS", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", 1.0, None),
    ("IP_ADDRESS", r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}", 0.6, "octets"),
    ("PHONE_NUMBER", r"(\+1 )?\([0-9]{3}\) [0-9]{3}-[0-9]{4}|(\+1[ -])?[0-9]{3}-[0-9]{3}-[0-9]{4}", 0.75, None),
    ("CREDIT_CARD", r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}", 1.0, "luhn"),
    ("ID", r"094-[0-9]{6}", 0.85, None),
    ("DATE_TIME", r"[0-9]{4}-[0-9]{2}-[0-9]{2}", 0.6, None),
    ("URL", r"https?://[A-Za-z0-9./?#=&_%:-]+", 0.6, None),
    ("US_SSN", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", 0.5, "ssn"),
    ("IBAN_CODE", r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", 0.8, "iban"),
)
#: Text that each match of a recogniser holds: without it the pattern needn't be tried.
HINTS = {"EMAIL_ADDRESS": "@", "ID": "094-", "URL": "://"}
#: A piece of text that holds each match of ``RECOGNISERS`` that it touches as a whole: the characters that they are made of, with a
#: digit, @ or : before the first space, and only spaces between digits or parentheses, as in phone and card numbers.
RUN = r"(?<![A-Za-z0-9._%+@/?#=&:()-])[A-Za-z._%+/?#=&()-]*+[0-9@:](?:[A-Za-z0-9._%+@/?#=&:()-]++|(?<=[0-9)]) (?=[0-9(]))*+"
#: Labels of token classifiers, and the entities that they stand for (fixed values).
LABELS = {
    "PER": "PERSON", "PATIENT": "PERSON", "STAFF": "PERSON", "HCW": "PERSON", "PERSON": "PERSON",
    "LOC": "LOCATION", "GPE": "LOCATION", "HOSPITAL": "LOCATION", "FACILITY": "LOCATION", "LOCATION": "LOCATION",
    "ORG": "ORGANIZATION", "HOSP": "ORGANIZATION", "PATORG": "ORGANIZATION", "VENDOR": "ORGANIZATION", "ORGANIZATION": "ORGANIZATION",
    "NORP": "NRP", "DATE": "DATE_TIME", "TIME": "DATE_TIME", "PHONE": "PHONE_NUMBER", "AGE": "AGE", "ID": "ID", "EMAIL": "EMAIL",
}
IGNORED_LABELS = ("O",)
LOW_SCORE = {"ID": 0.4}
EXCLUDED = ("IN_PAN",)
DEFAULT_THRESHOLD, WRAPPER_THRESHOLD = 0.0, 0.45


def _luhn(match: Column) -> Column:
    digits = F.transform(F.split(F.regexp_replace(match, "[^0-9]", ""), ""), lambda c: c.try_cast("int"))
    digits = F.reverse(F.filter(digits, lambda d: d.isNotNull()))

    def worth(d: Column, i: Column) -> Column:
        twice = d * 2
        return F.when(i % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(F.transform(digits, worth), F.lit(0), lambda a, d: a + d) % 10 == 0


def _octets(match: Column) -> Column:
    return F.forall(F.split(match, r"\."), lambda p: p.try_cast("int") <= 255)


def _ssn(match: Column) -> Column:
    """Numbers that can be issued: no part all zeros, area neither 666 nor from 900 on."""
    area, group, serial = F.substring(match, 1, 3), F.substring(match, 5, 2), F.substring(match, 8, 4)
    return ~area.isin("000", "666") & (area < "900") & (group != "00") & (serial != "0000")


def _iban(match: Column) -> Column:
    """The number modulo 97 is 1, with the first four characters last and letters from 10 on."""
    moved = F.split(F.concat(F.substr(match, F.lit(5)), F.substring(match, 1, 4)), "")
    value = F.transform(F.filter(moved, lambda c: c != ""), lambda c: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1)
    return F.aggregate(value, F.lit(0), lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97) == 1


_SPANS = "array<struct<entity:string,start:int,end:int,score:double>>"
CHECKS = {"luhn": _luhn, "octets": _octets, "ssn": _ssn, "iban": _iban}


def _let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of a value that is computed once, however often ``fn`` uses it."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def _located(text: Column, pattern: str) -> Column:
    """(start, match) of a pattern's matches: places come from the lengths of what lies between them and of the matches."""
    inner = f"(?:{pattern})"
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,match:string>>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        start = s["at"] + x["gap"]
        return F.struct((start + F.length(x["m"])).alias("at"), F.array_append(s["out"], F.struct(start.alias("start"), x["m"].alias("match"))).alias("out"))

    def placed(found: Column) -> Column:
        between = F.slice(F.split(text, inner, -1), 1, F.size(found))
        return F.aggregate(F.zip_with(found, between, lambda m, b: F.struct(F.length(b).alias("gap"), m.alias("m"))), state, step)["out"]

    return _let(F.regexp_extract_all(text, F.lit(inner), F.lit(0)), placed)


def pattern_spans(text: Column, entity: str, pattern: str, score: float, check: str | None = None, hint: str | None = None) -> Column:
    """Spans of a pattern's matches."""
    found = _located(text, pattern)
    if check:
        found = F.filter(found, lambda x: CHECKS[check](x["match"]))
    spans = F.transform(found, lambda x: F.struct(F.lit(entity).alias("entity"), x["start"].alias("start"), (x["start"] + F.length(x["match"])).alias("end"), F.lit(score).alias("score")))
    # most texts hold no match: a search for fixed text or one scan by the pattern decides that before any array is made
    inner = f"(?:{pattern})"
    holds = text.rlike(inner) if hint is None else text.contains(hint) & text.rlike(inner)
    return F.when(holds, spans).otherwise(F.array().cast(_SPANS))


def _own_spans(text: Column, recognisers: Sequence[tuple[str, str, float, str | None]]) -> Column:
    """Spans of some of ``RECOGNISERS``: the text is scanned for ``RUN`` alone, which holds every match of theirs whole, and
    the patterns are tried in what that finds."""

    def within(run: Column) -> Column:
        spans = F.concat(*[pattern_spans(run["match"], *r, HINTS.get(r[0])) for r in recognisers])
        return F.transform(spans, lambda s: F.struct(s["entity"].alias("entity"), (s["start"] + run["start"]).alias("start"), (s["end"] + run["start"]).alias("end"), s["score"].alias("score")))

    return F.when(text.rlike("[0-9@:]"), F.flatten(F.transform(_located(text, RUN), within))).otherwise(F.array().cast(_SPANS))


def detect(text: Column, recognisers: Sequence[tuple[str, str, float, str | None]] = RECOGNISERS, model_spans: Column | None = None) -> Column:
    """All spans, sorted by (start, end, entity); a null text has none."""
    given = F.coalesce(text, F.lit(""))
    own = [r for r in recognisers if r[:2] in {x[:2] for x in RECOGNISERS}]
    parts = [pattern_spans(given, *r) for r in recognisers if r not in own]
    if own:
        parts.append(_own_spans(given, own))
    if model_spans is not None:
        parts.append(model_spans)
    by_place = F.transform(F.concat(*parts), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["entity"].alias("entity"), s["score"].alias("score")))
    return F.transform(F.array_sort(by_place), lambda s: F.struct(s["entity"].alias("entity"), s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score")))


def map_label(label: Column, labels: Mapping[str, str] = LABELS) -> Column:
    """The entity of a classifier's label; a label to ignore is null, an unknown one stays as it is."""
    table = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    return F.when(label.isin(*IGNORED_LABELS), F.lit(None)).otherwise(F.coalesce(F.element_at(table, label), label))


def scaled_score(entity: Column, score: Column, factors: Mapping[str, float] = LOW_SCORE) -> Column:
    """Scores of unreliable entities times their factor."""
    out = score
    for name, factor in factors.items():
        out = F.when(entity == name, out * factor).otherwise(out)
    return out


def keep_spans(spans: Column, threshold: float = DEFAULT_THRESHOLD, excluded: Sequence[str] = EXCLUDED) -> Column:
    """Spans of ``threshold`` or more whose entity isn't excluded."""
    return F.filter(spans, lambda s: (s["score"] >= threshold) & ~s["entity"].isin(*excluded))


def resolve(spans: Column) -> Column:
    """Spans without overlaps: from left to right, of two that overlap the higher score stays, then the longer, then the first."""
    none = F.array().cast(_SPANS)

    def step(kept: Column, s: Column) -> Column:
        last = F.element_at(kept, -1)
        better = (s["score"] > last["score"]) | ((s["score"] == last["score"]) & (s["end"] - s["start"] > last["end"] - last["start"]))
        instead = F.array_append(F.slice(kept, 1, F.size(kept) - 1), s)
        return F.when((F.size(kept) == 0) | (s["start"] >= F.get(kept, F.size(kept) - 1)["end"]), F.array_append(kept, s)).when(F.coalesce(better, F.lit(True)), instead).otherwise(kept)

    return F.aggregate(spans, none, step)


def redact(text: Column, spans: Column) -> Column:
    """Each span (resolved, in order) replaced by ``<ENTITY>``."""
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(s: Column, x: Column) -> Column:
        return F.struct(x["end"].alias("at"), F.concat(s["out"], F.substr(text, s["at"] + 1, x["start"] - s["at"]), F.lit("<"), x["entity"], F.lit(">")).alias("out"))

    def replaced(own: Column) -> Column:
        return F.when(F.size(own) == 0, text).otherwise(_let(F.aggregate(own, state, step), lambda done: F.concat(done["out"], F.substr(text, done["at"] + 1, F.length(text)))))

    return _let(spans, replaced)


def record(text: Column, spans: Column) -> Column:
    """The confidence record: original text without new-lines, type, place and score of each span (not resolved)."""
    return F.transform(
        spans,
        lambda s: F.struct(
            F.replace(F.substr(text, s["start"] + 1, s["end"] - s["start"]), F.lit("\n"), F.lit("")).alias("Original Text"),
            s["entity"].alias("Type"), s["start"].alias("Start"), s["end"].alias("End"), s["score"].alias("Score"),
        ),
    )


def scrub(text: Column, threshold: float = DEFAULT_THRESHOLD, model_spans: Column | None = None) -> tuple[Column, Column]:
    """(redacted text, confidence record)."""
    kept = keep_spans(detect(text, model_spans=model_spans), threshold)
    return redact(text, resolve(kept)), record(text, kept)
