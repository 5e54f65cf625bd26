"""Dates in text and JSON: fuzzy parsing by dateutil in Arrow batches, strict patterns natively, and bounds.

What a fuzzy parser fills in (a missing year, say) comes from ``as_of``, one value for a run, never from the clock.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EARLIEST = datetime(2010, 1, 1)
_NAMES = (
    "jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
    "|mon(?:day)?|tue(?:sday)?|wed(?:nesday)?|thu(?:rsday)?|fri(?:day)?|sat(?:urday)?|sun(?:day)?"
)
#: What a text must hold for the parser to find a date: a digit, or a month's or week day's name as a whole run of letters.
MAY_HOLD_DATE = rf"(?i)\p{{Nd}}|(?<!\p{{L}})(?:{_NAMES})(?!\p{{L}})"
#: A text with one plain year-month-day or month/day/year and no other digit; with no name either, the parser has no choice.
_PLAIN = re.compile(r"[^0-9]*(?<![\w.,:/+-])(?:([12][0-9]{3})-(0[1-9]|1[0-2])-([0-2][0-9]|3[01])|(0?[1-9]|1[0-2])/(0?[1-9]|[12][0-9]|3[01])/([12][0-9]{3}))(?![\w.,:/+-])[^0-9]*")
_NAMED = re.compile(rf"(?<![a-z])(?:{_NAMES})(?![a-z])", re.IGNORECASE)


def _plain(text: str) -> tuple[int, int, int] | None:
    """(year, month, day) where the parser would do no more than read them."""
    if not text.isascii() or not (m := _PLAIN.fullmatch(text)) or _NAMED.search(text):
        return None
    y, month, d, us_month, us_d, us_y = m.groups()
    return (int(y), int(month), int(d)) if y else (int(us_y), int(us_month), int(us_d))


def parse_fuzzy(text: str, as_of: datetime) -> datetime | None:
    """At most one date of a text, zone ignored; None if the parser refuses it for any reason."""
    if found := _plain(text):
        try:
            return datetime(*found)
        except ValueError:
            return None
    return _remembered(text, as_of) if len(text) <= 200 else _parsed(text, as_of)


def _parsed(text: str, as_of: datetime) -> datetime | None:
    from dateutil import parser

    midnight = as_of.replace(hour=0, minute=0, second=0, microsecond=0, tzinfo=None)
    try:
        return parser.parse(text, fuzzy=True, ignoretz=True, default=midnight)
    except Exception:  # noqa: BLE001  the parser raises many kinds
        return None


_remembered = functools.lru_cache(1 << 14)(_parsed)


def find_dates(value: object, earliest: datetime | None, latest: datetime | None, as_of: datetime) -> list[datetime]:
    """Dates of a string (one at most), or depth first of the strings in lists and mappings, within both bounds."""
    low, high = earliest or EARLIEST, latest or as_of
    if isinstance(value, str):
        found = parse_fuzzy(value, as_of)
        return [found] if found is not None and low <= found <= high else []
    if isinstance(value, dict):
        value = list(value.values())
    return [d for v in value for d in find_dates(v, low, high, as_of)] if isinstance(value, list) else []


def fuzzy_date(text: Column, as_of: datetime) -> Column:
    """The date of each text without bounds, or null; texts that can't hold one don't reach Python. Dates before 1678 or from
    2262 on, which the exchanged type can't hold, are null."""
    @F.pandas_udf(T.TimestampNTZType())
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        low, high = datetime(1678, 1, 1), datetime(2262, 1, 1)  # what the exchanged type holds
        for texts in batches:
            found = (parse_fuzzy(t, as_of) if t is not None else None for t in texts)
            yield pd.Series([d if d is not None and low <= d < high else None for d in found], dtype="datetime64[ns]")

    return parse(F.when(text.rlike(MAY_HOLD_DATE), text))


def strict_dates(text: Column) -> Column:
    """All ISO dates of a text, in order, that name a real day."""
    found = F.regexp_extract_all(text, F.lit(r"(?:^|[^0-9])([0-9]{4}-[0-9]{2}-[0-9]{2})(?![0-9])"), F.lit(1))
    return F.filter(F.transform(found, lambda d: F.try_to_date(d, "yyyy-MM-dd").cast("timestamp_ntz")), lambda d: d.isNotNull())


def json_dates(texts: DataFrame, as_of: datetime, column: str = "text") -> DataFrame:
    """``texts`` with ``dates``: those of the strings in the JSON value of ``column``, depth first; bad JSON has none."""
    @F.pandas_udf(T.ArrayType(T.TimestampNTZType()))
    def parse(values: pd.Series) -> pd.Series:
        def one(v):
            try:
                return find_dates(json.loads(v), datetime(1678, 1, 1), datetime(2262, 1, 1), as_of) if v is not None else []
            except ValueError:
                return []

        return pd.Series([one(v) for v in values], dtype=object)

    return texts.withColumn("dates", parse(F.col(column)))


def lines(texts: DataFrame, column: str = "text") -> DataFrame:
    """A row for each line (line from 0, text); an empty piece after the last line end isn't one."""
    pieces = F.split(F.col(column), r"\r\n|\r|\n", -1)
    cut = F.when(F.element_at(pieces, -1) == "", F.slice(pieces, 1, F.size(pieces) - 1)).otherwise(pieces)
    rest = [c for c in texts.columns if c != column]
    return texts.select(*rest, F.posexplode(cut).alias("line", column))


def file_dates(files: DataFrame, as_of: datetime) -> DataFrame:
    """(…, pos, date) of files (path, text, any more): a .json's strings depth first, a .txt line by line, none of others.
    Rows without path or text have none."""
    rest = [c for c in files.columns if c != "text"]
    trees = json_dates(files.where(F.col("path").endswith(".json")), as_of).select(*rest, F.posexplode("dates").alias("pos", "date"))
    each = line_dates(files.where(F.col("path").endswith(".txt")), as_of).select(*rest, F.col("line").alias("pos"), "date")
    return trees.unionByName(each)


def within(date: Column, earliest: Column | None, latest: Column | None, as_of: datetime) -> Column:
    """Both bounds inclusive, time of day counted; missing ones are 2010-01-01 and ``as_of``."""
    low = F.lit(EARLIEST).cast("timestamp_ntz") if earliest is None else F.coalesce(earliest, F.lit(EARLIEST).cast("timestamp_ntz"))
    high = F.lit(as_of).cast("timestamp_ntz") if latest is None else F.coalesce(latest, F.lit(as_of).cast("timestamp_ntz"))
    return date.between(low, high)


def line_dates(texts: DataFrame, as_of: datetime, column: str = "text", strict: bool = False) -> DataFrame:
    """(…, line, date): the fuzzy date of each line or, ``strict``, all its ISO dates."""
    each = lines(texts, column)
    if strict:
        return each.withColumn("date", F.explode(strict_dates(F.col(column)))).drop(column)
    return each.withColumn("date", fuzzy_date(F.col(column), as_of)).drop(column).where("date is not null")


def cell_dates(cells: DataFrame, as_of: datetime) -> DataFrame:
    """(id, pos, date) of list cells (id, pos, value): the fuzzy date of each, within the default bounds."""
    found = cells.withColumn("date", fuzzy_date(F.col("value"), as_of))
    return found.where(within(F.col("date"), None, None, as_of)).select("id", "pos", "date")


def distinct_dates(dates: DataFrame, keys: list[str], date: str = "date", position: str = "pos") -> DataFrame:
    """One row for each key and date with its first position."""
    return dates.groupBy(*keys, date).agg(F.min(position).alias(position))
