"""Band matching of visit dates with extracted dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_DAY = 86_400_000_000


def _micros(t: Column) -> Column:
    """Microseconds of a zone-less time, exactly."""
    day = F.datediff(t.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    clock = F.hour(t).cast("long") * 3600 + F.minute(t) * 60
    return day * F.lit(_DAY) + clock * 1_000_000 + (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("long")


def band_join(extracted: DataFrame, visits: DataFrame, days: int, key: Sequence[str] = ("key",), visit: str = "visit", date: str = "extracted") -> DataFrame:
    """Every visit with every extracted date of its key at most ``days`` days away (exact time, inclusive).

    Equi-join on the key and a time bucket of four bands, so that each visit looks into one or two buckets. A key with very
    many dates so spreads over its buckets instead of pairing all with all. Only the bucket travels besides the given columns.
    """
    if days < 0:
        raise ValueError("days can't be negative")
    band, width = days * _DAY, 4 * max(days, 1) * _DAY
    keys = list(key)
    e = extracted.withColumn("_bucket", F.floor(_micros(F.col(date)) / width))
    at = _micros(F.col(visit))
    v = visits.withColumn("_bucket", F.explode(F.sequence(F.floor((at - band) / width), F.floor((at + band) / width))))
    joined = v.join(e, [*keys, "_bucket"])
    return joined.where(F.abs(_micros(F.col(date)) - _micros(F.col(visit))) <= F.lit(band)).drop("_bucket")


def first_match(extracted: DataFrame, visits: DataFrame, days: int, position: Sequence[str], key: Sequence[str] = ("key",), visit: str = "visit", date: str = "extracted") -> DataFrame:
    """For each visit the first extracted date (smallest ``position``, not the nearest) within ``days`` days: unique pairs."""
    keys = list(key)
    once = visits.select(*keys, visit).distinct()
    pairs = band_join(extracted.select(*keys, date, *[c for c in position if c != date]), once, days, keys, visit, date)
    return pairs.groupBy(*keys, visit).agg(F.min_by(date, F.struct(*position)).alias(date))


def first_dates(rows: DataFrame, key: str, position: str, columns: Sequence[str]) -> DataFrame:
    """For each key the first non-null value of each column, in the order of ``position``."""
    return rows.groupBy(key).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(position))).alias(c) for c in columns])


def pairs_in(pairs: DataFrame, known: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairs whose columns stand in ``known``."""
    return pairs.join(known.select(*columns).distinct(), list(columns), "left_semi")


def pairs_not_in(pairs: DataFrame, known: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairs whose columns don't stand in ``known`` (null equal to null).

    The columns are compared as one struct, in which nulls are equal: what made ``known`` distinct is dealt for the join, too.
    """
    whole = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(columns)])
    other = known.select(whole.alias("_known")).distinct()
    return pairs.join(other, whole == F.col("_known"), "left_anti")
