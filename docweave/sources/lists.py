"""Delimited lists: target strings and keyed look-ups. Every value is a string; blank and missing cells are null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEPARATORS = {".csv": ",", ".tsv": "\t"}


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a .csv or .tsv file (the extension decides, as it is written) with a header line."""
    separator = next((s for e, s in SEPARATORS.items() if path.endswith(e)), None)
    if separator is None:
        raise ValueError(f"{path}: the file must be .csv or .tsv")
    return spark.read.options(header=True, sep=separator, multiLine=True, quote='"', escape='"', inferSchema=False).csv(path)


def read_targets(spark: SparkSession, path: str, column: str) -> list[str | None]:
    """The key column in file order, duplicates kept: a list that the user wrote, small by nature."""
    rows = read_list(spark, path)
    if column not in rows.columns:
        raise ValueError(f"{path}: there is no column {column}")
    ranked = rows.select(column, F.monotonically_increasing_id().alias("_n"))
    return [r[0] for r in sorted(ranked.collect(), key=lambda r: r[1])]


def keyed_values(rows: DataFrame, ids: DataFrame, value: str, first: str = "grls_id", second: str = "subject_id", key: str = "id", position: Column | None = None) -> DataFrame:
    """(id, pos, value): rows whose ``first`` column is the id, or else whose ``second`` is; each row once for an id.

    Two equi-joins instead of one with OR; null matches nothing. ``pos`` is the rows' order.
    """
    ordered = rows.select(F.col(first).alias("_a"), F.col(second).alias("_b"), F.col(value).alias("value"), (F.monotonically_increasing_id() if position is None else position).alias("pos"))
    wanted = ids.select(F.col(key).alias("id")).distinct()
    by_first = wanted.join(ordered, F.col("id") == F.col("_a")).select("id", "pos", "value")
    rest = wanted.join(ordered, F.col("id") == F.col("_b")).where(~F.col("_a").eqNullSafe(F.col("id"))).select("id", "pos", "value")
    return by_first.unionByName(rest)
