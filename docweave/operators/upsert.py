"""Upsert of date pairs into the metadata: placeholders are filled, the rest is inserted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .match import pairs_not_in

KEY = ("subject_id", "input_id")
PAIR = ("visit_date", "extracted_date")


def upsert_pairs(metadata: DataFrame, pairs: DataFrame) -> DataFrame:
    """``metadata`` with ``pairs`` (subject_id, input_id, visit_date, extracted_date): all rows of the new version.

    All placeholders (rows of the key with both dates null) take the key's smallest pair; pairs that no row of the key holds
    then are inserted, with ids after the largest. A second run with the same pairs changes nothing.
    """
    wanted = pairs.select(*KEY, *PAIR).distinct()
    lowest = wanted.groupBy(*KEY).agg(F.min(F.struct(*PAIR)).alias("p")).select(F.col("subject_id").alias("_s"), F.col("input_id").alias("_i"), F.col("p.visit_date").alias("_v"), F.col("p.extracted_date").alias("_e"))
    open_ = F.col("visit_date").isNull() & F.col("extracted_date").isNull()
    joined = metadata.join(lowest, metadata["subject_id"].eqNullSafe(lowest["_s"]) & (metadata["input_id"] == lowest["_i"]), "left")
    filled = joined.withColumns({"visit_date": F.when(open_, F.col("_v")).otherwise(F.col("visit_date")), "extracted_date": F.when(open_, F.col("_e")).otherwise(F.col("extracted_date"))}).select(*metadata.columns)
    rest = pairs_not_in(wanted, filled, [*KEY, *PAIR])
    return filled.unionByName(numbered(rest.withColumn("year_in_study", F.lit(None).cast("int")), metadata).select(*metadata.columns))


def numbered(rows: DataFrame, table: DataFrame, column: str = "id") -> DataFrame:
    """``rows`` with ids after the largest of ``table``: numbers within hashed groups, interleaved, so that no task numbers all
    rows. Ids are unique but leave gaps."""
    groups = max(1024, 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    top = table.agg(F.coalesce(F.max(column), F.lit(0)).alias("_top"))
    content = [c for c in rows.columns if c != column]
    dealt = rows.drop(column).withColumn("_g", F.pmod(F.xxhash64(*content), F.lit(groups)))
    within = F.row_number().over(Window.partitionBy("_g").orderBy(*content))
    ranked = dealt.withColumn("_n", (within - 1) * groups + F.col("_g") + 1)
    return ranked.withColumn("_top", top.scalar()).withColumn(column, F.col("_top") + F.col("_n")).drop("_g", "_n", "_top")
