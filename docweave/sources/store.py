"""Intermediate results in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only in local mode, where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if folder is None:
        if not _LOCAL:
            _LOCAL.append(tempfile.mkdtemp(prefix="docweave-checkpoints-"))
        folder = _LOCAL[0]
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, what: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"


def materialised(df: DataFrame) -> DataFrame:
    """``df`` computed once by a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()
