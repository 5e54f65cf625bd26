"""Session helpers shared by the training-data operators: the shared folder, intermediate tables, input sizes."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}


def release() -> None:
    """Give freed memory back to the system: Python workers outlive their tasks, and several share an executor's memory."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def lean_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let Arrow batches hold at most ``rows`` rows in this session: texts are long, and the JVM, its off-heap buffers and
    the Python worker each hold a batch."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; a temporary one only where that is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if "dir" not in _LOCAL:
        _LOCAL["dir"] = "file://" + tempfile.mkdtemp(prefix="docweave-")
    spark.sparkContext.setCheckpointDir(_LOCAL["dir"])
    return _LOCAL["dir"]


def fresh_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str = "table") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, what)
    for made in _OPEN:
        made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_OPEN: list[list[str]] = []


@contextlib.contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Tables that operators store within this block are deleted at its end. What the operators returned reads them: write it,
    or compute it, inside the block."""
    _OPEN.append(made := [])
    try:
        yield
    finally:
        _OPEN.remove(made)
        for path in made:
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def steady(df: DataFrame, what: str = "input") -> DataFrame:
    """``df`` if it only reads, filters and projects a table, whose partitions come out the same when a task runs again; stored
    first if anything else stands in its plan."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    nodes = {re.sub(r"^[\s:+|-]*", "", line).split(" ")[0] for line in plan.splitlines() if line.strip()}
    return df if nodes <= {"Relation", "Project", "Filter", "LocalRelation"} else stored(df, what)


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of a text column, by one column-pruned aggregate."""
    return int(docs.agg(F.coalesce(F.sum(F.octet_length(column).cast("long")), F.lit(0))).first()[0])


def pieces(total: int, each: int) -> int:
    """How many parts of about ``each`` units make ``total``."""
    return max(1, -(-total // each))
