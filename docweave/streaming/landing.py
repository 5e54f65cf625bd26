"""Registration as a stream: files that arrive below a folder become inputs as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import paths as P


def arriving(spark: SparkSession, root: str, document_type: str = "document", most_files: int = 1000) -> DataFrame:
    """A stream of (input_file, document_type, subject_id) of new files whose directory names a subject."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    found = files.option("recursiveFileLookup", True).option("maxFilesPerTrigger", most_files).load(root)
    path = F.regexp_replace("path", "^file:/+", "/")
    subject = P.subject_id(P.dirname(F.col("input_file")))
    return found.select(path.alias("input_file"), F.lit(document_type).alias("document_type")).withColumn("subject_id", subject).where("subject_id is not null")


def daily_counts(stream: DataFrame, time: str, watermark: str = "1 day") -> DataFrame:
    """Arrivals by day, closed once the watermark has passed it."""
    return stream.withWatermark(time, watermark).groupBy(F.window(time, "1 day")).agg(F.count("*").alias("n"))


def write(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the stream to Parquet, each file once across restarts."""
    return stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
