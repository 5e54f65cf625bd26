"""File listings and whole-file texts."""

from __future__ import annotations

import itertools
import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import dirname
from .store import fresh_folder

#: Names that Spark's readers pass over; they do look into folders whose names begin with these.
_HIDDEN, _LOOKED_INTO = re.compile(r"^(?:\.|_[^=]*$)|\._COPYING_$"), ("_metadata", "_common_metadata")


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, directory) of every file below ``root``, whatever its type; contents aren't read. Hidden and empty files are left
    out, as Spark's readers do.

    Local folders are walked level by level by the executors: Spark's own listing puts 32 files into a task at most and keeps
    every file's state in the driver. Patterns, and stores that only Spark opens, go through it still.
    """
    place = re.sub("^file:/+", "/", root)
    local = root != place or spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").startswith("file:")
    if local and not re.search(r"^\w+:|[*?\[\]{}\\]", place) and os.path.isdir(place):
        files = _walked(spark, os.path.abspath(place))
    else:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    plain = F.regexp_replace("path", "^file:/+", "/")
    return files.select(plain.alias("path")).withColumn("directory", dirname(F.col("path")))


def _walked(spark: SparkSession, root: str) -> DataFrame:
    """(path) of the files below a folder, dealt evenly. Each level is stored in the shared folder, whatever the tree's depth."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema, levels = "path string, folder boolean", []
    folders = spark.range(0, 1, 1, 1).select(F.lit(root).alias("path"))
    while True:
        levels.append(fresh_folder(spark, "listing"))
        folders.mapInArrow(_entries, schema).write.parquet(levels[-1])
        folders = spark.read.schema(schema).parquet(levels[-1]).where("folder").select("path")
        n = folders.count()
        if n == 0:
            return spark.read.schema(schema).parquet(*levels).where("not folder").select("path").repartition(tasks)
        folders = folders.repartition(min(n, tasks))


def _shown(entry: os.DirEntry) -> bool:
    hidden = bool(_HIDDEN.search(entry.name))
    try:
        return not hidden or entry.name.startswith(_LOOKED_INTO) if entry.is_dir() else not hidden and entry.stat().st_size > 0
    except FileNotFoundError:  # gone meanwhile, or a link to nothing
        return False


def _entries(batches):
    """What the folders of ``batches`` hold, 10,000 entries at a time; folders that are gone meanwhile hold nothing."""
    import pyarrow as pa

    names = ["path", "folder"]

    def rows(batch):
        for folder in batch.column(0).to_pylist():
            try:
                with os.scandir(folder) as found:
                    for x in found:
                        if _shown(x):
                            yield os.fsencode(x.path).decode(errors="replace"), x.is_dir()
            except (FileNotFoundError, NotADirectoryError):
                continue

    for batch in batches:
        each = rows(batch)
        while part := list(itertools.islice(each, 10_000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part), (pa.string(), pa.bool_()))], names=names)


def read_texts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, text) of whole UTF-8 files."""
    texts = spark.read.text(paths, wholetext=True)
    return texts.select(F.regexp_replace("_metadata.file_path", "^file:/+", "/").alias("path"), F.col("value").alias("text"))


def read_each(rows: DataFrame, path: str = "path") -> DataFrame:
    """``rows`` with the text of the file that ``path`` names, and an error where it can't be read: one bad file doesn't
    stop the others, and no list of paths goes through the driver."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                found = [_content(p) for p in part.column(rows_path).to_pylist()]
                texts, errors = (pa.array([f[k] for f in found], pa.string()) for k in range(2))
                yield pa.RecordBatch.from_arrays([*part.columns, texts, errors], names=[*part.schema.names, "text", "error"])

    rows_path = rows.columns.index(path)
    return rows.mapInArrow(read, f"{fields}, text string, error string")


def _content(path: str | None) -> tuple[str | None, str | None]:
    from pyarrow import fs

    try:
        files, place = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
        with files.open_input_file(place) as f:
            return f.read().decode(), None
    except Exception as e:  # noqa: BLE001  a missing, unreadable or badly encoded file is that file's error
        return None, str(e) or type(e).__name__


def write_texts(rows: DataFrame, path: str = "path", text: str = "text") -> None:
    """Write each non-empty text to the path of its row (last level of the edge: one file a row, by the executors).

    Paths go through the file system that their scheme names; folders are made; a rerun overwrites with the same content.
    """

    def write(part):
        from pyarrow import fs

        for row in part:
            if row[1]:
                files, place = fs.FileSystem.from_uri(row[0] if "://" in row[0] else f"file://{row[0]}")
                files.create_dir(place.rpartition("/")[0], recursive=True)
                with files.open_output_stream(place, compression=None) as out:
                    out.write(row[1].encode())

    rows.select(path, text).foreachPartition(write)
