"""Process tables as Parquet snapshots behind a log of commits.

A commit writes new snapshots of one or more tables and then one numbered log entry that names the snapshot of every table;
the entry is created only if no other has its number. Readers see the last entry, so that tables changed together appear
together, a failed run leaves nothing visible, and of two writers that began from the same state one is refused. Paths may be
on any store that Spark's Hadoop file systems reach (the refusal needs one where creating a file is exclusive).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from .schemas import TABLES

OPERATIONS = ("install", "drop")
LOG = "_commits"


class ConflictError(RuntimeError):
    """Another writer has changed the tables meanwhile."""


class Catalog:
    def __init__(self, spark: SparkSession, root: str):
        if not root:
            raise ValueError("the catalog needs a path")
        self.spark, self.root = spark, root.rstrip("/")
        self._seen: dict[str, str] = {}  # the snapshots that reads of this object named last

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), place

    def _head(self) -> tuple[int, dict[str, str]]:
        """(number, snapshots by table) of the last commit; (0, nothing) without any."""
        fs, place = self._fs(f"{self.root}/{LOG}")
        if not fs.exists(place):
            return 0, {}
        found = [f.getPath() for f in fs.listStatus(place)]
        last = max((p for p in found if p.getName().isdigit()), key=lambda p: p.getName(), default=None)
        if last is None:
            return 0, {}
        stream = fs.open(last)
        try:
            content = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        if not content.strip():
            raise ConflictError(f"{last.toString()} is being written, or was broken off: then delete it")
        return int(last.getName()), json.loads(content)

    def _commit(self, number: int, snapshots: Mapping[str, str]) -> None:
        fs, place = self._fs(f"{self.root}/{LOG}/{number:010d}")
        try:
            stream = fs.create(place, False)
        except Exception as e:  # noqa: BLE001  how a store says that the file is there differs
            raise ConflictError(f"commit {number} exists already") from e
        try:
            stream.write(bytearray(json.dumps(dict(snapshots)).encode()))
        finally:
            stream.close()

    def exists(self, table: str) -> bool:
        return table in self._head()[1]

    def read(self, table: str) -> DataFrame:
        snapshots = self._head()[1]
        if table not in snapshots:
            raise ValueError(f"table {table} isn't installed in {self.root}")
        self._seen[table] = snapshots[table]
        return self.spark.read.schema(TABLES[table]).parquet(f"{self.root}/{table}/{snapshots[table]}")

    def commit(self, tables: Mapping[str, DataFrame]) -> None:
        """Replace all these tables at once by rows that may read them. Refused with ``ConflictError`` if another writer has
        replaced one of them since this object read it."""
        known = self._head()[1]
        for table in tables:
            if table not in known:
                raise ValueError(f"table {table} isn't installed in {self.root}")
        seen = dict(self._seen)
        fresh = {table: self._save(table, rows) for table, rows in tables.items()}
        number, known = self._head()
        for table in tables:
            if seen.get(table, known[table]) != known[table]:
                raise ConflictError(f"table {table} has changed since it was read")
        self._commit(number + 1, known | fresh)
        self._seen |= fresh

    def write(self, table: str, rows: DataFrame) -> None:
        """Replace one table."""
        self.commit({table: rows})

    def appended(self, table: str, rows: DataFrame) -> DataFrame:
        """The table with ``rows`` added, for ``commit``."""
        return self.read(table).select(*TABLES[table].names).unionByName(rows.select(*TABLES[table].names))

    def append(self, table: str, rows: DataFrame) -> None:
        self.commit({table: self.appended(table, rows)})

    def _save(self, table: str, rows: DataFrame) -> str:
        name, schema = f"v-{uuid.uuid4().hex}", TABLES[table]
        typed = rows.select(*[rows[f.name].cast(f.dataType).alias(f.name) for f in schema])
        typed.write.parquet(f"{self.root}/{table}/{name}")
        return name

    def install(self) -> None:
        """Create the tables that don't exist yet."""
        number, known = self._head()
        new = {t: self._save(t, self.spark.createDataFrame([], schema)) for t, schema in TABLES.items() if t not in known}
        if new:
            self._commit(number + 1, known | new)

    def drop(self) -> None:
        """Remove the tables and their log."""
        for name in (LOG, *TABLES):
            fs, place = self._fs(f"{self.root}/{name}")
            fs.delete(place, True)
        self._seen.clear()

    def run(self, operation: str) -> None:
        if operation not in OPERATIONS:
            raise ValueError(f"operation {operation!r}: use one of {', '.join(OPERATIONS)}")
        getattr(self, operation)()
