"""A Python data source "sqlite" for tick databases: one partition per table and range of row ids, and a writer.

Options: ``path`` (database file), ``table`` (name, a LIKE pattern with %, or empty for all tables), ``rows`` (ids per
partition). The reader adds the table's name as ``contract``. The database has to be readable at the same path on all
executors. The writer gathers rows as Parquet-free batches: each task writes a database of its own beside ``path``, and
the commit, which runs once, attaches them in turn.
"""

from __future__ import annotations

import dataclasses
import os
import sqlite3
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from .ticks import files_by_stem

_TYPES = {"INTEGER": T.LongType(), "INT": T.LongType(), "BIGINT": T.LongType(), "REAL": T.DoubleType(), "DOUBLE": T.DoubleType(), "FLOAT": T.DoubleType()}


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def list_tables(path: str, pattern: str = "%") -> list[str]:
    """Tables but SQLite's own, in the order of their names."""
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        return [r[0] for r in db.execute("SELECT name FROM sqlite_master WHERE type = 'table' AND name NOT LIKE 'sqlite_%' AND name LIKE ? ORDER BY name", (pattern,))]


def contract_tables(path: str) -> list[str]:
    """Tables whose upper-case names start with ES and end with _TICK."""
    return [t for t in list_tables(path) if t.upper().startswith("ES") and t.upper().endswith("_TICK")]


@dataclasses.dataclass
class TableRange(InputPartition):
    table: str
    low: int
    high: int


class SqliteReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.path, self.pattern, self.rows = options["path"], options.get("table", "") or "%", int(options.get("rows", 1_000_000))
        self.names = [f.name for f in schema if f.name != "contract"]
        self.order = [f.name for f in schema]

    def partitions(self) -> list[TableRange]:
        out = []
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            for t in list_tables(self.path, self.pattern):
                low, high = db.execute(f"SELECT min(rowid), max(rowid) FROM {_quoted(t)}").fetchone()
                if low is not None:
                    out += [TableRange(t, a, min(high + 1, a + self.rows)) for a in range(low, high + 1, self.rows)]
        return out or [TableRange("", 0, 0)]

    def read(self, partition: TableRange) -> Iterator[tuple]:
        if not partition.table:
            return
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            have = {r[1] for r in db.execute(f"PRAGMA table_info({_quoted(partition.table)})")}
            cols = ", ".join(_quoted(n) if n in have else f"NULL AS {_quoted(n)}" for n in self.names)
            for row in db.execute(f"SELECT {cols} FROM {_quoted(partition.table)} WHERE rowid >= ? AND rowid < ? ORDER BY rowid", (partition.low, partition.high)):
                values = iter(row)
                yield tuple(partition.table if n == "contract" else next(values) for n in self.order)


@dataclasses.dataclass
class Part(WriterCommitMessage):
    path: str


class SqliteWriter(DataSourceWriter):
    def __init__(self, schema: T.StructType, options: dict, overwrite: bool):
        self.path, self.table, self.overwrite = options["path"], options.get("table") or "data", overwrite
        self.names = [f.name for f in schema]
        self.types = ["INTEGER" if isinstance(f.dataType, (T.IntegralType, T.BooleanType)) else "REAL" if isinstance(f.dataType, T.FractionalType) else "TEXT" for f in schema]

    def _create(self, db: sqlite3.Connection) -> None:
        db.execute(f"CREATE TABLE IF NOT EXISTS {_quoted(self.table)} ({', '.join(f'{_quoted(n)} {t}' for n, t in zip(self.names, self.types))})")

    def write(self, iterator: Iterator) -> Part:
        part = f"{self.path}.{uuid.uuid4().hex}.part"
        with sqlite3.connect(part) as db:
            self._create(db)
            plain = lambda v: v if v is None or isinstance(v, (int, float, str, bytes)) else str(v)
            db.executemany(f"INSERT INTO {_quoted(self.table)} VALUES ({', '.join('?' * len(self.names))})", (tuple(plain(v) for v in row) for row in iterator))
        return Part(part)

    def commit(self, messages: list[Part | None]) -> None:
        db = sqlite3.connect(self.path)
        try:
            if self.overwrite:
                db.execute(f"DROP TABLE IF EXISTS {_quoted(self.table)}")
            self._create(db)
            db.commit()
            for m in filter(None, messages):
                db.execute("ATTACH DATABASE ? AS part", (m.path,))
                db.execute(f"INSERT INTO {_quoted(self.table)} SELECT * FROM part.{_quoted(self.table)}")
                db.commit()
                db.execute("DETACH DATABASE part")
                os.remove(m.path)
        finally:
            db.close()

    def abort(self, messages: list[Part | None]) -> None:
        for m in filter(None, messages):
            if os.path.exists(m.path):
                os.remove(m.path)


class SqliteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> T.StructType:
        path = self.options["path"]
        fields: dict[str, T.DataType] = {}
        with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
            for t in list_tables(path, self.options.get("table", "") or "%"):
                for _, name, kind, *_ in db.execute(f"PRAGMA table_info({_quoted(t)})"):
                    fields.setdefault(name, _TYPES.get(kind.upper().split("(")[0], T.StringType()))
        return T.StructType([T.StructField("contract", T.StringType()), *[T.StructField(n, k) for n, k in fields.items() if n != "contract"]])

    def reader(self, schema: T.StructType) -> SqliteReader:
        return SqliteReader(schema, self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> SqliteWriter:
        return SqliteWriter(schema, self.options, overwrite)


def write_folder(spark: SparkSession, folder: str, path: str) -> list[str]:
    """Every Parquet file of a folder, in the order of paths, as a table of the database named by the file's stem.

    A table that exists is replaced; files without rows make an empty table. Returns the names of the tables.
    """
    register(spark)
    names = []
    for name, files in files_by_stem(spark, folder).items():
        spark.read.parquet(*files).write.format("sqlite").option("path", path).option("table", name).mode("overwrite").save()
        names.append(name)
    return names


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SqliteSource)
