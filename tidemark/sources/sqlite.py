"""A Python data source for SQLite files, read in ranges of rows.

Options: ``path``, ``table``, ``partitions``. A path with a scheme is handed out to
all executors with the job's files, so it may lie on any file system that Spark
reads; a plain path must be one that all executors can open. Ranges hold equally
many rows, whatever gaps the row ids have; tables without row ids are cut by position.
"""

from __future__ import annotations

import os
import sqlite3

from pyspark import SparkFiles
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_TYPES = {"INT": "bigint", "INTEGER": "bigint", "BIGINT": "bigint", "REAL": "double", "DOUBLE": "double", "FLOAT": "double"}


class _Range(InputPartition):
    def __init__(self, condition: str, values: tuple):
        self.condition, self.values = condition, values


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _open(options: dict):
    path = SparkFiles.get(options["file"]) if options.get("file") else options["path"]
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


class _Reader(DataSourceReader):
    def __init__(self, options: dict, columns: list[str], key: list[str]):
        self.options, self.table = options, _quoted(options["table"])
        self.parts, self.columns, self.key = int(options.get("partitions", 4)), columns, key

    def partitions(self):
        with _open(self.options) as db:
            n = db.execute(f"SELECT count(*) FROM {self.table}").fetchone()[0]
            step = max(1, -(-n // self.parts))
            try:
                edges = [db.execute(f"SELECT rowid FROM {self.table} ORDER BY rowid LIMIT 1 OFFSET ?", (i,)).fetchone()[0] for i in range(0, n, step)]
            except sqlite3.OperationalError:  # a table without row ids
                order = ", ".join(map(_quoted, self.key))
                return [_Range(f"ORDER BY {order} LIMIT ? OFFSET ?", (step, i)) for i in range(0, n, step)] or [_Range("LIMIT 0", ())]
        ranges = [_Range("WHERE rowid >= ? AND rowid < ?", (a, b)) for a, b in zip(edges, edges[1:])]
        return [*ranges, _Range("WHERE rowid >= ?", (edges[-1],))] if edges else [_Range("LIMIT 0", ())]

    def read(self, part):
        names = ", ".join(map(_quoted, self.columns))
        with _open(self.options) as db:
            yield from db.execute(f"SELECT {names} FROM {self.table} {part.condition}", part.values)


class SqliteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite_file"

    def _columns(self) -> list[tuple[str, str, int]]:
        with _open(self.options) as db:
            found = db.execute(f"PRAGMA table_info({_quoted(self.options['table'])})").fetchall()
        return [(name, _TYPES.get(kind.upper(), "string"), key) for _, name, kind, _, _, key in found]

    def schema(self) -> str:
        return ", ".join(f"`{n}` {t}" for n, t, _ in self._columns())

    def reader(self, schema):
        columns = self._columns()
        return _Reader(dict(self.options), [n for n, *_ in columns], [n for n, _, k in sorted(columns, key=lambda c: c[2]) if k])


def read(spark, path: str, table: str, partitions: int = 4, most_bytes: int = 1 << 30):
    """A table of a SQLite file. A path with a scheme goes to every executor, so such a file may have ``most_bytes`` at most."""
    spark.dataSource.register(SqliteSource)
    options = {"path": path, "table": table, "partitions": partitions}
    if "://" in path or path.startswith("file:"):
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        size = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).getLen()
        if size > most_bytes:
            raise ValueError(f"{path} has {size} bytes; more than {most_bytes} are not sent to every executor: put it where all can open it and give a plain path")
        spark.sparkContext.addFile(path)
        options["file"] = os.path.basename(path)
    return spark.read.format("sqlite_file").options(**options).load()
