"""Tables of an SQLite database as a data source: reads in ranges of a key, writes that are seen whole or not at all.

    spark.dataSource.register(SqlStore)
    spark.read.format("touchline_sql").options(path=file, table="games", key="game_id").load()
    rows.write.format("touchline_sql").options(path=file, table="games").mode("append").save()

A read is cut into ranges of an integer key with about as many rows each, by the key's own index; a partition is one range. A write
has two phases. Each task attempt puts its rows into a staging table of its own, in short transactions. When
all tasks have said that theirs are there, the driver moves the named staging tables into the table in one transaction; if
a task fails, the driver drops them. Attempts that Spark repeats leave tables that nobody names; they are dropped as well, and
tasks that go on after that leave none.

With mode overwrite the transaction empties the table first. With the option keys (columns, comma-joined) rows that are there with
the same keys are replaced. The database file must be on a path that the tasks see: a local master, or a shared mount.
"""

from __future__ import annotations

import sqlite3
import uuid
from collections.abc import Iterator
from contextlib import closing
from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal
from itertools import islice

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import (
    BinaryType, BooleanType, ByteType, DataType, DateType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructField, StructType,
    TimestampType
)

#: Ranges of a read without the option partitions, rows of a batch.
PARTITIONS, ROWS = 8, 10_000
#: Seconds that a task waits for another one's transaction.
WAIT = 120
_KINDS: dict[type[DataType], str] = {
    BooleanType: "BOOLEAN", ByteType: "INTEGER", ShortType: "INTEGER", IntegerType: "INTEGER", LongType: "INTEGER", FloatType: "REAL", DoubleType: "REAL",
    StringType: "TEXT", DateType: "DATE", TimestampType: "DATETIME", BinaryType: "BLOB"
}
#: What a declared type is read as, by the words that occur in it, the first that fits.
_READ = [
    ("BOOL", BooleanType()), ("INT", LongType()), ("CHAR", StringType()), ("TEXT", StringType()), ("DATETIME", TimestampType()), ("TIMESTAMP", TimestampType()),
    ("DATE", DateType()), ("REAL", DoubleType()), ("FLOA", DoubleType()), ("DOUB", DoubleType()), ("NUM", DoubleType()), ("DEC", DoubleType()),
    ("BLOB", BinaryType())
]


def _connect(path: str) -> sqlite3.Connection:
    return sqlite3.connect(path.removeprefix("file:"), timeout=WAIT, isolation_level=None)


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _schema(path: str, table: str) -> StructType:
    with closing(_connect(path)) as c:
        columns = c.execute(f"PRAGMA table_info({quoted(table)})").fetchall()
    if not columns:
        raise ValueError(f"{path} has no table {table}")
    kind = lambda declared: next((t for word, t in _READ if word in declared.upper()), StringType())
    return StructType([StructField(name, kind(declared or "TEXT")) for _, name, declared, *_ in columns])


@dataclass
class Range(InputPartition):
    """Rows with low <= key < high; None is open; nulls go with the first."""

    low: int | None
    high: int | None
    nulls: bool


class SqlReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType) -> None:
        self.path, self.table, self.key = options["path"], options["table"], options.get("key")
        self.parts, self.schema = int(options.get("partitions", PARTITIONS)), schema

    def partitions(self) -> list[Range]:
        """Cuts at the keys of every n-th row; one range without a key."""
        if not self.key:
            return [Range(None, None, True)]
        key, table = quoted(self.key), quoted(self.table)
        with closing(_connect(self.path)) as c:
            n = c.execute(f"SELECT count({key}) FROM {table}").fetchone()[0]
            at = [n * i // self.parts for i in range(1, self.parts)]
            cuts = [c.execute(f"SELECT {key} FROM {table} WHERE {key} IS NOT NULL ORDER BY {key} LIMIT 1 OFFSET ?", (x,)).fetchone() for x in at if x < n]
        edges = [None, *sorted({x[0] for x in cuts}), None]
        return [Range(a, b, i == 0) for i, (a, b) in enumerate(zip(edges, edges[1:]))]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, where, values = to_arrow_schema(self.schema), [], []
        if self.key:
            bounds = [f"{quoted(self.key)} {op} ?" for op, x in ((">=", part.low), ("<", part.high)) if x is not None]
            values = [x for x in (part.low, part.high) if x is not None]
            where = [" AND ".join(bounds) or "1", *([f"{quoted(self.key)} IS NULL"] if part.nulls else [])]
        names = ", ".join(map(quoted, self.schema.names))
        with closing(_connect(self.path)) as c:
            cursor = c.execute(f"SELECT {names} FROM {quoted(self.table)}" + (" WHERE " + " OR ".join(f"({w})" for w in where) if where else ""), values)
            while got := cursor.fetchmany(ROWS):
                columns = [[_read(x, f.dataType) for x in col] for col, f in zip(zip(*got), self.schema)]
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, arrow)], schema=arrow)


def _read(x, kind: DataType):
    if x is None:
        return None
    if isinstance(kind, DateType):
        return date.fromisoformat(x[:10])
    if isinstance(kind, TimestampType):
        return datetime.fromisoformat(x)
    return bool(x) if isinstance(kind, BooleanType) else str(x) if isinstance(kind, StringType) else x


def _written(x):
    return x.isoformat(" ") if isinstance(x, datetime) else x.isoformat() if isinstance(x, date) else float(x) if isinstance(x, Decimal) else x


@dataclass
class Staged(WriterCommitMessage):
    table: str
    rows: int


class SqlWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str], schema: StructType, overwrite: bool) -> None:
        self.path, self.table, self.overwrite, self.schema = options["path"], options["table"], overwrite, schema
        self.keys = [k.strip() for k in options.get("keys", "").split(",") if k.strip()]
        self.mark = f"staging_{uuid.uuid4().hex[:16]}"

    def begin(self) -> SqlWriter:
        """On the driver, before any task: a mark that stands while the write goes on. A task that goes on after its end finds none, and
        leaves nothing."""
        with closing(_connect(self.path)) as c:
            c.execute(f"CREATE TABLE {quoted(self.mark)} (at TEXT)")
        return self

    def _columns(self) -> str:
        return ", ".join(f"{quoted(f.name)} {_KINDS.get(type(f.dataType), 'TEXT')}" for f in self.schema)

    def write(self, rows) -> Staged:
        """In a task: its rows into a table that no other attempt uses."""
        name, n = f"{self.mark}_{uuid.uuid4().hex[:16]}", 0
        put = f"INSERT INTO {quoted(name)} VALUES ({', '.join('?' * len(self.schema))})"
        with closing(_connect(self.path)) as c:
            rows, more = iter(rows), True
            while more:  # no lock while Spark makes the next rows
                batch = [tuple(map(_written, r)) for r in islice(rows, ROWS)]
                more = len(batch) == ROWS
                c.execute("BEGIN IMMEDIATE")
                try:
                    if not c.execute("SELECT 1 FROM sqlite_master WHERE name = ?", (self.mark,)).fetchone():
                        raise RuntimeError("this write has ended without the task")
                    c.execute(f"CREATE TABLE IF NOT EXISTS {quoted(name)} ({self._columns()})")
                    c.executemany(put, batch)
                    c.execute("COMMIT")
                except BaseException:
                    c.execute("ROLLBACK")
                    raise
                n += len(batch)
        return Staged(name, n)

    def commit(self, messages: list[Staged | None]) -> None:
        """On the driver, once: all staged rows in one transaction. Where keys are given, a row replaces those with its keys, and
        of two new rows with equal keys any one stays."""
        names = ", ".join(map(quoted, self.schema.names))
        with closing(_connect(self.path)) as c:
            c.execute("BEGIN IMMEDIATE")
            try:
                c.execute(f"CREATE TABLE IF NOT EXISTS {quoted(self.table)} ({self._columns()})")
                if self.overwrite:
                    c.execute(f"DELETE FROM {quoted(self.table)}")
                for m in messages:
                    if m is None:
                        continue
                    if self.keys:
                        same = " AND ".join(f"{quoted(self.table)}.{quoted(k)} IS s.{quoted(k)}" for k in self.keys)
                        c.execute(f"CREATE INDEX {quoted('key_' + m.table)} ON {quoted(m.table)} ({', '.join(map(quoted, self.keys))})")
                        c.execute(f"DELETE FROM {quoted(self.table)} WHERE EXISTS (SELECT 1 FROM {quoted(m.table)} s WHERE {same})")
                        one = f"rowid IN (SELECT min(rowid) FROM {quoted(m.table)} GROUP BY {', '.join(map(quoted, self.keys))})"
                    c.execute(f"INSERT INTO {quoted(self.table)} ({names}) SELECT {names} FROM {quoted(m.table)}" + (f" WHERE {one}" if self.keys else ""))
                self._drop(c)
                c.execute("COMMIT")
            except BaseException:
                c.execute("ROLLBACK")
                raise

    def abort(self, messages: list[Staged | None]) -> None:
        """On the driver, if a task failed for good: the table stays as it was."""
        with closing(_connect(self.path)) as c:
            c.execute("BEGIN IMMEDIATE")
            self._drop(c)
            c.execute("COMMIT")

    def _drop(self, c: sqlite3.Connection) -> None:
        """Drops the mark and all staging tables of this write, those of repeated attempts too."""
        for (name,) in c.execute("SELECT name FROM sqlite_master WHERE type = 'table' AND name LIKE ?", (f"{self.mark}%",)).fetchall():
            c.execute(f"DROP TABLE {quoted(name)}")


class SqlStore(DataSource):
    @classmethod
    def name(cls) -> str:
        return "touchline_sql"

    def schema(self) -> StructType:
        return _schema(self.options["path"], self.options["table"])

    def reader(self, schema: StructType) -> SqlReader:
        return SqlReader(dict(self.options), schema)

    def writer(self, schema: StructType, overwrite: bool) -> SqlWriter:
        return SqlWriter(dict(self.options), schema, overwrite).begin()
