"""Database tables: partitioned JDBC reads with bounds from the table, and SQLite files."""

from __future__ import annotations

import json
import math
import os
import sqlite3
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceWriter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, EqualTo, Filter, WriterCommitMessage,
)
from pyspark.sql.types import StructType

#: The database that Spark brings along.
DERBY = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def jdbc(spark: SparkSession, url: str, driver: str | None = None, **options: str):
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    return reader.option("driver", driver) if driver else reader


def read_jdbc(
    spark: SparkSession, url: str, table: str, key: str | None = None, rows_each: int = 100_000, most_parts: int = 64, driver: str | None = None, fetch: int = 1000,
) -> DataFrame:
    """A database table; with a key (number, date or time) it is read in ranges at once.

    The database itself tells the key's bounds and the number of rows, in one query; there is a range for each
    `rows_each` rows, at most `most_parts` (each is a connection).  Null keys come with the first range.  Filters and
    chosen columns of what is returned go to the database.
    """
    reader = jdbc(spark, url, driver, dbtable=table, fetchsize=str(fetch))
    if key:
        quoted = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(key)
        asked = f"(select min({quoted}) as lo, max({quoted}) as hi, count(*) as n from {table}) b"
        told = jdbc(spark, url, driver, dbtable=asked).load().first()
        lo, hi, n = told
        parts = min(max(math.ceil(n / rows_each), 1), most_parts)
        if parts > 1 and lo != hi:
            bounds = {"lowerBound": str(lo), "upperBound": str(hi)}
            reader = reader.options(partitionColumn=key, numPartitions=str(parts), **bounds)
    return reader.load()


def write_jdbc(rows: DataFrame, url: str, table: str, driver: str | None = None, mode: str = "append", most_parts: int = 8, batch: int = 1000) -> None:
    """Rows into a table over at most `most_parts` connections.  Each task commits by itself; for a unit use a table set."""
    writer = rows.write.format("jdbc").option("url", url).option("dbtable", table).option("numPartitions", most_parts).option("batchsize", batch)
    (writer.option("driver", driver) if driver else writer).mode(mode).save()


class Range(InputPartition):
    def __init__(self, path: str, low: int, high: int):
        super().__init__((path, low, high))


class SqliteSource(DataSource):
    """format("sqlite"): a table of a SQLite file that driver and executors mount, read in ranges of its row numbers.

    Options: path, table, parts (1), busy_ms (5000), pushdown (false).  With pushdown, which Spark has to allow by
    spark.sql.python.filterPushdown.enabled, comparisons of single columns with values go to the database.  The file is
    opened read-only, so a writer in WAL mode is not held up.

    A write takes a folder as path: every task fills a file of its own there, and the list of files, which a commit
    replaces, is the table.  Such a folder is read as a file is, with `parts` ranges in each of its files.
    """

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> str:
        kinds = {"INTEGER": "bigint", "INT": "bigint", "BIGINT": "bigint", "REAL": "double", "DOUBLE": "double", "FLOAT": "double", "BLOB": "binary"}
        with open_sqlite(self.options, files_of(self.options)[0]) as db:
            columns = db.execute(f'pragma table_info("{self.options["table"]}")').fetchall()
        if not columns:
            raise ValueError(f"no table {self.options['table']}")
        return ", ".join(f"`{c[1]}` {kinds.get(c[2].upper().split('(')[0], 'string')}" for c in columns)

    def reader(self, schema) -> DataSourceReader:
        kind = PushingReader if self.options.get("pushdown", "false").lower() == "true" else SqliteReader
        return kind(dict(self.options), [f.name for f in schema])

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return SqliteWriter(dict(self.options), schema, overwrite)


class Closing:
    """A connection that is closed at the end of a with block."""

    def __init__(self, db: sqlite3.Connection):
        self.db = db

    def __enter__(self) -> sqlite3.Connection:
        return self.db

    def __exit__(self, *_) -> None:
        self.db.close()


def list_of(options: dict[str, str]) -> str:
    return f"{options['path']}/{options['table']}.json"


def files_of(options: dict[str, str]) -> list[str]:
    """The file itself, or those of a written folder."""
    if not os.path.isdir(options["path"]):
        return [options["path"]]
    with open(list_of(options)) as f:
        return [f"{options['path']}/{name}" for name in json.load(f)]


def open_sqlite(options: dict[str, str], path: str) -> Closing:
    """immutable: files of a folder don't change any more, so they need no locks, which some mounts lack."""
    still = "&immutable=1" if path != options["path"] else ""
    db = sqlite3.connect(f"file:{path}?mode=ro{still}", uri=True, timeout=int(options.get("busy_ms", "5000")) / 1000)
    return Closing(db)


class SqliteReader(DataSourceReader):
    def __init__(self, options: dict[str, str], columns: list[str]):
        self.options, self.columns, self.where, self.values = options, columns, [], []

    def partitions(self) -> list[InputPartition]:
        files = files_of(self.options)
        return [r for path in files for r in self.ranges(path)] or [Range(files[0], 0, 0)]

    def ranges(self, path: str) -> list[InputPartition]:
        with open_sqlite(self.options, path) as db:
            low, high = db.execute(f'select min(rowid), max(rowid) from "{self.options["table"]}"').fetchone()
        if low is None:
            return []
        step = max(math.ceil((high - low + 1) / int(self.options.get("parts", "1"))), 1)
        return [Range(path, at, at + step) for at in range(low, high + 1, step)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        path, low, high = partition.value
        names = ", ".join(f'"{c}"' for c in self.columns)
        where = " and ".join(["rowid >= ?", "rowid < ?", *self.where])
        with open_sqlite(self.options, path) as db:
            yield from db.execute(f'select {names} from "{self.options["table"]}" where {where}', [low, high, *self.values])


class PushingReader(SqliteReader):
    SIGNS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            sign = self.SIGNS.get(type(f))
            if sign and len(f.attribute) == 1 and isinstance(f.value, (int, float, str)) and not isinstance(f.value, bool):
                self.where.append(f'"{f.attribute[0]}" {sign} ?')
                self.values.append(f.value)
            else:
                yield f


@dataclass
class Written(WriterCommitMessage):
    name: str


class SqliteWriter(DataSourceWriter):
    KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "TEXT", "binary": "BLOB"}

    def __init__(self, options: dict[str, str], schema: StructType, overwrite: bool):
        other = [f.name for f in schema if f.dataType.simpleString() not in self.KINDS]
        if other:
            raise ValueError(f"SQLite keeps no such type as that of {', '.join(other)}")
        self.options, self.overwrite = options, overwrite
        self.columns = ", ".join(f'"{f.name}" {self.KINDS[f.dataType.simpleString()]}' for f in schema)
        self.marks = ", ".join("?" for _ in schema)
        self.doubles = [i for i, f in enumerate(schema) if f.dataType.simpleString() == "double"]

    def checked(self, rows: Iterator[Row]) -> Iterator[Row]:
        for row in rows:
            if any(row[i] is not None and row[i] != row[i] for i in self.doubles):
                raise ValueError("SQLite keeps a NaN as null")
            yield row

    def write(self, iterator: Iterator[Row]) -> Written:
        os.makedirs(self.options["path"], exist_ok=True)
        name = f"{uuid.uuid4().hex}.db"
        path = f"{self.options['path']}/{name}"
        try:
            # Nobody else knows the file yet: it needs neither locks nor a journal.
            with Closing(sqlite3.connect(f"file:{path}?mode=rwc&nolock=1", uri=True)) as db:
                db.execute("pragma journal_mode = off")
                db.execute(f'create table "{self.options["table"]}" ({self.columns})')
                db.executemany(f'insert into "{self.options["table"]}" values ({self.marks})', self.checked(iterator))
                db.commit()
        except BaseException:
            if os.path.exists(path):
                os.remove(path)
            raise
        return Written(name)

    def commit(self, messages: list) -> None:
        before = []
        if not self.overwrite and os.path.exists(list_of(self.options)):
            with open(list_of(self.options)) as f:
                before = json.load(f)
        told = f"{self.options['path']}/.{uuid.uuid4().hex}"
        with open(told, "w") as f:
            json.dump(before + [m.name for m in messages if m is not None], f)
        os.replace(told, list_of(self.options))

    def abort(self, messages: list) -> None:
        for m in messages:
            if m is not None and os.path.exists(path := f"{self.options['path']}/{m.name}"):
                os.remove(path)


def write_ranges(rows: DataFrame, path: str, table: str, key: str) -> None:
    """Rows into a folder of SQLite files, each of which holds a range of the key in its order."""
    rows.sparkSession.dataSource.register(SqliteSource)
    most = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.sparkSession.sparkContext.defaultParallelism)
    dealt = rows.repartitionByRange(most, key).sortWithinPartitions(key)
    dealt.write.format("sqlite").option("path", path).option("table", table).mode("append").save()
