"""Delivery to a transport as a Spark sink: rows are sent by the tasks, and a batch counts once it is committed.

    rows.write.format("deliveries").option("transport", "package.module:Class").option("batch", "7").mode("append").save()

A transport is a class of one's own (`Transport`); `FolderTransport` keeps deliveries as files.
"""

from __future__ import annotations

import importlib
import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType


class NoBatches(Exception):
    """The other side takes one item at a time (404 or 501 to a batch)."""


class Transport:
    """What a sink needs of the other side.  Options are those of the write; one transport serves one task attempt."""

    def __init__(self, options: dict[str, str]):
        self.options = options

    def open(self) -> None:
        """Connect; called again once after a ConnectionError."""

    def send(self, rows: list[dict]) -> None:
        """Send a batch; ConnectionError is tried again once, NoBatches turns to send_one for good."""
        raise NoBatches

    def send_one(self, row: dict) -> None:
        raise NotImplementedError

    def close(self) -> Any:
        """End of the task attempt: what publish and withdraw need to know about it."""

    def publish(self, receipts: list, batch: str) -> None:
        """All tasks are through.  A batch may come again after a failure and must count once."""

    def withdraw(self, receipts: list) -> None:
        """The job failed; receipts are those of the tasks that ended."""


class FolderTransport(Transport):
    """Deliveries as JSON lines in a folder that driver and executors mount: a batch is visible by its one list of files."""

    def open(self) -> None:
        os.makedirs(f"{self.options['folder']}/parts", exist_ok=True)
        self.path = f"{self.options['folder']}/parts/{uuid.uuid4().hex}.json"
        self.file = open(self.path, "w")

    def send(self, rows: list[dict]) -> None:
        self.file.writelines(json.dumps(r, ensure_ascii=False, default=str) + "\n" for r in rows)

    def close(self) -> str:
        self.file.close()
        return self.path

    def publish(self, receipts: list, batch: str) -> None:
        os.makedirs(f"{self.options['folder']}/batches", exist_ok=True)
        told = f"{self.options['folder']}/batches/.{uuid.uuid4().hex}"
        with open(told, "w") as f:
            json.dump({"batch": batch, "parts": receipts}, f)
        try:
            os.link(told, f"{self.options['folder']}/batches/{batch}.json")  # fails where the batch is there already
        except FileExistsError:
            self.withdraw(receipts)
        finally:
            os.remove(told)

    def withdraw(self, receipts: list) -> None:
        for path in receipts:
            if os.path.exists(path):
                os.remove(path)


def delivered(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """(batch, columns of schema) of all committed batches of a FolderTransport."""
    told = spark.read.schema("batch string, parts array<string>").json(f"file://{folder}/batches")
    parts = told.select("batch", F.explode("parts").alias("_part"))
    rows = spark.read.schema(schema).json(f"file://{folder}/parts").withColumn("_part", F.regexp_replace(F.col("_metadata.file_path"), "^file:/*", "/"))
    return rows.join(parts, "_part").drop("_part")


@dataclass
class Receipt(WriterCommitMessage):
    value: Any


def deliver(transport: Transport, rows: Iterator[Row], size: int) -> None:
    """Send rows in batches of `size`, or one by one where the other side has no batches."""
    batches = True

    def once_more(send, what) -> None:
        try:
            send(what)
        except ConnectionError:
            transport.open()
            send(what)

    while chunk := [r.asDict(recursive=True) for r in islice(rows, size)]:
        if batches:
            try:
                once_more(transport.send, chunk)
                continue
            except NoBatches:
                batches = False
        for row in chunk:
            once_more(transport.send_one, row)


class Sink(DataSourceWriter, DataSourceStreamWriter):
    def __init__(self, options: dict[str, str]):
        self.options = dict(options)

    def transport(self) -> Transport:
        module, name = self.options.get("transport", f"{__name__}:FolderTransport").split(":")
        return getattr(importlib.import_module(module), name)(self.options)

    def write(self, iterator: Iterator[Row]) -> Receipt:
        transport = self.transport()
        transport.open()
        try:
            deliver(transport, iterator, int(self.options.get("size", "50")))
        except BaseException:
            transport.withdraw([transport.close()])
            raise
        return Receipt(transport.close())

    def commit(self, messages: list, batchId: int | None = None) -> None:
        batch = self.options["batch"] if batchId is None else f"{self.options.get('batch', 'stream')}-{batchId}"
        self.transport().publish([m.value for m in messages if m is not None], batch)

    def abort(self, messages: list, batchId: int | None = None) -> None:
        self.transport().withdraw([m.value for m in messages if m is not None])


class Deliveries(DataSource):
    """format("deliveries"): options transport, batch (the name under which a write counts once), size, and the transport's own."""

    @classmethod
    def name(cls) -> str:
        return "deliveries"

    def schema(self) -> str:
        return "payload string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return Sink(self.options)

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamWriter:
        return Sink(self.options)
