"""A data source for stored pages, and readers for run registries and fixtures."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class StoredPages(DataSource):
    """format("stored_pages"): pages generated or kept by a store of one's own.

    Options: module and function, `function(part, parts)` yielding (url, status, content_type, html); parts, how many
    tasks read at once.  For plain folders of files use `read_pages`.
    """

    @classmethod
    def name(cls) -> str:
        return "stored_pages"

    def schema(self) -> str:
        return "url string, status int, content_type string, html string"

    def reader(self, schema) -> DataSourceReader:
        return StoredPagesReader(self.options)


class StoredPagesReader(DataSourceReader):
    def __init__(self, options):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(i) for i in range(int(self.options.get("parts", "1")))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        import importlib

        make = getattr(importlib.import_module(self.options["module"]), self.options["function"])
        yield from make(partition.value, int(self.options.get("parts", "1")))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(url, html) of the HTML files below a folder, the path being the URL."""
    files = spark.read.format("text").option("wholetext", True).option("recursiveFileLookup", True).load(path)
    return files.select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("html"))


def read_documents(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Whole JSON files, one document each: registries of runs, fixtures to replay."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)
