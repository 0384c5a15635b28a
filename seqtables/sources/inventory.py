"""File inventories: every file below a folder with its length, listed by tasks.

A Python data source. The folder's first level is dealt to partitions by a checksum of the names; each partition lists that level
itself and walks its own share, so neither the driver nor a single task holds the names of the whole store. Files
of length 0 are listed like any other. Paths go through Arrow's file systems: a shared folder, HDFS or S3.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Shares that a folder is dealt into, and files sent to Spark at once.
SHARES, BATCH = 64, 10_000
_SCHEMA = "path string, length bigint"


class FileInventory(DataSource):
    """``spark.read.format("file_inventory").option("path", folder)``; option ``shares`` for the number of partitions."""

    @classmethod
    def name(cls) -> str:
        return "file_inventory"

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return InventoryReader(self.options["path"], int(self.options.get("shares", SHARES)))


class InventoryReader(DataSourceReader):
    def __init__(self, path: str, shares: int):
        self.path, self.shares = path, shares

    def _open(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path)

    def partitions(self) -> list[InputPartition]:
        system, root = self._open()
        if system.get_file_info(root).type == fs.FileType.NotFound:
            raise FileNotFoundError(f"no folder {self.path}")
        return [InputPartition(i) for i in range(self.shares)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        system, root = self._open()
        held: list[tuple[str, int]] = []
        own = (e for e in self._entries(system, root) if zlib.crc32(e.base_name.encode()) % self.shares == partition.value)
        for path, size in self._files(system, own):
            held.append((path, size))
            if len(held) == BATCH:
                yield self._batch(held)
                held = []
        if held:
            yield self._batch(held)

    @staticmethod
    def _entries(system: fs.FileSystem, folder: str) -> list[fs.FileInfo]:
        # a folder that goes away while the store is listed has no files
        return system.get_file_info(fs.FileSelector(folder, allow_not_found=True))

    def _files(self, system: fs.FileSystem, entries) -> Iterator[tuple[str, int]]:
        waiting = [iter(entries)]
        while waiting:
            entry = next(waiting[-1], None)
            if entry is None:
                waiting.pop()
            elif entry.type == fs.FileType.File:
                yield entry.path, entry.size
            elif entry.type == fs.FileType.Directory:
                waiting.append(iter(self._entries(system, entry.path)))

    @staticmethod
    def _batch(held: list[tuple[str, int]]) -> pa.RecordBatch:
        paths, sizes = zip(*held)
        return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], ["path", "length"])


def inventory(spark: SparkSession, path: str, shares: int = SHARES) -> DataFrame:
    """path and length of every file below the folder. A folder that is not there is an error."""
    spark.dataSource.register(FileInventory)
    return spark.read.format("file_inventory").option("path", path).option("shares", shares).load()


def of_experiments(files: DataFrame, uid_pattern: str) -> DataFrame:
    """uid, path and length; ``uid_pattern`` is a regular expression over the path whose first group is the uid."""
    return files.select(F.regexp_extract("path", uid_pattern, 1).alias("uid"), "path", "length")


def read_files(files: DataFrame) -> DataFrame:
    """(uid, mate) of the read files a job is given: ``uid.fastq.bz2`` and ``uid_2.fastq.bz2`` in the folder ``uid``.

    Files of other names or in other folders do not count; empty ones do.
    """
    name = r"/([^/]+)/\1(_2)?\.fastq\.bz2$"
    return files.select(
        F.regexp_extract("path", name, 1).alias("uid"),
        F.when(F.regexp_extract("path", name, 2) == "", 1).otherwise(2).alias("mate"),
    ).filter("uid <> ''")
