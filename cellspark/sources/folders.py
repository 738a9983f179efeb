"""Files of a shared folder, listed and written inside tasks.

Listing a lake from one place takes as long as it has files. Here the driver lists the upper folder levels only; each
folder found there is a partition of a Python data source, and the task that reads it lists what lies below.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow.fs as fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Schemes that Hadoop and Arrow name differently.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}
KNOWN_SCHEMES = ("file", "s3", "gs", "gcs", "hdfs", "abfs", "abfss")


def can_open(uri: str) -> bool:
    """Whether tasks can open the folder themselves; others are reached through Spark's own readers only."""
    scheme = uri.split(":", 1)[0] if ":/" in uri else "file"
    return ARROW_SCHEMES.get(scheme, scheme) in KNOWN_SCHEMES


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder that all machines share, and the path in it."""
    if not can_open(uri):
        raise ValueError(f"tasks cannot open {uri}; known schemes are {', '.join((*KNOWN_SCHEMES, *ARROW_SCHEMES))}")
    if ":/" not in uri:
        return fs.LocalFileSystem(), os.path.abspath(uri)
    scheme, rest = uri.split(":", 1)
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{ARROW_SCHEMES.get(scheme, scheme)}:{rest}")


class Folder(InputPartition):
    """A folder to list, whole or only the files that lie in it directly."""

    def __init__(self, path: str, whole: bool):
        super().__init__(path)
        self.path, self.whole = path, whole


class FolderReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["path"].rstrip("/")
        self.levels, self.suffix = int(options.get("levels", "2")), options.get("suffix", "")

    def _inside(self, path: str, recursive: bool) -> Iterator[fs.FileInfo]:
        system, base = opened(f"{self.root}/{path}".rstrip("/"))
        for info in system.get_file_info(fs.FileSelector(base, allow_not_found=True, recursive=recursive)):
            info_path = f"{path}/{info.path[len(base):].lstrip('/')}".lstrip("/")
            yield info_path, info

    def partitions(self) -> list[Folder]:
        """The folders ``levels`` below the root, and those above them for files that lie there."""
        above, at = [Folder("", self.levels == 0)], [""]
        for level in range(self.levels):
            at = [path for folder in at for path, info in self._inside(folder, False) if info.type == fs.FileType.Directory and hidden(path) is None]
            above += [Folder(path, level == self.levels - 1) for path in at]
        return above

    def read(self, partition: Folder) -> Iterator[tuple[str]]:
        for path, info in self._inside(partition.path, partition.whole):
            if info.type == fs.FileType.File and path.endswith(self.suffix) and hidden(path) is None:
                yield (f"{self.root}/{path}",)


def hidden(path: str) -> str | None:
    """The first part of a path that Spark's readers skip: names that begin with a dot, or with an underscore and hold no '='."""
    return next((part for part in path.split("/") if part.startswith(".") or (part.startswith("_") and "=" not in part)), None)


class FolderFiles(DataSource):
    """``spark.read.format("folder_files").option("levels", 2).option("suffix", ".parquet").load(root)``: column path."""

    @classmethod
    def name(cls) -> str:
        return "folder_files"

    def schema(self) -> str:
        return "path string"

    def reader(self, schema) -> FolderReader:
        return FolderReader(self.options)


def list_files(spark: SparkSession, root: str, levels: int = 2, suffix: str = ".parquet"):
    """(path) of every file below ``root`` that ends in ``suffix``; a partition for each folder ``levels`` down."""
    spark.dataSource.register(FolderFiles)
    return spark.read.format("folder_files").option("levels", str(levels)).option("suffix", suffix).load(root)
