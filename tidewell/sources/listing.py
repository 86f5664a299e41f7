"""A data source that lists files without reading them: ``spark.read.format("listing")``.

Spark's own readers pass over files of no bytes, and binaryFile holds each file whole. Here a task lists some folders and gives
names, sizes and times only. Folders are reached by pyarrow's file systems (local, HDFS, S3, GCS).
"""

from __future__ import annotations

import fnmatch
import time
from collections.abc import Iterator, Sequence
from datetime import UTC

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "path string, size long, modified timestamp"
#: Folders that one task lists.
FOLDERS = 200


def open_root(path: str):
    """(file system, path within it, what goes before such a path) of a folder given as a path or an address."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path.rstrip("/") or "/", "file:"
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").strip("/"), "file:"
    system, inner = fs.FileSystem.from_uri(path)
    return system, inner.rstrip("/"), path.rstrip("/").removesuffix(inner.rstrip("/"))


class Folders(InputPartition):
    def __init__(self, folders: list[str], deep: bool):
        super().__init__(0)
        self.folders, self.deep = folders, deep


class ListingReader(DataSourceReader):
    """The root is listed by itself; the folders in it are dealt to tasks, which list them with all that is below."""

    def __init__(self, options: dict):
        self.root, self.glob = options["path"], options.get("glob", "*")
        self.chunk = int(options.get("folders", FOLDERS))

    def partitions(self) -> Sequence[InputPartition]:
        from pyarrow import fs

        system, inner, _ = open_root(self.root)
        if system.get_file_info(inner).type == fs.FileType.File:
            return [Folders([inner], False)]
        below = sorted(i.path for i in system.get_file_info(fs.FileSelector(inner)) if i.type == fs.FileType.Directory)
        return [Folders([inner], False), *(Folders(below[i : i + self.chunk], True) for i in range(0, len(below), self.chunk))]

    def read(self, partition: Folders) -> Iterator[tuple]:
        from pyarrow import fs

        system, inner, before = open_root(self.root)
        for folder in partition.folders:
            own = system.get_file_info(folder)
            found = [own] if own.type == fs.FileType.File else system.get_file_info(fs.FileSelector(folder, recursive=partition.deep, allow_not_found=True))
            for i in found:
                hidden = any(x[:1] in ("_", ".") for x in i.path.removeprefix(inner).split("/"))  # as Spark's readers have it
                if i.type == fs.FileType.File and not hidden and fnmatch.fnmatchcase(i.base_name, self.glob):
                    yield before + i.path, i.size, i.mtime.astimezone(UTC) if i.mtime else None


class ListingStreamReader(ListingReader, DataSourceStreamReader):
    """Each trigger lists the files anew: an offset is the time of a pass, in milliseconds."""

    def initialOffset(self) -> dict:
        return {"ms": 0}

    def latestOffset(self) -> dict:
        return {"ms": int(time.time() * 1000)}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return ListingReader.partitions(self)

    def commit(self, end: dict) -> None:
        pass


class Listing(DataSource):
    """As a stream, each trigger gives all files there are, so what came, changed, failed or was too young is seen again. Options: path, glob (names of files), folders (how many of them a task lists)."""

    @classmethod
    def name(cls) -> str:
        return "listing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ListingReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return ListingStreamReader(self.options)


def list_files(spark: SparkSession, root: str, glob: str = "*", folders: int = FOLDERS) -> DataFrame:
    """(path, size, modified) of the files below a folder (or of the file that root is), those of no bytes too, but none of a hidden name. A missing folder is an error."""
    spark.dataSource.register(Listing)
    return spark.read.format("listing").option("glob", glob).option("folders", folders).load(root)
