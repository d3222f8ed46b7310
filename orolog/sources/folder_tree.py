"""A folder tree as a listing table: a Python data source.

``spark.read.format("folder_listing").load(path)`` gives ``id, parent_id, name, mime_type, trashed`` of everything
below a folder that all executors see, the columns that `listing` walks. Ids are paths relative to the folder,
whose own id is ``root``. Each folder right below it is a partition that an executor walks; entries beginning
with a dot count as trashed. A filter on ``parent_id = …`` is pushed down: only that folder is read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition

from orolog.operators.listing import FOLDER, PDF, ZIPS

SCHEMA = "id string, parent_id string, name string, mime_type string, trashed boolean"
ROOT = "root"
_KINDS = {".pdf": PDF, ".zip": ZIPS[0], ".txt": "text/plain"}


class Subtree(InputPartition):
    def __init__(self, folder: str, deep: bool) -> None:
        super().__init__(folder)
        self.folder, self.deep = folder, deep


class FolderReader(DataSourceReader):
    def __init__(self, top: str) -> None:
        self.top = top
        self.parent: str | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("parent_id",) and self.parent is None:
                self.parent = f.value
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        if self.parent is not None:
            return [Subtree("" if self.parent == ROOT else self.parent, False)]
        folders = sorted(e.name for e in os.scandir(self.top) if e.is_dir())
        return [Subtree("", False), *(Subtree(f, True) for f in folders)]

    def read(self, partition: Subtree) -> Iterator[tuple]:
        start = os.path.join(self.top, partition.folder)
        if not os.path.isdir(start) or os.path.relpath(start, self.top).startswith(".."):
            return
        todo = [partition.folder]
        while todo:
            folder = todo.pop()
            for e in sorted(os.scandir(os.path.join(self.top, folder)), key=lambda e: e.name):
                key = os.path.join(folder, e.name)
                is_folder = e.is_dir(follow_symlinks=False)
                kind = FOLDER if is_folder else _KINDS.get(os.path.splitext(e.name)[1].lower(), "application/octet-stream")
                yield key, folder or ROOT, e.name, kind, e.name.startswith(".")
                if is_folder and partition.deep:
                    todo.append(key)


class FolderListing(DataSource):
    @classmethod
    def name(cls) -> str:
        return "folder_listing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FolderReader:
        return FolderReader(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FolderListing)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
