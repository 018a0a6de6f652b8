"""Clips as files: a sink that puts every file at its path, all of a job's or none.

``df.write.format("clip_files").option("root", folder).mode("append").save()`` takes rows (path, bytes); paths lie below
``root``, relative ones are tried below it.  A task writes into a staging folder of its own below ``root``, so that one that
runs twice, or beside itself, disturbs nothing; the driver moves the files of the tasks that count and deletes the rest.
Moving replaces what stands at a path.  The driver never holds a list of files: it walks folder by folder.

The folder must be one that driver and executors share under the same path.
"""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage


@dataclass
class Staged(WriterCommitMessage):
    folder: str
    n_files: int


class ClipFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "clip_files"

    def schema(self) -> str:
        return "path string, bytes binary"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return ClipWriter(self.options["root"], schema.names)


class ClipWriter(DataSourceWriter):
    def __init__(self, root: str, names: list[str]):
        self.root = os.path.abspath(root.removeprefix("file:"))
        self.staging = f"{self.root}/_staging-{uuid.uuid4().hex}"
        self.names = names
        os.makedirs(self.staging)

    def _below_root(self, path: str) -> str:
        place = os.path.relpath(os.path.join(self.root, path.removeprefix("file:")), self.root)
        if place.split(os.sep)[0] == "..":
            raise ValueError(f"{path} doesn't lie below {self.root}")
        return place

    def write(self, rows: Iterator) -> Staged:
        folder, n = f"{self.staging}/{uuid.uuid4().hex}", 0
        os.mkdir(folder)  # an error once the job is aborted and its staging folder gone
        at, what = self.names.index("path"), self.names.index("bytes")
        for r in rows:
            place = f"{folder}/{self._below_root(r[at])}"
            os.makedirs(os.path.dirname(place), exist_ok=True)
            with open(place, "wb") as f:
                f.write(r[what])
            n += 1
        return Staged(folder, n)

    def commit(self, messages: list[Staged | None]) -> None:
        for m in messages:
            for folder, _, names in os.walk(m.folder) if m and m.n_files else ():
                there = os.path.join(self.root, os.path.relpath(folder, m.folder))
                os.makedirs(there, exist_ok=True)
                for name in names:
                    os.replace(os.path.join(folder, name), os.path.join(there, name))
        shutil.rmtree(self.staging, ignore_errors=True)

    def abort(self, messages: list[Staged | None]) -> None:
        shutil.rmtree(self.staging, ignore_errors=True)


def write_clip_files(clips: DataFrame, root: str) -> None:
    """Files from rows (path, bytes); the job's files appear when all of them are written."""
    clips.sparkSession.dataSource.register(ClipFiles)
    clips.select("path", "bytes").write.format("clip_files").option("root", root).mode("append").save()
