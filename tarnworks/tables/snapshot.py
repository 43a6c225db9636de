"""Snapshot headers: one small JSON file per table version.

A header names the schema, the operation, summary counters and the files the version is made of:
the commit folders all of whose files are live, and one saved file list (Parquet, written by Spark)
for commits of which only some files are. Whole folders keep headers short, and a reader hands
Spark one path for them.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tarnworks.sources import filesystem as fs

FILE_LIST = T.StructType([
    T.StructField("path", T.StringType()),       # relative to the table root
    T.StructField("partition", T.StringType()),  # "day=2024-01-01", empty when unpartitioned
    T.StructField("record_count", T.LongType()),
    T.StructField("file_size_in_bytes", T.LongType()),
])


class CommitConflict(RuntimeError):
    """Another writer committed this version first."""


@dataclass
class Snapshot:
    version: int
    snapshot_id: int
    parent: int | None
    committed_at: float
    operation: str
    schema: dict
    partition_by: list[str]
    folders: list[str] = field(default_factory=list)  # commits that are wholly live
    file_list: str | None = None  # live files of the other commits
    deletes: list[str] = field(default_factory=list)  # folders of deleted positions
    summary: dict[str, str] = field(default_factory=dict)
    writers: dict[str, int] = field(default_factory=dict)

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(self.schema)


def new_snapshot_id() -> int:
    return uuid.uuid4().int >> 65


def now() -> float:
    return time.time()


class SnapshotLog:
    """The ordered headers of one table. Single writer; a lost race raises."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.folder = f"{root}/_log"

    def _path(self, version: int) -> str:
        return f"{self.folder}/{version:020d}.json"

    def versions(self) -> list[int]:
        names = fs.list_names(self.spark, self.folder)
        return [int(name[:-5]) for name in names if name.endswith(".json")]

    def load(self, version: int) -> Snapshot:
        return Snapshot(**json.loads(fs.read_text(self.spark, self._path(version))))

    def latest(self) -> Snapshot | None:
        versions = self.versions()
        return self.load(versions[-1]) if versions else None

    def all(self) -> list[Snapshot]:
        return [self.load(version) for version in self.versions()]

    def commit(self, snapshot: Snapshot) -> None:
        try:
            fs.create_text(self.spark, self._path(snapshot.version), json.dumps(asdict(snapshot)))
        except FileExistsError as error:
            raise CommitConflict(f"version {snapshot.version} exists in {self.folder}") from error

    def drop(self, version: int) -> None:
        fs.delete(self.spark, self._path(version))
