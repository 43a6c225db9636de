"""Intermediate tables and task-written files in the folder all executors share."""

from __future__ import annotations

import mmap
import os
import tempfile
import uuid

import numpy as np
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from tarnworks.sources.filesystem import delete
from tarnworks.workspace import fresh_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Staged tables of one operator. ``drop`` removes a table that nothing reads any more; what an
    operator's result still reads stays until the cluster empties the folder."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = fresh_dir(spark, label)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write once and read back: cuts lineage in a way that survives lost executors."""
        df.write.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            delete(self.spark, self.path(name), recursive=True)


def _open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("s3a://"):
        uri = "s3://" + uri[len("s3a://"):]
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), os.path.abspath(uri)
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def write_blob(folder: str, stem: str, data: bytes) -> str:
    """Write a file from a task; returns its name. Every attempt takes a name of its own and only the
    attempt whose row Spark commits is ever referred to, so retries and speculation are harmless."""
    fs, root = _open_fs(folder)
    fs.create_dir(root, recursive=True)
    name = f"{stem}-{uuid.uuid4().hex}.bin"
    with fs.open_output_stream(f"{root}/{name}") as out:
        out.write(data)
    return name


def map_blob(folder: str, name: str) -> np.ndarray:
    """The bytes of a file, memory-mapped. A file in a remote store is copied to the worker's own
    temporary folder first and unlinked at once, so that it goes with the mapping."""
    fs, root = _open_fs(folder)
    path = f"{root}/{name}"
    if not isinstance(fs, pafs.LocalFileSystem):
        handle, path = tempfile.mkstemp()
        with os.fdopen(handle, "wb") as out, fs.open_input_stream(f"{root}/{name}") as source:
            while chunk := source.read(8 << 20):
                out.write(chunk)
        view = np.memmap(path, dtype=np.uint8, mode="r")
        os.unlink(path)
        return view
    with open(path, "rb") as source:
        return np.frombuffer(mmap.mmap(source.fileno(), 0, access=mmap.ACCESS_READ), dtype=np.uint8)
