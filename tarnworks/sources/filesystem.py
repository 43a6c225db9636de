"""The few file-system calls a table commit needs, through the Hadoop client Spark already has."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _handle(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def qualified(spark: SparkSession, path: str) -> str:
    fs, target = _handle(spark, path)
    return fs.makeQualified(target).toString()


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _handle(spark, path)
    return fs.exists(target)


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, target = _handle(spark, path)
    if not fs.exists(target):
        return []
    names = (status.getPath().getName() for status in fs.listStatus(target))
    return sorted(name for name in names if not name.startswith("."))


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Create the whole file at once, or raise ``FileExistsError`` when it is already there.

    The text goes to a hidden file of its own, which is then renamed without overwriting."""
    fs, target = _handle(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(fs.makeQualified(draft), fs.makeQualified(target), plain)
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if "FileAlreadyExists" in error.java_exception.toString() or fs.exists(target):
            raise FileExistsError(path) from error
        raise


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _handle(spark, path)
    size = fs.getFileStatus(target).getLen()
    stream = fs.open(target)
    try:
        return bytes(spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str, recursive: bool = False) -> bool:
    fs, target = _handle(spark, path)
    return fs.delete(target, recursive)
