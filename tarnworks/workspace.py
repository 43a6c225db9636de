"""Shared scratch space: where intermediate tables, checkpoints and topics are written."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, where driver and
    executors are one process, may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not one_process(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="run-")
    return _LOCAL_ROOTS[app]


def one_process(spark: SparkSession) -> bool:
    """Driver and executors are the same process."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path nobody has written to yet. It outlives the call: lazy results may still read it."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def fresh_name(label: str) -> str:
    """A name for catalog objects that no other run uses."""
    return f"{label}_{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts lineage in a way that survives lost executors, and gives the planner real sizes.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
