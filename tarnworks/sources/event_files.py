"""Messages that arrive as files of rows: a folder, a file or a glob, read as a batch or as a stream."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class EventFiles:
    """Parquet files of ``schema``; ``as_messages`` gives their rows the columns of a topic's records (key, value,
    partition, offset, timestamp), so that what reads a topic reads files too."""

    path: str
    schema: T.StructType
    as_messages: Callable[[DataFrame], DataFrame]

    def batch(self, spark: SparkSession) -> DataFrame:
        return self.as_messages(spark.read.schema(self.schema).parquet(self.path))

    def stream(self, spark: SparkSession, limits: dict[str, str] | None = None) -> DataFrame:
        """New files since the reader's last run. ``limits`` are the source's rate options."""
        return self.as_messages(spark.readStream.schema(self.schema).options(**(limits or {})).parquet(self.path))


def deliver(rows: DataFrame, folder: str) -> int:
    """Put rows into the folder as new files; returns how many, counted in the stage that writes them."""
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(folder)
    return seen.get["rows"]
