"""Tables laid out by the day of a timestamp column that users never see."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnworks.functions.times import day_of
from tarnworks.tables.versioned import VersionedTable

DAY = "_day"


def create(table: VersionedTable, schema: T.StructType, ts_column: str) -> VersionedTable:
    if ts_column not in schema.names:
        raise ValueError(f"no column {ts_column}")
    return table.create(T.StructType([*schema.fields, T.StructField(DAY, T.DateType())]), [DAY])


def append(table: VersionedTable, rows: DataFrame, ts_column: str) -> int | None:
    return table.append(rows.withColumn(DAY, day_of(F.col(ts_column))))


def read(table: VersionedTable) -> DataFrame:
    return table.read().drop(DAY)


def between(table: VersionedTable, ts_column: str, low: str, high: str) -> DataFrame:
    """Rows with low <= ts < high. The matching day predicate prunes folders before any file opens."""
    start, end = (F.lit(bound).cast("timestamp") for bound in (low, high))
    ts, day = F.col(ts_column), F.col(DAY)
    rows = table.read().where((day >= start.cast("date")) & (day <= end.cast("date")))
    return rows.where((ts >= start) & (ts < end)).drop(DAY)
