"""How rows lie across segments: hash distribution, small replicated tables, serving order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def segment_of(id_: Column, segments: int) -> Column:
    """NULL ids lie together on segment 0."""
    return F.coalesce(F.pmod(id_, F.lit(segments)), F.lit(0)).cast("int")


def segment_counts(df: DataFrame, segments: int, key: str = "id") -> DataFrame:
    return df.groupBy(segment_of(F.col(key), segments).alias("segment")).agg(F.count("*").alias("rows_cnt"))


def replicated_counts(df: DataFrame, segments: int) -> DataFrame:
    """Rows each segment sees when every one of them holds a full copy of ``df``.

    Counted once; the copies are all alike.
    """
    every = F.explode(F.array(*[F.lit(i) for i in range(segments)]))
    return df.agg(F.count("*").alias("rows_cnt")).select(every.alias("segment"), "rows_cnt")


def in_serving_order(df: DataFrame, schema, order: list[str]) -> DataFrame:
    """Cast to the serving schema and lay rows out by the order key.

    The remaining columns close the range key, so one hot key value spreads over tasks.
    """
    typed = df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])
    rest = [name for name in schema.names if name not in order]
    return typed.repartitionByRange(*order, *rest).sortWithinPartitions(*order)
