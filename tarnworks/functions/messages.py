"""Event encoding: JSON text in and out of binary message values, and key placement."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnworks.schemas import EVENT_VALUE

EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def encode_event(*columns: Column | str) -> Column:
    """One JSON object per row as bytes, timestamps in ISO form with microseconds."""
    options = {"timestampFormat": EVENT_TIME_FORMAT, "timestampNTZFormat": EVENT_TIME_FORMAT}
    return F.to_json(F.struct(*columns), options).cast("binary")


def decode_event(value: Column, schema: T.StructType = EVENT_VALUE, corrupt_column: str | None = None) -> Column:
    """Parse a message value. A malformed value yields an all-NULL struct, never an error.

    ``corrupt_column`` adds a string field that keeps the text of values that did not parse.
    """
    options = {"mode": "PERMISSIVE"}
    if corrupt_column:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
        options["columnNameOfCorruptRecord"] = corrupt_column
    return F.from_json(value.cast("string"), schema, options)


def partition_of(text: Column, partitions: int) -> Column:
    """Stable placement from the leading 28 bits of an MD5 digest; any language can repeat it."""
    prefix = F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("bigint")
    return F.pmod(prefix, F.lit(partitions)).cast("int")
