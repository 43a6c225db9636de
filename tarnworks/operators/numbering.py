"""Row numbers for groups too large for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnworks.workspace import stage

_ORDINAL_BITS = 33


def number_within(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    name: str,
    chunks: int | None = None,
    order_is_unique: bool = False,
) -> DataFrame:
    """Dense numbers 1..n inside each key, in ``order``, whatever the size of a key.

    Rows are range-partitioned on (key, order), so a large key spans many tasks. Each row then
    needs only its place inside its own task plus the number of rows of the same key in earlier
    tasks; the latter is a tiny table of one row per (key, task).

    Writes two staging tables at most: one fixes the tie-break between copies, one fixes the
    range bounds. Both make the result independent of task retries.
    """
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not order_is_unique:
        df = stage(df.withColumn("_tie", F.monotonically_increasing_id()), "ties")
        order = [*order, F.col("_tie")]
        wanted = max(wanted, df.rdd.getNumPartitions())  # one chunk per split of the staged files
    chunks = chunks or wanted
    bounds = [F.col(key).asc_nulls_first() for key in keys] + order

    # monotonically_increasing_id packs (task, place in task) into one number
    place = F.monotonically_increasing_id()
    placed = stage(
        df.repartitionByRange(chunks, *bounds)
        .sortWithinPartitions(*bounds)
        .withColumn("_place", place)
        .withColumns({
            "_chunk": F.shiftright("_place", _ORDINAL_BITS).cast("int"),
            "_ordinal": F.col("_place").bitwiseAND(F.lit((1 << _ORDINAL_BITS) - 1)),
        })
        .drop("_place", "_tie"),
        "placed",
    )
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(*keys, "_chunk")
        .agg(F.min("_ordinal").alias("_first"), F.count("*").alias("_rows"))
        .withColumn("_shift", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1)
        .select(*[F.col(key).alias(f"_k_{key}") for key in keys], F.col("_chunk").alias("_k_chunk"), "_shift")
    )
    same = F.col("_chunk") == F.col("_k_chunk")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_k_{key}"))
    numbered = placed.join(starts, same).withColumn(name, F.col("_ordinal") + F.col("_shift"))
    return numbered.select(*[c for c in df.columns if c != "_tie"], name)


def rank_rows(df: DataFrame, keys: list[str], order: list[Column], name: str = "rn") -> DataFrame:
    """``row_number() OVER (PARTITION BY keys ORDER BY order)``, one plan for groups of any size: the input is
    evaluated once, ranges split large groups, and a place in the range gives the rank."""
    return number_within(df, keys, order, name)
