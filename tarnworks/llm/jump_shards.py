"""Sharding by jump consistent hashing (Lamping and Veach), in DataFrame expressions only.

A key is hashed to 64 bits and walked through the published generator. The walk yields the bucket for
``shards`` and for ``shards + 1`` at once; with one more shard a key either stays or moves to the new one.

Law: ``key``. Key and shard count decide, so equal keys share a shard, also a NULL key (its own constant
hash). Defined cases: NULL text counts as empty; repeated rows each get a slot of their own; an empty table
gives an empty result; other columns of the input are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnworks.llm.scratch import Scratch, read_table

SHARDS = 16
# Fixed value: multiplier of the generator in the published algorithm, in two 32-bit halves.
MULTIPLIER = 2862933555777941757
_LOW32 = (1 << 32) - 1
_ORDINAL_BITS = 33


def _low_product(a: Column, factor: int) -> Column:
    """Low 32 bits of a * factor for 0 <= a, factor < 2^32, without overflowing a long."""
    low = a.bitwiseAND(0xFFFF) * F.lit(factor)
    high = F.shiftleft((F.shiftright(a, 16) * F.lit(factor)).bitwiseAND(0xFFFF), 16)
    return (low + high).bitwiseAND(_LOW32)


def _next_state(high: Column, low: Column) -> tuple[Column, Column]:
    """state * MULTIPLIER + 1 modulo 2^64, the state in two 32-bit halves."""
    m_high, m_low = MULTIPLIER >> 32, MULTIPLIER & _LOW32
    upper = F.shiftright(low, 16) * F.lit(m_low)
    product = low.bitwiseAND(0xFFFF) * F.lit(m_low) + F.shiftleft(upper.bitwiseAND(0xFFFF), 16) + F.lit(1)
    carry = F.shiftright(product, 32) + F.shiftright(upper, 16)
    new_high = (carry + _low_product(high, m_low) + _low_product(low, m_high)).bitwiseAND(_LOW32)
    return new_high, product.bitwiseAND(_LOW32)


def jump_buckets(key_hash: Column, shards: int) -> Column:
    """Struct (shard, grown): the bucket of a 64-bit hash among ``shards`` and ``shards + 1``."""
    start = F.struct(
        F.shiftrightunsigned(key_hash, 32).alias("high"),
        key_hash.bitwiseAND(_LOW32).alias("low"),
        F.lit(0).cast("bigint").alias("jump"),
        F.lit(0).cast("bigint").alias("shard"),
        F.lit(0).cast("bigint").alias("grown"),
    )

    def step(state: Column, _: Column) -> Column:
        high, low = _next_state(state["high"], state["low"])
        # the generator's top 31 bits give a uniform number; the next candidate lies beyond this one
        ratio = F.lit(float(1 << 31)) / (F.shiftright(high, 1) + 1).cast("double")
        moved = F.struct(
            high.alias("high"),
            low.alias("low"),
            F.floor((state["jump"] + 1) * ratio).cast("bigint").alias("jump"),
            F.when(state["jump"] < shards, state["jump"]).otherwise(state["shard"]).alias("shard"),
            state["jump"].alias("grown"),
        )
        return F.when(state["jump"] > shards, state).otherwise(moved)

    # every step jumps ahead by one bucket at least, so shards + 1 steps always suffice
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(shards + 1)), start, step)
    return F.struct(walked["shard"].cast("int").alias("shard"), walked["grown"].cast("int").alias("grown"))


def shard_documents(df: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, size, text_crc32, law, shard, slot, grown_shard).

    Slots are numbered from 0 in each shard, by key. A shard is as large as the data over the shard
    count, so it is never numbered in one task: rows are range-partitioned by (shard, key) and each adds
    its place in its own range to the number of rows of its shard in earlier ranges.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    narrow = df.select(
        F.col(key).alias(key),
        (F.octet_length(body).cast("bigint") + 1).alias("size"),
        F.crc32(body).alias("text_crc32"),
        jump_buckets(F.xxhash64(F.col(key).cast("string")), shards).alias("_at"),
        F.monotonically_increasing_id().alias("_tie"),  # spreads repeated rows over ranges
    ).select(key, "size", "text_crc32", F.col("_at.shard").alias("shard"), F.col("_at.grown").alias("grown_shard"), "_tie")
    scratch = Scratch(df.sparkSession, "jump-shards")
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["shard", key, "text_crc32", "_tie"]
    sharded = scratch.stage(narrow, "sharded")  # range bounds are sampled from this, not from the texts
    placed = scratch.stage(
        sharded.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id()).drop("_tie")
        .withColumns({
            "_range": F.shiftright("_at", _ORDINAL_BITS).cast("int"),
            "_ordinal": F.col("_at").bitwiseAND((1 << _ORDINAL_BITS) - 1),
        }).drop("_at"),
        "placed",
    )
    scratch.drop("sharded")
    before = Window.partitionBy("shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("shard", "_range").agg(F.count("*").alias("_rows"), F.min("_ordinal").alias("_first"))
        .select("shard", "_range", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    )
    return placed.join(starts, ["shard", "_range"]).select(
        key, "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("_ordinal") + F.col("_shift")).alias("slot"), "grown_shard",
    )


def query(spark, sf_dir: str) -> DataFrame:
    return shard_documents(read_table(spark, sf_dir, "documents"), SHARDS)
