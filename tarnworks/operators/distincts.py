"""Distinct counts that can be added up: exact ones from bitmaps, approximate ones from sketches.

Both are kept as rows of a table, one set for each group, and answer any coarser grouping without the rows they came from:
months roll up to quarters, quarters to years, and an id that occurs in several months counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET, IDS = "bucket", "ids"
SKETCH = "sketch"
SKETCH_LG_K = 16  # a relative error of about 0.4 percent, 64 kB a sketch


def id_bitmaps(rows: DataFrame, groups: list[str], id_: str, *more: Column) -> DataFrame:
    """(groups, bucket, ids): a bitmap for each 32,768 consecutive ids of a group, NULL ids in a row of their own.

    Rows meet by bucket, not by id, so a shuffle carries a bit for each id where ids are numbers of a sequence and lie together.
    ``more`` aggregates ride along. Scattered ids, such as hashes, would make a bitmap each: sketch those, or group by id.
    """
    bucket = F.bitmap_bucket_number(F.col(id_)).alias(BUCKET)
    return rows.groupBy(*groups, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(id_))).alias(IDS), *more)


def distinct_ids(bitmaps: DataFrame, groups: list[str | Column], name: str = "ids_cnt") -> DataFrame:
    """Exact number of distinct ids of each group; the groups may be coarser than those of the bitmaps."""
    named = [F.col(g) if isinstance(g, str) else g for g in groups]
    united = bitmaps.groupBy(*named, BUCKET).agg(F.bitmap_or_agg(IDS).alias(IDS))
    return united.groupBy(*united.columns[: len(named)]).agg(F.coalesce(F.sum(F.bitmap_count(IDS)), F.lit(0)).alias(name))


def id_sketches(rows: DataFrame, groups: list[str], id_: str, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """(groups, sketch): a HyperLogLog sketch of the ids of each group, whatever the ids are."""
    return rows.groupBy(*groups).agg(F.hll_sketch_agg(id_, F.lit(lg_k)).alias(SKETCH))


def estimated_ids(sketches: DataFrame, groups: list[str | Column], name: str = "ids_cnt") -> DataFrame:
    """Estimated number of distinct ids of each group, from sketches of the same or of finer groups."""
    return sketches.groupBy(*groups).agg(F.hll_sketch_estimate(F.hll_union_agg(SKETCH)).alias(name))
