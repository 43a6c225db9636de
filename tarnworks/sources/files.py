"""Plain file scans: pushed-down reads, globs that ignore table state, file listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SMALL_FILE_BYTES = 64 * 1024 * 1024
SKETCH_K = 800  # ranks within about half a percent


def scan(rows: DataFrame, columns: list[str], row_filter: Column | None = None) -> DataFrame:
    """Filtered projection of stored rows; filter and columns reach the Parquet reader."""
    if row_filter is not None:
        rows = rows.where(row_filter)
    return rows.select(*columns)


def raw_glob(spark: SparkSession, pattern: str) -> DataFrame:
    """Every Parquet file that matches, live or not. Overcounts a table after rewrites."""
    return spark.read.parquet(pattern)


def size_profile(files: DataFrame, by: str, size: str, small_bytes: int = SMALL_FILE_BYTES) -> DataFrame:
    """Small-file profile of each folder or partition ``by``, with a sketch of the sizes that can be merged further up."""
    return files.groupBy(by).agg(
        F.count("*").alias("file_count"),
        F.sum(size).alias("total_bytes"),
        F.min(size).alias("min_bytes"),
        F.max(size).alias("max_bytes"),
        F.count_if(F.col(size) < small_bytes).alias("small_files"),
        F.kll_sketch_agg_bigint(size, F.lit(SKETCH_K)).alias("sizes"),
    )


def size_quantiles(profile: DataFrame, ranks: list[float], by: list[str] | None = None) -> DataFrame:
    """Quantiles of the sizes over many folders, from their sketches alone."""
    merged = profile.groupBy(*(by or [])).agg(F.kll_merge_agg_bigint("sizes", F.lit(SKETCH_K)).alias("sizes"))
    at = F.array(*[F.lit(float(rank)) for rank in ranks])
    return merged.select(
        *(by or []), F.kll_sketch_get_n_bigint("sizes").alias("file_count"), F.kll_sketch_get_quantile_bigint("sizes", at).alias("quantiles"),
    )
