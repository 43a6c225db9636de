"""Whitening of embeddings, with one computation for each distinct vector.

Entries become whole numbers x, so equal vectors meet in one group and their number is the group's weight. Sums and
deviations are exact; the covariance is a weighted product of rows centred before they are multiplied (n x - S is a whole
number, divided by n once). Tasks emit partial products of dimensions by dimensions, which Spark adds up; only that one matrix, of a size
fixed by the number of dimensions, comes to the driver for its eigenvectors. Each distinct vector is whitened once and joined back
to its rows, with vectors that hold many rows dealt over many tasks.

Defined cases: rows whose vector is NULL, or holds NULL or non-finite entries, take no part; repeated rows count as
often as they occur; a component without variance (to rounding) whitens to NULL, its explained share stays; a deviation beyond 64 bits is NULL;
vectors without entries have no components, hence no rows; vectors of unequal lengths, or entries of 2^50 and more, which whole numbers
can't hold exactly, raise; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnworks.llm.scratch import Scratch, read_table
from tarnworks.llm.spread_join import spread_join

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
WIDEST = 2.0**50
_LONG = 2**63 - 1


def whole_numbers(vector: Column) -> Column:
    """floor(1024 c) + 100000 of every entry, as long."""
    return F.transform(vector, lambda c: (F.floor(c.cast("double") * SCALE) + SHIFT).cast("bigint"))


def usable(vector: Column) -> Column:
    """Not NULL, and every entry finite."""
    def bad(c: Column) -> Column:
        return c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))

    return vector.isNotNull() & ~F.exists(vector, lambda c: F.coalesce(bad(c.cast("double")), F.lit(True)))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


@dataclass(frozen=True)
class Fit:
    """Rows n, sums S by dimension, eigenvalues and unit eigenvectors (columns) by falling eigenvalue."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def _weighted_product(rows: DataFrame, centred, width: int) -> np.ndarray:
    """Sum over rows of weight times the outer product of ``centred(batch)``; tasks emit one partial matrix each."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            c = centred(batch)
            total += (c * batch.column("members").to_numpy(zero_copy_only=False)[:, None]).T @ c
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "v"])

    cells = rows.mapInArrow(partial, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    product = np.zeros((width, width))
    for cell in cells:
        product[cell["i"], cell["j"]] = product[cell["j"], cell["i"]] = cell["v"]
    return product


def fit(distinct: DataFrame, width: int) -> Fit:
    """distinct: (x, members), staged."""
    sums = distinct.select("members", F.posexplode("x").alias("i", "x")).groupBy("i").agg(
        F.sum("members").alias("n"), F.sum(F.col("x").cast("decimal(38,0)") * F.col("members")).cast("decimal(38,0)").alias("s")
    ).orderBy("i").collect()
    n, total = int(sums[0]["n"]), [int(r["s"]) for r in sums]
    centred = _centred(n, total, width)
    covariance = _weighted_product(distinct, centred, width) / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    largest = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.sign(vectors[largest, np.arange(width)])
    return Fit(n, np.array(total, dtype=object), values, vectors, float(np.trace(covariance)))


def _deviations(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """n x - S as whole numbers: in 64 bits where they fit, else in Python's."""
    bound = max(n * int(np.abs(x).max(initial=0)), max(map(abs, total)))
    if bound < 2**61:
        return n * x - np.array(total, dtype=np.int64)
    return n * x.astype(object) - np.array(total, dtype=object)


def _centred(n: int, total: list[int], width: int):
    return lambda batch: _deviations(_matrix(batch.column("x"), width), n, total).astype(np.float64) / n


def _squares(d: np.ndarray) -> list[int | None]:
    """Exact sums of squares; None beyond 64 bits."""
    if d.dtype != object and (not d.size or float(np.abs(d).max()) ** 2 * d.shape[1] < 2**62):
        return (d * d).sum(axis=1).tolist()
    return [s if s <= _LONG else None for s in (d.astype(object) ** 2).sum(axis=1).tolist()]


def whitened(distinct: DataFrame, fitted: Fit, components: int) -> DataFrame:
    """Adds (deviation, z) to the distinct vectors; z has one entry a component, NULL without variance."""
    width = len(fitted.values)
    kept = min(components, width)
    values, vectors = fitted.values[:kept], fitted.vectors[:, :kept]
    some = values > width * np.finfo(float).eps * max(fitted.values[0], 0.0)
    weights = np.where(some, vectors / np.sqrt(np.where(some, values, 1.0)), 0.0)
    n, total = fitted.n, [int(s) for s in fitted.sums]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = _deviations(_matrix(batch.column("x"), width), n, total)
            z = (d.astype(np.float64) / n) @ weights
            empty = np.broadcast_to(~some, z.shape).ravel()
            flat = pa.array(z.ravel(), pa.float64(), mask=empty)
            offsets = pa.array(np.arange(0, len(z) * kept + 1, kept), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("x"), batch.column("members"), pa.array(_squares(d), pa.int64()), pa.ListArray.from_arrays(offsets, flat)],
                ["x", "members", "deviation", "z"],
            )

    return distinct.mapInArrow(project, "x array<bigint>, members bigint, deviation bigint, z array<double>")


def identity_error(scored: DataFrame, fitted: Fit, kept: int) -> float | None:
    """Largest absolute entry of the whitened values' covariance less the identity, over components with variance."""
    mean = scored.select(F.posexplode("z").alias("i", "z"), "members").where("z is not null").groupBy("i").agg(
        (F.sum(F.col("z") * F.col("members")) / fitted.n).alias("m")
    ).orderBy("i").collect()
    if not mean:
        return None
    at, middle = [r["i"] for r in mean], np.array([r["m"] for r in mean])

    def centred(batch: pa.RecordBatch) -> np.ndarray:
        z = batch.column("z").flatten().to_numpy(zero_copy_only=False).reshape(-1, kept)
        return z[:, at] - middle

    covariance = _weighted_product(scored, centred, len(at)) / fitted.n
    return float(np.abs(covariance - np.eye(len(at))).max())


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): a row for each usable row and component."""
    spark = df.sparkSession
    out = "id {}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    scratch = Scratch(spark, "whitening")
    kept = df.select(F.col(key).alias("id"), F.col(vector).alias("v")).where(usable(F.col("v")))
    ranges = kept.agg(
        F.min(F.size("v")).alias("least"), F.max(F.size("v")).alias("most"), F.max(F.array_max(F.transform("v", F.abs))).alias("widest"),
    ).first()
    if not ranges["most"]:
        return spark.createDataFrame([], out.format(kept.schema["id"].dataType.simpleString())).withColumnRenamed("id", key)
    if ranges["least"] != ranges["most"]:
        raise ValueError(f"vectors of {ranges['least']} to {ranges['most']} entries can't be whitened together")
    if ranges["widest"] >= WIDEST / SCALE:
        raise ValueError(f"entries up to {ranges['widest']} are too large for exact sums")
    width = ranges["most"]
    rows = kept.select("id", whole_numbers(F.col("v")).alias("x"))
    distinct = scratch.stage(rows.groupBy("x").agg(F.count("*").alias("members")), "distinct")
    fitted = fit(distinct, width)
    scored = scratch.stage(whitened(distinct, fitted, components), "whitened")
    error = identity_error(scored, fitted, min(components, width))
    shares = fitted.values / fitted.trace if fitted.trace > 0 else np.full(width, np.nan)
    explained = F.array(*[F.lit(float(s) if np.isfinite(s) else None).cast("double") for s in shares[:components]])
    scratch.drop("distinct")
    joined = spread_join(rows, scored, "x", "members", "id")
    return joined.select("id", "deviation", F.posexplode("z").alias("at", "whitened")).select(
        F.col("id").alias(key), (F.col("at") + 1).alias("component"), F.lit(fitted.n).cast("bigint").alias("n"), "deviation",
        "whitened", explained[F.col("at")].alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))
