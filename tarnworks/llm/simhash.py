"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most ``2r + 1`` bits apart (r = 1: three bits) have, outside some one of three blocks of
bits, at most ``2r`` differing bits. So every distinct fingerprint emits, for each block, all variants
within half the radius (r flips) of its other bits, with that block masked: 131 keys in place of the 2,081
that a ball of the rounded-up radius needs. Keys are shuffled, colliding fingerprints are verified bit by
bit, and only a spanning forest of each bucket's verified links leaves the task.

A bucket of more than ``BUCKET_ROWS`` fingerprints isn't compared pairwise: its members emit the whole ball of
radius two. A fingerprint within one flip of a variant is at most three bits from any within two, so such
a bucket links as a star without comparing anything, and geometry bounds it by the ball's 2,081 points.

Equal fingerprints are one node, so groups of copies cost no more than one document. Defined cases: NULL or
blank texts have fingerprint zero and link like any other; fewer words than a shingle make one shingle;
repeated rows fall into one component; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tarnworks.llm.columns import free_name
from tarnworks.llm.components import components
from tarnworks.llm.scratch import Scratch, read_table

SHINGLE_WORDS = 3
SEED = 42
RADIUS = 3
BLOCKS = ((0, 22), (22, 43), (43, 64))
BUCKET_ROWS = 256
_SHINGLES_AT_ONCE = 1 << 16
_ONE = np.uint64(1)


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space; only A-Z are lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(words: list[bytes], width: int) -> list[bytes]:
    if len(words) < width:
        return [b" ".join(words)] if words else []
    return [b" ".join(group) for group in zip(*(words[i:] for i in range(width)))]


def fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """64 bits; a bit is set if more than half of the shingles' hashes set it."""
    pieces = shingles(words_of(text), width)
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, len(pieces), _SHINGLES_AT_ONCE):
        part = pieces[start : start + _SHINGLES_AT_ONCE]
        hashes = np.fromiter((digest(piece, SEED) for piece in part), dtype="<u8", count=len(part))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(pieces), bitorder="little").view("<u8")[0])


@F.pandas_udf(LongType())
def printed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The fingerprint of a whole text as a signed long."""
    for texts in batches:
        prints = np.fromiter((fingerprint(t) for t in texts), dtype=np.uint64, count=len(texts))
        yield pd.Series(prints.view(np.int64))


def _mask(block: tuple[int, int]) -> np.uint64:
    return np.uint64(sum(1 << bit for bit in range(*block)))


def _masked_variants(prints: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(block, keys) with keys of shape (fingerprints, 1 + bits outside the block)."""
    for number, block in enumerate(BLOCKS):
        outside = [bit for bit in range(64) if not block[0] <= bit < block[1]]
        flips = np.array([0] + [1 << bit for bit in outside], dtype=np.uint64)
        yield number, (prints & ~_mask(block))[:, None] ^ flips[None, :]


def _ball_flips() -> tuple[np.ndarray, np.ndarray]:
    single = [1 << bit for bit in range(64)]
    double = [1 << a | 1 << b for a in range(64) for b in range(a)]
    flips = np.array([0, *single, *double], dtype=np.uint64)
    return flips, np.array([0] + [1] * 64 + [2] * len(double), dtype=np.int32)


def _forest(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges (member, root) of the links among a bucket's distinct fingerprints."""
    linked = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= RADIUS
    root = np.arange(len(prints))
    while True:
        nearest = np.where(linked, root[None, :], len(prints)).min(axis=1)
        nearest = nearest[nearest]
        if (nearest == root).all():
            break
        root = nearest
    moved = root != np.arange(len(prints))
    return prints[moved], prints[root[moved]]


def _runs(*sorted_columns: np.ndarray) -> np.ndarray:
    """Bounds of the runs of equal keys in sorted columns."""
    change = np.zeros(len(sorted_columns[0]) - 1, dtype=bool)
    for column in sorted_columns:
        change |= column[1:] != column[:-1]
    return np.concatenate([[0], np.flatnonzero(change) + 1, [len(sorted_columns[0])]])


def _bucket_links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted (key, block, fp) rows to spanning edges (u, v); members of large buckets come back as (u, u).

    A run may cross batches: the last one is kept back until it ends, up to the bucket size."""
    carry = np.empty((0, 3), dtype=np.int64)
    large_key: tuple[int, int] | None = None
    for batch in batches:
        rows = batch[["key", "block", "fp"]].to_numpy(dtype=np.int64)
        held = np.concatenate([carry, rows])
        if not len(held):
            continue
        yield from _emit(held, False, large_key)
        carry = held[_runs(held[:, 0], held[:, 1])[-2] :]
        at = (int(carry[0, 0]), int(carry[0, 1]))
        if len(carry) > BUCKET_ROWS or at == large_key:
            large_key = at
            yield pd.DataFrame({"u": carry[:, 2], "v": carry[:, 2]})
            carry = carry[:0]
    yield from _emit(carry, True, large_key)


def _emit(rows: np.ndarray, last: bool, large_key: tuple[int, int] | None) -> Iterator[pd.DataFrame]:
    """Edges of the runs in sorted rows; the last run is left alone unless ``last``."""
    if not len(rows):
        return
    bounds = _runs(rows[:, 0], rows[:, 1])
    if not last:
        bounds = bounds[:-1]
    starts, sizes = bounds[:-1], np.diff(bounds)
    prints = np.ascontiguousarray(rows[:, 2]).view(np.uint64)
    left, right = [], []
    if len(starts) and (int(rows[0, 0]), int(rows[0, 1])) == large_key:  # only the first run can go on from before
        left.append(prints[: sizes[0]])
        right.append(prints[: sizes[0]])
        starts, sizes = starts[1:], sizes[1:]
    pairs = starts[sizes == 2]  # most buckets hold one fingerprint, or two
    near = np.bitwise_count(prints[pairs] ^ prints[pairs + 1]) <= RADIUS
    left.append(prints[pairs][near])
    right.append(prints[pairs + 1][near])
    for start, size in zip(starts[sizes > 2], sizes[sizes > 2]):
        members = prints[start : start + size]
        a, b = (members, members) if size > BUCKET_ROWS else _forest(members)
        left.append(a)
        right.append(b)
    u, v = np.concatenate(left).view(np.int64), np.concatenate(right).view(np.int64)
    if len(u):
        yield pd.DataFrame({"u": u, "v": v}).drop_duplicates()


def _emit_masked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        prints = batch["fp"].to_numpy(dtype=np.int64).view(np.uint64)
        for start in range(0, len(prints), 4096):
            part = prints[start : start + 4096]
            for block, keys in _masked_variants(part):
                yield pd.DataFrame({
                    "key": keys.ravel().view(np.int64), "block": np.int32(block),
                    "fp": np.repeat(part, keys.shape[1]).view(np.int64),
                })


def _emit_ball(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    flips, steps = _ball_flips()
    for batch in batches:
        prints = batch["fp"].to_numpy(dtype=np.int64).view(np.uint64)
        for start in range(0, len(prints), 256):
            part = prints[start : start + 256]
            yield pd.DataFrame({
                "key": (part[:, None] ^ flips[None, :]).ravel().view(np.int64),
                "steps": np.tile(steps, len(part)), "fp": np.repeat(part, len(flips)).view(np.int64),
            })


def links(distinct: DataFrame, scratch: Scratch) -> DataFrame:
    """Edges (u, v) whose components are those of the links between distinct fingerprints (column fp)."""
    keyed = distinct.mapInPandas(_emit_masked, "key bigint, block int, fp bigint")
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = scratch.stage(
        keyed.repartition(parts, "key", "block").sortWithinPartitions("key", "block")
        .mapInPandas(_bucket_links, "u bigint, v bigint"),
        "links",
    )
    crowded = scratch.stage(found.where("u = v").select(F.col("u").alias("fp")).distinct(), "crowded")
    edges = found.where("u <> v")
    if crowded.isEmpty():
        return edges
    ball = scratch.stage(crowded.mapInPandas(_emit_ball, "key bigint, steps int, fp bigint"), "ball")
    centre = ball.where("steps <= 1").groupBy("key").agg(F.min("fp").alias("centre"))
    starred = ball.join(centre, "key").select(F.col("fp").alias("u"), F.col("centre").alias("v")).where("u <> v")
    return edges.unionByName(scratch.stage(starred.distinct(), "starred"))


def _grouped(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """rows: (id, fp), staged. Adds ``first``, the smallest id reachable over links."""
    classes = scratch.stage(rows.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    roots = components(links(classes.select("fp"), scratch), scratch)
    labelled = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = labelled.groupBy("root").agg(F.min("least").alias("first"))
    by_class = scratch.stage(labelled.join(named, "root").select("fp", "first"), "by-class")
    return rows.join(by_class, "fp")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint, component_id): component_id is the smallest key reachable over links."""
    scratch = Scratch(df.sparkSession, "simhash")
    rows = scratch.stage(df.select(F.col(key).alias("id"), printed(F.col(text)).alias("fp")), "prints")
    return _grouped(rows, scratch).select(
        F.col("id").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first").alias("component_id")
    )


def keep(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, columns unchanged: the one with the smallest key, NULL first, then with the smallest
    hash of key and text; of rows equal in both, any one. Links are those of ``near_duplicates``."""
    scratch = Scratch(df.sparkSession, "simhash-keep")
    row = free_name("row", df.columns)
    rows = df.withColumn(row, F.xxhash64(key, text))
    prints = scratch.stage(rows.select(F.struct(F.col(key).alias("key"), F.col(row).alias("row")).alias("id"), printed(F.col(text)).alias("fp")), "prints")
    others = scratch.stage(_grouped(prints, scratch).where("id <> first").select(F.col("id.row").alias(row)).distinct(), "others")
    repeated = scratch.stage(
        prints.groupBy(F.col("id.row").alias(row)).count().where("count > 1").select(row).join(others, row, "left_anti"), "repeated"
    )
    first = rows.join(others, row, "left_anti")
    once = first.join(repeated, row, "left_anti")
    again = first.join(repeated, row, "left_semi").dropDuplicates([row])
    kept = once if repeated.isEmpty() else once.unionByName(again)
    return kept.select(*df.columns)


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))
