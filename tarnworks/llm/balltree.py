"""Exact top-k inner products by ball-tree branch and bound, one tree a shard.

Candidates are dealt over shards by a hash, and each shard becomes a tree of balls over its scaled integer
vectors, written once to a table. A block of queries then passes the shards in two waves: the first, a
few shards, gives each query a k-th score to beat; the second visits the others with it. In a tree a
node's inner products are at most q.c + |q| r; queries go to the child with the higher bound first, and
a node whose bound can't beat the current k-th (score, smaller id) is skipped. The k-th score carries over from
node to node and from shard to shard in a task.

Scores are sums of integers, exact in double precision below 2^53; a vector beyond that raises.

Defined cases: NULL vectors and those with NULL or non-finite components take no part, as queries or candidates;
vectors of different lengths are compared as if the shorter ended in zeros; ties go to the smaller id; rows that
repeat an id are candidates each, but never for a query of that id; a repeated query id is asked once for each
different vector and its answers are ranked together; empty vectors score zero; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnworks.llm.scratch import Scratch, read_table

SCALE = 64
TOP = 20
QUERY_STEP = 20
SHARD_ROWS = 4096
LEAF_ROWS = 64
BLOCK_QUERIES = 4096
FIRST_WAVE = 8  # one shard in so many
_NO_ID = np.iinfo(np.int64).max


def scaled(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): floor(64 x) of the vectors that take part."""
    values = F.transform(F.col(vector), lambda x: x.cast("double"))
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        df.select(F.col(key).alias("id"), values.alias("v")).where(F.col("v").isNotNull() & F.col("id").isNotNull()).where(whole)
        .select("id", F.transform("v", lambda x: F.floor(x * SCALE).cast("double")).alias("v"))
    )


def matrix(vectors: list, width: int | None = None) -> np.ndarray:
    """Rows padded with zeros to one length."""
    width = max([width or 0, *map(len, vectors)])
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def build_tree(ids: np.ndarray, x: np.ndarray) -> dict[str, np.ndarray]:
    """Rows in tree order, and for each node its rows, children, centre, radius and smallest id."""
    order = np.lexsort((ids,))
    nodes: list[tuple[int, int, int, int]] = []

    def grow(start: int, end: int) -> int:
        number = len(nodes)
        nodes.append((start, end, -1, -1))
        if end - start > LEAF_ROWS:
            part = x[order[start:end]]
            far = part[np.argmax(((part - part.mean(axis=0)) ** 2).sum(axis=1))]
            other = part[np.argmax(((part - far) ** 2).sum(axis=1))]
            # halves along the line between two far rows; equal rows stay in the order of their ids
            side = np.argsort(part @ (other - far), kind="stable")
            order[start:end] = order[start:end][side]
            middle = (start + end) // 2
            left, right = grow(start, middle), grow(middle, end)
            nodes[number] = (start, end, left, right)
        return number

    grow(0, len(ids))
    x, ids = x[order], ids[order]
    spans = np.array(nodes, dtype=np.int64)
    centres = np.stack([x[a:b].mean(axis=0) for a, b, _, _ in nodes])
    radii = np.array([np.sqrt(((x[a:b] - c) ** 2).sum(axis=1).max()) for (a, b, _, _), c in zip(nodes, centres)])
    least = np.array([ids[a:b].min() for a, b, _, _ in nodes])
    return {"ids": ids, "x": x, "spans": spans, "centres": centres, "radii": radii, "least": least}


class Best:
    """The k best (score, smaller id) of every query in a block."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray):
        self.ids, self.q, self.k, self.floor = query_ids, queries, k, floor
        self.norms = np.sqrt((queries**2).sum(axis=1))
        self.score = np.full((len(query_ids), k), -np.inf)
        self.found = np.full((len(query_ids), k), _NO_ID)

    def kth(self, who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score and id that a newcomer has to beat; a floor from earlier shards admits equal scores."""
        score, found = self.score[who, -1], self.found[who, -1]
        low = self.floor[who] > score
        return np.where(low, self.floor[who], score), np.where(low, _NO_ID, found)

    def offer(self, who: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        scores = np.where(ids[None, :] == self.ids[who][:, None], -np.inf, scores)
        all_scores = np.concatenate([self.score[who], scores], axis=1)
        all_ids = np.concatenate([self.found[who], np.broadcast_to(ids, scores.shape)], axis=1)
        all_ids = np.where(np.isneginf(all_scores), _NO_ID, all_ids)
        rank = np.lexsort((all_ids, -all_scores), axis=1)[:, : self.k]
        self.score[who] = np.take_along_axis(all_scores, rank, axis=1)
        self.found[who] = np.take_along_axis(all_ids, rank, axis=1)


def search(tree: dict[str, np.ndarray], best: Best) -> None:
    """Branch and bound for all queries of a block together."""
    width = max(best.q.shape[1], tree["x"].shape[1])
    q = np.pad(best.q, ((0, 0), (0, width - best.q.shape[1])))
    x, centres = (np.pad(tree[n], ((0, 0), (0, width - tree[n].shape[1]))) for n in ("x", "centres"))
    most = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, width)
    if most >= 2**53:
        raise OverflowError("vector components are too large for exact integer scores")
    # rounding of centre and radius must never lower a bound; scores are whole numbers
    bounds = np.floor(q @ centres.T + best.norms[:, None] * tree["radii"][None, :] + 1e-6 * (1 + best.norms[:, None]))

    def visit(node: int, who: np.ndarray) -> None:
        score, found = best.kth(who)
        bound = bounds[who, node]
        who = who[(bound > score) | ((bound == score) & (tree["least"][node] < found))]
        if not len(who):
            return
        start, end, left, right = tree["spans"][node]
        if left < 0:
            best.offer(who, tree["ids"][start:end], q[who] @ x[start:end].T)
            return
        leftward = bounds[who, left] >= bounds[who, right]
        for first, second, group in ((left, right, who[leftward]), (right, left, who[~leftward])):
            if len(group):
                visit(first, group)
                visit(second, group)

    if len(tree["ids"]) and len(best.ids):
        visit(0, np.arange(len(best.ids)))


_NAMES = ("ids", "x", "spans", "centres", "radii", "least")


def _shards(candidates: DataFrame, scratch: Scratch) -> DataFrame:
    """(shard, tree): one row a shard, each array as bytes with its width."""
    n = candidates.count()
    shards = max(1, -(-n // SHARD_ROWS))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        x = matrix(rows["v"].tolist())
        tree = build_tree(rows["id"].to_numpy(np.int64), x)
        row = {"shard": [int(rows["shard"].iloc[0])], "width": [x.shape[1]]}
        return pd.DataFrame(row | {name: [np.ascontiguousarray(tree[name]).tobytes()] for name in _NAMES})

    # the place in the scan takes part, so that rows repeating an id spread as well
    dealt = candidates.withColumn("shard", F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(shards)))
    schema = "shard bigint, width int, " + ", ".join(f"{name} binary" for name in _NAMES)
    return scratch.stage(dealt.groupBy("shard").applyInPandas(build, schema), "trees")


def _tree(row) -> dict[str, np.ndarray]:
    kinds = {"ids": np.int64, "x": np.float64, "spans": np.int64, "centres": np.float64, "radii": np.float64, "least": np.int64}
    tree = {name: np.frombuffer(getattr(row, name), dtype=kind) for name, kind in kinds.items()}
    tree["spans"] = tree["spans"].reshape(-1, 4)
    tree["x"] = tree["x"].reshape(len(tree["ids"]), row.width)
    tree["centres"] = tree["centres"].reshape(len(tree["spans"]), row.width)
    return tree


def _wave(trees: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray) -> DataFrame:
    """(query_id, vec_id, score, slot) of the best in each task's shards."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = None
        for batch in batches:
            for row in batch.itertuples():
                best = best or Best(ids, queries, k, floor)
                search(_tree(row), best)
        if best is None:
            return
        who, rank = np.nonzero(best.found != _NO_ID)
        yield pd.DataFrame({
            "slot": who, "query_id": ids[who], "vec_id": best.found[who, rank], "score": best.score[who, rank].astype(np.int64),
        })

    return trees.mapInPandas(run, "slot bigint, query_id bigint, vec_id bigint, score bigint")


def _blocks(sizes: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """First and last of the neighbouring parts that make up a block of about BLOCK_QUERIES."""
    first, total, last = None, 0, None
    for part, n in sizes:
        if first is not None and total + n > BLOCK_QUERIES:
            yield first, last
            first, total = None, 0
        first, last, total = part if first is None else first, part, total + n
    if first is not None:
        yield first, last


def top_k(queries: DataFrame, candidates: DataFrame, k: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score). queries and candidates: (id, v) with whole-numbered doubles.

    Blocks hold BLOCK_QUERIES queries at most and go along with the tasks; there are as many passes over the
    trees as blocks."""
    spark = candidates.sparkSession
    scratch = Scratch(spark, "ball-tree")
    trees = _shards(candidates, scratch)
    asked = scratch.stage(
        queries.distinct().repartitionByRange(max(1, -(-queries.count() // BLOCK_QUERIES)), "id", "v")
        .withColumn("part", F.spark_partition_id()), "queries"
    )
    shards = trees.count()
    parts = min(max(1, shards), int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = []
    sizes = asked.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()
    for low, high in _blocks([(r["part"], r["n"]) for r in sizes]):
        rows = asked.where(F.col("part").between(low, high)).toPandas()  # one bounded block
        for start in range(0, len(rows), BLOCK_QUERIES):
            part = rows.iloc[start : start + BLOCK_QUERIES]
            ids, q = part["id"].to_numpy(np.int64), matrix(part["v"].tolist())
            floor = np.full(len(ids), -np.inf)
            first = _wave(trees.where(F.col("shard") % FIRST_WAVE == 0).repartition(parts), ids, q, k, floor)
            name = f"found-{low}-{start}"
            seen = scratch.stage(first, f"{name}-first")
            ranked = Window.partitionBy("slot").orderBy(F.desc("score"), "vec_id")
            kth = seen.withColumn("r", F.row_number().over(ranked)).where(F.col("r") == k).select("slot", "score").toPandas()
            floor[kth["slot"].to_numpy(np.int64)] = kth["score"]
            rest = _wave(trees.where(F.col("shard") % FIRST_WAVE != 0).repartition(parts), ids, q, k, floor)
            found += [seen, scratch.stage(rest, f"{name}-rest")]
    if not found:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    union = found[0]
    for more in found[1:]:
        union = union.unionByName(more)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return union.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    vectors = scaled(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return top_k(vectors.where(F.col("id") % QUERY_STEP == 0), vectors)


ORACLE = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.x AS DOUBLE[]), CAST(c.x AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % {QUERY_STEP} = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= {TOP}
"""
