"""Embedding near-duplicates over a robust-pruned flat graph.

Equal vectors are one node. Nodes go to the shards of their nearest ``overlap`` centres; the centres are fitted to a
bounded sample. In each shard every node keeps the near and random candidates that survive robust pruning (a candidate
goes when a kept one is clearly closer to it than the node is), and takes reverse edges. The lists of a node's
shards are united. Each node then searches the graph of each of its shards from the medoid: a greedy beam to the nearest
nodes, then range expansion, which follows every edge of every node inside the widened radius until nothing
new turns up. What it meets is verified in double precision. A shard above ``SHARD_ROWS`` is dealt over parts, and two
parts meet in a task that searches the graph of each by the nodes of the other, so a crowded centre costs more tasks and never a larger
one. What either search meets is a link of both ends.

Pairs don't leave the tasks: a task returns, for each of its nodes, the number of linked vectors and the root of its
local tree. A pair that shares several shards is counted in the first of them.

Recall is audited against brute force for ``AUDIT_ROWS`` nodes, as the mean share of a node's links, those of few links apart;
while it is below ``RECALL``, the overlap doubles, up to all shards.

Defined cases: vectors that are NULL, zero or hold NULL or non-finite components link with nothing and stand alone, as do
rows with a NULL id; repeated rows count each other; vectors of different lengths compare as if the shorter ended
in zeros; an empty table gives an empty result; only id and vector are read.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.llm.components import components
from tarnworks.llm.scratch import Scratch, read_table

COSINE = 0.9
SLACK = 0.06  # range expansion passes through nodes this far below the threshold
SHARD_ROWS = 2048
ROWS_PER_CENTRE = 512
MOST_CENTRES = 4096
SAMPLE_ROWS = 16384
OVERLAP = 2
NEAR, RANDOM, DEGREE, ALPHA = 40, 8, 24, 1.2
BEAM = 12
AUDIT_ROWS, RECALL, LEAST_RECALL = 256, 0.95, 0.9


def unit_rows(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out / np.sqrt((out**2).sum(axis=1, keepdims=True))


def centres_of(sample: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """Spherical k-means."""
    rng = np.random.default_rng(3)
    centres = sample[rng.choice(len(sample), size=k, replace=False)]
    for _ in range(rounds):
        owner = np.concatenate([(sample[i : i + 4096] @ centres.T).argmax(axis=1) for i in range(0, len(sample), 4096)])
        total = np.zeros_like(centres)
        np.add.at(total, owner, sample)
        size = np.sqrt((total**2).sum(axis=1, keepdims=True))
        centres = np.where(size > 0, total / np.maximum(size, 1e-12), centres)
    return centres


def pruned_edges(x: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Edges (from, to) of a robust-pruned graph over unit rows, reverse edges included."""
    n = len(x)
    if n < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    rng = np.random.default_rng(seed)
    near = x @ x.T
    np.fill_diagonal(near, -2)
    k = min(NEAR, n - 1)
    pool = np.concatenate([np.argpartition(-near, k - 1, axis=1)[:, :k], rng.integers(0, n, (n, RANDOM))], axis=1)
    rows = np.arange(n)[:, None]
    own = np.where(pool == rows, -2, near[rows, pool])
    order = np.argsort(-own, axis=1, kind="stable")
    pool, own = np.take_along_axis(pool, order, axis=1), np.take_along_axis(own, order, axis=1)
    alive = own > -2
    source, target = [], []
    for _ in range(DEGREE):
        some = np.flatnonzero(alive.any(axis=1))
        if not len(some):
            break
        first = alive[some].argmax(axis=1)
        chosen = pool[some, first]
        source.append(some)
        target.append(chosen)
        # distances are 1 - cosine
        covered = ALPHA * (1 - near[chosen[:, None], pool[some]]) <= 1 - own[some]
        alive[some] &= ~(covered | (pool[some] == chosen[:, None]))
    far = rng.integers(0, n, (n, 2))  # long edges keep all parts in reach
    a = np.concatenate([*source, np.repeat(np.arange(n), 2)])
    b = np.concatenate([*target, far.ravel()])
    return np.concatenate([a, b]), np.concatenate([b, a])


def adjacency(lists: list[np.ndarray]) -> np.ndarray:
    """Lists of places as rows padded with -1."""
    out = np.full((len(lists), max(1, max(map(len, lists), default=1))), -1, dtype=np.int64)
    for i, one in enumerate(lists):
        out[i, : len(one)] = one
    return out


def _cosines(x: np.ndarray, q: np.ndarray, who: np.ndarray, node: np.ndarray) -> np.ndarray:
    out = np.empty(len(who), dtype=np.float32)
    for start in range(0, len(who), 1 << 16):
        part = slice(start, start + (1 << 16))
        out[part] = np.einsum("pd,pd->p", q[who[part]], x[node[part]])
    return out


def range_search(x: np.ndarray, links: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, node) met inside the radius, a little below the threshold included. x, q: unit rows, single precision."""
    n, m = len(x), len(q)
    medoid = int((x @ x.mean(axis=0)).argmax())
    met = np.zeros((m, n), dtype=bool)
    reach = COSINE - SLACK
    beam = np.full((m, BEAM), medoid)
    value = np.full((m, BEAM), -np.inf, dtype=np.float32)
    value[:, 0] = q @ x[medoid]
    done = np.ones((m, BEAM), dtype=bool)
    done[:, 0] = False
    met[:, medoid] = True
    inside: list[tuple[np.ndarray, np.ndarray]] = []
    first = value[:, 0] >= reach
    inside.append((np.flatnonzero(first), np.full(first.sum(), medoid)))
    active = np.arange(m)
    while len(active):
        pick = np.where(done[active], -np.inf, value[active]).argmax(axis=1)
        done[active, pick] = True
        near = links[beam[active, pick]]
        who = np.repeat(active, near.shape[1])
        node = near.ravel()
        fresh = (node >= 0) & ~met[who, node]
        who, node = who[fresh], node[fresh]
        met[who, node] = True
        cosine = _cosines(x, q, who, node)
        hit = cosine >= reach
        inside.append((who[hit], node[hit]))
        table = np.full((len(active), near.shape[1]), -np.inf, dtype=np.float32)
        places = np.flatnonzero(fresh)
        table.ravel()[places] = cosine
        all_value = np.concatenate([value[active], table], axis=1)
        all_node = np.concatenate([beam[active], np.where(near >= 0, near, medoid)], axis=1)
        all_done = np.concatenate([done[active], np.isneginf(table)], axis=1)
        best = np.argpartition(-all_value, BEAM - 1, axis=1)[:, :BEAM]
        value[active] = np.take_along_axis(all_value, best, axis=1)
        beam[active] = np.take_along_axis(all_node, best, axis=1)
        done[active] = np.take_along_axis(all_done, best, axis=1) | np.isneginf(value[active])
        active = active[~done[active].all(axis=1)]
    who, node = (np.concatenate(part) for part in zip(*inside))
    found_who, found_node = [who], [node]
    while len(who):
        new_who, new_node = [], []
        for start in range(0, len(who), 1 << 14):
            part = slice(start, start + (1 << 14))
            near = links[node[part]]
            w, b = np.repeat(who[part], near.shape[1]), near.ravel()
            fresh = (b >= 0) & ~met[w, b]
            key = np.unique(w[fresh] * n + b[fresh])
            w, b = key // n, key % n
            met[w, b] = True
            hit = _cosines(x, q, w, b) >= reach
            new_who.append(w[hit])
            new_node.append(b[hit])
        who, node = np.concatenate(new_who), np.concatenate(new_node)
        found_who.append(who)
        found_node.append(node)
    return np.concatenate(found_who), np.concatenate(found_node)


def _roots(names: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest name in each place's component; a, b: edges between places."""
    label = np.searchsorted(np.sort(names), names)
    while len(a):
        before = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        if (label == before).all():
            break
    return np.sort(names)[label]


def _shared(mine: np.ndarray, theirs: np.ndarray) -> np.ndarray:
    """The smallest number that two rows of numbers have in common."""
    least = np.full(len(mine), np.iinfo(np.int64).max)
    for i in range(mine.shape[1]):
        for j in range(theirs.shape[1]):
            same = (mine[:, i] == theirs[:, j]) & (mine[:, i] >= 0)
            least[same] = np.minimum(least[same], mine[same, i])
    return least


def _lists(rows: pd.DataFrame) -> np.ndarray:
    """Adjacency lists as places among the rows, which are sorted by cid."""
    names, lists = rows["cid"].to_numpy(np.int64), []
    for near in rows["near"]:
        near = np.asarray(near, dtype=np.int64)
        at = np.minimum(np.searchsorted(names, near), len(names) - 1)
        lists.append(at[names[at] == near])
    return adjacency(lists)


def _links(asks: tuple[np.ndarray, np.ndarray], base: tuple[np.ndarray, np.ndarray], lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Verified pairs (asking node, node of the graph); asks, base: (names, unit rows)."""
    (asking, exact_q), (names, exact) = asks, base
    who, node = range_search(exact.astype(np.float32), lists, exact_q.astype(np.float32))
    other = asking[who] != names[node]
    who, node = who[other], node[other]
    close = np.zeros(len(who), dtype=bool)
    for start in range(0, len(who), 1 << 16):
        part = slice(start, start + (1 << 16))
        close[part] = np.einsum("pd,pd->p", exact_q[who[part]], exact[node[part]]) >= COSINE
    return who[close], node[close]


def _search_tile(rows: pd.DataFrame) -> pd.DataFrame:
    """Two parts of a shard, each searched by the other's nodes, or one part by its own: (cid, links, root) for every node.

    A pair that either search meets is a link of both its ends, so links are mutual however a shard is cut."""
    shard, i, j = (int(rows[c].iloc[0]) for c in ("shard", "i", "j"))
    rows = rows.sort_values("cid", kind="stable")
    width = int(rows["v"].map(len).max())
    sides = [rows[rows["part"] == i]] if i == j else [rows[rows["part"] == i], rows[rows["part"] == j]]
    names = [side["cid"].to_numpy(np.int64) for side in sides]
    found = pd.DataFrame({"cid": np.concatenate(names), "links": np.int64(0), "root": np.concatenate(names)})
    if any(not len(one) for one in names):
        return found
    unit = [(one, unit_rows(side["v"].tolist(), width)) for one, side in zip(names, sides)]
    left, right = sides[0], sides[-1]
    who, node = _links(unit[0], unit[-1], _lists(right))
    back_node, back_who = (who, node) if i == j else _links(unit[-1], unit[0], _lists(left))
    key = np.unique(np.concatenate([who * len(right) + node, back_who * len(right) + back_node]))
    who, node = key // len(right), key % len(right)
    homes = [adjacency([np.asarray(h, dtype=np.int64) for h in side["homes"]]) for side in (left, right)]
    counted = _shared(homes[0][who], homes[1][node]) == shard  # a pair in several shards counts in the first

    def times(place: np.ndarray, side: pd.DataFrame, other: np.ndarray, others: pd.DataFrame) -> np.ndarray:
        sizes = others["size"].to_numpy(np.int64)[other[counted]]
        return np.bincount(place[counted], weights=sizes, minlength=len(side)).astype(np.int64)

    links = [times(who, left, node, right)] + ([] if i == j else [times(node, right, who, left)])
    shift = 0 if i == j else len(left)
    found["links"] = np.concatenate(links)
    found["root"] = _roots(found["cid"].to_numpy(np.int64), who, shift + node)
    return found


def _nodes(df: DataFrame, key: str, vector: str, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(id, v) of all rows, v NULL where a vector can't link; and the nodes (cid, v, size, least)."""
    values = F.transform(F.col(vector), lambda x: x.cast("double"))
    fit = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = scratch.stage(
        df.select(F.col(key).alias("id"), values.alias("v")).withColumn("v", F.when(F.col("id").isNotNull() & fit, F.col("v"))), "rows"
    )
    nodes = scratch.stage(
        rows.where("v is not null").groupBy("v").agg(F.count("*").alias("size"), F.min("id").alias("least"))
        .select(F.xxhash64("v").alias("cid"), "v", "size", "least"), "nodes"
    )
    return rows, nodes


def _homes(nodes: DataFrame, centres: np.ndarray, overlap: int) -> DataFrame:
    """The nodes with the numbers of their nearest centres."""
    width, k = centres.shape[1], min(overlap, len(centres))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = unit_rows([v[:width] for v in batch["v"]], width)
                x = np.nan_to_num(x)
                homes = np.concatenate([np.argpartition(-(x[i : i + 2048] @ centres.T), k - 1, axis=1)[:, :k] for i in range(0, len(x), 2048)])
                batch["homes"] = list(homes)
                yield batch

    return nodes.mapInPandas(run, "cid bigint, v array<double>, size bigint, least bigint, homes array<bigint>")


def _build_shard(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("cid", kind="stable")
    names = rows["cid"].to_numpy(np.int64)
    x = unit_rows(rows["v"].tolist(), int(rows["v"].map(len).max())).astype(np.float32)
    a, b = pruned_edges(x, seed=int(rows["shard"].iloc[0]))
    key = np.unique(a * len(names) + b)
    a, b = key // max(1, len(names)), key % max(1, len(names))
    cuts = np.searchsorted(a, np.arange(1, len(names)))
    return pd.DataFrame({"cid": names, "near": [names[part] for part in np.split(b, cuts)]})


def _link(nodes: DataFrame, centres: np.ndarray, overlap: int, scratch: Scratch) -> DataFrame:
    """(cid, links, root): one row for each node and search."""
    tag = f"-{overlap}"
    homed = scratch.stage(_homes(nodes, centres, overlap), "homed" + tag)
    sizes = homed.select(F.explode("homes").alias("shard")).groupBy("shard").count().collect()  # one row a centre
    parts = F.create_map(*[F.lit(x) for r in sizes for x in (r["shard"], -(-r["count"] // SHARD_ROWS))]) if sizes else None
    placed = scratch.stage(
        homed.withColumn("shard", F.explode("homes"))
        .withColumn("parts", F.element_at(parts, F.col("shard")) if parts is not None else F.lit(1))
        .withColumn("part", F.pmod(F.col("cid"), F.col("parts"))), "placed" + tag
    )
    lists = placed.groupBy("shard", "part").applyInPandas(_build_shard, "cid bigint, near array<bigint>")
    # a node has a list from each of its shards, of bounded length
    united = scratch.stage(lists.groupBy("cid").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "graph" + tag)
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts").cast("bigint") - 1)).alias("other")
    tiles = placed.join(united, "cid").select("shard", "part", "cid", "v", "size", "homes", "near", other).select(
        "*", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j")
    ).drop("other")
    return scratch.stage(
        tiles.groupBy("shard", "i", "j").applyInPandas(_search_tile, "cid bigint, links bigint, root bigint"), "found" + tag
    )


def _true_links(nodes: DataFrame, sample: list, width: int) -> DataFrame:
    """(cid, true): brute force over all nodes for a bounded sample."""
    ids = np.array([r["cid"] for r in sample])
    x = unit_rows([r["v"] for r in sample], width)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(ids), dtype=np.int64)
        for batch in batches:
            if len(batch):
                y = unit_rows([v[:width] for v in batch["v"]], width)
                close = (np.nan_to_num(y) @ x.T >= COSINE) & (batch["cid"].to_numpy()[:, None] != ids[None, :])
                total += (close * batch["size"].to_numpy()[:, None]).sum(axis=0)
        yield pd.DataFrame({"cid": ids, "true": total})

    return nodes.mapInPandas(run, "cid bigint, true bigint").groupBy("cid").agg(F.sum("true").alias("true"))


def _sample(nodes: DataFrame, n: int, most: int) -> DataFrame:
    """(cid, v) of the ``most`` nodes of least hash, or all ``n``, if fewer.

    Nodes whose hash lies above twice the expected bound go first: a ranking alone would send ``most`` rows of every task
    to one. Should fewer than ``most`` lie below it, all of those are taken; the sample only seeds the clusters.
    """
    order = F.xxhash64("cid")
    share = 2 * most / n
    thin = nodes.where(order < int(-(2**63) + share * 2**64)) if share < 1 else nodes
    return thin.select("cid", "v").orderBy(order, "cid").limit(most)


def audited(truth: pd.DataFrame, got: pd.DataFrame) -> float:
    """Mean share of a node's links that were found; nodes of few links apart, whichever mean is lower. No dense group weighs
    more than its nodes do."""
    both = truth[truth["true"] > 0].merge(got, on="cid", how="left").fillna({"links": 0})
    share = both["links"] / both["true"]
    few = share[both["true"] <= both["true"].median()] if len(both) else share
    return float(min(share.mean(), few.mean())) if len(both) else 1.0


def link_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, float]:
    """((key, n_links, component_id, kept), audited recall)."""
    scratch = Scratch(df.sparkSession, "flat-graph")
    rows, nodes = _nodes(df, key, vector, scratch)
    n = nodes.count()
    if not n:
        return rows.select(F.col("id").alias(key), F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept")), 1.0
    width = nodes.agg(F.max(F.size("v"))).first()[0]
    sample = _sample(nodes, n, SAMPLE_ROWS).toPandas()
    k = max(1, min(-(-n // ROWS_PER_CENTRE), MOST_CENTRES, len(sample)))
    centres = centres_of(unit_rows(sample["v"].tolist(), width), k)
    overlap, recall = OVERLAP, 0.0
    audit = sample.iloc[:: max(1, len(sample) // AUDIT_ROWS)].head(AUDIT_ROWS).to_dict("records")
    truth = _true_links(nodes, audit, width).toPandas()
    while True:
        found = _link(nodes, centres, overlap, scratch)
        totals = scratch.stage(found.groupBy("cid").agg(F.sum("links").alias("links")), f"totals-{overlap}")
        got = totals.where(F.col("cid").isin([int(c) for c in truth["cid"]])).toPandas()  # AUDIT_ROWS rows
        recall = audited(truth, got)
        if recall >= RECALL or overlap >= k:
            break
        overlap *= 2
    if recall < LEAST_RECALL:
        warnings.warn(f"audited recall {recall:.3f} though every shard was searched", RuntimeWarning, stacklevel=2)
    roots = components(found.where("cid <> root").select("cid", "root"), scratch)
    labelled = nodes.join(roots.withColumnRenamed("node", "cid"), "cid", "left").select("cid", "v", "size", "least", F.coalesce("root", "cid").alias("root"))
    least = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = scratch.stage(
        labelled.join(least, "root").join(totals, "cid", "left")
        .select("v", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), "component_id"), "classes"
    )
    result = rows.join(classes, "v", "left").select(
        F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
    return result.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id"))), recall


def query(spark, sf_dir: str) -> DataFrame:
    return link_vectors(read_table(spark, sf_dir, "embeddings"))[0]
