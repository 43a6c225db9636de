"""Mixing sources to target weights by iterative proportional fitting.

Token weights are summed for every (source, language, topic) cell. Raking scales the cells in turn until the
three marginals agree with their targets. A cell's factor times the sampling rate (kept tokens over all tokens) is the
probability with which each of its documents is kept. A cell that would need more than one is kept whole, and the rest
is raked again against what remains of the targets and of the rate, so a rare cell never sets how much of the others
survives. Without a given rate the sample is the largest one whose shares are the targets exactly, or RATE of the tokens if
that is more. The draw is a hash of the key, so it is repeatable and needs no state.

Cells kept whole leave their values below target by what they lack; the other values share it. Targets that no sample
meets, since some cells are missing, leave the raking unsettled; then the targets move towards the rows' own shares until
it settles, and a warning says how far.

Targets default to each marginal's own share to a power below one (flattened), or come as a mapping. The cell
table is sources x languages x topics, the size of the mixing recipe and not of the data; its size is checked
before it comes to the driver.

Defined cases: NULL source, language or topic is a value of its own; NULL and blank texts weigh nothing and are
drawn by their cell's factor (a cell without any weight: never); a NULL key is drawn as the empty string; rows
that repeat a key share its draw; a target for an absent value is left out and the others rescaled; an empty
table gives an empty result. Working columns start with two underscores; rows keep their own.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnworks.llm.columns import free_name
from tarnworks.llm.scratch import read_table

POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.8}
RATE = 0.25
ROUNDS = 1000
STALL = 50  # rounds in which the distance must fall
TOLERANCE = 1e-9
UNSETTLED = 1e-6
MOVES = (0.0, 0.05, 0.1, 0.2, 0.4, 0.7, 1.0)
MOST_CELLS = 1_000_000
_DRAW_RANGE = float(1 << 32)


def tokens_of(text: Column) -> Column:
    """Words between ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def topic_of(text: Column) -> Column:
    """A coarse topic by built-in expressions, for tables without one: the manner of a text."""
    return (
        F.when(F.coalesce(F.trim(text), F.lit("")) == "", "blank")
        .when(F.contains(text, F.lit(" | ")), "tabular")
        .when(F.contains(text, F.lit("!!")), "shouting")
        .when(F.length(text) >= 4000, "long prose")
        .otherwise("prose")
    )


def flattened(masses: dict, power: float) -> dict:
    raised = {k: m**power for k, m in masses.items() if m > 0}
    total = sum(raised.values())
    return {k: r / total for k, r in raised.items()}


def rake(cells: np.ndarray, members: list[np.ndarray], targets: list[np.ndarray]) -> tuple[np.ndarray, float]:
    """Factors of the cells and the largest distance of a share from its target. members: each cell's number on
    each marginal; targets: shares by number."""
    weights = cells / cells.sum()
    before = off = np.inf
    for turn in range(ROUNDS):
        off = 0.0
        for member, target in zip(members, targets):
            now = np.bincount(member, weights=weights, minlength=len(target))
            scale = np.divide(target, now, out=np.zeros(len(target)), where=now > 0)
            weights = weights * scale[member]
            off = max(off, float(np.abs(now - target).max()))
        if off < TOLERANCE:
            break
        if turn % STALL == STALL - 1:
            if off > 0.99 * before:
                break
            before = off
    return np.divide(weights * cells.sum(), cells, out=np.zeros(len(cells)), where=cells > 0), off


def settled(
    cells: np.ndarray, members: list[np.ndarray], targets: list[np.ndarray]
) -> tuple[np.ndarray, float]:
    """Factors of a raking that settles, and how far the targets had to move towards the cells' own shares for it."""
    for moved in MOVES:
        own = [np.bincount(m, weights=cells, minlength=len(t)) / cells.sum() for m, t in zip(members, targets)]
        nearer = [(1 - moved) * t + moved * np.where(t > 0, o, 0.0) for t, o in zip(targets, own)]
        factors, off = rake(cells, members, [t / t.sum() for t in nearer])
        if off <= UNSETTLED:
            break
    return factors, moved


def fill(
    cells: np.ndarray, members: list[np.ndarray], targets: list[np.ndarray], rate: float | None = None
) -> tuple[np.ndarray, float]:
    """Probabilities of the cells, and how far targets had to move. Cells that would need more than one are kept whole
    and the free ones raked again, until none does or the targets allow no more."""
    total = cells.sum()
    # a cell of a value that isn't wanted takes no part
    free = np.all([t[m] > 0 for m, t in zip(members, targets)], axis=0) & (cells > 0)
    chances = np.zeros(len(cells))
    if not free.any():
        return chances, 0.0
    factors, off = rake(np.where(free, cells, 0.0), members, targets)
    factors = factors * (total / cells[free].sum())
    if rate is None:
        rate = max(1.0 / factors.max(), RATE)
    left = min(rate, 1.0) * total
    wanted = [target * left for target in targets]
    moved = 0.0
    while True:
        some = np.where(free, cells, 0.0)
        factors, off = rake(some, members, [want / left for want in wanted])
        over = free & (factors * (left / some.sum()) > 1.0 + 1e-12)
        if not over.any() and off > UNSETTLED:
            factors, moved = settled(some, members, [want / left for want in wanted])
            over = free & (factors * (left / some.sum()) > 1.0 + 1e-12)
        chances[free] = np.minimum(factors * (left / some.sum()), 1.0)[free]
        if not over.any():
            return chances, moved
        free &= ~over
        left -= cells[over].sum()
        if not free.any() or left <= TOLERANCE * total:
            return chances, moved
        remaining = []
        for member, want in zip(members, wanted):
            taken, held, drawn = (
                np.bincount(member, weights=np.where(which, w, 0.0), minlength=len(want))
                for which, w in ((over, cells), (free, cells), (free, chances * cells))
            )
            remaining.append(np.where(held > 0, np.maximum(want - taken, drawn), 0.0))
        wanted = [r * (left / r.sum()) for r in remaining]


def probabilities(
    rows: DataFrame, marginals: list[str], targets: Mapping[str, Mapping] | None = None, rate: float | None = None
) -> DataFrame:
    """(marginals..., cell_tokens, probability) from rows with the marginals and ``__tokens``."""
    spark = rows.sparkSession
    table = rows.groupBy(*marginals).agg(F.sum("__tokens").alias("cell_tokens")).limit(MOST_CELLS + 1).collect()
    if len(table) > MOST_CELLS:
        raise ValueError(f"a recipe of more than {MOST_CELLS} cells: give coarser marginals")
    schema = rows.select(*marginals, F.lit(0).cast("bigint").alias("cell_tokens"), F.lit(0.0).alias("probability")).schema
    table = sorted(table, key=repr)
    weights = np.array([r["cell_tokens"] or 0 for r in table], dtype=np.float64)
    if not weights.sum():
        return spark.createDataFrame([(*r, 0.0) for r in table], schema)
    members, shares = [], []
    for name in marginals:
        values = sorted({r[name] for r in table}, key=repr)
        at = {v: i for i, v in enumerate(values)}
        member = np.array([at[r[name]] for r in table])
        masses = dict(zip(values, np.bincount(member, weights=weights, minlength=len(values))))
        wanted = dict((targets or {}).get(name) or flattened(masses, POWERS.get(name, 1.0)))
        share = np.array([wanted.get(v, 0.0) if masses[v] > 0 else 0.0 for v in values])
        members.append(member)
        shares.append(share / share.sum())
    chances, moved = fill(weights, members, shares, rate)
    if moved:
        warnings.warn(f"raking hasn't settled: targets moved by {moved:g} towards the rows' own shares", RuntimeWarning, stacklevel=2)
    return spark.createDataFrame([(*r, float(c)) for r, c in zip(table, chances)], schema)


def draw(key: Column) -> Column:
    """A number in [0, 1) that depends on the key alone."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(_DRAW_RANGE)


def with_probability(
    df: DataFrame, marginals: list[str], key: str = "doc_id", text: str = "text",
    targets: Mapping[str, Mapping] | None = None, rate: float | None = None,
) -> DataFrame:
    """``df`` with __tokens, __topic, __probability and __drawn; ``topic`` is derived unless it is a column."""
    topic = F.col("topic") if "topic" in df.columns else topic_of(F.col(text))
    rows = df.withColumns({"__tokens": tokens_of(F.col(text)), "__topic": topic})
    names = ["__topic" if m == "topic" else m for m in marginals]
    recipe = probabilities(rows.select(*[F.col(n).alias(m) for n, m in zip(names, marginals)], "__tokens"), marginals, targets, rate)
    small = recipe.select(*[F.col(m).alias(f"__m{i}") for i, m in enumerate(marginals)], F.col("probability").alias("__probability"))
    same = F.lit(True)
    for i, name in enumerate(names):
        same = same & rows[name].eqNullSafe(small[f"__m{i}"])
    # the recipe has MOST_CELLS rows at most
    joined = rows.join(F.broadcast(small), same, "left").drop(*[f"__m{i}" for i in range(len(marginals))])
    return joined.withColumn("__drawn", draw(F.col(key)) < F.col("__probability"))


def keep(df: DataFrame, targets: Mapping[str, Mapping] | None = None, rate: float | None = None) -> DataFrame:
    """The drawn rows, columns unchanged, whatever their names."""
    aside = {c: free_name(c.strip("_"), df.columns) for c in df.columns if c.startswith("__")}
    drawn = with_probability(df.withColumnsRenamed(aside), ["source", "lang", "topic"], targets=targets, rate=rate).where("__drawn")
    return drawn.select(*[F.col(aside.get(c, c)).alias(c) for c in df.columns])


def query(spark, sf_dir: str) -> DataFrame:
    rows = with_probability(read_table(spark, sf_dir, "documents"), ["source", "lang", "topic"])
    return rows.select(
        "doc_id", "source", "lang", F.col("__topic").alias("topic"), F.col("__tokens").alias("tokens"),
        F.round("__probability", 6).alias("probability"), F.col("__drawn").alias("sampled"),
    )
