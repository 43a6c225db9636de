"""Which sources of a language write alike, and which words set a source apart: dominance skybands.

A term's share in a group (or in its whole language) is ``1 + floor(10^9 (count + 5) / (N + 5 V))`` over the V terms that
at least ``LEAST_DOCUMENTS`` documents of the language use; N is the group's count of them. All numbers are integers.

*Terms of a group.* The value, share in the group less share in the language, can only grow with the group's count and
fall with the language's. So a term with k others of no lower group count, no higher language count and earlier UTF-8 has
k terms before it in every ranking. Partitions of a group keep the terms dominated by fewer than k others (the
k-skyband), bands are merged, and only the merged band is ranked by the exact value. Whoever k terms dominate, k terms of
the band dominate too, so a task holds two counts of each member and nothing of the others.

*Pairs of sources.* Values are sums over all kept terms of absolute differences. Tasks hold tiles of sources by chunks of
terms and emit partial sums, so a task is bounded whatever the number of sources or terms.

Defined cases: NULL text, language and source count as ''; a text without terms still makes its group occur; repeated rows
are documents of their own; a language without kept terms has pairs of value 0 and no term rows; ties go to the earlier
UTF-8; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnworks.llm.scratch import Scratch, read_table

LEAST_DOCUMENTS = 30
TOP_TERMS = 50
SMOOTHING = 5
SCALE_STEPS = 3  # shares are in units of 1000 ** -3
PART_TERMS = 1024  # terms of a group in one partition of the first skybands
MERGED_TERMS = 8192  # members of bands that one task merges
MERGE_WHILE = 0.75  # a merge that leaves more than this share of the members is the last
TILE_SOURCES = 256
TILE_TERMS = 4096
_TERMS_AT_ONCE = 1 << 21
_BYTES_AT_ONCE = 1 << 20
_ROWS_AT_ONCE = 1 << 16
_POINTS_AT_ONCE = 512

_TERM = re.compile(rb"[A-Za-z\x80-\xff]+")  # letters and everything beyond ASCII, byte by byte
_GAP = re.compile(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]")
_COUNTS = pa.schema([
    ("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64()),
])


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in pieces of about a megabyte, none of which cuts a term."""
    start = 0
    while start < len(text):
        gap = _GAP.search(text, start + _BYTES_AT_ONCE)
        end = gap.start() if gap else len(text)
        yield text[start:end]
        start = end


def _terms_of(text: bytes) -> tuple[pa.Array, np.ndarray]:
    """A text's terms with how often each entry counts; long texts come with the terms of each piece counted."""
    if len(text) <= _BYTES_AT_ONCE:
        terms = _TERM.findall(text.lower())
        return pa.array(terms, pa.binary()), np.ones(len(terms), dtype=np.int64)
    counts = [Counter(_TERM.findall(piece.lower())) for piece in _pieces(text)]
    return pa.array([t for c in counts for t in c], pa.binary()), np.fromiter((n for c in counts for n in c.values()), dtype=np.int64)


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's texts by (lang, source, term); a NULL term says that the group occurs."""
    held, names, size = [], {}, 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
            terms, times = _terms_of(text)
            held.append((names.setdefault((lang, source), len(names)), terms, times))
            size += len(terms)
            if size > _TERMS_AT_ONCE:
                yield from _counted(held, list(names))
                held, names, size = [], {}, 0
    yield from _counted(held, list(names))


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that sorts the keys, and where each run of equal ones starts in it."""
    order = np.argsort(keys)
    put = keys[order]
    return order, np.flatnonzero(np.concatenate([[True], put[1:] != put[:-1]]))


def _counted(held: list[tuple[int, pa.Array, np.ndarray]], names: list[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
    if not names:
        return
    nothing = [0] * len(names)
    yield pa.RecordBatch.from_arrays([
        pa.array([n[0] for n in names], pa.string()), pa.array([n[1] for n in names], pa.string()),
        pa.nulls(len(names), pa.binary()), pa.array(nothing, pa.int64()), pa.array(nothing, pa.int64()),
    ], schema=_COUNTS)
    coded = pa.chunked_array([terms for _, terms, _ in held], pa.binary()).combine_chunks().dictionary_encode()
    known = max(len(coded.dictionary), 1)
    lengths = [len(terms) for _, terms, _ in held]
    if not sum(lengths):
        return
    times = np.concatenate([t for _, _, t in held])
    keys = np.repeat(np.arange(len(held)), lengths) * known + coded.indices.to_numpy()
    order, starts = _runs(keys)  # a text and a term
    n = np.add.reduceat(times[order], starts)
    text, term = np.divmod(keys[order[starts]], known)
    keys = np.array([group for group, _, _ in held])[text] * known + term
    order, starts = _runs(keys)  # a group and a term
    n, docs = np.add.reduceat(n[order], starts), np.diff(starts, append=len(keys))
    group, term = np.divmod(keys[order[starts]], known)
    langs, sources = (pa.array([name[i] for name in names], pa.string()) for i in (0, 1))
    for at in range(0, len(n), _ROWS_AT_ONCE):
        part = slice(at, at + _ROWS_AT_ONCE)
        own = pa.array(group[part])
        yield pa.RecordBatch.from_arrays(
            [langs.take(own), sources.take(own), coded.dictionary.take(pa.array(term[part])), pa.array(n[part]), pa.array(docs[part])],
            schema=_COUNTS,
        )


def term_counts(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents; one row of each group has a NULL term."""
    rows = df.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"),
    )
    counted = rows.mapInArrow(_count_terms, "lang string, source string, term binary, n bigint, docs bigint")
    typed = counted.withColumn("term", F.col("term").cast("string"))
    # tasks have combined their rows already; dealt first, they aren't hashed once more before the shuffle
    return typed.repartition("lang", "source", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, size: Column) -> Column:
    """``1 + floor(10^9 (n + 5) / size)`` by long division in base 1000, which stays in 64 bits up to 9e15 tokens."""
    rest = n + SMOOTHING
    value, rest = _divided(rest, size)
    for _ in range(SCALE_STEPS):
        digit, rest = _divided(rest * 1000, size)
        value = value * 1000 + digit
    return value + 1


def _divided(number: Column, by: Column) -> tuple[Column, Column]:
    return F.call_function("div", number, by), number % by


def _share(n: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The same for arrays; 0 where there are no kept terms."""
    size = np.broadcast_to(size, n.shape)
    some = np.where(size > 0, size, 1)
    value, rest = np.divmod(n + SMOOTHING, some)
    for _ in range(SCALE_STEPS):
        digit, rest = np.divmod(rest * 1000, some)
        value = value * 1000 + digit
    return np.where(size > 0, value + 1, 0)


# ---- terms of a group ---------------------------------------------------------------


class _Band:
    """The k-skyband of points that come in UTF-8 order: those with fewer than k earlier points at least as good."""

    def __init__(self, k: int):
        self.k = k
        self.n = np.empty(0, dtype=np.int64)
        self.lang_n = np.empty(0, dtype=np.int64)

    def add(self, n: np.ndarray, lang_n: np.ndarray) -> np.ndarray:
        """Which of the next points belong to the band."""
        member = np.zeros(len(n), dtype=bool)
        for at in range(0, len(n), _POINTS_AT_ONCE):
            a, b = n[at : at + _POINTS_AT_ONCE], lang_n[at : at + _POINTS_AT_ONCE]
            before = np.tri(len(a), k=-1, dtype=bool)
            by = np.count_nonzero(before & (a[None, :] >= a[:, None]) & (b[None, :] <= b[:, None]), axis=1)
            for start in range(0, len(self.n), 1 << 14):
                old = slice(start, start + (1 << 14))
                by += np.count_nonzero((self.n[old] >= a[:, None]) & (self.lang_n[old] <= b[:, None]), axis=1)
            kept = by < self.k
            member[at : at + _POINTS_AT_ONCE] = kept
            self.n, self.lang_n = np.concatenate([self.n, a[kept]]), np.concatenate([self.lang_n, b[kept]])
        return member


def skyband(rows: DataFrame, groups: list[str], k: int, order: str = "term") -> DataFrame:
    """Rows (groups, order, n, lang_n, others) that fewer than k rows of their group dominate."""

    def band(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held = None, None
        for batch in batches:
            for key, part in batch.groupby(groups, sort=False, dropna=False):
                if key != at:
                    at, held = key, _Band(k)
                yield part[held.add(part["n"].to_numpy(), part["lang_n"].to_numpy())]

    dealt = rows.repartition(*groups).sortWithinPartitions(*groups, order)
    return dealt.mapInPandas(band, rows.schema)


def merged_skybands(rows: DataFrame, groups: list[str], k: int, scratch: Scratch, part_terms: int = PART_TERMS,
                    merged_terms: int = MERGED_TERMS) -> DataFrame:
    """Skybands of partitions, merged until a group has one, or until merging hardly takes anything away any more: what
    is left holds the k best of a group either way, and no task ever takes more than about ``merged_terms`` rows."""
    band, before, level = rows, None, 0
    while True:
        sizes = band.groupBy(*groups).agg(F.ceil(F.count("*") / (merged_terms if level else part_terms)).alias("parts"))
        dealt = band.join(sizes, groups).withColumn("part", F.pmod(F.xxhash64("term"), "parts"))
        last, band = band, scratch.stage(skyband(dealt.drop("parts"), [*groups, "part"], k).drop("part"), f"band-{level}")
        left = band.count()
        if level and (before * MERGE_WHILE <= left or last.groupBy(*groups).count().where(F.col("count") > merged_terms).isEmpty()):
            return band
        before, level = left, level + 1


# ---- pairs of sources ---------------------------------------------------------------


def _tile_sums(rows: pd.DataFrame) -> pd.DataFrame:
    """Partial sums of one tile: sources of blocks i and j by a chunk of terms. Rows without a term are its sources."""
    lang, i, j, chunk = rows["lang"].iloc[0], rows["i"].iloc[0], rows["j"].iloc[0], rows["chunk"].iloc[0]
    own = rows[rows["term"].isna()].sort_values("source")
    names, size, block, kept = (own[c].to_numpy() for c in ("source", "size", "block", "kept"))
    base = _share(np.zeros(len(own), dtype=np.int64), size)
    used = rows[rows["term"].notna()]
    at = pd.Index(names).get_indexer(used["source"])
    term, terms = pd.factorize(used["term"])
    shares = np.repeat(base[:, None], len(terms), axis=1)
    shares[at, term] = _share(used["n"].to_numpy(), size[at])
    left, right, value = [], [], []
    for a in np.flatnonzero(block == i):
        others = np.flatnonzero(block == j)
        if i == j:
            others = others[others > a]
        apart = np.abs(base[others] - base[a])
        found = np.abs(shares[others] - shares[a]).sum(axis=1) - apart * len(terms)
        if chunk == 0:
            found = found + apart * kept[a]
        left.append(np.full(len(others), a))
        right.append(others)
        value.append(found)
    a, b = (np.concatenate([np.empty(0, dtype=np.int64), *x]) for x in (left, right))
    return pd.DataFrame({"lang": lang, "a": names[a], "b": names[b], "value": np.concatenate([np.empty(0, dtype=np.int64), *value])})


def source_distances(kept: DataFrame, groups: DataFrame, tile_sources: int = TILE_SOURCES, tile_terms: int = TILE_TERMS) -> DataFrame:
    """(lang, source, item, value) for every two sources of a language, either way round."""
    blocks = groups.groupBy("lang").agg(F.ceil(F.count("*") / tile_sources).alias("blocks"))
    placed = groups.join(blocks, "lang").select(
        "*", F.pmod(F.xxhash64("source"), "blocks").alias("block"),
        F.greatest(F.ceil(F.col("kept") / tile_terms), F.lit(1)).alias("chunks"),
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    i, j = F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    columns = ["lang", "i", "j", "chunk", "source", "block", "size", "kept", "term", "n"]
    own = placed.select("*", other).select(
        "*", i, j, F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
        F.lit(None).cast("string").alias("term"), F.lit(0).cast("bigint").alias("n"),
    ).select(*columns)
    used = kept.select("lang", "source", "term", "n").join(placed, ["lang", "source"]).select("*", other).select(
        "*", i, j, F.pmod(F.xxhash64("term"), "chunks").alias("chunk"),
    ).select(*columns)
    half = own.unionByName(used).groupBy("lang", "i", "j", "chunk").applyInPandas(
        _tile_sums, "lang string, a string, b string, value bigint"
    ).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    return half.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        half.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value")
    )


# ---- the audit ----------------------------------------------------------------------


def audit(df: DataFrame, least_documents: int = LEAST_DOCUMENTS, top_terms: int = TOP_TERMS,
          part_terms: int = PART_TERMS, tile_sources: int = TILE_SOURCES, tile_terms: int = TILE_TERMS,
          merged_terms: int = MERGED_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): all pairs of sources and the terms that set each group most apart."""
    scratch = Scratch(df.sparkSession, "divergence")
    counts = scratch.stage(term_counts(df), "counts")
    terms = scratch.stage(
        counts.where("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= least_documents).drop("docs"), "terms",
    )
    kept = scratch.stage(counts.where("term is not null").drop("docs").join(terms, ["lang", "term"]), "kept")
    langs = terms.groupBy("lang").agg(
        F.count("*").alias("kept"), (F.sum("lang_n") + F.count("*") * SMOOTHING).alias("lang_size"),
    )
    groups = scratch.stage(
        counts.where("term is null").select("lang", "source")
        .join(kept.groupBy("lang", "source").agg(F.sum("n").alias("tokens")), ["lang", "source"], "left")
        .join(langs, "lang", "left").select(
            "lang", "source", F.coalesce("kept", F.lit(0)).alias("kept"),
            F.coalesce(F.coalesce("tokens", F.lit(0)) + F.col("kept") * SMOOTHING, F.lit(0)).alias("size"),
            F.coalesce("lang_size", F.lit(0)).alias("lang_size"),
        ), "groups",
    )
    value = share(F.col("n"), F.col("size")) - share(F.col("lang_n"), F.col("lang_size"))
    apart = kept.join(groups, ["lang", "source"]).select("lang", "source", "term", "n", "lang_n", value.alias("value"))
    # what a term above its language's share is dominated by is above it too, so the others go first
    band = merged_skybands(scratch.stage(apart.where("n > 0 and value > 0"), "apart"), ["lang", "source"], top_terms, scratch, part_terms, merged_terms)
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    of_terms = band.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value").withColumn(
        "rank", F.row_number().over(ranked)
    ).where(F.col("rank") <= top_terms)
    of_pairs = source_distances(kept, groups, tile_sources, tile_terms).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value"
    ).withColumn("rank", F.row_number().over(ranked))
    return of_pairs.unionByName(of_terms)


def query(spark, sf_dir: str) -> DataFrame:
    return audit(read_table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH docs AS (
    SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS found
    FROM documents),
tokens AS (
    SELECT d, lang, source, translate(unnest(found), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM docs),
terms AS (
    SELECT lang, term, count(*) AS c FROM tokens GROUP BY lang, term HAVING count(DISTINCT d) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(c) AS n FROM terms GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS c FROM tokens GROUP BY lang, source, term),
spread AS (
    SELECT g.lang, g.source, t.term, t.c AS lang_c, coalesce(c.c, 0) AS c
    FROM (SELECT DISTINCT lang, source FROM docs) g JOIN terms t ON g.lang = t.lang
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = t.term),
sized AS (SELECT *, sum(c) OVER (PARTITION BY lang, source) AS own FROM spread),
shares AS (
    SELECT s.lang, s.source, s.term, s.c,
           1 + (1000000000::HUGEINT * (s.c + 5)) // (s.own + 5 * l.v)::HUGEINT AS p,
           1 + (1000000000::HUGEINT * (s.lang_c + 5)) // (l.n + 5 * l.v)::HUGEINT AS q
    FROM sized s JOIN langs l ON s.lang = l.lang),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
    FROM (SELECT DISTINCT lang, source FROM docs) a JOIN (SELECT DISTINCT lang, source FROM docs) b
      ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
    GROUP BY a.lang, a.source, b.source),
both_parts AS (
    SELECT lang, source, 'pair' AS part, item, value FROM pairs
    UNION ALL
    SELECT lang, source, 'term', term, p - q FROM shares WHERE c > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INT) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM both_parts)
WHERE part = 'pair' OR r <= 50
"""
