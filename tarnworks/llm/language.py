"""Language identification by Bayesian fusion of evidence.

For every language l the posterior is proportional to

    P(text | l)^w * P(declared markup language | l) * P(address suffix | l) * P(l | host)

* Text: naive Bayes over hashed character trigrams of words. Trigrams of one text aren't independent, so the mean
  log-likelihood counts as ``TEXT_WEIGHT`` trigrams at most. The model learns from a bounded sample of rows, ``SAMPLE_ROWS``
  for each declared language (those with the smallest hashes), with add-half smoothing. A language is learnt if at
  least ``LEAST_SHARE`` of the declared rows declare it, so that there are a thousand at most; its tag is two or three letters, and
  a region after them is left out (``en-GB`` is ``en``). Any other declaration is no evidence.
* Declared language and address suffix: right with a given trust; the rest is spread evenly.
* Host: expected languages of all its texts, smoothed towards its domain's, that towards its suffix's, that towards
  the whole table's. All four levels are grouped sums over the whole table.

A row is rejected if it has no letters or if no language reaches ``CONFIDENCE``. Its language is then ``und``.

Defined cases: NULL, empty and blank texts are rejected; a NULL declaration, address or host is no evidence (its row
takes the table's prior); repeated rows are judged alike; a table without any declared language rejects every row;
an empty table gives an empty result. Working columns start with two underscores; rows keep their own.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnworks.llm.columns import free_name
from tarnworks.llm.scratch import Scratch, read_table
from tarnworks.llm.subwords import hashed_ngrams

BUCKETS = 1 << 14
SAMPLE_ROWS = 500
TEXT_WEIGHT = 60
DECLARED_TRUST = 0.8
SUFFIX_TRUST = 0.6
HOST_WEIGHT = 20.0
CONFIDENCE = 0.5
LEAST_SHARE = 1 / 1000
KNOWN_WORDS = 400_000
TEXTS_AT_ONCE = 500
WORDS_AT_ONCE = 10_000  # whose trigrams are held at once
# Country suffixes whose language has another code; a suffix equal to a code needs no entry.
SUFFIX_LANGUAGES = {"at": "de", "uk": "en", "us": "en", "au": "en", "ie": "en", "mx": "es", "ar": "es", "co": "es"}


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of the words' character trigrams."""
    return hashed_ngrams(words, (3,), BUCKETS, whole=False)


def spoken(text: str | None) -> list[str]:
    """Words that hold a letter, without the marks around them."""
    stripped = (w.strip(".,;:!?()[]{}\"'|#*%&$") for w in (text or "").lower().split())
    return [w for w in stripped if w.isalpha() or any(map(str.isalpha, w))]


def _languages(rows: DataFrame) -> DataFrame:
    """(language, bucket, n): trigram counts of the sample, combined in each task."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for language, body in zip(batch["language"], batch["body"]):
                row = counts.setdefault(language, np.zeros(BUCKETS, dtype=np.int64))
                times = Counter(spoken(body))
                owner, bucket = trigrams(list(times))
                np.add.at(row, bucket, np.fromiter(times.values(), np.int64, len(times))[owner])
        for language, row in counts.items():
            used = np.flatnonzero(row)
            yield pd.DataFrame({"language": language, "bucket": used, "n": row[used]})

    declared = rows.where("language is not null")
    sizes = {r["language"]: r["count"] for r in declared.groupBy("language").count().collect()}  # tags of two or three letters
    sizes = {language: n for language, n in sizes.items() if n >= LEAST_SHARE * sum(sizes.values())}
    if not sizes:
        return rows.sparkSession.createDataFrame([], "language string, bucket int, n bigint")
    # first thin each language to about four samples by its size, so that few rows meet in the ranking
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, 4 * SAMPLE_ROWS / n))]), F.col("language"))
    thin = F.shiftrightunsigned("order", 11).cast("double") / F.lit(float(1 << 53)) < share
    first = Window.partitionBy("language").orderBy("order", "body")
    sample = (
        declared.where(thin).withColumn("__rank", F.row_number().over(first)).where(F.col("__rank") <= SAMPLE_ROWS)
        .select("language", "body")
    )
    counted = sample.mapInPandas(count, "language string, bucket int, n bigint")
    return counted.groupBy("language", "bucket").agg(F.sum("n").alias("n"))


def fit(rows: DataFrame) -> tuple[list[str], np.ndarray]:
    """rows: (language, body, order), order a hash that picks the sample. Languages in order and their log-probabilities of each bucket."""
    counts = _languages(rows).toPandas()  # languages times BUCKETS numbers at most
    languages = sorted(set(counts["language"]))
    table = np.full((len(languages), BUCKETS), 0.5)
    at = {language: i for i, language in enumerate(languages)}
    table[counts["language"].map(at).to_numpy(dtype=np.int64), counts["bucket"].to_numpy(dtype=np.int64)] += counts["n"]
    return languages, np.log(table / table.sum(axis=1, keepdims=True))


def log_likelihoods(logs: np.ndarray):
    """A column function: text to its tempered log-likelihood in each language; NULL without letters."""
    sent, shape = logs.T.astype(np.float32).tobytes(), logs.T.shape

    @F.pandas_udf("array<double>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = np.frombuffer(sent, dtype=np.float32).reshape(shape)
        known: dict[str, tuple[int, int]] = {}
        sums = np.empty((0, shape[1]))
        for texts in batches:
            out = []
            for start in range(0, len(texts), TEXTS_AT_ONCE):  # words of so many texts are held at once
                group = [spoken(text) for text in texts.iloc[start : start + TEXTS_AT_ONCE]]
                if len(known) > KNOWN_WORDS:
                    known, sums = {}, np.empty((0, shape[1]))
                new = list(set().union(*group).difference(known))
                added = [sums]
                for begin in range(0, len(new), WORDS_AT_ONCE):
                    part, place = new[begin : begin + WORDS_AT_ONCE], len(sums) + begin
                    owner, bucket = trigrams(part)
                    added.append(np.stack([np.bincount(owner, weights=table[bucket, k], minlength=len(part)) for k in range(shape[1])], axis=1))
                    known.update(zip(part, zip(range(place, place + len(part)), np.bincount(owner, minlength=len(part)).tolist())))
                sums = np.concatenate(added)
                for words in group:
                    if not words:
                        out.append(None)
                        continue
                    places, counts = zip(*map(known.__getitem__, words))
                    n = sum(counts)
                    out.append(sums[list(places)].sum(axis=0) / n * min(n, TEXT_WEIGHT))
            yield pd.Series(out, dtype=object)

    return score


def host_of(address: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(address, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:@]+)", 1)), F.lit(""))


def tag_of(declared: Column) -> Column:
    """The language of a declaration, without its region; NULL if it isn't a tag of two or three letters."""
    return F.nullif(F.regexp_extract(F.lower(F.trim(declared)), r"^([a-z]{2,3})([-_].*)?$", 1), F.lit(""))


def markup_language(html: Column) -> Column:
    """What the ``lang`` attribute of the html element declares."""
    return F.nullif(F.regexp_extract(html, r"""(?i)<html\b[^>]*?\slang\s*=\s*["']?([A-Za-z0-9_-]+)""", 1), F.lit(""))


def visible(html: Column) -> Column:
    """The text between tags, without scripts, styles, comments and character references."""
    hidden = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.regexp_replace(F.regexp_replace(hidden, r"<[^>]*>", " "), r"&#?\w{1,32};", " ")


def _evidence(claim: Column, languages: list[str], trust: float) -> Column:
    """Log-likelihood of a claimed language under each language; no evidence if it is none of them."""
    wrong = np.log((1 - trust) / max(1, len(languages) - 1)) if len(languages) > 1 else 0.0
    values = [F.when(claim == language, F.lit(float(np.log(trust)))).otherwise(F.lit(float(wrong))) for language in languages]
    return F.when(claim.isin(languages), F.array(*values)).otherwise(F.array(*[F.lit(0.0)] * len(languages)))


def _normal(logs: Column) -> Column:
    """Posterior from unnormalised logarithms."""
    raised = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda a, b: a + b))


def _plus(*arrays: Column) -> Column:
    total = arrays[0]
    for other in arrays[1:]:
        total = F.zip_with(total, other, lambda a, b: a + b)
    return total


def _summed(rows: DataFrame, by: str | None, name: str, k: int) -> DataFrame:
    sums = [F.coalesce(F.sum(F.col("__post")[i]), F.lit(0.0)) for i in range(k)]
    grouped = rows.groupBy(by) if by else rows.groupBy()
    return grouped.agg(F.array(*sums).alias(name))


def _smoothed(counts: Column, parent: Column) -> Column:
    n = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)
    return F.zip_with(counts, parent, lambda c, p: (c + HOST_WEIGHT * p) / (n + HOST_WEIGHT))


def identify(
    df: DataFrame, scratch: Scratch, keys: list[Column], text: str = "text", declared: str | None = None,
    address: str | None = None, host: str | None = None,
) -> DataFrame:
    """The key columns with language, confidence and kept, one row for each row of ``df``.

    ``declared``, ``address`` and ``host`` name columns; a host is taken from the address if not given.
    """
    claim = tag_of(F.col(declared)) if declared else F.lit(None).cast("string")
    place = F.lower(F.col(host)) if host else (host_of(F.col(address)) if address else F.lit(None).cast("string"))
    languages, logs = fit(df.select(claim.alias("language"), F.col(text).alias("body"), row_digest(df).alias("order")))
    k = len(languages)
    if not k:
        return df.select(*keys, F.lit("und").alias("language"), F.lit(0.0).alias("confidence"), F.lit(False).alias("kept"))
    suffix = F.when(F.instr("__host", ".") > 0, F.substring_index("__host", ".", -1))
    named = F.coalesce(*[F.when(suffix == a, F.lit(b)) for a, b in SUFFIX_LANGUAGES.items()], suffix)
    rows = scratch.stage(
        df.select(*keys, claim.alias("__claim"), place.alias("__host"), log_likelihoods(logs)(F.col(text)).alias("__text"))
        .withColumns({"__suffix": suffix, "__domain": F.when(F.instr("__host", ".") > 0, F.substring_index("__host", ".", -2))})
        .withColumn("__own", _plus(F.col("__text"), _evidence(F.col("__claim"), languages, DECLARED_TRUST), _evidence(named, languages, SUFFIX_TRUST)))
        .withColumn("__post", _normal(F.col("__own"))),
        "evidence",
    )
    # four levels of grouped sums; every level is smoothed towards the one above
    by_host = rows.groupBy("__host", "__domain", "__suffix").agg(
        *[F.coalesce(F.sum(F.col("__post")[i]), F.lit(0.0)).alias(f"s{i}") for i in range(k)]
    ).withColumn("__post", F.array(*[f"s{i}" for i in range(k)])).select("__host", "__domain", "__suffix", "__post")
    by_host = scratch.stage(by_host, "hosts")
    whole = by_host.agg(*[F.sum(F.col("__post")[i]) for i in range(k)]).first()
    shares = np.array([float(x or 0) for x in whole]) + 1.0
    prior = F.array(*[F.lit(float(x)) for x in shares / shares.sum()])
    by_suffix = _summed(by_host, "__suffix", "__ns", k).withColumn("__ps", _smoothed(F.col("__ns"), prior)).select("__suffix", "__ps")
    by_domain = (
        _summed(by_host.where("__domain is not null"), "__domain", "__nd", k)
        .withColumn("__suffix", F.substring_index("__domain", ".", -1)).join(by_suffix, "__suffix", "left")
        .withColumn("__pd", _smoothed(F.col("__nd"), F.coalesce("__ps", prior))).select("__domain", "__pd")
    )
    hosts = scratch.stage(
        by_host.where("__host is not null").join(by_domain, "__domain", "left")
        .select("__host", _smoothed(F.col("__post"), F.coalesce("__pd", prior)).alias("__ph")),
        "host-priors",
    )
    logged = F.transform(F.coalesce("__ph", prior), lambda p: F.log(F.greatest(p, F.lit(1e-9))))
    judged = rows.join(hosts, "__host", "left").withColumn("__all", _normal(_plus(F.col("__own"), logged)))
    best = F.array_max("__all")
    sure = F.coalesce(best >= CONFIDENCE, F.lit(False))
    named_best = F.element_at(F.array(*[F.lit(x) for x in languages]), F.array_position("__all", best).cast("int"))
    own = df.select(*keys).columns
    dropped = [c for c in judged.columns if c.startswith("__") and c not in own]
    return judged.withColumns({
        "language": F.when(sure, named_best).otherwise(F.lit("und")),
        "confidence": F.coalesce(best, F.lit(0.0)), "kept": sure,
    }).drop(*dropped)


def row_digest(df: DataFrame) -> Column:
    """Equal for rows that agree in every column, whose verdict is then the same."""
    return F.xxhash64(*[F.col(c) for c in sorted(df.columns)])


def keep(df: DataFrame, text: str = "text", declared: str | None = "lang", address: str | None = None, host: str | None = "source") -> DataFrame:
    """The rows with an identified language, columns unchanged."""
    scratch = Scratch(df.sparkSession, "language")
    row = free_name("row", df.columns)
    verdicts = identify(df, scratch, [row_digest(df).alias(row)], text, declared, address, host)
    rejected = scratch.stage(verdicts.where("not kept").select(row).distinct(), "rejected")
    return df.withColumn(row, row_digest(df)).join(rejected, row, "left_anti").select(*df.columns)


def documents_and_pages(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """(table_name, doc_id, page_id, text, declared, host): documents with their ``lang`` and ``source``, pages with
    their visible text, the language that their markup declares and the host of their address. The other id is NULL."""
    return docs.select(
        F.lit("documents").alias("table_name"), "doc_id", F.lit(None).cast(pages.schema["page_id"].dataType).alias("page_id"),
        "text", F.col("lang").alias("declared"), F.col("source").alias("host"),
    ).unionByName(pages.select(
        F.lit("pages").alias("table_name"), F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"), "page_id",
        visible(F.col("html")).alias("text"), markup_language(F.col("html")).alias("declared"), host_of(F.col("url")).alias("host"),
    ))


def query(spark, sf_dir: str) -> DataFrame:
    """All documents and all pages, judged by one model with all levels of evidence."""
    rows = documents_and_pages(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "pages"))
    keys = [F.col(c) for c in ("table_name", "doc_id", "page_id")]
    return identify(rows, Scratch(spark, "language"), keys, declared="declared", host="host")
