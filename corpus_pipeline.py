"""Corpus preparation in stages: language, quality, near-duplicates, mixing, packing.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet and reads again as the
next stage's documents. All but the last return the columns of documents. No SQL can express the trained models; the tests
follow a whole run stage by stage, with plain versions of those that no model decides.

Stages treat awkward rows as the operators they call do: NULL and empty texts have no identified language and go in the
first stage, repeated rows are near-duplicates of which one stays, extra columns stay until packing, whatever their
names, and no documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarnworks.llm import language, mixing, packing, quality, simhash
from tarnworks.llm.scratch import Scratch, read_table


ROWS_AT_ONCE = 1_000  # whole texts that pass between the JVM and Python together; both hold several such batches


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_AT_ONCE))


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an identified language; the declared one is ``lang``, the host ``source``."""
    _small_batches(spark)
    return language.keep(docs)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    _small_batches(spark)
    return quality.keep(docs, read_table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group whose fingerprints link: three words, three bits at most."""
    _small_batches(spark)
    return simhash.keep(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with the target shares of sources, languages and topics."""
    return mixing.keep(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces, each with its sequence and offset."""
    _small_batches(spark)
    return packing.pack(docs, packing.vocabulary_path())


STAGES = [
    ("language identification", identified),
    ("quality classifier", good),
    ("near-duplicate removal", distinct),
    ("mixing to target weights", mixed),
    ("best-fit packing", packed),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = scratch.stage(stage(spark, docs, sf_dir), f"{number}")
        if number:
            scratch.drop(f"{number - 1}")
    return docs
