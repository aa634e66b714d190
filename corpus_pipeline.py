"""From raw documents to training shards: five stages, each on all that the one before kept.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the columns of
``documents``. Between stages the rows are written as Parquet to the shared folder and read again, so a
lost executor repeats a stage's tasks and never an earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from passbook.llm import decontaminate, mixing, quality, sequences, simhash
from passbook.workspace import stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal regression expects to be sound; the others go.

    It is fitted on the labelled ones among ``docs``. Without labels all stay.
    """
    ratings = quality.grades_of(_table(spark, sf_dir, "labels"))
    return quality.good(docs, quality.train(docs, ratings))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: three-word shingles, three bits."""
    return simhash.keep_one(docs, size=simhash.WORDS, radius=simhash.RADIUS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the order of the mix, as often as the mix takes them."""
    return mixing.mix(docs)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of token sequences in training order."""
    return sequences.shards(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", mixing_sources),
    ("token-ID / binary output", token_shards),
]

#: Fitted weights and the tokenizer cannot be said in SQL; the tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    rows = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        rows = stored(stage(spark, rows, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, rows, sf_dir)


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
