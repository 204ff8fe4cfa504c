"""A training corpus from ``documents``: known language, no copies, no benchmark, a target mixture.

Each stage takes all that the stage before has kept, is written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barlake.llm.common import stored, table
from barlake.llm.decontaminate import drop_contaminated
from barlake.llm.exact_dedup import drop_copies
from barlake.llm.language import drop_unknown, fit
from barlake.llm.mixing import mix
from barlake.llm.simhash import drop_near_copies

#: Share of a document's letter trigrams that must be known in the languages its words are labelled with.
LEAST_FAMILIAR = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in languages that were not learned go, mixtures of learned ones stay; null and wordless texts go."""
    return drop_unknown(docs, fit(docs), least_familiar=LEAST_FAMILIAR)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return drop_copies(spark, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked fingerprints the smallest doc_id stays."""
    return drop_near_copies(spark, docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rate at which each document is to be read."""
    return mix(spark, docs, table(spark, sf_dir, "labels"))


STAGES = [
    ("language", known_language),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mixing", mixture),
]
#: Trained models and iteration have no SQL; the tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
