"""Exact duplicates by a tree-merge of sorted digest runs.

Rows are dealt into runs. A run holds each digest once, with its count and the identifier that
stays; runs are merged ``fan_in`` at a time in rounds until one is left. A digest that a third
of all rows share has at most one row per run, so no task ever gets the rows of a group, neither
on the way up nor on the way back, where the verdict goes to runs first and to rows second.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from barlake.llm.common import ascii_lower, keep_rows, stored, text_hash

RUNS, FAN_IN = 4096, 16


def digest_rows(docs: DataFrame) -> DataFrame:
    """One row per document: its number, SHA-256 of the normalised text and two checks of it."""
    text = ascii_lower(F.coalesce("text", F.lit("")))
    rows = docs.select("doc_id", text_hash(), text.alias("text"), F.monotonically_increasing_id().alias("row"))
    return rows.select(
        "doc_id",
        "text_hash",
        "row",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        F.octet_length("text").alias("size"),
        F.xxhash64("text").alias("check"),
        F.pmod(F.xxhash64("row"), F.lit(RUNS)).cast("int").alias("run"),
    )


def _merge(runs: DataFrame, first: bool = False) -> DataFrame:
    """Merge equal digests of a run. Fails if a digest stands for different texts."""
    merged = runs.groupBy("run", "digest").agg(
        F.max("keep").alias("keep"),
        F.sum("copies").alias("copies"),
        F.min("size").alias("size"),
        F.max("size").alias("size_high"),
        F.min("check").alias("check"),
        F.max("check").alias("check_high"),
    )
    same = (F.col("size") == F.col("size_high")) & (F.col("check") == F.col("check_high"))
    broken = F.raise_error(F.lit("different texts share a SHA-256 digest")).cast("bigint")
    return merged.select(
        "run", "digest", "keep", F.when(same, F.col("copies")).otherwise(broken).alias("copies"),
        "size", "check",
    )


def exact_groups(spark: SparkSession, docs: DataFrame, *, keep: str = "largest") -> DataFrame:
    """One row per document: ``doc_id, text_hash, row, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. The row with the
    largest (or smallest) doc_id stays. A null doc_id ranks below every number; of rows with the
    same doc_id the one read last stays, so each group keeps exactly one row. An empty table
    gives no rows; other columns are not read.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError(f"unknown choice: {keep}")
    # An identifier is ranked, so that the same maximum serves both choices.
    sign = 1 if keep == "largest" else -1
    rows = stored(spark, digest_rows(docs), "digests")
    runs = rows.select(
        "run", "digest", "size", "check",
        F.struct((F.col("doc_id") * sign).alias("id"), "row").alias("keep"),
        F.lit(1).cast("bigint").alias("copies"),
    )
    leaves = stored(spark, _merge(runs), "runs")
    top, left = leaves, RUNS
    while left > 1:
        left //= FAN_IN
        top = _merge(top.withColumn("run", F.floor(F.col("run") / FAN_IN).cast("int")))
    verdict = top.select("digest", "keep", F.col("copies").alias("group_size"))
    by_run = leaves.select("run", "digest").join(verdict, "digest")
    return rows.join(by_run, ["run", "digest"]).select(
        "doc_id",
        "text_hash",
        "row",
        (F.col("keep.id") * sign).alias("keep_id"),
        "group_size",
        (F.col("keep.row") == F.col("row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(spark: SparkSession, docs: DataFrame, *, keep: str = "largest") -> DataFrame:
    """The documents, with all their columns, less the copies of those that stay."""
    return keep_rows(docs, exact_groups(spark, docs, keep=keep).where("kept"))
