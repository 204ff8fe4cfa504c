"""Helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from barlake.session import scratch_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Every byte that is no part of a word becomes a space; A-Z become a-z.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: cuts lineage, survives lost executors."""
    path = scratch_dir(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; ``lower`` does so fast where all characters are ASCII."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def map_rows(
    rows: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` of a function from one batch to batches."""

    def over_all(batches):
        for batch in batches:
            yield from function(batch)

    return rows.mapInArrow(over_all, schema)


def words_of(data: bytes | None) -> list[bytes]:
    """Lower-cased words of UTF-8 text: runs of a-z, 0-9 and non-ASCII characters."""
    return data.translate(WORD_BYTES).split() if data else []


def slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows whose sizes sum to about ``most``."""
    start = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def text_hash() -> Column:
    """With the doc_id, what tells rows apart."""
    return F.xxhash64("text").alias("text_hash")


def _keyed(docs: DataFrame) -> DataFrame:
    """Each row as one value beside its key, so that no column name can clash."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return docs.select(F.struct("*").alias("document"), name.alias("name"), text_hash())


def _key(keys: DataFrame) -> DataFrame:
    return keys.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("name"), "text_hash").distinct()


def keep_rows(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """One row of ``docs``, with all its columns, for each ``doc_id, text_hash`` of ``keys``."""
    same = Window.partitionBy("name", "text_hash").orderBy("text_hash")
    kept = _keyed(docs).join(_key(keys), ["name", "text_hash"], "left_semi")
    return kept.withColumn("rank", F.row_number().over(same)).where("rank = 1").select("document.*")


def drop_rows(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``docs`` with none of the ``doc_id, text_hash`` of ``keys``."""
    return _keyed(docs).join(_key(keys), ["name", "text_hash"], "left_anti").select("document.*")
