"""Scans of the small contract tables: manifests, decisions, strategy registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from barlake.files import partition_folders
from barlake.journal import read_settled, settle
from barlake.schema import (
    DECISIONS,
    FETCH_MANIFEST,
    REGISTRY_REQUIRED,
    USABLE_STATUSES,
    ContractError,
    conform,
    exchange_code,
    require_columns,
)


def scan_fetch_manifest(spark: SparkSession, path: str) -> DataFrame:
    frame = spark.read.parquet(path)
    return conform(require_columns(frame, FETCH_MANIFEST.names, "fetch manifest"), FETCH_MANIFEST)


def usable_sources(manifest: DataFrame, exchange: str) -> DataFrame:
    """Distinct raw file paths of an exchange that were fetched successfully."""
    require_columns(manifest, ["exchange", "local_path", "status"], "source manifest")
    return (
        manifest.where(
            (F.col("exchange") == exchange_code(exchange))
            & F.col("status").isin(*USABLE_STATUSES)
            & F.col("local_path").isNotNull()
        )
        .select("local_path")
        .distinct()
        .orderBy("local_path")
    )


def missing_sources(sources: DataFrame, listing: DataFrame) -> DataFrame:
    """Manifest paths that no longer exist in a file listing."""
    bare = F.regexp_replace("path", r"^file:/*", "/")
    return sources.join(listing.select(bare.alias("local_path")), "local_path", "left_anti")


def empty_decisions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DECISIONS)


def scan_decisions(
    spark: SparkSession, path: str, parts: list[tuple[str, int]] | None = None
) -> DataFrame:
    """Stored decisions; an empty typed table when nothing is stored yet.

    ``parts`` names strategies with a month each (as ``year * 100 + month``); only those folders are read.
    """
    settle(spark, path, started_only=True)
    if not partition_folders(spark, path):
        return empty_decisions(spark)
    # The declared schema keeps strategy ids text: folder names would be inferred as numbers.
    kinds = StructType([*DECISIONS.fields, StructField("month", IntegerType())])
    stored = read_settled(spark, path, lambda: spark.read.schema(kinds).parquet(path))
    if parts is not None:
        chosen = F.lit(False)
        for strategy in sorted({part[0] for part in parts}):
            months = sorted({part[1] for part in parts if part[0] == strategy})
            chosen |= (F.col("strategy_id") == strategy) & F.col("month").isin(months)
        stored = stored.where(chosen)
    return conform(stored, DECISIONS)


def strategy_registry(source: DataFrame | str, spark: SparkSession | None = None) -> DataFrame:
    """Registry rows with typed required columns; further columns pass through."""
    frame = source if isinstance(source, DataFrame) else spark.read.parquet(source)
    require_columns(frame, REGISTRY_REQUIRED, "strategy registry")
    frame = frame.withColumns({name: F.col(name).cast("string") for name in REGISTRY_REQUIRED})
    if not frame.where(F.col("strategy_id").isNull()).isEmpty():
        raise ContractError("strategy registry has null strategy_id")
    return frame


def active_strategies(registry: DataFrame) -> DataFrame:
    return registry.where(F.col("status") == "active")
