"""Publish verified months to another location, skipping those that lie there unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from barlake.operators.manifest import assert_resolved, changed_partitions, sync_status
from barlake.plans.contents import compare_contents, month_contents
from barlake.plans.history import month_files
from barlake.schema import MONTH_KEY, ContractError, require_columns
from barlake.session import scratch_dir
from barlake.journal import settle
from barlake.storage import delete_path, has_months, only_months, path_exists, read_months, swap_months

_PLACE = "exchange string, year int, month int, object_key string, size bigint, etag string"
# What was published: size and checksum at the source, and of the files written from it.
_RECORD = f"{_PLACE}, target_size bigint, target_etag string"


def published_record(spark: SparkSession, target: str) -> DataFrame:
    """What earlier runs wrote, one row per month."""
    path = f"{target}/_inventory"
    if not path_exists(spark, path):
        return spark.createDataFrame([], _RECORD)
    return spark.read.schema(_RECORD).parquet(path)


def _at_target(spark: SparkSession, target: str) -> DataFrame:
    """Size and checksum of the files that lie at the target now."""
    bars = f"{target}/bars"
    if not has_months(spark, bars):
        return spark.createDataFrame([], _PLACE)
    place = F.regexp_extract("partition_path", r"(exchange=[^/]*/year=[^/]*/month=[^/]*)$", 1)
    return month_files(spark, bars).where(F.col("exchange").isNotNull()).select(
        *MONTH_KEY, place.alias("object_key"), F.col("file_size_bytes").alias("size"), F.col("md5").alias("etag")
    )


def remote_inventory(spark: SparkSession, target: str) -> DataFrame:
    """The months at the target, described by their source.

    A month whose files are those that were written has the size and checksum of its source; one
    that was changed, or put there by others, has its own. A month that was lost is
    not listed, whatever the record says.
    """
    there, record = _at_target(spark, target).alias("t"), published_record(spark, target).alias("r")
    same = (F.col("r.target_size") == F.col("t.size")) & (F.col("r.target_etag") == F.col("t.etag"))
    on = [F.col(f"t.{name}") == F.col(f"r.{name}") for name in MONTH_KEY]
    return there.join(record, on, "left").select(
        *[F.col(f"t.{name}").alias(name) for name in (*MONTH_KEY, "object_key")],
        F.when(same, F.col("r.size")).otherwise(F.col("t.size")).alias("size"),
        F.when(same, F.col("r.etag")).otherwise(F.col("t.etag")).alias("etag"),
    )


def _of(status: DataFrame, code: str) -> list[tuple[str, int, int]]:
    months = status.where(F.col("status") == code).select(*MONTH_KEY)
    return sorted((r.exchange, r.year, r.month) for r in months.collect())


def _same_rows(spark: SparkSession, source: str, target: str, months: list) -> list[tuple[str, int, int]]:
    """Those of the months that hold the same rows on both sides, whatever their files."""
    if not months:
        return []
    ours, theirs = (month_contents(only_months(read_months(spark, p), months)) for p in (source, f"{target}/bars"))
    return _of(compare_contents(ours, theirs), "OK")


def publish_status(
    spark: SparkSession, target: str, manifest: DataFrame, source: str | None = None
) -> DataFrame:
    """OK, MISSING, STALE or EXTRA for each month of the manifest or the target.

    With the ``source`` table, months whose files differ are compared by their rows, and are OK if these are
    the same; no other months are read.
    """
    status = sync_status(manifest, remote_inventory(spark, target))
    if source is None:
        return status
    same = _same_rows(spark, source, target, _of(status, "STALE"))
    equal = F.concat_ws("/", *MONTH_KEY).isin(["/".join(map(str, m)) for m in same])
    return status.withColumn("status", F.when(equal, "OK").otherwise(F.col("status")))


def publish_history(
    spark: SparkSession, source: str, target: str, *, audit: DataFrame,
    fetch_manifest: DataFrame, manifest: DataFrame, exchanges: tuple[str, ...] | None = None,
) -> list[tuple[str, int, int]]:
    """Publish the months that the target lacks or has in another state.

    Refuses a failed audit, unresolved fetches and an incomplete partition manifest. Months
    are written beside the target's, their rows are counted against the manifest, and only
    then are they moved into place. Months that the target has beyond the manifest stay, and so do
    those whose source has other files, but the same rows.
    Returns the months written; a second run with nothing new writes none.
    """
    if not audit.first()["passed"]:
        raise ContractError("the audit did not pass")
    assert_resolved(fetch_manifest)
    require_columns(
        manifest, [*MONTH_KEY, "partition_path", "row_count", "file_size_bytes", "md5"],
        "partition manifest",
    )
    if exchanges:
        manifest = manifest.where(F.col("exchange").isin(*exchanges))
    # A row per month, which several steps read: its statistics are taken once.
    listed = scratch_dir(spark, "manifest")
    manifest = manifest.select(*MONTH_KEY, "partition_path", "row_count", "file_size_bytes", "md5")
    manifest.write.parquet(listed)
    manifest = spark.read.schema(manifest.schema).parquet(listed)
    if manifest.isEmpty():
        raise ContractError("no months to publish for the selected exchanges")

    settle(spark, f"{target}/bars")
    status = publish_status(spark, target, manifest)
    same = _same_rows(spark, source, target, _of(status, "STALE"))
    differing = sorted((r.exchange, r.year, r.month) for r in changed_partitions(status).collect())
    if not differing:
        return []
    months = [month for month in differing if month not in same]
    wanted = only_months(manifest, months)

    def complete(written: DataFrame) -> None:
        counts = written.groupBy(*MONTH_KEY).agg(F.count("*").alias("written"))
        short = wanted.join(counts, list(MONTH_KEY), "left").where("NOT row_count <=> written").count()
        if short:
            raise ContractError(f"{short} months differ from the partition manifest")

    if months:
        bars = only_months(read_months(spark, source), months)
        swap_months(spark, bars, f"{target}/bars", complete, by_month=True)

    # Months with the same rows are recorded as well: their source has other files now.
    placed = only_months(_at_target(spark, target), differing).select(
        *MONTH_KEY, "object_key", F.col("size").alias("target_size"), F.col("etag").alias("target_etag")
    )
    now = only_months(manifest, differing).join(placed, list(MONTH_KEY)).select(
        *MONTH_KEY, "object_key", F.col("file_size_bytes").alias("size"), F.col("md5").alias("etag"),
        "target_size", "target_etag",
    )
    record = published_record(spark, target).join(now, list(MONTH_KEY), "left_anti").unionByName(now)
    staged = scratch_dir(spark, "inventory")
    record.write.parquet(staged)
    spark.read.schema(_RECORD).parquet(staged).write.mode("overwrite").parquet(f"{target}/_inventory")
    delete_path(spark, staged)
    return months
