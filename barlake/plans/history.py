"""Raw files to a checked monthly bar table, its audit and its partition manifest."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from barlake.operators.normalize import (
    UNADJUSTED,
    assert_bars,
    distinct_bars,
    drop_variant_symbols,
    key_tasks,
    normalize_fields,
    usable_rows,
    with_unadjusted,
)
from barlake.operators.manifest import merge_manifest
from barlake.operators.quality import (
    global_audit, ingest_summary, misplaced_rows, partition_audit, partition_statistics,
)
from barlake.schema import (
    BARS,
    EXCHANGES,
    FETCH_MANIFEST,
    MONTH_KEY,
    PARTITION_MANIFEST,
    ContractError,
    add_month_columns,
    conform,
    exchange_code,
)
from barlake.files import partition_folders
from barlake.journal import prepare, settle
from barlake.session import scratch_dir
from barlake.sources.bars import present_months
from barlake.sources.inventory import list_files, with_partition_identity
from barlake.sources.raw import read_raw, same_spelling
from barlake.sources.tables import scan_fetch_manifest
from barlake.storage import (
    delete_path,
    has_months,
    only_months,
    path_exists,
    read_months,
    stage_months,
    swap_months,
)

MODES = ("create", "clean", "incremental", "only_missing", "repair")


@dataclass(frozen=True)
class Ingested:
    """Bars parsed from raw files, written to scratch once and read from there."""

    rows: DataFrame  # canonical bars plus the path of their file
    files: DataFrame  # path, format_id
    skipped: DataFrame  # path, reason: files that held no data
    staged: tuple[str, ...]  # scratch tables behind the two, to delete when done with them


def ingest_files(
    spark: SparkSession, path: str | list[str], exchange: str, *,
    quarantine: str | None = None, strict: bool = True, allow_skipped: bool = False,
) -> Ingested:
    """Parse the raw files of one exchange and gate them.

    Files with missing columns and, unless a ``quarantine`` path is given, incomplete
    rows fail the job with their number. The parsed rows are written once; all checks
    and the build read that table.
    """
    raw = read_raw(spark, path, exchange)
    bad = raw.files.where((F.size("missing_columns") > 0) | (F.size("missing_fields") > 0))
    examples = bad.limit(5).collect()
    if examples:
        texts = [
            f"{r.path}: format_id={r.format_id} missing {r.missing_columns or r.missing_fields}"
            for r in examples
        ]
        raise ContractError("raw files lack required columns: " + "; ".join(texts))
    if not allow_skipped and not raw.skipped.isEmpty():
        raise ContractError(f"raw files without data: {[r.path for r in raw.skipped.limit(5).collect()]}")

    staged = scratch_dir(spark, "ingest")
    # Columns that repeat others are not written.
    normalize_fields(raw.rows, exchange).drop(*UNADJUSTED).write.option("compression", "zstd").parquet(staged)
    fields = with_unadjusted(spark.read.parquet(staged))
    incomplete = fields.where(~usable_rows(strict))
    if quarantine:
        set_aside(spark, incomplete, raw.files, exchange, quarantine)
    else:
        count = incomplete.count()
        if count:
            raise ContractError(f"{count} incomplete market rows in raw files")
    rows = fields.where(usable_rows(strict)).drop("unreadable")
    # Without variants no keys are shuffled to look for theirs.
    if exchange_code(exchange) == "BSE" and not rows.where(F.col("symbol").endswith("#")).isEmpty():
        rows = drop_variant_symbols(rows)
    # Raw files hold one day each; their digests are only taken where a manifest asks.
    digests = list_files(spark, path, digest=True).select(same_spelling("path").alias("path"), "md5")
    files = raw.files.select("path", "format_id").join(digests, "path", "left")
    return Ingested(rows, files, raw.skipped, (staged, raw.staged))


def set_aside(
    spark: SparkSession, incomplete: DataFrame, files: DataFrame, exchange: str, path: str
) -> None:
    """Put incomplete rows into a table of such rows, in place of those that earlier runs found in the same ``files``."""
    place = f"exchange={exchange_code(exchange)}"
    settle(spark, path)
    rows = incomplete.drop("exchange")
    if place in partition_folders(spark, path):
        earlier = spark.read.parquet(f"{path}/{place}")
        rows = rows.unionByName(earlier.join(files.select("path").distinct(), "path", "left_anti"))
    prepare(spark, path, lambda folder: rows.write.option("compression", "zstd").parquet(f"{folder}/{place}"), lambda folder: None)
    settle(spark, path)


def ingest_once(spark: SparkSession, path: str, exchange: str, output: str) -> DataFrame:
    """Raw files to one flat bar table; repeated full rows merge. Returns the summary."""
    ingested = ingest_files(spark, path, exchange)
    staged = stage_months(distinct_bars(ingested.rows), spark, "flat")
    assert_bars(read_months(spark, staged))
    flat = conform(read_months(spark, staged), BARS)
    flat.write.mode("overwrite").parquet(output)
    for scratch in (staged, *ingested.staged):
        delete_path(spark, scratch)
    return ingest_summary(spark.read.parquet(output))


def source_files(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Raw files and formats that fed each month: at most a file per day and format."""
    months = add_month_columns(rows).select(*MONTH_KEY, "path").distinct().join(files, "path", "left")
    return months.groupBy(*MONTH_KEY).agg(
        F.array_sort(F.collect_set("path")).alias("source_raw_files"),
        F.array_sort(F.collect_set("md5")).alias("source_md5s"),
        F.array_sort(F.collect_set("format_id")).alias("format_ids"),
        F.countDistinct("path").alias("source_raw_count"),
    )


def month_files(spark: SparkSession, path: str) -> DataFrame:
    """Size and checksum of each month's files.

    A month in one file has that file's md5; a month that was split has the md5 of its
    files' sorted md5s.
    """
    files = with_partition_identity(list_files(spark, path, digest=True)).where(
        F.col("path").endswith(".parquet")
    )
    sums = F.array_sort(F.collect_list("md5"))
    return files.groupBy(*MONTH_KEY).agg(
        F.sum("length").alias("file_size_bytes"),
        F.when(F.count("*") == 1, F.max("md5")).otherwise(F.md5(F.array_join(sums, ","))).alias("md5"),
        F.min(F.regexp_extract("path", r"^(.*)/[^/]*$", 1)).alias("partition_path"),
    )


def partition_manifest(
    spark: SparkSession, path: str, sources: DataFrame | None = None, status: str = "refreshed"
) -> DataFrame:
    """One row per month: statistics of its bars beside size and checksum of its files."""
    stats = partition_statistics(read_months(spark, path))
    rows = stats.join(month_files(spark, path), list(MONTH_KEY), "left")
    if sources is not None:
        rows = rows.join(sources, list(MONTH_KEY), "left")
    else:
        rows = rows.withColumns({n: F.lit(None) for n in ("source_raw_files", "source_md5s", "format_ids", "source_raw_count")})
    return conform(
        rows.withColumns(
            {
                "parser_versions": F.lit("1"),
                "created_at": F.current_timestamp(),
                "verified_at": F.lit(None),
                "status": F.lit(status),
            }
        ),
        PARTITION_MANIFEST,
    )


def as_json_lists(manifest: DataFrame) -> DataFrame:
    """The manifest with its list columns as JSON text, for consumers without arrays."""
    lists = ("source_raw_files", "source_md5s", "format_ids")
    return manifest.withColumns({name: F.to_json(name) for name in lists})


def store_bars(
    spark: SparkSession, bars: DataFrame, path: str, *, mode: str = "create",
    exchanges: tuple[str, ...] = EXCHANGES, partition: tuple[str, int, int] | None = None,
    by_month: bool = False,
) -> None:
    """Write bars as months beside the table, check them, and put them in place as one change.

    ``create`` refuses an existing table; ``clean`` replaces it, or only the given
    exchanges; ``incremental`` replaces the months present in ``bars``;
    ``only_missing`` adds months the table lacks; ``repair`` replaces one month. Checked are the
    months that are written. A job that dies at any step leaves the old table, or one that the next
    reader or writer makes the new one. Bars that were read from a monthly table are ``by_month`` already.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode: {mode}")
    settle(spark, path)
    exists = has_months(spark, path)
    if mode == "create" and exists:
        raise FileExistsError(f"{path} exists: choose clean, incremental, only_missing or repair")
    needed = None
    if mode == "repair":
        exchange, year, month = partition
        bars = only_months(add_month_columns(bars), [(exchange_code(exchange), year, month)])
        needed = f"repair produced no bars for {partition}"
    elif mode == "only_missing" and exists:
        # At most exchanges x calendar months.
        present = F.broadcast(present_months(read_months(spark, path)))
        bars = add_month_columns(bars).join(present, list(MONTH_KEY), "left_anti")
    elif mode == "clean" and len(exchanges) < len(EXCHANGES):
        bars = bars.where(F.col("exchange").isin(*map(exchange_code, exchanges)))

    def replaced(present: list[str], new: list[str]) -> list[str]:
        """Months that a clean build did not make again go with the change."""
        if mode != "clean":
            return []
        whole = len(exchanges) == len(EXCHANGES)
        rebuilt = {f"exchange={exchange_code(name)}" for name in exchanges}
        return [place for place in present if whole or place.split("/")[0] in rebuilt]

    swap_months(spark, bars, path, assert_bars, by_month=by_month, needed=needed, drop=replaced)


def build_history(
    spark: SparkSession, input_path: str, output: str, *,
    exchanges: tuple[str, ...] = EXCHANGES, mode: str = "create",
    partition: tuple[str, int, int] | None = None, quarantine: str | None = None,
    sources: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Raw files of all exchanges to a monthly table; returns its partition manifest.

    Files of an exchange are below ``<input>/<exchange>`` when that folder exists, else
    below ``<input>``; ``sources`` may name them instead, from a fetch manifest. Files
    without data are skipped, conflicting rows of one key fail the build.
    """
    parts = []
    for exchange in map(exchange_code, exchanges):
        own = f"{input_path}/{exchange}"
        path = (sources or {}).get(exchange) or (own if path_exists(spark, own) else input_path)
        parts.append(
            ingest_files(spark, path, exchange, quarantine=quarantine, allow_skipped=True)
        )
    rows = reduce(DataFrame.unionByName, [part.rows for part in parts])
    store_bars(spark, rows, output, mode=mode, exchanges=exchanges, partition=partition)
    # The manifest is small and outlives the scratch tables it is computed from.
    manifest = scratch_dir(spark, "manifest")
    files = reduce(DataFrame.unionByName, [part.files for part in parts])
    sources = source_files(rows, files)
    partition_manifest(spark, output, sources, status="built").write.parquet(manifest)
    for scratch in [path for part in parts for path in part.staged]:
        delete_path(spark, scratch)
    return spark.read.schema(PARTITION_MANIFEST).parquet(manifest)


def store_fetch_manifest(spark: SparkSession, new: DataFrame, path: str) -> DataFrame:
    """Merge manifest rows into the stored manifest and return it."""
    merged = conform(new, FETCH_MANIFEST)
    if path_exists(spark, path):
        merged = merge_manifest(scan_fetch_manifest(spark, path), merged)
    staged = scratch_dir(spark, "fetch-manifest")
    merged.write.parquet(staged)
    spark.read.parquet(staged).write.mode("overwrite").parquet(path)
    delete_path(spark, staged)
    return scan_fetch_manifest(spark, path)


def audit_history(spark: SparkSession, path: str, report: str | None = None):
    """Monthly and global audit of a table; optionally written as JSON."""
    bars = read_months(spark, path)
    partitions = partition_audit(bars, tasks=key_tasks(bars.count()))
    if report:
        partitions.write.mode("overwrite").json(f"{report}/partitions")
        schema = partitions.schema
        partitions = spark.read.schema(schema).json(f"{report}/partitions")
    # Only the dates are read: a row in the wrong folder would be pruned away by date scans.
    elsewhere = misplaced_rows(bars).count()
    total = global_audit(partitions, bars).withColumns(
        {"misplaced_rows": F.lit(elsewhere), "passed": F.col("passed") & F.lit(elsewhere == 0)}
    )
    if report:
        total.write.mode("overwrite").json(f"{report}/global")
    return partitions, total
