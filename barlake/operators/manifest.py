"""Fetch manifests, partition manifests and their reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from barlake.functions.dates import days_between, is_weekday
from barlake.schema import (
    FETCH_MANIFEST,
    FETCH_STATUSES,
    MONTH_KEY,
    UNRESOLVED_STATUSES,
    USABLE_STATUSES,
    ContractError,
    conform,
    month_path,
    require_columns,
)
from barlake.sources.formats import expected_files
from barlake.sources.inventory import file_name
from barlake.storage import keep_last

_FETCH_KEY = ("exchange", "date")


def status_codes(statuses) -> list[str]:
    """Known statuses, with ``missing`` read as ``expected``."""
    codes = sorted({"expected" if status == "missing" else status for status in statuses})
    unknown = [code for code in codes if code not in FETCH_STATUSES]
    if unknown:
        raise ContractError(f"unsupported fetch statuses: {unknown}")
    return codes


def dates_with_status(manifest: DataFrame, statuses) -> DataFrame:
    """Distinct dates that carry one of the statuses, ascending."""
    chosen = manifest.where(F.col("status").isin(status_codes(statuses)))
    return chosen.select("date").distinct().orderBy("date")


def build_fetch_manifest(days: DataFrame, registry: DataFrame, files: DataFrame) -> DataFrame:
    """Manifest rows for ``(exchange, date)`` days, from the files that are present.

    ``files`` is a digested file listing; a day's file is found by its expected name. Of
    files with one name the newest counts, of equally old ones the last by path.
    """
    expected = expected_files(days, registry)
    found = files.select(
        F.lower(file_name(F.col("path"))).alias("_name"), "path", "length", "sha256", "modified"
    )
    found = keep_last(found, ["_name"], ["modified", "path"])
    joined = expected.join(found, F.lower("expected_filename") == F.col("_name"), "left")
    present = F.col("path").isNotNull()
    return conform(
        joined.select(
            "exchange", "date", "expected_format_id", "expected_filename",
            F.element_at("expected_urls", 1).alias("expected_url_primary"),
            F.col("path").alias("local_path"),
            F.when(present, "downloaded").otherwise("expected").alias("status"),
            F.lit(None).alias("http_status"),
            F.col("length").alias("bytes"), "sha256",
            F.lit(None).alias("attempts"),
            F.col("modified").alias("last_attempt_at"),
            F.when(present, "").otherwise("file not present").alias("last_error"),
            "parser_hint",
        ),
        FETCH_MANIFEST,
    )


def merge_manifest(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Existing rows with those of the new rows' exchange and date replaced."""
    kept = existing.join(new.select(*_FETCH_KEY).distinct(), list(_FETCH_KEY), "left_anti")
    return kept.unionByName(new)


def combine_manifests(manifests: list[DataFrame]) -> DataFrame:
    """One manifest from several; the later one wins per exchange and date."""
    if not manifests:
        raise ValueError("at least one manifest is required")
    numbered = [frame.withColumn("_source", F.lit(i)) for i, frame in enumerate(manifests)]
    return keep_last(reduce(DataFrame.unionByName, numbered), _FETCH_KEY, ["_source"]).drop("_source")


def mark_manifest_row(
    manifest: DataFrame, *, day, status: str, reason: str, exchange: str | None = None,
    at: Column | None = None,
) -> DataFrame:
    """Set status, reason and time of exactly one row."""
    code = status_codes([status])[0]
    chosen = F.col("date") == F.lit(day)
    if exchange:
        chosen &= F.col("exchange") == exchange.upper()
    matched = manifest.where(chosen).count()
    if matched != 1:
        raise ContractError(f"expected one manifest row for {exchange or 'any exchange'} {day}; found {matched}")
    changes = {
        "status": F.lit(code),
        "last_error": F.lit(reason),
        "last_attempt_at": at if at is not None else F.current_timestamp(),
    }
    return manifest.withColumns(
        {name: F.when(chosen, value).otherwise(F.col(name)) for name, value in changes.items()}
    )


def status_histogram(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("exchange", "status").agg(F.count("*").alias("rows"))


def rate_limit_ratio(manifest: DataFrame, threshold: float) -> DataFrame:
    """Share of rate-limited rows per exchange and whether it exceeds the threshold."""
    if not 0 <= threshold <= 1:
        raise ValueError("threshold must be between 0 and 1")
    limited = F.when(F.col("status") == "rate_limited", 1.0).otherwise(0.0)
    ratio = manifest.groupBy("exchange").agg(F.avg(limited).alias("rate_limited_ratio"))
    return ratio.withColumn("exceeded", F.col("rate_limited_ratio") > threshold)


def manifest_months(manifest: DataFrame) -> DataFrame:
    """Months for which a raw file is usable."""
    usable = manifest.where(F.col("status").isin(*USABLE_STATUSES))
    return usable.select(
        "exchange", F.year("date").alias("year"), F.month("date").alias("month")
    ).distinct()


def month_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Months on one side only, with the ``side`` they are on."""
    months = [F.col(name) for name in MONTH_KEY]
    only_left = left.select(*months).subtract(right.select(*months))
    only_right = right.select(*months).subtract(left.select(*months))
    return only_left.withColumn("side", F.lit("left")).unionByName(
        only_right.withColumn("side", F.lit("right"))
    )


def sync_status(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Compare a partition manifest with a remote inventory, month by month.

    ``local``: exchange, year, month, partition_path, file_size_bytes, md5.
    ``remote``: exchange, year, month, object_key, size, etag.
    """
    require_columns(
        local, [*MONTH_KEY, "partition_path", "file_size_bytes", "md5"], "partition manifest"
    )
    ours, theirs = local.alias("l"), remote.alias("r")
    on = reduce(
        Column.__and__, [F.col(f"l.{name}") == F.col(f"r.{name}") for name in MONTH_KEY]
    )
    key = F.concat(
        month_path(F.col("l.exchange"), F.col("l.year"), F.col("l.month")), F.lit("/part.parquet")
    )
    same = F.col("r.size").eqNullSafe(F.col("l.file_size_bytes")) & F.col("r.etag").eqNullSafe(
        F.col("l.md5")
    )
    known = F.col("l.exchange").isNotNull()
    status = (
        F.when(~known, "EXTRA")
        .when(F.col("r.exchange").isNull(), "MISSING")
        .when(same, "OK")
        .otherwise("STALE")
    )
    return ours.join(theirs, on, "full").select(
        F.coalesce("l.exchange", "r.exchange").alias("exchange"),
        F.col("l.year").alias("year"),
        F.col("l.month").alias("month"),
        F.col("l.partition_path").alias("local_partition_path"),
        F.coalesce(F.col("r.object_key"), key).alias("object_key"),
        F.col("l.file_size_bytes").alias("local_file_size"),
        F.when(known, F.col("r.size")).alias("remote_file_size"),
        F.col("l.md5").alias("local_etag"),
        F.when(known, F.col("r.etag")).alias("remote_etag"),
        known.alias("manifest_entry"),
        status.alias("status"),
    )


def in_sync_order(sync: DataFrame) -> DataFrame:
    return sync.orderBy(
        "exchange", F.asc_nulls_last("year"), F.asc_nulls_last("month"), "object_key"
    )


def sync_verdict(sync: DataFrame) -> DataFrame:
    """``ok`` when every month is OK, per exchange."""
    fine = F.bool_and(F.col("status") == "OK")
    return sync.groupBy("exchange").agg(F.when(fine, "ok").otherwise("fail").alias("verdict"))


def assert_resolved(manifest: DataFrame) -> None:
    """Refuse to go on while dates are expected, missing, failed or rate limited."""
    open_rows = manifest.where(F.col("status").isin(*UNRESOLVED_STATUSES)).count()
    if open_rows:
        raise ContractError(f"fetch manifest has {open_rows} unresolved rows")


def doctor_report(manifest: DataFrame, local_months: DataFrame, remote_months: DataFrame) -> DataFrame:
    """One health row per exchange of the fetch manifest."""
    def with_status(*codes):
        return F.sum(F.col("status").isin(*codes).cast("bigint"))

    counts = manifest.groupBy("exchange").agg(
        F.count("*").alias("raw_rows"),
        F.min("date").alias("start"),
        F.max("date").alias("end"),
        with_status("downloaded").alias("raw_downloaded"),
        with_status("skipped_existing").alias("raw_skipped_existing"),
        with_status("validated").alias("raw_validated"),
        with_status(*USABLE_STATUSES).alias("raw_usable"),
        with_status("rate_limited").alias("raw_rate_limited"),
        with_status("parse_failed", "corrupt_html").alias("raw_unparseable"),
        with_status("failed").alias("raw_failed"),
        F.collect_set("date").alias("_dates"),
    )
    weekdays = F.filter(days_between(F.col("start"), F.col("end")), is_weekday)
    # The set difference, beside the reference count difference: both are bounded by
    # the calendar, one manifest row per exchange and date.
    counts = counts.withColumns(
        {
            "expected_trading_weekdays": F.size(weekdays).cast("bigint"),
            "raw_missing_weekdays": F.size(F.array_except(weekdays, F.col("_dates"))).cast("bigint"),
        }
    ).withColumn("raw_missing", F.greatest(F.col("expected_trading_weekdays") - F.col("raw_rows"), F.lit(0)))

    def months(frame, flag):
        return frame.select(*MONTH_KEY).distinct().withColumn(flag, F.lit(True))

    expected = months(manifest_months(manifest), "expected")
    merged = expected.join(months(local_months, "local"), list(MONTH_KEY), "full").join(
        months(remote_months, "remote"), list(MONTH_KEY), "full"
    )
    wanted, local, remote = (
        F.coalesce(F.col(name), F.lit(False)) for name in ("expected", "local", "remote")
    )

    def number(condition):
        return F.sum(condition.cast("bigint"))

    partitions = merged.groupBy("exchange").agg(
        number(wanted).alias("partitions_expected"),
        number(local).alias("partitions_present"),
        number(wanted & ~local).alias("partitions_missing"),
        number(remote).alias("remote_partitions_present"),
        number(wanted & ~remote).alias("remote_partitions_missing"),
        number(local != remote).alias("local_remote_mismatches"),
    )
    report = counts.join(partitions, "exchange", "left").drop("_dates", "start", "end", "raw_rows")
    failed = (F.col("raw_failed") > 0) | (F.col("raw_rate_limited") > 0)
    warned = (
        (F.col("raw_missing") > 0)
        | (F.col("partitions_missing") > 0)
        | (F.col("remote_partitions_missing") > 0)
    )
    return report.withColumn("status", F.when(failed, "fail").when(warned, "warn").otherwise("ok"))


def changed_partitions(sync: DataFrame) -> DataFrame:
    """Local months that must be published: absent remotely or different there."""
    return sync.where(F.col("status").isin("MISSING", "STALE")).select(*MONTH_KEY)
