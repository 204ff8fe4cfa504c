"""Fetch manifests, sync and health."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlake.operators import manifest as m
from barlake.queries import adapter as a
from barlake.sources import formats as fmt
from barlake.sources.tables import usable_sources

_GOOD = "('downloaded', 'skipped_existing', 'validated')"


def _first(spark, d):
    return a.fetch_manifests(spark, d)[0]


def doctor_report(spark, sf_dir):
    local, remote = a.partition_sides(spark, sf_dir)
    thinned = local.where(F.col("month") % 4 != 0)
    return m.doctor_report(a.fetch_manifests(spark, sf_dir)[0], thinned, remote)


def fetch_manifest_days(spark, sf_dir):
    none = spark.createDataFrame(
        [], "path string, length bigint, sha256 string, modified timestamp"
    )
    rows = m.build_fetch_manifest(a.days(spark, sf_dir), fmt.formats(spark), none)
    return rows.select(
        "exchange", "date", "expected_format_id", "expected_filename", "status", "last_error",
        "parser_hint",
    )


def mark_row(spark, sf_dir):
    rows = _first(spark, sf_dir).withColumns(
        {"last_error": F.lit(""), "last_attempt_at": F.lit(None).cast("timestamp")}
    )
    newest = rows.where(F.col("exchange") == "NSE").agg(F.max("date").alias("day")).first()["day"]
    marked = m.mark_manifest_row(
        rows, day=newest, status="missing", reason="reviewed", exchange="nse",
    )
    return marked.drop("last_attempt_at")


def _sync(spark, d):
    return m.sync_status(*a.partition_sides(spark, d))


_SYNC = """
synced AS (
  SELECT coalesce(l.exchange, r.exchange) AS exchange, l.year AS year, l.month AS month,
    l.partition_path AS local_partition_path,
    coalesce(r.object_key, 'exchange=' || l.exchange || '/year=' || CAST(l.year AS varchar)
      || '/month=' || lpad(CAST(l.month AS varchar), 2, '0') || '/part.parquet') AS object_key,
    l.file_size_bytes AS local_file_size, CASE WHEN l.year IS NOT NULL THEN r.size END AS remote_file_size,
    l.md5 AS local_etag, CASE WHEN l.year IS NOT NULL THEN r.etag END AS remote_etag,
    l.year IS NOT NULL AS manifest_entry,
    CASE WHEN l.year IS NULL THEN 'EXTRA' WHEN r.year IS NULL THEN 'MISSING'
      WHEN r.size = l.file_size_bytes AND r.etag = l.md5 THEN 'OK' ELSE 'STALE' END AS status
  FROM local_parts l FULL JOIN remote_parts r
    ON l.exchange = r.exchange AND l.year = r.year AND l.month = r.month
)"""

MANIFEST_QUERIES = {
    "status_histogram": (
        lambda spark, d: m.status_histogram(_first(spark, d)),
        a.with_sql(a.FETCH_SQL, select="""
SELECT exchange, status, count(*) AS rows FROM fetch_a GROUP BY exchange, status"""),
    ),
    "rate_limit_ratio": (
        lambda spark, d: m.rate_limit_ratio(_first(spark, d), 0.09).withColumn(
            "rate_limited_ratio", F.round("rate_limited_ratio", 6)
        ),
        a.with_sql(a.FETCH_SQL, select="""
SELECT exchange, round(avg(CASE WHEN status = 'rate_limited' THEN 1.0 ELSE 0.0 END), 6) AS rate_limited_ratio,
  avg(CASE WHEN status = 'rate_limited' THEN 1.0 ELSE 0.0 END) > 0.09 AS exceeded
FROM fetch_a GROUP BY exchange"""),
    ),
    "manifest_dates": (
        lambda spark, d: m.dates_with_status(_first(spark, d), {"missing", "failed"}),
        a.with_sql(a.FETCH_SQL, select="""
SELECT DISTINCT date FROM fetch_a WHERE status IN ('expected', 'failed')"""),
    ),
    "usable_sources": (
        lambda spark, d: usable_sources(_first(spark, d), "NSE"),
        a.with_sql(a.FETCH_SQL, select=f"""
SELECT DISTINCT local_path FROM fetch_a WHERE exchange = 'NSE' AND status IN {_GOOD}"""),
    ),
    "fetch_manifest_days": (fetch_manifest_days, a.with_sql(a.DAYS_SQL, select="""
SELECT exchange, date, f.parser || '_bhavcopy_v1' AS expected_format_id, CASE parser
    WHEN 'nse_legacy_cm' THEN 'cm' || upper(strftime(date, '%d%b%Y')) || 'bhav.csv.zip'
    WHEN 'nse_udiff_cm' THEN 'BhavCopy_NSE_CM_0_0_0_' || strftime(date, '%Y%m%d') || '_F_0000.csv.zip'
    WHEN 'bse_legacy_equity' THEN 'EQ' || strftime(date, '%d%m%y') || '_CSV.ZIP'
    ELSE 'BhavCopy_BSE_CM_0_0_0_' || strftime(date, '%Y%m%d') || '_F_0000.CSV' END AS expected_filename,
  'expected' AS status, 'file not present' AS last_error, parser AS parser_hint
FROM (SELECT *, CASE
    WHEN exchange = 'NSE' AND date <= '2024-07-07' THEN 'nse_legacy_cm' WHEN exchange = 'NSE' THEN 'nse_udiff_cm'
    WHEN date <= '2024-07-29' THEN 'bse_legacy_equity' ELSE 'bse_udiff_cm' END AS parser FROM days) f""")),
    "manifest_merge": (
        lambda spark, d: m.merge_manifest(*a.fetch_manifests(spark, d)),
        a.with_sql(a.FETCH_SQL, select="""
SELECT * FROM fetch_a o WHERE NOT EXISTS (
  SELECT 1 FROM fetch_b n WHERE n.exchange = o.exchange AND n.date = o.date)
UNION ALL SELECT * FROM fetch_b"""),
    ),
    "manifest_combine": (
        lambda spark, d: m.combine_manifests(list(a.fetch_manifests(spark, d))),
        a.with_sql(a.FETCH_SQL, select="""
SELECT * EXCLUDE (src, rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY exchange, date ORDER BY src DESC) AS rn FROM (
    SELECT *, 0 AS src FROM fetch_a UNION ALL SELECT *, 1 FROM fetch_b)) WHERE rn = 1"""),
    ),
    "manifest_mark": (mark_row, a.with_sql(a.FETCH_SQL, select="""
SELECT exchange, date, local_path, CASE WHEN newest THEN 'expected' ELSE status END AS status, attempts,
  CASE WHEN newest THEN 'reviewed' ELSE '' END AS last_error
FROM (SELECT *, exchange = 'NSE' AND date = (SELECT max(date) FROM fetch_a WHERE exchange = 'NSE') AS newest FROM fetch_a)""")),
    "manifest_months": (
        lambda spark, d: m.manifest_months(_first(spark, d)),
        a.with_sql(a.FETCH_SQL, select=f"""
SELECT DISTINCT exchange, CAST(year(date) AS integer) AS year, CAST(month(date) AS integer) AS month
FROM fetch_a WHERE status IN {_GOOD}"""),
    ),
    "sync_status": (
        lambda spark, d: m.in_sync_order(_sync(spark, d)),
        a.with_sql(a.SYNC_SQL, _SYNC, select="SELECT * FROM synced"),
    ),
    "sync_verdict": (
        lambda spark, d: m.sync_verdict(_sync(spark, d)),
        a.with_sql(a.SYNC_SQL, _SYNC, select="""
SELECT exchange, CASE WHEN bool_and(status = 'OK') THEN 'ok' ELSE 'fail' END AS verdict
FROM synced GROUP BY exchange"""),
    ),
    "changed_partitions": (
        lambda spark, d: m.changed_partitions(_sync(spark, d)),
        a.with_sql(a.SYNC_SQL, _SYNC, select="""
SELECT exchange, year, month FROM synced WHERE status IN ('MISSING', 'STALE')"""),
    ),
    "month_set_diff": (
        lambda spark, d: m.month_differences(*a.partition_sides(spark, d)),
        a.with_sql(a.SYNC_SQL, select="""
SELECT *, 'left' AS side FROM (SELECT exchange, year, month FROM local_parts
  EXCEPT SELECT exchange, year, month FROM remote_parts)
UNION ALL
SELECT *, 'right' FROM (SELECT exchange, year, month FROM remote_parts
  EXCEPT SELECT exchange, year, month FROM local_parts)"""),
    ),
    "doctor_report": (doctor_report, a.with_sql(a.FETCH_SQL, a.SYNC_SQL, f"""
wd AS (
  SELECT exchange, count(*) FILTER (WHERE isodow(day) < 6) AS expected_trading_weekdays,
    count(*) FILTER (WHERE isodow(day) < 6 AND NOT EXISTS (
      SELECT 1 FROM fetch_a f WHERE f.exchange = s.exchange AND f.date = s.day)) AS raw_missing_weekdays
  FROM (SELECT exchange, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS date) AS day
        FROM fetch_a GROUP BY exchange) s GROUP BY exchange
), counts AS (
  SELECT exchange, count(*) AS raw_rows,
    count(*) FILTER (WHERE status = 'downloaded') AS raw_downloaded,
    count(*) FILTER (WHERE status = 'skipped_existing') AS raw_skipped_existing,
    count(*) FILTER (WHERE status = 'validated') AS raw_validated,
    count(*) FILTER (WHERE status IN {_GOOD}) AS raw_usable,
    count(*) FILTER (WHERE status = 'rate_limited') AS raw_rate_limited,
    count(*) FILTER (WHERE status IN ('parse_failed', 'corrupt_html')) AS raw_unparseable,
    count(*) FILTER (WHERE status = 'failed') AS raw_failed
  FROM fetch_a GROUP BY exchange
), months AS (
  SELECT exchange, year, month, max(e) AS e, max(l) AS l, max(r) AS r FROM (
    SELECT DISTINCT exchange, year(date) AS year, month(date) AS month, 1 AS e, 0 AS l, 0 AS r
    FROM fetch_a WHERE status IN {_GOOD}
    UNION ALL SELECT exchange, year, month, 0, 1, 0 FROM local_parts WHERE month % 4 <> 0
    UNION ALL SELECT exchange, year, month, 0, 0, 1 FROM remote_parts) GROUP BY exchange, year, month
), parts AS (
  SELECT exchange, CAST(sum(e) AS bigint) AS partitions_expected, CAST(sum(l) AS bigint) AS partitions_present,
    count(*) FILTER (WHERE e = 1 AND l = 0) AS partitions_missing,
    CAST(sum(r) AS bigint) AS remote_partitions_present,
    count(*) FILTER (WHERE e = 1 AND r = 0) AS remote_partitions_missing,
    count(*) FILTER (WHERE l <> r) AS local_remote_mismatches
  FROM months GROUP BY exchange
)""", select="""
SELECT exchange, raw_downloaded, raw_skipped_existing, raw_validated, raw_usable, raw_rate_limited,
  raw_unparseable, raw_failed, expected_trading_weekdays, raw_missing_weekdays,
  greatest(expected_trading_weekdays - raw_rows, 0) AS raw_missing, partitions_expected,
  partitions_present, partitions_missing, remote_partitions_present, remote_partitions_missing,
  local_remote_mismatches,
  CASE WHEN raw_failed + raw_rate_limited > 0 THEN 'fail'
    WHEN expected_trading_weekdays > raw_rows OR partitions_missing > 0 OR remote_partitions_missing > 0
    THEN 'warn' ELSE 'ok' END AS status
FROM counts JOIN wd USING (exchange) JOIN parts USING (exchange)""")),
}
