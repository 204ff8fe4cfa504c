"""Audit queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlake.operators import quality as q
from barlake.operators.normalize import bar_violations
from barlake.queries import adapter as a
from barlake.schema import BAR_REQUIRED, BARS

_MONTH = "exchange, CAST(year(date) AS integer) AS year, CAST(month(date) AS integer) AS month"
_GROUP = "exchange, year(date), month(date)"
_INVALID = "high < low OR open < 0 OR high < 0 OR low < 0 OR close < 0"
_COUNTERS = f"""
  CAST(count(*) FILTER (WHERE {_INVALID}) AS bigint) AS invalid_ohlc_count,
  CAST(count(*) FILTER (WHERE volume < 0) AS bigint) AS negative_volume_count,
  CAST(count(*) FILTER (WHERE turnover < 0) AS bigint) AS negative_turnover_count"""
_NULLS = ",\n  ".join(
    f"CAST(count(*) FILTER (WHERE {n} IS NULL) AS bigint) AS null_{n}" for n in BARS.names
)
_REQUIRED_NULLS = ", ".join(
    f"CASE WHEN null_{n} > 0 THEN '{n}' END" for n in BAR_REQUIRED
)
_DUPLICATES = f"""
dup AS (
  SELECT exchange, year(date) AS y, month(date) AS m, CAST(sum(n) AS bigint) AS n FROM (
    SELECT date, exchange, isin, series, count(*) AS n FROM bars_dirty
    GROUP BY date, exchange, isin, series HAVING count(*) > 1) GROUP BY exchange, y, m
), measured AS (
  SELECT {_MONTH}, count(*) AS rows, min(date) AS date_min, max(date) AS date_max,
    count(DISTINCT symbol) AS symbols, {_COUNTERS},
  {_NULLS}
  FROM bars_dirty GROUP BY {_GROUP}
), audited AS (
  SELECT measured.*, coalesce(dup.n, 0) AS duplicate_key_count
  FROM measured LEFT JOIN dup ON dup.exchange = measured.exchange AND y = year AND m = month
)"""


def _verdict(columns: str, source: str) -> str:
    return f"""
SELECT {columns},
  list_aggregate(list_filter([{_REQUIRED_NULLS}], lambda x: x IS NOT NULL), 'string_agg', ',') AS required_null_columns,
  (len(list_filter([{_REQUIRED_NULLS}], lambda x: x IS NOT NULL)) = 0 AND duplicate_key_count
    + invalid_ohlc_count + negative_volume_count + negative_turnover_count = 0) AS passed
FROM {source}"""


def _flat(audit):
    joined = F.nullif(F.array_join("required_null_columns", ","), F.lit(""))
    return audit.withColumn("required_null_columns", joined)


def partition_audit(spark, sf_dir):
    return _flat(q.partition_audit(a.bars_dirty(spark, sf_dir)))


def _global(spark, sf_dir):
    rows = a.bars_dirty(spark, sf_dir)
    return q.global_audit(q.partition_audit(rows), rows)


def global_audit(spark, sf_dir):
    return _flat(_global(spark, sf_dir).drop("missing_columns", "unexpected_columns"))


def audit_verdict(spark, sf_dir):
    clean = a.bars(spark, sf_dir)
    verdicts = [
        audit.select(F.lit(name).alias("input"), "passed")
        for name, audit in (
            ("dirty", _global(spark, sf_dir)),
            ("clean", q.global_audit(q.partition_audit(clean), clean)),
        )
    ]
    return verdicts[0].unionByName(verdicts[1])


def expected_weekdays(spark, sf_dir):
    spans = a.bars(spark, sf_dir).groupBy("exchange", "isin").agg(
        F.min("date").alias("start"), F.max("date").alias("end")
    )
    return q.expected_weekdays(spans, ("exchange", "isin"))


def ingest_summary(spark, sf_dir):
    row = q.ingest_summary(a.bars_dirty(spark, sf_dir))
    return row.withColumn("exchanges", F.array_join("exchanges", ","))


_SUMS = ["rows", "duplicate_key_count", "invalid_ohlc_count", "negative_volume_count",
         "negative_turnover_count", *[f"null_{n}" for n in BARS.names]]
_TOTAL = "total AS (SELECT count(*) AS partitions, " + ", ".join(
    f"CAST(sum({n}) AS bigint) AS {n}" for n in _SUMS
) + " FROM audited)"

QUALITY_QUERIES = {
    "partition_counts": (
        lambda spark, d: q.partition_counts(a.bars(spark, d)),
        a.with_sql(select=f"SELECT {_MONTH}, count(*) AS rows FROM bars GROUP BY {_GROUP}"),
    ),
    "exchange_summary": (
        lambda spark, d: q.exchange_summary(a.bars(spark, d)),
        a.with_sql(select="""
SELECT exchange, count(*) AS rows, min(date) AS date_min, max(date) AS date_max,
  count(DISTINCT symbol) AS symbols FROM bars GROUP BY exchange"""),
    ),
    "month_summary": (
        lambda spark, d: q.coverage_summary(a.bars(spark, d)),
        a.with_sql(select=f"""
SELECT exchange, CAST(y AS integer) AS year, CAST(m AS integer) AS month, count(*) AS rows,
  min(date) AS date_min, max(date) AS date_max
FROM (SELECT exchange, date, year(date) AS y, month(date) AS m FROM bars)
GROUP BY GROUPING SETS ((exchange), (exchange, y, m))"""),
    ),
    "partition_manifest": (
        lambda spark, d: q.partition_statistics(a.bars(spark, d)),
        a.with_sql(select=f"""
SELECT {_MONTH}, count(*) AS row_count, min(date) AS min_date, max(date) AS max_date,
  count(DISTINCT symbol) AS symbols FROM bars GROUP BY {_GROUP}"""),
    ),
    "null_counts": (
        lambda spark, d: q.null_counts(a.bars_dirty(spark, d)),
        a.with_sql(a.DIRTY_SQL, select=" UNION ALL ".join(
            f"SELECT '{n}' AS column_name, count(*) FILTER (WHERE {n} IS NULL) AS nulls FROM bars_dirty"
            for n in BARS.names
        )),
    ),
    "duplicate_keys": (
        lambda spark, d: q.duplicate_rows(a.bars_dirty(spark, d)),
        a.with_sql(a.DIRTY_SQL, select="""
SELECT CAST(sum(n) AS bigint) AS duplicate_key_count FROM (
  SELECT count(*) AS n FROM bars_dirty GROUP BY date, exchange, isin, series HAVING count(*) > 1)"""),
    ),
    "contract_violations": (
        lambda spark, d: bar_violations(a.bars_dirty(spark, d)),
        a.with_sql(a.DIRTY_SQL, select="SELECT " + ", ".join(
            f"(SELECT count(*) FROM bars_dirty WHERE {n} IS NULL) AS null_{n}" for n in BAR_REQUIRED
        ) + """, (SELECT CAST(sum(n) AS bigint) FROM (
  SELECT count(*) AS n FROM bars_dirty GROUP BY date, exchange, isin, series HAVING count(*) > 1)
) AS duplicate_rows"""),
    ),
    "invalid_ohlc": (
        lambda spark, d: q.invalid_rows(a.bars_dirty(spark, d)),
        a.with_sql(a.DIRTY_SQL, select=f"SELECT {_COUNTERS} FROM bars_dirty"),
    ),
    "partition_audit": (
        partition_audit, a.with_sql(a.DIRTY_SQL, _DUPLICATES, select=_verdict("*", "audited")),
    ),
    "global_audit": (
        global_audit, a.with_sql(a.DIRTY_SQL, _DUPLICATES, _TOTAL, select=_verdict("*", "total")),
    ),
    "audit_verdict": (audit_verdict, a.with_sql(a.DIRTY_SQL, select=f"""
SELECT 'dirty' AS input, count(*) FILTER (WHERE {_INVALID} OR volume < 0 OR turnover < 0 OR isin IS NULL) = 0
  AND count(*) = count(DISTINCT (date, exchange, isin, series)) AS passed FROM bars_dirty
UNION ALL
SELECT 'clean', count(*) FILTER (WHERE {_INVALID} OR volume < 0 OR turnover < 0 OR isin IS NULL) = 0
  AND count(*) = count(DISTINCT (date, exchange, isin, series)) FROM bars""")),
    "missing_weekdays": (
        lambda spark, d: q.missing_weekdays(a.bars(spark, d), ("exchange", "isin")),
        a.with_sql(select="""
SELECT exchange, isin, date FROM (
  SELECT exchange, isin, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS date) AS date
  FROM bars GROUP BY exchange, isin) e
WHERE isodow(date) < 6 AND NOT EXISTS (
  SELECT 1 FROM bars b WHERE b.exchange = e.exchange AND b.isin = e.isin AND b.date = e.date)"""),
    ),
    "expected_weekdays": (expected_weekdays, a.with_sql(select="""
SELECT exchange, isin, count(*) FILTER (WHERE isodow(date) < 6) AS weekdays FROM (
  SELECT exchange, isin, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS date) AS date
  FROM bars GROUP BY exchange, isin) GROUP BY exchange, isin""")),
    "ingest_summary": (ingest_summary, a.with_sql(a.DIRTY_SQL, select="""
SELECT count(*) AS rows, min(date) AS date_min, max(date) AS date_max,
  string_agg(DISTINCT exchange, ',' ORDER BY exchange) AS exchanges, count(DISTINCT symbol) AS symbols,
  count(*) FILTER (WHERE deliverable_qty IS NULL) AS missing_deliverable_qty,
  count(*) FILTER (WHERE delivery_pct IS NULL) AS missing_delivery_pct FROM bars_dirty""")),
}
