"""Scans, dates and formats."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from barlake.functions.dates import date_in_filename, parse_trade_date
from barlake.operators.asof import latest_as_of, lookback_slices
from barlake.operators.normalize import distinct_bars, drop_variant_symbols, vwap
from barlake.queries import adapter as a
from barlake.schema import add_month_columns, month_path
from barlake.session import scratch_dir
from barlake.sources import bars as scans
from barlake.sources import formats as fmt

_KEYS = ["date", "exchange", "isin", "symbol"]


def scan_filtered(spark, sf_dir):
    return scans.filter_bars(
        a.bars(spark, sf_dir), start=date(1996, 1, 1), end=date(1999, 6, 30), exchanges=["NSE"],
        symbols=["S00001", "S00002", "S00007"], columns=[*_KEYS, "adj_close", "volume"],
    )


def trading_dates(spark, sf_dir):
    return scans.trading_dates(
        a.bars(spark, sf_dir), start=date(1996, 1, 1), end=date(1999, 6, 30), exchanges="BSE"
    )


def month_range_scan(spark, sf_dir):
    return scans.scan_month_range(
        a.bars(spark, sf_dir), "NSE", date(1996, 3, 15), date(1997, 2, 10),
        columns=[*_KEYS, "close"],
    )


def single_month_scan(spark, sf_dir):
    return scans.scan_month(
        a.bars(spark, sf_dir), "BSE", 1998, 2, as_of=date(1998, 2, 20), columns=[*_KEYS, "close"]
    )


def history_scan(spark, sf_dir):
    return scans.scan_history(
        a.bars(spark, sf_dir), "NSE", date(1999, 8, 13), columns=[*_KEYS, "close"]
    )


def bounded_history_scan(spark, sf_dir):
    return scans.scan_for_strategies(
        a.bars(spark, sf_dir), "NSE", date(1999, 8, 13), [30, 120, 0], columns=[*_KEYS, "close"]
    )


def missing_months(spark, sf_dir):
    present = a.bars(spark, sf_dir).where(F.month("date") % 5 != 0)
    return scans.missing_months(present, "NSE", date(1994, 11, 1), date(2001, 6, 30))


def point_in_time_slice(spark, sf_dir):
    rows = scans.point_in_time(
        a.bars_multi(spark, sf_dir), exchange="BSE", as_of=date(1998, 6, 30), lookback_days=90,
        series=["EQ"],
    )
    return rows.select(*_KEYS, "series", "adj_close")


def _month_ends(spark, sf_dir):
    dates = a.bars(spark, sf_dir).select("date").distinct()
    return dates.groupBy(F.trunc("date", "month")).agg(F.max("date").alias("as_of")).select("as_of")


def latest_per_date(spark, sf_dir):
    latest = latest_as_of(
        a.bars_multi(spark, sf_dir), _month_ends(spark, sf_dir), keys=("exchange", "symbol")
    )
    return latest.select("as_of", "exchange", "symbol", "isin", "series", "date", "adj_close")


def lookback(spark, sf_dir):
    slices = lookback_slices(a.bars(spark, sf_dir), _month_ends(spark, sf_dir), 30)
    return slices.groupBy("as_of", "exchange").agg(
        F.count("*").alias("rows"), F.min("date").alias("first_date"),
        F.max("adj_close").alias("high_close"),
    )


def month_derivation(spark, sf_dir):
    rows = add_month_columns(a.bars(spark, sf_dir).select("date", "exchange").distinct())
    path = month_path(F.col("exchange"), F.col("year"), F.col("month"))
    return rows.withColumn("path", path)


def _raw_dates(spark, sf_dir):
    day = F.col("date")
    texts = F.array(
        F.date_format(day, "yyyy-MM-dd"), F.upper(F.date_format(day, "dd-MMM-yyyy")),
        F.upper(F.date_format(day, "d-MMM-yyyy")), F.upper(F.date_format(day, "dd-MMM-yy")),
        F.concat(F.lit("x"), F.date_format(day, "ddMMyyyy")),
    )
    dated = a.bars(spark, sf_dir).select("date").distinct()
    return dated.select("date", F.explode(texts).alias("text"))


def date_parse(spark, sf_dir):
    rows = _raw_dates(spark, sf_dir)
    return rows.select("date", "text", parse_trade_date(F.col("text")).alias("parsed"))


_DATE_PARSE = a.with_sql(
    """
raw_dates AS (
  SELECT date, unnest([strftime(date, '%Y-%m-%d'), upper(strftime(date, '%d-%b-%Y')),
    CAST(day(date) AS varchar) || upper(strftime(date, '-%b-%Y')), upper(strftime(date, '%d-%b-%y')),
    'x' || strftime(date, '%d%m%Y')]) AS text
  FROM (SELECT DISTINCT date FROM bars)
)""",
    select="""
SELECT date, text, CASE
  WHEN text LIKE 'x%' THEN NULL
  WHEN text SIMILAR TO '[0-9]{4}-.*' THEN CAST(text AS date)
  WHEN text SIMILAR TO '.*-[0-9]{4}' THEN date
  ELSE CAST('20' || right(text, 2) || strftime(date, '-%m-%d') AS date) END AS parsed
FROM raw_dates""",
)


def format_lookup(spark, sf_dir):
    found = fmt.format_on_date(a.days(spark, sf_dir), fmt.formats(spark))
    return found.select("exchange", "date", "format_id", "parser")


_FORMAT_CASE = """
formatted AS (
  SELECT exchange, date, CASE
    WHEN exchange = 'NSE' AND date BETWEEN '1994-01-01' AND '2024-07-07' THEN 'nse_legacy_cm'
    WHEN exchange = 'NSE' AND date >= '2024-07-08' THEN 'nse_udiff_cm'
    WHEN exchange = 'BSE' AND date BETWEEN '2007-01-01' AND '2024-07-29' THEN 'bse_legacy_equity'
    WHEN exchange = 'BSE' AND date >= '2024-07-30' THEN 'bse_udiff_cm' END AS parser
  FROM days
), named AS (
  SELECT *, parser || '_bhavcopy_v1' AS format_id, CASE parser
    WHEN 'nse_legacy_cm' THEN 'cm' || upper(strftime(date, '%d%b%Y')) || 'bhav.csv.zip'
    WHEN 'nse_udiff_cm' THEN 'BhavCopy_NSE_CM_0_0_0_' || strftime(date, '%Y%m%d') || '_F_0000.csv.zip'
    WHEN 'bse_legacy_equity' THEN 'EQ' || strftime(date, '%d%m%y') || '_CSV.ZIP'
    WHEN 'bse_udiff_cm' THEN 'BhavCopy_BSE_CM_0_0_0_' || strftime(date, '%Y%m%d') || '_F_0000.CSV'
    END AS filename
  FROM formatted
)"""


def expected_files(spark, sf_dir):
    files = fmt.expected_files(a.days(spark, sf_dir), fmt.formats(spark))
    return files.select(
        "exchange", "date", "expected_format_id", "expected_filename",
        F.element_at("expected_urls", 1).alias("expected_url_primary"),
        F.size("expected_urls").cast("bigint").alias("urls"), "parser_hint",
    )


def filename_date(spark, sf_dir):
    files = fmt.expected_files(a.days(spark, sf_dir), fmt.formats(spark))
    name = F.col("expected_filename")
    return files.select("exchange", name.alias("filename"), date_in_filename(name).alias("date"))


def vwap_fallback(spark, sf_dir):
    source = F.when(F.col("volume") % 2 == 0, F.col("close"))
    price = vwap(source, F.col("turnover"), F.col("volume"))
    return a.bars(spark, sf_dir).select(*_KEYS, price.alias("vwap"))


def variant_symbol_drop(spark, sf_dir):
    # The drop reads its rows four times: they are derived once.
    path = scratch_dir(spark, "bars")
    a.bars_hash(spark, sf_dir).select(*_KEYS, "series", "close").write.parquet(path)
    return drop_variant_symbols(spark.read.parquet(path)).select(*_KEYS, "series", "close")


def canonical_dedupe(spark, sf_dir):
    rows = a.bars(spark, sf_dir)
    again = rows.where(F.col("volume") % 4 == 0)
    return distinct_bars(rows.unionByName(again)).select(*_KEYS, "close", "volume", "trades")


_MONTH_ENDS = """
month_ends AS (
  SELECT max(date) AS as_of FROM (SELECT DISTINCT date FROM bars)
  GROUP BY year(date), month(date)
)"""

SCAN_QUERIES = {
    "scan_filtered": (scan_filtered, a.with_sql(select="""
SELECT date, exchange, isin, symbol, adj_close, volume FROM bars
WHERE date BETWEEN '1996-01-01' AND '1999-06-30' AND exchange = 'NSE'
  AND symbol IN ('S00001', 'S00002', 'S00007')""")),
    "trading_dates": (trading_dates, a.with_sql(select="""
SELECT DISTINCT date FROM bars
WHERE date BETWEEN '1996-01-01' AND '1999-06-30' AND exchange = 'BSE'""")),
    "month_range_scan": (month_range_scan, a.with_sql(select="""
SELECT date, exchange, isin, symbol, close FROM bars
WHERE date BETWEEN '1996-03-15' AND '1997-02-10' AND exchange = 'NSE'""")),
    "single_month_scan": (single_month_scan, a.with_sql(select="""
SELECT date, exchange, isin, symbol, close FROM bars
WHERE date BETWEEN '1998-02-01' AND '1998-02-20' AND exchange = 'BSE'""")),
    "history_scan": (history_scan, a.with_sql(select="""
SELECT date, exchange, isin, symbol, close FROM bars
WHERE date <= '1999-08-13' AND exchange = 'NSE'""")),
    "bounded_history_scan": (bounded_history_scan, a.with_sql(select="""
SELECT date, exchange, isin, symbol, close FROM bars
WHERE date BETWEEN CAST('1999-08-13' AS date) - 120 AND '1999-08-13' AND exchange = 'NSE'""")),
    "missing_months": (missing_months, a.with_sql(select="""
SELECT CAST(year(m) AS integer) AS year, CAST(month(m) AS integer) AS month
FROM (SELECT unnest(generate_series(DATE '1994-11-01', DATE '2001-06-01', INTERVAL 1 MONTH)) AS m)
WHERE (year(m), month(m)) NOT IN (
  SELECT DISTINCT (year(date), month(date)) FROM bars WHERE exchange = 'NSE' AND month(date) % 5 <> 0)""")),
    "month_derivation": (month_derivation, a.with_sql(select="""
SELECT DISTINCT date, exchange, CAST(year(date) AS integer) AS year, CAST(month(date) AS integer) AS month,
  'exchange=' || exchange || '/year=' || CAST(year(date) AS varchar) || '/month=' || strftime(date, '%m') AS path
FROM bars""")),
    "point_in_time_slice": (point_in_time_slice, a.with_sql(a.MULTI_SQL, select="""
SELECT date, exchange, isin, symbol, series, adj_close FROM bars_multi
WHERE exchange = 'BSE' AND series = 'EQ' AND date BETWEEN DATE '1998-06-30' - 90 AND '1998-06-30'""")),
    "latest_as_of": (latest_per_date, a.with_sql(a.MULTI_SQL, _MONTH_ENDS, select="""
SELECT as_of, exchange, symbol, isin, series, date, adj_close FROM (
  SELECT m.as_of, b.*, row_number() OVER (
    PARTITION BY m.as_of, b.exchange, b.symbol ORDER BY b.date DESC, b.series DESC, b.isin DESC) AS rn
  FROM month_ends m JOIN bars_multi b ON b.date <= m.as_of) WHERE rn = 1""")),
    "lookback_slices": (lookback, a.with_sql(_MONTH_ENDS, select="""
SELECT as_of, exchange, count(*) AS rows, min(date) AS first_date, max(adj_close) AS high_close
FROM month_ends JOIN bars ON date BETWEEN as_of - 30 AND as_of GROUP BY as_of, exchange""")),
    "date_parse": (date_parse, _DATE_PARSE),
    "format_lookup": (format_lookup, a.with_sql(a.DAYS_SQL, _FORMAT_CASE, select="""
SELECT exchange, date, format_id, parser FROM named""")),
    "expected_files": (expected_files, a.with_sql(a.DAYS_SQL, _FORMAT_CASE, select="""
SELECT exchange, date, format_id AS expected_format_id, filename AS expected_filename,
  CASE parser
    WHEN 'nse_legacy_cm' THEN 'https://archives.nseindia.com/content/historical/EQUITIES/'
      || upper(strftime(date, '%Y/%b/')) || filename
    WHEN 'nse_udiff_cm' THEN 'https://archives.nseindia.com/content/cm/' || filename
    ELSE 'https://www.bseindia.com/download/BhavCopy/Equity/' || filename END AS expected_url_primary,
  CAST(CASE parser WHEN 'nse_legacy_cm' THEN 2 ELSE 1 END AS bigint) AS urls, parser AS parser_hint
FROM named""")),
    "filename_date": (filename_date, a.with_sql(a.DAYS_SQL, _FORMAT_CASE, select="""
SELECT exchange, filename, date FROM named""")),
    "vwap": (vwap_fallback, a.with_sql(select="""
SELECT date, exchange, isin, symbol,
  CASE WHEN volume % 2 = 0 THEN close ELSE turnover / volume END AS vwap FROM bars""")),
    "variant_symbol_drop": (variant_symbol_drop, a.with_sql(a.HASH_SQL, select="""
SELECT date, exchange, isin, symbol, series, close FROM (
  SELECT *, bool_or(symbol NOT LIKE '%#') OVER (PARTITION BY date, exchange, isin, series) AS has_plain
  FROM bars_hash)
WHERE NOT (symbol LIKE '%#' AND has_plain)""")),
    "canonical_dedupe": (canonical_dedupe, a.with_sql(select="""
SELECT DISTINCT date, exchange, isin, symbol, close, volume, trades
FROM (SELECT * FROM bars UNION ALL SELECT * FROM bars WHERE volume % 4 = 0)""")),
}
