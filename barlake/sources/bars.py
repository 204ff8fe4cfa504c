"""Scans over the canonical bar table."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barlake.schema import BAR_REQUIRED, BARS, ContractError, conform, require_columns

_PARTITION_COLUMNS = {"year", "month"}


def month_ordinal(year: Column, month: Column) -> Column:
    """Months since year zero, so that consecutive months differ by one."""
    return year * 12 + month - 1


def _ordinal(day: date) -> int:
    return day.year * 12 + day.month - 1


def months_between(start: date, end: date) -> list[tuple[int, int]]:
    """Inclusive ``(year, month)`` pairs between two dates."""
    if end < start:
        raise ValueError("end must be on or after start")
    return [(n // 12, n % 12 + 1) for n in range(_ordinal(start), _ordinal(end) + 1)]


def date_window(df: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """Rows with ``start <= date <= end``.

    Spark cannot derive partition bounds from a date predicate, so on a monthly table
    the same window is also stated on ``year`` and ``month``: those become partition
    filters, the date predicate reaches the parquet row groups.
    """
    conditions = []
    if start is not None:
        conditions.append(F.col("date") >= F.lit(start))
    if end is not None:
        conditions.append(F.col("date") <= F.lit(end))
    if _PARTITION_COLUMNS <= set(df.columns):
        ordinal = month_ordinal(F.col("year"), F.col("month"))
        if start is not None:
            conditions.append(ordinal >= _ordinal(start))
        if end is not None:
            conditions.append(ordinal <= _ordinal(end))
    return df.where(reduce(Column.__and__, conditions)) if conditions else df


def _membership(df: DataFrame, **choices: Iterable[str] | str | None) -> DataFrame:
    for name, values in choices.items():
        if isinstance(values, str):
            values = [values]
        if values:
            df = df.where(F.col(name).isin(list(values)))
    return df


def filter_bars(
    bars: DataFrame,
    *,
    start: date | None = None,
    end: date | None = None,
    exchanges: Iterable[str] | str | None = None,
    symbols: Iterable[str] | str | None = None,
    series: Iterable[str] | str | None = None,
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """Filter on the window and memberships, then project to the requested columns."""
    wanted = list(columns) if columns is not None else BARS.names
    unknown = [name for name in wanted if name not in BARS.names]
    if unknown:
        raise ContractError(f"unsupported bar columns: {unknown}")
    require_columns(bars, BAR_REQUIRED, "bar table")
    rows = _membership(
        date_window(bars, start, end), exchange=exchanges, symbol=symbols, series=series
    )
    return rows.select([F.col(name).cast(BARS[name].dataType).alias(name) for name in wanted])


def scan_bars(spark: SparkSession, path: str | list[str], **filters) -> DataFrame:
    """Read a bar table (a monthly tree or parquet files) with early filters."""
    paths = [path] if isinstance(path, str) else list(path)
    return filter_bars(spark.read.parquet(*paths), **filters)


def scan_paths(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """Read parquet files and folders, searched recursively, as canonical bars."""
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    frame = reader.parquet(*list(paths))
    return conform(require_columns(frame, BAR_REQUIRED, "bar table"), BARS)


def trading_dates(
    bars: DataFrame,
    *,
    start: date | None = None,
    end: date | None = None,
    exchanges: Iterable[str] | str | None = None,
) -> DataFrame:
    """Distinct trading dates, ascending."""
    require_columns(bars, ["date"], "bar table")
    rows = _membership(date_window(bars, start, end), exchange=exchanges)
    return rows.select(F.col("date").cast("date").alias("date")).distinct().orderBy("date")


def present_months(bars: DataFrame) -> DataFrame:
    """Distinct ``(exchange, year, month)`` of a bar table.

    On a monthly tree these are partition columns and no data page is read.
    """
    if not _PARTITION_COLUMNS <= set(bars.columns):
        bars = bars.select("exchange", F.year("date").alias("year"), F.month("date").alias("month"))
    return bars.select("exchange", "year", "month").distinct()


def month_calendar(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One ``(year, month)`` row per month of the window, generated inside Spark."""
    first, last = months_between(start, end)[0], months_between(start, end)[-1]
    ordinals = spark.range(first[0] * 12 + first[1] - 1, last[0] * 12 + last[1])
    return ordinals.select(
        F.floor(F.col("id") / 12).cast("int").alias("year"),
        (F.col("id") % 12 + 1).cast("int").alias("month"),
    )


def missing_months(bars: DataFrame, exchange: str, start: date, end: date) -> DataFrame:
    """Months of the window for which the exchange has no bars."""
    first, last = start.replace(day=1), (end.replace(day=1) + timedelta(days=31)).replace(day=1)
    # Whole months, so that only their partitions are opened.
    asked = date_window(bars, first, last - timedelta(days=1))
    present = present_months(asked.where(F.col("exchange") == exchange))
    return month_calendar(bars.sparkSession, start, end).join(
        present, ["year", "month"], "left_anti"
    )


def scan_month_range(
    bars: DataFrame, exchange: str, start: date, end: date, **filters
) -> DataFrame:
    """Bars of a date window; every month it touches must exist."""
    gaps = sorted((r.year, r.month) for r in missing_months(bars, exchange, start, end).collect())
    if gaps:
        raise FileNotFoundError(f"exchange={exchange} has no bars for months {gaps}")
    return filter_bars(bars, start=start, end=end, exchanges=exchange, **filters)


def scan_month(
    bars: DataFrame, exchange: str, year: int, month: int, as_of: date | None = None, **filters
) -> DataFrame:
    """Bars of one month, up to ``as_of`` (the month end when not given)."""
    first = date(year, month, 1)
    last = (first + timedelta(days=31)).replace(day=1) - timedelta(days=1)
    rows = filter_bars(bars, start=first, end=last, exchanges=exchange, **filters)
    if date_window(bars, first, last).where(F.col("exchange") == exchange).isEmpty():
        raise FileNotFoundError(f"exchange={exchange} has no bars for {year}-{month:02d}")
    return rows if as_of is None else rows.where(F.col("date") <= F.lit(as_of))


def scan_history(bars: DataFrame, exchange: str, end: date, **filters) -> DataFrame:
    """All bars of an exchange up to ``end``; at least one month must exist."""
    month_end = (end.replace(day=1) + timedelta(days=31)).replace(day=1) - timedelta(days=1)
    if date_window(bars, None, month_end).where(F.col("exchange") == exchange).isEmpty():
        raise FileNotFoundError(f"exchange={exchange} has no bars up to {end}")
    return filter_bars(bars, end=end, exchanges=exchange, **filters)


def scan_for_strategies(
    bars: DataFrame, exchange: str, as_of: date, lookbacks: list[int | None], **filters
) -> DataFrame:
    """The longest declared look-back, or all history when a strategy declares none."""
    if lookbacks and all(days is not None for days in lookbacks):
        start = as_of - timedelta(days=max(lookbacks))
        return scan_month_range(bars, exchange, start, as_of, **filters)
    return scan_history(bars, exchange, as_of, **filters)


def point_in_time(
    frame: DataFrame,
    *,
    exchange: str | None = None,
    as_of: date | None = None,
    start: date | None = None,
    lookback_days: int | None = None,
    symbols: Iterable[str] | None = None,
    series: Iterable[str] | str | None = None,
) -> DataFrame:
    """What was known at ``as_of``, optionally within a calendar-day look-back."""
    if lookback_days is not None:
        if as_of is None:
            raise ValueError("lookback_days requires as_of")
        horizon = as_of - timedelta(days=lookback_days)
        start = horizon if start is None else max(start, horizon)
    rows = date_window(frame, start, as_of)
    return _membership(rows, exchange=exchange, symbol=symbols, series=series)
