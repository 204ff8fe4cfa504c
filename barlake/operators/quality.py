"""Audit of the bar table: counts, keys, prices, calendars."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from barlake.functions.dates import days_between, is_weekday
from barlake.schema import (
    BAR_KEY,
    BAR_REQUIRED,
    BARS,
    MONTH_KEY,
    add_month_columns,
    conform,
)


def _rows_where(condition: Column) -> Column:
    return F.coalesce(F.sum(F.coalesce(condition, F.lit(False)).cast("bigint")), F.lit(0))


def invalid_ohlc() -> Column:
    """High below low, or any negative price."""
    negative = [F.col(name) < 0 for name in ("open", "high", "low", "close")]
    # OR of conditions that may be NULL: true wins, NULL alone counts as valid.
    return F.coalesce(
        reduce(Column.__or__, negative, F.col("high") < F.col("low")), F.lit(False)
    )


def _row_counters() -> dict[str, Column]:
    return {
        "invalid_ohlc_count": _rows_where(invalid_ohlc()),
        "negative_volume_count": _rows_where(F.col("volume") < 0),
        "negative_turnover_count": _rows_where(F.col("turnover") < 0),
    }


def _null_counters() -> dict[str, Column]:
    return {f"null_{name}": _rows_where(F.col(name).isNull()) for name in BARS.names}


def _aliased(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def null_counts(bars: DataFrame) -> DataFrame:
    """NULLs per column, one row per column, from one aggregation."""
    counts = bars.agg(*_aliased(_null_counters()))
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("column_name"), F.col(f"null_{name}").alias("nulls"))
            for name in BARS.names
        ]
    )
    return counts.select(F.inline(pairs))


def invalid_rows(bars: DataFrame) -> DataFrame:
    """One row: invalid prices, negative volumes, negative turnovers."""
    return bars.agg(*_aliased(_row_counters()))


def duplicate_rows(bars: DataFrame, per: tuple[str, ...] = (), tasks: int | None = None) -> DataFrame:
    """Rows that share their key with another row, in total or per group; ``tasks`` fixes how many count them."""
    if tasks:
        bars = bars.select(*per, *BAR_KEY).repartition(tasks, *BAR_KEY)
    repeated = bars.groupBy(*per, *BAR_KEY).count().where(F.col("count") > 1)
    total = F.coalesce(F.sum("count"), F.lit(0)).alias("duplicate_key_count")
    return repeated.groupBy(*per).agg(total) if per else repeated.agg(total)


def partition_counts(bars: DataFrame) -> DataFrame:
    return add_month_columns(bars).groupBy(*MONTH_KEY).agg(F.count("*").alias("rows"))


def exchange_summary(bars: DataFrame) -> DataFrame:
    """Rows, date range and distinct symbols per exchange."""
    return bars.groupBy("exchange").agg(
        F.count("*").alias("rows"),
        F.min("date").alias("date_min"),
        F.max("date").alias("date_max"),
        F.countDistinct("symbol").alias("symbols"),
    )


def coverage_summary(bars: DataFrame) -> DataFrame:
    """Rows and date range per exchange and per month, in one pass.

    ``year`` and ``month`` are NULL on the exchange rows.
    """
    months = add_month_columns(bars).groupBy(*MONTH_KEY).agg(
        F.count("*").alias("rows"),
        F.min("date").alias("date_min"),
        F.max("date").alias("date_max"),
    )
    sets = [["exchange"], list(MONTH_KEY)]
    columns = [F.col(name) for name in MONTH_KEY]
    return months.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(
        F.sum("rows").alias("rows"),
        F.min("date_min").alias("date_min"),
        F.max("date_max").alias("date_max"),
    )


def partition_audit(bars: DataFrame, *, schema_checked: bool = True, tasks: int | None = None) -> DataFrame:
    """The audit of every month: counters, NULLs per column, duplicates, verdict.

    Counters are pre-aggregated per (month, symbol) for the distinct symbols and the
    key shuffle carries keys only. Duplicates are counted across all files of a month. With ``tasks``, which
    fixes how many count the keys, ``bars`` are a table that may be read more often: symbols are then counted apart, and
    the counters need no shuffle but a row per month.
    """
    rows = add_month_columns(conform(bars, BARS, lenient=True))
    ends = [F.count("*").alias("rows"), F.min("date").alias("date_min"), F.max("date").alias("date_max")]
    symbols = F.countDistinct("symbol").alias("symbols")
    counters = [*_aliased(_row_counters()), *_aliased(_null_counters())]
    # Months come from the data, so a NULL exchange or date must match itself.
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in MONTH_KEY]

    def with_months(measured: DataFrame, told: DataFrame) -> DataFrame:
        renamed = told.withColumnsRenamed({name: f"_{name}" for name in MONTH_KEY})
        return measured.join(renamed, same, "left").drop(*[f"_{name}" for name in MONTH_KEY])

    months = rows.groupBy(*MONTH_KEY)
    if tasks:
        measured = with_months(months.agg(*ends, *counters), months.agg(symbols))
        order = [*MONTH_KEY, "rows", "date_min", "date_max", "symbols"]
        measured = measured.select(*order, *[name for name in measured.columns if name not in order])
    else:
        measured = months.agg(*ends, symbols, *counters)
    audited = with_months(measured, duplicate_rows(rows, MONTH_KEY, tasks))
    audited = audited.fillna(0, ["duplicate_key_count"])
    return with_verdict(audited, schema_checked)


def with_verdict(audit: DataFrame, schema_ok: bool = True) -> DataFrame:
    """Add the required columns that hold NULLs and whether the audit passed."""
    null_columns = F.array_compact(
        F.array(*[F.when(F.col(f"null_{name}") > 0, name) for name in BAR_REQUIRED])
    )
    defects = (
        F.col("duplicate_key_count") + F.col("invalid_ohlc_count")
        + F.col("negative_volume_count") + F.col("negative_turnover_count")
    )
    audit = audit.withColumn("required_null_columns", null_columns)
    passed = (F.size("required_null_columns") == 0) & (defects == 0) & F.lit(schema_ok)
    return audit.withColumn("passed", passed)


def schema_deviations(bars: DataFrame) -> tuple[list[str], list[str]]:
    """Missing and unexpected columns, partition columns aside."""
    names = [name for name in bars.columns if name not in ("year", "month")]
    missing = [name for name in BARS.names if name not in names]
    return missing, [name for name in names if name not in BARS.names]


def misplaced_rows(table: DataFrame) -> DataFrame:
    """Rows of a monthly table whose folder is not that of their date."""
    here = (F.col("year") == F.year("date")) & (F.col("month") == F.month("date"))
    return table.where(~F.coalesce(here, F.lit(False))).select("exchange", "year", "month", "date")


def global_audit(partitions: DataFrame, bars: DataFrame) -> DataFrame:
    """One row for the whole table, rolled up from the monthly audit.

    A key includes date and exchange, so the monthly counts of repeated keys, which are taken
    over all files, add up to those of the table.
    """
    missing, unexpected = schema_deviations(bars)
    summed = [
        "rows", "duplicate_key_count", "invalid_ohlc_count", "negative_volume_count",
        "negative_turnover_count", *[f"null_{name}" for name in BARS.names],
    ]
    total = partitions.agg(
        F.count("*").alias("partitions"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in summed],
    )
    return with_verdict(total, not missing and not unexpected).withColumns(
        {
            "missing_columns": F.array(*map(F.lit, missing)).cast("array<string>"),
            "unexpected_columns": F.array(*map(F.lit, unexpected)).cast("array<string>"),
        }
    )


def missing_weekdays(bars: DataFrame, per: tuple[str, ...] = ("exchange",)) -> DataFrame:
    """Weekdays without bars between the first and last date of each group.

    One pass: a group's dates are gathered as a set, map-side, which the calendar bounds.
    """
    seen = bars.groupBy(*per).agg(
        F.min("date").alias("_lo"), F.max("date").alias("_hi"), F.collect_set("date").alias("_dates")
    )
    expected = F.filter(days_between(F.col("_lo"), F.col("_hi")), is_weekday)
    return seen.select(*per, F.explode(F.array_except(expected, "_dates")).alias("date"))


def expected_weekdays(spans: DataFrame, per: tuple[str, ...] = ("exchange",)) -> DataFrame:
    """Number of weekdays between ``start`` and ``end`` of each row."""
    days = F.filter(days_between(F.col("start"), F.col("end")), is_weekday)
    return spans.select(*per, F.coalesce(F.size(days), F.lit(0)).cast("bigint").alias("weekdays"))


def ingest_summary(bars: DataFrame) -> DataFrame:
    """One row describing an ingest. A NULL symbol counts as one symbol."""
    symbol_is_null = F.max(F.col("symbol").isNull().cast("int"))
    return bars.agg(
        F.count("*").alias("rows"),
        F.min("date").alias("date_min"),
        F.max("date").alias("date_max"),
        F.array_sort(F.collect_set("exchange")).alias("exchanges"),
        (F.countDistinct("symbol") + F.coalesce(symbol_is_null, F.lit(0))).alias("symbols"),
        _rows_where(F.col("deliverable_qty").isNull()).alias("missing_deliverable_qty"),
        _rows_where(F.col("delivery_pct").isNull()).alias("missing_delivery_pct"),
    )


def partition_statistics(bars: DataFrame) -> DataFrame:
    """Rows, date range and distinct symbols of each month."""
    return add_month_columns(bars).groupBy(*MONTH_KEY).agg(
        F.count("*").alias("row_count"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.countDistinct("symbol").alias("symbols"),
    )
