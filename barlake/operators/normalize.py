"""From raw fields to canonical bars, with the checks that gate them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from barlake.functions.dates import parse_trade_date
from barlake.schema import (
    BAR_KEY,
    BAR_REQUIRED,
    BARS,
    ContractError,
    conform,
    exchange_code,
    require_columns,
)

# Keys that one task counts.
KEYS_PER_TASK = 500_000


def vwap(source: Column, turnover: Column, volume: Column) -> Column:
    """The source's own average price, else turnover / volume (NULL at zero volume)."""
    return F.coalesce(source, F.try_divide(turnover, volume.cast("double")))


def _text(name: str) -> Column:
    return F.nullif(F.trim(F.col(name)), F.lit(""))


def _number(name: str) -> Column:
    return _text(name).try_cast("double")


def _whole(name: str) -> Column:
    """Integer text; also accepts ``1000.0``, as exchanges write both."""
    return F.coalesce(_text(name).try_cast("bigint"), _number(name).try_cast("bigint"))


_NUMERIC = (
    "open", "high", "low", "close", "prev_close", "vwap", "volume", "turnover", "trades",
    "deliverable_qty", "delivery_pct",
)


def _unreadable() -> Column:
    """Whether any numeric field holds text that is not a number."""
    return reduce(
        Column.__or__,
        [_text(name).isNotNull() & _number(name).isNull() for name in _NUMERIC],
    )


# Columns of unadjusted bars that repeat others.
UNADJUSTED = ("adj_open", "adj_high", "adj_low", "adj_close", "adj_factor")


def with_unadjusted(rows: DataFrame) -> DataFrame:
    """Bars with ``adj_*`` columns that repeat the raw prices, with factor 1."""
    repeated = {f"adj_{name}": F.col(name) for name in ("open", "high", "low", "close")}
    whole = rows.withColumns(repeated | {"adj_factor": F.lit(1.0)})
    return whole.select(*BARS.names, *[name for name in rows.columns if name not in BARS.names])


def normalize_fields(rows: DataFrame, exchange: str) -> DataFrame:
    """Named text fields to canonical bars, with ``path`` and ``unreadable``.

    Prices are not adjusted: ``adj_*`` repeat the raw prices with factor 1. A field that
    is not a number becomes NULL and marks its row ``unreadable``.
    """
    close, volume, turnover = _number("close"), _whole("volume"), _number("turnover")
    prices = {name: _number(name) for name in ("open", "high", "low")}
    canonical = {
        "date": F.coalesce(parse_trade_date(F.col("date")), F.col("file_date")),
        "exchange": F.lit(exchange_code(exchange)),
        "isin": F.col("isin"),
        "symbol": F.col("symbol"),
        "series": F.col("series"),
        **prices,
        "close": close,
        "prev_close": _number("prev_close"),
        "vwap": vwap(_number("vwap"), turnover, volume),
        "volume": volume,
        "turnover": turnover,
        "trades": _whole("trades"),
        "deliverable_qty": _whole("deliverable_qty"),
        "delivery_pct": _number("delivery_pct"),
    }
    return with_unadjusted(
        rows.select(*[value.alias(name) for name, value in canonical.items()], "path", _unreadable().alias("unreadable"))
    )


def is_complete() -> Column:
    """Whether a bar has everything that identifies and prices it."""
    needed = ("date", "isin", "symbol", "close", "volume")
    condition = F.lit(True)
    for name in needed:
        condition &= F.col(name).isNotNull()
    return condition


def drop_variant_symbols(bars: DataFrame) -> DataFrame:
    """Drop ``SYM#`` rows whose key also has a row without ``#``.

    Variants are a thin slice of the rows: plain keys are first cut down to theirs, which
    lets adaptive execution copy the thin side; plain rows pass straight through.
    """
    variant = F.coalesce(F.col("symbol").endswith("#"), F.lit(False))
    plain, thin = bars.where(~variant), bars.where(variant)
    shadowed = plain.select(*BAR_KEY).join(thin.select(*BAR_KEY).distinct(), list(BAR_KEY), "left_semi")
    return plain.unionByName(thin.join(shadowed.distinct(), list(BAR_KEY), "left_anti"))


def usable_rows(strict: bool = True) -> Column:
    """Rows that may become bars; ``strict`` also refuses unreadable numbers."""
    return is_complete() & ~F.col("unreadable") if strict else is_complete()


def distinct_bars(bars: DataFrame) -> DataFrame:
    """Canonical projection with repeated full rows removed."""
    return conform(bars, BARS).distinct()


def bar_violations(bars: DataFrame) -> DataFrame:
    """One row: NULL counts of the required columns and rows with a repeated key.

    NULLs are summed per key first, so the table is aggregated once and the key
    shuffle carries a handful of counters.
    """
    require_columns(bars, BARS.names, "canonical bars")
    nulls = [
        F.sum(F.col(name).isNull().cast("bigint")).alias(f"null_{name}") for name in BAR_REQUIRED
    ]
    per_key = bars.groupBy(*BAR_KEY).agg(F.count("*").alias("_rows"), *nulls)
    return per_key.agg(
        *[
            F.coalesce(F.sum(f"null_{name}"), F.lit(0)).alias(f"null_{name}")
            for name in BAR_REQUIRED
        ],
        F.coalesce(F.sum(F.when(F.col("_rows") > 1, F.col("_rows"))), F.lit(0)).alias(
            "duplicate_rows"
        ),
    )


def key_tasks(rows: int) -> int:
    """Tasks that rows are dealt to by key. Keys of sorted files shrink to a few bytes, so tasks made by their
    bytes, as adaptive execution makes them, would hold millions."""
    return -(-rows // KEYS_PER_TASK) or 1


def assert_bars(bars: DataFrame) -> DataFrame:
    """Fail unless required columns are non-null and the key is unique.

    NULLs need no shuffle, and tell how many tasks the keys are dealt to.
    """
    require_columns(bars, BARS.names, "canonical bars")
    counters = [F.count_if(F.col(name).isNull()).alias(name) for name in BAR_REQUIRED]
    counts = bars.agg(F.count("*").alias("_rows"), *counters).first()
    nulls = [name for name in BAR_REQUIRED if counts[name]]
    if nulls:
        raise ContractError(f"bars have null values in required columns: {nulls}")
    keys = bars.select(*BAR_KEY).repartition(key_tasks(counts["_rows"]), *BAR_KEY)
    repeated = keys.groupBy(*BAR_KEY).count().where("count > 1").agg(F.sum("count").alias("rows")).first()["rows"]
    if repeated:
        raise ContractError(f"bars have {repeated} rows with a duplicate date/exchange/isin/series key")
    return bars
