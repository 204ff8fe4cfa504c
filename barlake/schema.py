"""Declared schemas, keys and value domains of every table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T


class ContractError(ValueError):
    """A table breaks its declared schema or its key."""


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_date, _text, _double, _long, _int = (
    T.DateType(),
    T.StringType(),
    T.DoubleType(),
    T.LongType(),
    T.IntegerType(),
)

# Table schemas, in column order.
BARS = _struct(
    date=_date, exchange=_text, isin=_text, symbol=_text, series=_text,
    open=_double, high=_double, low=_double, close=_double, prev_close=_double,
    vwap=_double, volume=_long, turnover=_double, trades=_long,
    deliverable_qty=_long, delivery_pct=_double,
    adj_open=_double, adj_high=_double, adj_low=_double, adj_close=_double,
    adj_factor=_double,
)
DECISIONS = _struct(
    date=_date, strategy_id=_text, exchange=_text, isin=_text, symbol=_text,
    target_weight=_double, rank=_long, score=_double,
)
FETCH_MANIFEST = _struct(
    exchange=_text, date=_date, expected_format_id=_text, expected_filename=_text,
    expected_url_primary=_text, local_path=_text, status=_text, http_status=_long,
    bytes=_long, sha256=_text, attempts=_long, last_attempt_at=T.TimestampType(),
    last_error=_text, parser_hint=_text,
)
PARTITION_MANIFEST = _struct(
    exchange=_text, year=_int, month=_int, partition_path=_text, row_count=_long,
    min_date=_date, max_date=_date, symbols=_long, file_size_bytes=_long, md5=_text,
    source_raw_count=_long, source_raw_files=T.ArrayType(_text),
    source_md5s=T.ArrayType(_text), format_ids=T.ArrayType(_text),
    parser_versions=_text, created_at=T.TimestampType(), verified_at=T.TimestampType(),
    status=_text,
)
PERFORMANCE = _struct(
    date=_date, strategy_id=_text, decision_kind=_text, daily_return=_double,
    invested_weight=_double, cash_weight=_double, cumulative_multiple=_double,
    drawdown=_double,
)

# Keys, required columns and domains.
BAR_KEY = ("date", "exchange", "isin", "series")
BAR_ORDER = ("date", "exchange", "symbol", "isin", "series")
BAR_REQUIRED = ("date", "exchange", "isin", "symbol", "series", "close", "adj_close", "volume")
DECISION_KEY = ("date", "strategy_id", "exchange", "isin", "symbol")
DECISION_ORDER = ("date", "strategy_id", "rank", "symbol")
REGISTRY_REQUIRED = ("strategy_id", "version", "status")
MONTH_KEY = ("exchange", "year", "month")
EXCHANGES = ("NSE", "BSE")
FETCH_STATUSES = (
    "expected", "downloaded", "skipped_existing", "not_available",
    "holiday_or_no_session", "rate_limited", "failed", "corrupt_html",
    "parse_failed", "validated", "missing",
)
USABLE_STATUSES = ("downloaded", "skipped_existing", "validated")
UNRESOLVED_STATUSES = ("expected", "missing", "failed", "rate_limited")


def require_columns(df: DataFrame, columns, what: str) -> DataFrame:
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ContractError(f"{what} is missing columns: {missing}")
    return df


def conform(df: DataFrame, schema: T.StructType, *, lenient: bool = False) -> DataFrame:
    """Project to ``schema``; ``lenient`` turns unconvertible values into NULL."""
    cast = Column.try_cast if lenient else Column.cast
    return df.select([cast(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields])


def exchange_code(exchange: str) -> str:
    code = exchange.upper()
    if code not in EXCHANGES:
        raise ContractError(f"unsupported exchange: {exchange}")
    return code


def add_month_columns(df: DataFrame, on: str = "date") -> DataFrame:
    """Add the integer ``year`` and ``month`` of the partition a bar belongs to."""
    return df.withColumns({"year": F.year(on), "month": F.month(on)})


def month_path(exchange: Column, year: Column, month: Column) -> Column:
    """``exchange=X/year=YYYY/month=MM`` with a two-digit month."""
    return F.format_string(
        "exchange=%s/year=%d/month=%s", exchange, year, F.lpad(month.cast("string"), 2, "0")
    )
