"""Forward returns of instruments."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from barlake.functions.series import MAX_SERIES_ROWS, ordered, over_series, split_series

_KEYS = ("exchange", "isin")
_ORDER = ("date", "series", "symbol")


def forward_returns(
    bars: DataFrame, *, series: str | None = "EQ", max_rows: int | None = MAX_SERIES_ROWS
) -> DataFrame:
    """Next adjusted close of each instrument and the return to it.

    ``series=None`` lets an instrument's next row be one of another series, with the
    series as tie-break on one date.
    """
    rows = bars if series is None else bars.where(F.col("series") == series)
    rows = rows.select("date", "exchange", "isin", "symbol", "series", "adj_close")
    following = F.lead("adj_close").over(ordered(_KEYS, _ORDER))
    priced = over_series(
        split_series(rows, _KEYS, _ORDER, ahead=1, max_rows=max_rows),
        lambda part: part.withColumn("next_adj_close", following),
    )
    return priced.select(
        "date", "exchange", "isin", "symbol", "series", "adj_close", "next_adj_close",
        (F.try_divide("next_adj_close", "adj_close") - 1).alias("forward_return"),
    )
