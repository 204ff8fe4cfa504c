import sys
from datetime import date
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from barlake.schema import BARS  # noqa: E402
from barlake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    return local_session(8, **{"spark.checkpoint.dir": shared, "spark.sql.maxMetadataStringLength": "10000"})


@pytest.fixture(scope="session")
def make_bars(spark):
    """Bars from ``(date, symbol, price)`` with optional fields per row."""

    def make(rows):
        records = []
        for row in rows:
            day, symbol, price = row[:3]
            extra = row[3] if len(row) > 3 else {}
            record = dict(
                date=day, exchange="NSE", isin=f"INE{symbol}", symbol=symbol, series="EQ",
                open=price, high=price + 1, low=price - 1, close=price, volume=1000,
                turnover=1000.0 * price, trades=10, adj_open=price, adj_high=price + 1,
                adj_low=price - 1, adj_close=price, adj_factor=1.0,
            )
            record.update(extra)
            records.append([record.get(name) for name in BARS.names])
        return spark.createDataFrame(records, BARS)

    return make


@pytest.fixture(scope="session")
def eight_bars(make_bars):
    prices = {"AAA": [100.0, 110.0, 105.0, 106.0], "BBB": [90.0, 95.0, 98.0, 100.0]}
    return make_bars(
        [(date(2026, 1, d + 1), s, p) for s, ps in prices.items() for d, p in enumerate(ps)]
    )
