from datetime import date

import pytest
from pyspark.sql import functions as F

from barlake.plans.performance import strategy_performance, write_performance
from barlake.schema import DECISIONS


def decisions_of(spark, *rows):
    full = [(d, s, "NSE", f"INE{sym}", sym, w, 1, None) for d, s, sym, w in rows]
    return spark.createDataFrame(full, DECISIONS)


def test_cash_day_and_partial_cash(spark, eight_bars):
    decisions = decisions_of(
        spark, (date(2026, 1, 1), "s", "AAA", 1.0), (date(2026, 1, 3), "s", "BBB", 0.5)
    )
    result = strategy_performance(decisions, eight_bars)
    rows = result.daily.orderBy("date").collect()
    third = 0.5 * (100 / 98 - 1)
    assert [r.date.day for r in rows] == [1, 2, 3]
    assert [r.daily_return for r in rows] == pytest.approx([0.1, 0.0, third])
    assert [r.cash_weight for r in rows] == pytest.approx([0.0, 1.0, 0.5])
    assert [r.cumulative_multiple for r in rows] == pytest.approx([1.1, 1.1, 1.1 * (1 + third)])
    assert [r.drawdown for r in rows] == pytest.approx([0, 0, 0])
    summary = result.summary.first()
    assert (summary.rows, summary.realized_dates, summary.n_realized) == (2, 3, 2)
    assert summary.latest_realized_date == date(2026, 1, 3)
    assert summary.primary_exchange == "NSE"


def test_drawdown_counts_from_one(spark, eight_bars):
    decisions = decisions_of(spark, (date(2026, 1, 2), "s", "AAA", 1.0))
    row = strategy_performance(decisions, eight_bars).daily.first()
    assert row.drawdown == pytest.approx(105 / 110 - 1)


def test_empty_strategies_have_defaults(spark, eight_bars):
    decisions = decisions_of(
        spark, (date(2026, 1, 4), "last_day", "AAA", 1.0), (date(2026, 1, 1), "other", "AAA", 1.0)
    )
    listed = spark.createDataFrame([("last_day",), ("none",)], "strategy_id string")
    result = strategy_performance(decisions, eight_bars, strategies=listed)
    rows = {r.strategy_id: r for r in result.summary.collect()}
    assert set(rows) == {"last_day", "none"}
    for name, count in (("last_day", 1), ("none", 0)):
        row = rows[name]
        assert (row.rows, row.realized_dates, row.final_multiple, row.max_drawdown) == (count, 0, 1.0, 0.0)
        assert row.latest_realized_date is None and row.primary_exchange is None
    assert result.daily.isEmpty()


def test_all_strategies_in_one_job_and_written(spark, eight_bars, tmp_path):
    decisions = decisions_of(
        spark, (date(2026, 1, 1), "a", "AAA", 1.0), (date(2026, 1, 1), "b", "BBB", 1.0)
    )
    result = strategy_performance(decisions, eight_bars, decision_kind="paper")
    write_performance(result, str(tmp_path / "perf"))
    stored = spark.read.parquet(str(tmp_path / "perf" / "daily"))
    assert {(r.strategy_id, r.decision_kind) for r in stored.collect()} == {("a", "paper"), ("b", "paper")}
    assert spark.read.json(str(tmp_path / "perf" / "summary")).count() == 2


def test_price_end_leaves_newest_decision_open(spark, eight_bars):
    decisions = decisions_of(
        spark, (date(2026, 1, 1), "s", "AAA", 1.0), (date(2026, 1, 2), "s", "AAA", 1.0)
    )
    result = strategy_performance(decisions, eight_bars, price_end=date(2026, 1, 2))
    assert [r.date.day for r in result.daily.collect()] == [1]


def test_calendar_of_other_exchange(spark, make_bars):
    bars = make_bars(
        [(date(2026, 1, d), "AAA", 100.0 + d) for d in (1, 2, 5)]
        + [(date(2026, 1, d), "BBB", 10.0, {"exchange": "BSE"}) for d in (1, 2, 3, 5)]
    )
    decisions = decisions_of(spark, (date(2026, 1, 1), "s", "AAA", 1.0), (date(2026, 1, 2), "s", "AAA", 1.0))
    wide = decisions.unionByName(decisions_of(spark, (date(2026, 1, 3), "s", "BBB", 0.0)).withColumn("exchange", F.lit("BSE")))
    daily = strategy_performance(wide, bars).daily
    assert [r.date.day for r in daily.orderBy("date").collect()] == [1, 2, 3]
