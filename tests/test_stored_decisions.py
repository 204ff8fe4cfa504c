"""Decisions are stored by strategy and month; a day touches its own months only."""

from datetime import date

import pytest

from barlake.plans.paper import add_decisions, write_decisions
from barlake.schema import DECISIONS, ContractError
from barlake.sources.tables import scan_decisions


def decided(spark, *rows):
    """Decisions from ``(day, strategy, symbol, weight)``."""
    return spark.createDataFrame(
        [(day, strategy, "NSE", f"I{symbol}", symbol, weight, 1, None) for day, strategy, symbol, weight in rows], DECISIONS
    )


def weights(spark, path, parts=None):
    rows = scan_decisions(spark, path, parts).collect()
    return {(r.date, r.strategy_id, r.symbol): r.target_weight for r in rows}


def files(folder):
    return {p: p.stat().st_size for p in folder.rglob("*.parquet")}


JAN, FEB = date(2026, 1, 5), date(2026, 2, 5)


def test_a_day_reads_and_writes_its_months_only(spark, tmp_path):
    path = str(tmp_path / "decisions")
    write_decisions(decided(spark, (JAN, "a/1", "X", 0.1), (FEB, "a/1", "X", 0.2), (FEB, "b", "X", 0.3)), path)
    before = files(tmp_path / "decisions")
    day = decided(spark, (FEB, "a/1", "X", 0.5), (FEB, "a/1", "Y", 0.5))
    for _ in range(2):
        assert add_decisions(day, path) == [("a/1", 202602)]
    after = files(tmp_path / "decisions")
    assert len(before) == 3 and len(before.keys() & after.keys()) == 2 and len(after) == 3
    expected = {(JAN, "a/1", "X"): 0.1, (FEB, "a/1", "X"): 0.5, (FEB, "a/1", "Y"): 0.5, (FEB, "b", "X"): 0.3}
    assert weights(spark, path) == expected
    assert weights(spark, path, [("a/1", 202602)]).keys() == {(FEB, "a/1", "X"), (FEB, "a/1", "Y")}
    # Writing a strategy as a whole drops its other months and leaves other strategies.
    write_decisions(decided(spark, (JAN, "a/1", "Z", 1.0)), path)
    assert weights(spark, path) == {(JAN, "a/1", "Z"): 1.0, (FEB, "b", "X"): 0.3}


def test_broken_decisions_leave_the_table(spark, tmp_path):
    path = str(tmp_path / "decisions")
    add_decisions(decided(spark, (JAN, "a", "X", 0.1)), path)
    with pytest.raises(ContractError, match="negative_weight"):
        add_decisions(decided(spark, (JAN, "a", "Y", -1.0)), path)
    with pytest.raises(ContractError, match="null"):
        add_decisions(decided(spark, (None, "a", "Y", 1.0)), path)
    assert add_decisions(decided(spark), path) == []
    assert weights(spark, path) == {(JAN, "a", "X"): 0.1}


def test_tables_without_months_are_written_anew(spark, tmp_path):
    path = str(tmp_path / "decisions")
    decided(spark, (JAN, "a", "X", 0.1), (JAN, "b", "X", 0.2)).write.partitionBy("strategy_id").parquet(path)
    assert len(weights(spark, path)) == 2
    add_decisions(decided(spark, (FEB, "a", "X", 0.3)), path)
    assert weights(spark, path) == {(JAN, "a", "X"): 0.1, (JAN, "b", "X"): 0.2, (FEB, "a", "X"): 0.3}
    assert all("month=" in str(p) for p in files(tmp_path / "decisions"))
