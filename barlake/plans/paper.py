"""Daily paper run: today's decisions of the active strategies, stored idempotently."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barlake.files import delete_path, partition_folders
from barlake.journal import prepare, settle
from barlake.operators.decisions import append_decisions, assert_decisions
from barlake.plans.backtest import Strategy, decision_dates
from barlake.schema import ContractError
from barlake.session import scratch_dir
from barlake.sources.tables import active_strategies, empty_decisions, scan_decisions


def _month() -> Column:
    return (F.year("date") * 100 + F.month("date")).alias("month")


def _store(decisions: DataFrame, path: str, *, whole: bool) -> None:
    """Write decisions as ``strategy_id=/month=`` folders, check them, and put them in place as one change."""
    spark = decisions.sparkSession

    def write(folder: str) -> None:
        (
            decisions.select("*", _month()).hint("rebalance", "strategy_id", "month")
            .sortWithinPartitions("strategy_id", "month", "date", "rank", "symbol")
            .write.partitionBy("strategy_id", "month").parquet(folder)
        )

    def check(folder: str) -> None:
        assert_decisions(scan_decisions(spark, folder))

    def replaced(present: list[str], new: list[str]) -> list[str]:
        strategies = {place.split("/")[0] for place in new} if whole else set()
        return [place for place in present if place.split("/")[0] in strategies]

    settle(spark, path)
    prepare(spark, path, write, check, drop=replaced)
    settle(spark, path)


def write_decisions(decisions: DataFrame, path: str) -> None:
    """Check the contract, then replace the stored decisions of the strategies present."""
    _store(decisions, path, whole=True)


def add_decisions(decisions: DataFrame, path: str) -> list[tuple[str, int]]:
    """Put decisions among the stored ones, by key; returns the strategies and months they fall in.

    Only those months are read, checked and written, so a day costs the same however long the
    history is. ``decisions`` are read twice: first for their months, at most strategies x calendar months.
    """
    spark = decisions.sparkSession
    found = decisions.select("strategy_id", _month()).distinct().collect()
    parts = sorted((r.strategy_id, r.month) for r in found if None not in r)
    if len(parts) < len(found):
        raise ContractError("decisions have null dates or strategies")
    if parts:
        settle(spark, path)
        # Strategies stored without months, as earlier versions did, are written anew.
        whole = any("/month=" not in place for place in partition_folders(spark, path))
        stored = scan_decisions(spark, path, None if whole else parts)
        _store(append_decisions(stored, decisions), path, whole=whole)
    return parts


def decide_today(
    strategies: dict[str, Strategy], registry: DataFrame, bars: DataFrame, as_of: date
) -> DataFrame:
    """Today's decisions of all active strategies, from bars known at ``as_of``."""
    known = bars.where(F.col("date") <= F.lit(as_of))
    today = decision_dates(bars, dates=[as_of])
    active = active_strategies(registry).select("strategy_id")
    names = [row.strategy_id for row in active.collect()]  # one short row per strategy
    unknown = [name for name in names if name not in strategies]
    if unknown:
        raise KeyError(f"no strategy function for active strategies {unknown}")
    decided = [strategies[name](known, today) for name in names]
    if not decided:
        return empty_decisions(bars.sparkSession)
    return reduce(DataFrame.unionByName, decided).where(F.col("date") == F.lit(as_of))


def run_paper(
    spark: SparkSession, strategies: dict[str, Strategy], registry: DataFrame, bars: DataFrame,
    as_of: date, path: str,
) -> DataFrame:
    """Put today's decisions among the stored ones; running a day again changes nothing."""
    today = scratch_dir(spark, "decisions")
    decide_today(strategies, registry, bars, as_of).write.parquet(today)
    add_decisions(spark.read.parquet(today), path)
    delete_path(spark, today)
    return scan_decisions(spark, path)
