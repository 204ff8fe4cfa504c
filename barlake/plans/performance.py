"""Realised performance of all strategies in one plan."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Window, functions as F

from barlake.functions.series import MAX_SERIES_ROWS
from barlake.operators.returns import forward_returns
from barlake.schema import PERFORMANCE, conform
from barlake.session import scratch_dir
from barlake.storage import delete_path


@dataclass(frozen=True)
class Performance:
    """Two views of one curve; ``write_performance`` computes the curve once for both."""

    curve: DataFrame
    listed: DataFrame | None = None

    @property
    def daily(self) -> DataFrame:
        return daily_performance(self.curve)

    @property
    def summary(self) -> DataFrame:
        return performance_summary(self.curve, self.listed)


def realized_rows(decisions: DataFrame, returns: DataFrame) -> DataFrame:
    """Every decision with its forward return, NULL while there is no next price."""
    on = ["date", "exchange", "isin", "symbol"]
    priced = returns.where(F.col("next_adj_close").isNotNull())
    return decisions.join(priced.select(*on, "forward_return"), on, "left")


def realized_by_date(decisions: DataFrame, returns: DataFrame) -> DataFrame:
    """Weighted return and invested weight of the realised decisions per strategy and date."""
    rows = realized_rows(decisions, returns).where(F.col("forward_return").isNotNull())
    return rows.groupBy("strategy_id", "date").agg(
        F.sum(F.col("target_weight") * F.col("forward_return")).alias("daily_return"),
        F.sum("target_weight").alias("invested_weight"),
    )


def exchange_calendars(bars: DataFrame) -> DataFrame:
    """One row per exchange with its sorted trading dates.

    Its size is the number of exchanges times the days of history, whatever the number
    of bars: dates are made distinct map-side.
    """
    dates = bars.select("exchange", "date").distinct()
    return dates.groupBy("exchange").agg(F.array_sort(F.collect_set("date")).alias("calendar"))


def _daily_curve(
    decisions: DataFrame, returns: DataFrame, calendars: DataFrame, primary_exchange: str | None
) -> DataFrame:
    """Per strategy and calendar date its return and weight; one NULL date if unrealised.

    Decisions are reduced to one row per strategy and date before anything is gathered,
    so what is held per strategy is bounded by the calendar, and joined once.
    """
    realized = F.col("forward_return").isNotNull()
    per_date = realized_rows(decisions, returns).groupBy("strategy_id", "date").agg(
        F.count("*").alias("rows"),
        F.min("exchange").alias("exchange"),
        F.sum(F.when(realized, F.col("target_weight") * F.col("forward_return"))).alias("r"),
        F.sum(F.when(realized, F.col("target_weight"))).alias("w"),
    )
    entry = F.struct(
        "date", F.col("r").alias("daily_return"), F.col("w").alias("invested_weight"),
        F.lit(False).alias("on_calendar"),
    )
    calendar_exchange = F.lit(primary_exchange) if primary_exchange else F.col("exchange")
    per_strategy = per_date.groupBy("strategy_id").agg(
        F.sum("rows").alias("rows"),
        F.min(calendar_exchange).alias("primary_exchange"),
        F.collect_list(F.when(F.col("r").isNotNull(), entry)).alias("entries"),
        F.min(F.when(F.col("r").isNotNull(), F.col("date"))).alias("start"),
        F.max(F.when(F.col("r").isNotNull(), F.col("date"))).alias("end"),
    )
    # One row per exchange, bounded by the calendar: small enough for every executor.
    joined = per_strategy.join(
        F.broadcast(calendars.withColumnRenamed("exchange", "primary_exchange")),
        "primary_exchange", "left",
    )
    open_days = F.filter("calendar", lambda day: day.between(F.col("start"), F.col("end")))
    idle = F.transform(
        open_days,
        lambda day: F.struct(
            day.alias("date"), F.lit(0.0).alias("daily_return"),
            F.lit(0.0).alias("invested_weight"), F.lit(True).alias("on_calendar"),
        ),
    )
    days = joined.select(
        "strategy_id", "rows", "primary_exchange",
        F.explode_outer(F.coalesce(F.concat("entries", idle), F.col("entries"))).alias("day"),
    ).select("strategy_id", "rows", "primary_exchange", "day.*")
    merged = days.groupBy("strategy_id", "rows", "primary_exchange", "date").agg(
        F.sum("daily_return").alias("daily_return"),
        F.sum("invested_weight").alias("invested_weight"),
        F.bool_or("on_calendar").alias("on_calendar"),
        (~F.bool_and("on_calendar")).alias("realized"),
    )
    return merged.where(F.col("date").isNull() | F.col("on_calendar"))


def with_equity(daily: DataFrame, per: tuple[str, ...] = ("strategy_id",)) -> DataFrame:
    """Cumulative multiple from 1.0 and drawdown from its peak, which starts at 1.0.

    The window of a strategy holds one row per trading date.
    """
    by_date = Window.partitionBy(*per).orderBy("date")
    so_far = by_date.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    grown = daily.withColumn(
        "cumulative_multiple", F.product(F.col("daily_return") + 1).over(so_far)
    )
    peak = F.greatest(F.max("cumulative_multiple").over(so_far), F.lit(1.0))
    return grown.withColumn("drawdown", F.col("cumulative_multiple") / peak - 1)


def strategy_performance(
    decisions: DataFrame,
    bars: DataFrame,
    *,
    decision_kind: str = "backtest",
    strategies: DataFrame | None = None,
    primary_exchange: str | None = None,
    price_end: date | None = None,
    series: str | None = "EQ",
    max_rows: int | None = MAX_SERIES_ROWS,
) -> Performance:
    """Daily performance and one summary row per strategy.

    ``strategies`` (with ``strategy_id``) restricts the result to, say, the active
    strategies and adds an empty summary for those without decisions. The calendar of a
    strategy is that of its smallest exchange code unless ``primary_exchange`` is given.
    """
    listed = None
    if strategies is not None:
        listed = strategies.select("strategy_id", F.lit(decision_kind).alias("decision_kind")).distinct()
        decisions = decisions.join(listed, "strategy_id", "left_semi")
    if price_end is not None:
        bars = bars.where(F.col("date") <= F.lit(price_end))
    # Only decided instruments need returns. The semi-join has the keys of the window
    # behind the returns, so it adds no shuffle of the bars.
    decided = decisions.select("exchange", "isin").distinct()
    priced = bars.join(decided, ["exchange", "isin"], "left_semi")
    returns = forward_returns(priced, series=series, max_rows=max_rows)
    curve = _daily_curve(decisions, returns, exchange_calendars(bars), primary_exchange)
    curve = with_equity(curve).withColumn("decision_kind", F.lit(decision_kind))

    return Performance(curve, listed)


def daily_performance(curve: DataFrame) -> DataFrame:
    cash = F.greatest(F.lit(0.0), 1 - F.col("invested_weight"))
    dated = curve.where(F.col("date").isNotNull())
    return conform(dated.withColumn("cash_weight", cash), PERFORMANCE)


def performance_summary(curve: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """One row per strategy; those ``listed`` without decisions get an empty one."""
    dated = F.col("date").isNotNull()
    summary = curve.groupBy("strategy_id", "decision_kind").agg(
        F.max("rows").alias("rows"),
        F.count("date").alias("realized_dates"),
        F.count_if(dated & F.col("realized")).alias("n_realized"),
        F.max("date").alias("latest_realized_date"),
        F.coalesce(F.max_by("cumulative_multiple", "date"), F.lit(1.0)).alias("final_multiple"),
        F.coalesce(F.min(F.when(dated, F.col("drawdown"))), F.lit(0.0)).alias("max_drawdown"),
        F.when(F.count("date") > 0, F.max("primary_exchange")).alias("primary_exchange"),
    )
    if listed is None:
        return summary
    defaults = {"rows": 0, "realized_dates": 0, "n_realized": 0, "final_multiple": 1.0, "max_drawdown": 0.0}
    return listed.join(summary, ["strategy_id", "decision_kind"], "left").fillna(defaults)


def write_performance(result: Performance, path: str) -> None:
    """Daily rows as parquet per strategy, summaries as JSON."""
    spark = result.curve.sparkSession
    staged = scratch_dir(spark, "curve")
    result.curve.write.parquet(staged)
    result = Performance(spark.read.parquet(staged), result.listed)
    (
        result.daily.repartition("strategy_id")
        .sortWithinPartitions("strategy_id", "date")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("decision_kind", "strategy_id")
        .parquet(f"{path}/daily")
    )
    result.summary.write.mode("overwrite").json(f"{path}/summary")
    delete_path(spark, staged)


def growth_statistics(daily: DataFrame) -> DataFrame:
    """Annual growth and Sharpe ratio per strategy, from its daily performance."""
    years = F.date_diff(F.max("date"), F.min("date")) / F.lit(365.25)
    final = F.max_by("cumulative_multiple", "date")
    spread = F.nullif(F.stddev_samp("daily_return"), F.lit(0.0))
    return daily.groupBy("strategy_id").agg(
        F.when(years > 0, F.pow(final, 1 / years) - 1).alias("cagr"),
        (F.avg("daily_return") / spread * F.sqrt(F.lit(252.0))).alias("sharpe"),
    )


def portfolio_turnover(decisions: DataFrame) -> DataFrame:
    """Sum of absolute weight changes between consecutive decision dates of a strategy.

    Each holding is compared with the strategy's previous and next decision date, which
    come from the distinct dates: one small row per strategy and date.
    """
    by_date = Window.partitionBy("strategy_id").orderBy("date")
    dates = decisions.select("strategy_id", "date").distinct().withColumn(
        "next_date", F.lead("date").over(by_date)
    )
    weights = decisions.groupBy("strategy_id", "date", "exchange", "isin", "symbol").agg(
        F.sum("target_weight").alias("weight")
    )
    held = weights.join(dates, ["strategy_id", "date"])
    instrument = ["strategy_id", "date", "exchange", "isin", "symbol"]
    # A holding counts with + on its date and with - on the next one.
    sold = held.where(F.col("next_date").isNotNull()).select(
        "strategy_id", F.col("next_date").alias("date"), "exchange", "isin", "symbol",
        (-F.col("weight")).alias("weight"),
    )
    changes = held.select(*instrument, "weight").unionByName(sold)
    net = changes.groupBy(*instrument).agg(F.sum("weight").alias("change"))
    return net.groupBy("strategy_id", "date").agg(F.sum(F.abs("change")).alias("turnover"))
