"""Backtests over whole date ranges."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from barlake.functions.dates import days_between
from barlake.functions.series import MAX_SERIES_ROWS
from barlake.operators.decisions import assert_decisions, decision_frame, fill_payload, sound_weights
from barlake.operators.features import feature_frame
from barlake.plans.slices import KEYS, PART_ROWS, SliceRuntime, largest_slice, slide
from barlake.schema import ContractError
from barlake.sources.bars import date_window, trading_dates
from barlake.storage import delete_path, move_path, path_exists, remove_others

# A declarative strategy: (bars or features, as-of dates) -> decisions of all dates.
Strategy = Callable[[DataFrame, DataFrame], DataFrame]

# Rows one call of a black-box strategy may receive.
MAX_SLICE_ROWS = 5_000_000
# Least number of parts of the universe that a per-instrument strategy is called on.
PARTS = 4


def decision_dates(
    bars: DataFrame, *, start: date | None = None, end: date | None = None,
    dates: Iterable[date] | DataFrame | None = None,
) -> DataFrame:
    """``as_of`` dates to decide on: those given, else all trading dates of the window."""
    if isinstance(dates, DataFrame):
        return dates.select("as_of").distinct()
    if dates is not None:
        rows = [(day,) for day in sorted(set(dates))]
        return bars.sparkSession.createDataFrame(rows, "as_of date")
    return trading_dates(bars, start=start, end=end).select(F.col("date").alias("as_of"))


def run_backtest(
    strategy: Strategy, bars: DataFrame, *, start: date | None = None, end: date | None = None,
    dates: Iterable[date] | DataFrame | None = None,
) -> DataFrame:
    """Decisions of a declarative strategy on every decision date, as one plan.

    Rows that can be told wrong by themselves (no date, weight or rank, a negative weight) fail the plan; repeated keys need a
    shuffle and are found where decisions are written.
    """
    as_of = decision_dates(bars, start=start, end=end, dates=dates)
    known = bars if end is None else bars.where(F.col("date") <= F.lit(end))
    decided = date_window(sound_weights(decision_frame(strategy(known, as_of))), start, end)
    if dates is None:
        return decided
    return decided.join(as_of.select(F.col("as_of").alias("date")), "date", "left_semi")


def chunk_plan(dates: DataFrame, *, chunk_size: int, warmup_days: int) -> DataFrame:
    """Consecutive chunks of dates with the first date of the bars each one sees.

    ``market_start`` is NULL without a warm-up: such a chunk sees all earlier bars.
    Numbering the dates needs one task; there is one row per trading date.
    """
    if chunk_size <= 0:
        raise ValueError("chunk_size must be positive")
    number = F.row_number().over(Window.orderBy("date")) - 1
    chunk = F.floor(number / chunk_size).cast("bigint")
    warm = F.date_sub(F.min("date"), warmup_days) if warmup_days > 0 else F.lit(None).cast("date")
    return (
        dates.select("date").distinct()
        .withColumn("chunk_id", chunk)
        .groupBy("chunk_id")
        .agg(
            F.min("date").alias("chunk_start"),
            F.max("date").alias("chunk_end"),
            F.count("*").alias("dates"),
            warm.alias("market_start"),
        )
    )


def date_digests(bars: DataFrame) -> dict[date, str]:
    """A digest of each date's rows, whatever their order and files: one row per date, one pass."""
    columns = sorted(bars.columns)
    row = F.xxhash64(F.struct(*columns))
    again = F.xxhash64(F.lit(1), F.struct(*reversed(columns)))
    total = [F.sum(value.cast("decimal(38,0)")).alias(name) for name, value in (("first", row), ("second", again))]
    found = bars.groupBy("date").agg(F.count("*").alias("rows"), *total)
    return {r.date: f"{r.rows}:{r.first}:{r.second}" for r in found.collect()}


def _chunk_name(chunk, version: str, digests: dict[date, str]) -> str:
    """A name that says what a chunk's decisions come from: plan, strategy and input."""
    first, last = chunk.market_start or date.min, chunk.chunk_end
    told = [f"{chunk.chunk_id}:{chunk.market_start}:{chunk.chunk_start}:{last}", version]
    told += [f"{day}={digests[day]}" for day in sorted(digests) if first <= day <= last]
    return "chunk-" + hashlib.sha256("\n".join(told).encode()).hexdigest()


def chunked_backtest(
    strategy: Strategy, bars: DataFrame, plan: DataFrame, path: str, *, version: str | None = None
) -> DataFrame:
    """Decisions of a strategy chunk by chunk, written below ``path`` as they are made, with ``chunk_id``.

    A chunk sees the bars from its warm-up (all earlier ones without) to its end, by a scan of
    those months. Each chunk's folder is named by a digest of its dates, the strategy's ``version``
    and the bars it sees, so chunks of another plan, strategy or input are never read; they are
    removed in the end. With a version, chunks that were complete before are not made again, so
    that a job that broke off goes on where it was. Decisions are checked as they are written; a chunk that breaks their
    contract, or has no bars, is an error.
    """
    spark = bars.sparkSession
    digests = date_digests(bars)
    names = []
    # One row per chunk of trading dates.
    for chunk in plan.orderBy("chunk_id").collect():
        name = _chunk_name(chunk, version or uuid.uuid4().hex, digests)
        names.append(name)
        if path_exists(spark, f"{path}/{name}/_SUCCESS"):
            continue
        if not any(chunk.chunk_start <= day <= chunk.chunk_end for day in digests):
            raise ContractError(f"chunk {chunk.chunk_id} has no bars from {chunk.chunk_start} on")
        seen = date_window(bars, chunk.market_start, chunk.chunk_end)
        decided = run_backtest(strategy, seen, start=chunk.chunk_start, end=chunk.chunk_end)
        unchecked = f"{path}/_{name}"
        decided.withColumn("chunk_id", F.lit(chunk.chunk_id)).write.mode("overwrite").parquet(unchecked)
        assert_decisions(spark.read.parquet(unchecked).drop("chunk_id"))
        delete_path(spark, f"{path}/{name}")
        move_path(spark, unchecked, f"{path}/{name}")
    remove_others(spark, path, names)
    return spark.read.parquet(*[f"{path}/{name}" for name in names])


def chunked_bars(
    bars: DataFrame, plan: DataFrame, history_start: date | None = None
) -> DataFrame:
    """Bars once per chunk that sees them, with ``chunk_id`` and ``chunk_start``.

    Chunks are expanded to their calendar days, so bars are matched by date. Chunks
    without a warm-up look back to ``history_start``, the table's first date if not given.
    """
    if history_start is None:
        history_start = bars.agg(F.min("date").alias("first")).first()["first"]
    start = F.coalesce("market_start", F.least(F.lit(history_start), F.col("chunk_start")))
    days = plan.select(
        "chunk_id", "chunk_start", F.explode(days_between(start, F.col("chunk_end"))).alias("date")
    )
    return bars.join(days, "date")


def chunked_features(
    bars: DataFrame, plan: DataFrame, *, columns: Iterable[str] | None = None,
    series: str | None = "EQ", max_rows: int | None = MAX_SERIES_ROWS,
) -> DataFrame:
    """Features as a chunk sees them: averages start anew at each chunk's warm-up."""
    wanted = list(columns) if columns is not None else None
    if wanted is not None:
        wanted = list(dict.fromkeys([*wanted, "date", "chunk_id", "chunk_start"]))
    seen = feature_frame(
        chunked_bars(bars, plan), columns=wanted, series=series,
        extra_keys=("chunk_id",), max_rows=max_rows,
    )
    return seen.where(F.col("date") >= F.col("chunk_start")).drop("chunk_start")


_PAYLOAD = (
    "date date, exchange string, isin string, symbol string, target_weight double, "
    "rank bigint, score double, position bigint"
)


def blackbox_decisions(
    bars: DataFrame,
    decide: Callable,
    *,
    strategy_id: str,
    lookback_days: int,
    dates: Iterable[date] | DataFrame | None = None,
    columns: Iterable[str] | None = None,
    features: DataFrame | None = None,
    per_instrument: bool = False,
    max_slice_rows: int = MAX_SLICE_ROWS,
    parts: int = PARTS,
) -> DataFrame:
    """Decisions of an opaque Python strategy, ``decide(as_of, runtime)``, on every trading date or on ``dates``.

    Each call gets the bars, and the rows of ``features``, of its look-back and nothing later; it
    returns None, a list of dicts or a DataFrame. A strategy that scores instruments one by
    one (``per_instrument``) is called on at least ``parts`` of the universe, more if slices are
    large; where it gives no rank, Spark numbers all rows of a date by falling score, symbol,
    exchange and isin, so that the number of parts never shows. One that must see the whole
    universe is called once per date, keeps its own order, and fails beyond
    ``max_slice_rows``; rows are never dropped. See ``slices`` for how rows reach the calls.
    """
    # One row per trading date and as-of date: bounded by the calendar.
    traded = {row["date"]: row["count"] for row in bars.groupBy("date").count().collect()}
    counts = dict(traded)
    if features is not None:
        for row in features.groupBy("date").count().collect():
            counts[row["date"]] = counts.get(row["date"], 0) + row["count"]
    days = list(traded) if dates is None else [row.as_of for row in decision_dates(bars, dates=dates).collect()]
    largest = largest_slice(counts, days, lookback_days)
    if not per_instrument:
        parts = 1
        if largest > max_slice_rows:
            raise ContractError(
                f"a slice has {largest} rows, more than {max_slice_rows}: score per "
                "instrument, shorten the look-back, or state the strategy with DataFrames"
            )
    else:
        parts = max(parts, -(-largest // PART_ROWS))
    if columns is not None:
        bars = bars.select(*dict.fromkeys([*KEYS, *columns]))

    def call(as_of: date, runtime: SliceRuntime) -> pd.DataFrame:
        return _payload_rows(decide(as_of, runtime), as_of)

    payload = slide(bars, days, call, _PAYLOAD, lookback_days=lookback_days, parts=parts, features=features, total=sum(counts.values()))
    if per_instrument:
        per_date = Window.partitionBy("date").orderBy(
            F.col("score").desc_nulls_last(), "symbol", "exchange", "isin", "position"
        )
        payload = payload.withColumn("position", F.row_number().over(per_date).cast("bigint"))
    return fill_payload(payload, strategy_id=strategy_id)


def _payload_rows(result, day: date) -> pd.DataFrame:
    names = [part.split()[0] for part in _PAYLOAD.split(", ")]
    frame = pd.DataFrame(result if result is not None else [])
    if frame.empty:
        return pd.DataFrame(columns=names)
    required = {"exchange", "isin", "symbol", "target_weight"}
    if not required <= set(frame.columns):
        raise ContractError(f"payload is missing {sorted(required - set(frame.columns))}")
    frame["position"] = range(1, len(frame) + 1)
    if "date" not in frame:
        frame["date"] = day
    if "score" in frame:
        frame["score"] = pd.to_numeric(frame["score"], errors="coerce")
    return frame.reindex(columns=names)


def rank_scores(scored: DataFrame, *, top_n: int) -> DataFrame:
    """Keep the N best scores per strategy and date, equally weighted."""
    per = Window.partitionBy("strategy_id", "date")
    best = per.orderBy(F.col("score").desc(), "symbol", "exchange", "isin")
    ranked = scored.where(F.col("score").isNotNull()).withColumn("rank", F.row_number().over(best))
    chosen = ranked.where(F.col("rank") <= top_n)
    return decision_frame(
        chosen.withColumn("target_weight", F.lit(1.0) / F.count("*").over(per))
    )
