"""Technical features per instrument, over whole histories, in one shuffle.

Returns, drawdowns and volatility are SQL windows that share one partitioning and sort.
The recursive averages (EMA, RSI, ADX) and rolling medians are added by one Arrow pass
over the already sorted partitions. An instrument that is too large for one task is cut
into blocks first, and the recursive averages are chained across its blocks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from barlake.functions import smoothing as sm
from barlake.functions.medians import group_medians
from barlake.functions.series import (
    BLOCK,
    HALO,
    MAX_SERIES_ROWS,
    NEAR,
    after,
    ordered,
    own_rows,
    split_series,
    trailing,
)
from barlake.schema import ContractError

# Feature names, in output order.
FEATURES = (
    "ret_5", "ret_20", "ret_60", "ema_20", "ema_trend_20", "drawdown_20", "drawdown_60",
    "rsi_14", "adx_14", "turnover_median_20", "turnover_median_60", "daily_return",
    "realized_vol_20", "is_above_ema_20",
)
# Rolling medians -> (rows, observations needed).
_MEDIANS = {"turnover_median_20": (20, 5), "turnover_median_60": (60, 10)}
# The longest reach back of any window.
_BACK = 60
_ORDER = ("date", "series", "isin")
_FIRST = "_first"
_STATE, _INDEX_STATE = "_state", "_index_state"


def true_range(high: Column, low: Column, previous_close: Column) -> Column:
    return F.greatest(high - low, F.abs(high - previous_close), F.abs(low - previous_close))


def directional_moves(high: Column, low: Column, previous_high: Column, previous_low: Column):
    """Upward and downward movement; only the larger of the two counts."""
    up, down = high - previous_high, previous_low - low
    plus = F.when((up > down) & (up > 0), up).otherwise(0.0)
    minus = F.when((down > up) & (down > 0), down).otherwise(0.0)
    return plus, minus


def _window_features(w) -> dict[str, Column]:
    price, previous = F.col("adj_close"), F.lag("adj_close").over(w)
    defined = {
        f"ret_{k}": F.try_divide(price, F.lag("adj_close", k).over(w)) - 1 for k in (5, 20, 60)
    }
    for rows, minimum in ((20, 5), (60, 10)):
        frame = trailing(w, rows)
        fall = F.try_divide(price, F.max("adj_close").over(frame)) - 1
        defined[f"drawdown_{rows}"] = after(F.count("adj_close").over(frame), minimum, fall)
    defined["daily_return"] = F.coalesce(F.try_divide(price, previous) - 1, F.lit(0.0))
    return defined


def _volatility(w) -> Column:
    frame = trailing(w, 20)
    return after(
        F.count("daily_return").over(frame), 10, F.stddev_samp("daily_return").over(frame)
    )


def _signals(w) -> dict[str, Column]:
    def previous(name):
        return F.lag(name).over(w)

    change = F.col("adj_close") - previous("adj_close")
    high, low = F.col("high"), F.col("low")
    plus, minus = directional_moves(high, low, previous("high"), previous("low"))
    zero = F.lit(0.0)
    return {
        "price": F.col("adj_close"),
        "gain": F.when(change.isNotNull(), F.greatest(change, zero)),
        "loss": F.when(change.isNotNull(), F.greatest(-change, zero)),
        "plus_dm": plus,
        "minus_dm": minus,
        "true_range": true_range(high, low, previous("close")),
    }


# Which smoothed signals an output needs.
_SMOOTHED = {
    "ema_20": ("price",),
    "rsi_14": ("gain", "loss"),
    "adx_14": ("plus_dm", "minus_dm", "true_range"),
}
_DERIVED_FROM_EMA = ("ema_trend_20", "is_above_ema_20")


def feature_frame(
    bars: DataFrame,
    *,
    columns: Iterable[str] | None = None,
    series: str | None = "EQ",
    extra_keys: tuple[str, ...] = (),
    max_rows: int | None = MAX_SERIES_ROWS,
) -> DataFrame:
    """Bars with features; ``columns`` picks the output, only what it needs is computed.

    A series is one ``(exchange, symbol, *extra_keys)``, ordered by date, then series
    and isin. ``series=None`` mixes all series of a symbol.
    """
    carried = [name for name in bars.columns if name not in ("year", "month")]
    wanted = list(columns) if columns is not None else carried + list(FEATURES)
    unknown = [name for name in wanted if name not in carried and name not in FEATURES]
    if unknown:
        raise ContractError(f"unsupported feature columns: {unknown}")
    need = set(wanted)
    if need & set(_DERIVED_FROM_EMA):
        need |= {"ema_20", "adj_close"}
    if "realized_vol_20" in need:
        need.add("daily_return")

    keys = ("exchange", "symbol", *extra_keys)
    rows = bars if series is None else bars.where(F.col("series") == series)
    parts = split_series(rows, keys, _ORDER, back=_BACK, max_rows=max_rows)

    base = [name for name in carried if name in need]
    smoothed = [name for name in _SMOOTHED if name in need]
    medians = [name for name in _MEDIANS if name in need]
    signal_names = [s for name in smoothed for s in _SMOOTHED[name]]

    def compute(part: DataFrame, in_blocks: bool) -> DataFrame:
        # The number of a block is unique, so it stands for the series as well.
        w = ordered(() if in_blocks else keys, _ORDER)
        simple = {n: c for n, c in _window_features(w).items() if n in need}
        signals = {f"_{n}": c for n, c in _signals(w).items() if n in signal_names}
        kept = base + [n for n in FEATURES if n in simple or n == "realized_vol_20" and n in need]
        whole = part.withColumns({**simple, **signals})
        if "realized_vol_20" in need:
            whole = whole.withColumn("realized_vol_20", _volatility(w))
        if in_blocks:
            # Signals reach back one row only.
            light = part.where(NEAR).withColumns({**signals, _FIRST: _begins_own(w)})
            whole = whole.withColumn(_FIRST, F.row_number().over(w) == 1)
            part = _chain_blocks(light, whole, keys, kept, smoothed, medians, list(signals))
        elif smoothed or medians:
            part = _arrow_pass(whole, keys, kept, smoothed, medians, list(signals))
        else:
            part = whole
        return part.select(*kept, *smoothed, *medians)

    frame = reduce(DataFrame.unionByName, [compute(part, in_blocks) for part, in_blocks in parts])
    ema = {
        "ema_trend_20": F.try_divide(F.col("adj_close"), F.col("ema_20")) - 1,
        "is_above_ema_20": F.when(F.col("adj_close") > F.col("ema_20"), 1.0).otherwise(0.0),
    }
    return frame.withColumns({n: c for n, c in ema.items() if n in need} or {}).select(*wanted)


def _run_of(table: pa.Table) -> np.ndarray:
    first = table.column(_FIRST).to_numpy()
    return np.cumsum(first) - 1


def _nullable(values: np.ndarray) -> pa.Array:
    return pa.array(values, type=pa.float64(), from_pandas=True)


def _extended(schema: T.StructType, drop: list[str], add: list[str]) -> T.StructType:
    fields = [f for f in schema.fields if f.name not in drop]
    return T.StructType(fields + [T.StructField(name, T.DoubleType()) for name in add])


def _sorted_runs(frame: DataFrame, keys, columns: list[str]) -> DataFrame:
    """Whole runs of each series side by side and in order, marking each first row.

    The shuffle and sort are those of the windows; Spark plans no second one.
    """
    w = Window.partitionBy(*keys, BLOCK).orderBy(*_ORDER)
    marked = frame.withColumn(_FIRST, F.row_number().over(w) == 1)
    ordering = [*keys, BLOCK, *_ORDER]
    return marked.sortWithinPartitions(*ordering).select(*columns, _FIRST)


def _map_runs(frame: DataFrame, function, drop: list[str], add: list[str]) -> DataFrame:
    schema = _extended(frame.schema, drop, add)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sm.whole_series(batches, _FIRST):
            columns = function(table)
            own = ~table.column(HALO).to_numpy() if HALO in drop else None
            for name in drop:
                table = table.drop_columns(name)
            for name in add:
                table = table.append_column(name, _nullable(columns[name]))
            yield from (table if own is None else table.filter(pa.array(own))).to_batches()

    return frame.mapInArrow(apply, schema)


def _smooth(table, run, smoothed, carry_of=lambda signal: None) -> dict[str, np.ndarray]:
    """Smoothed outputs of one run table; ADX stops at the directional index."""

    def average(signal):
        alpha, minimum = sm.SIGNALS[signal]
        values = sm.doubles(table, f"_{signal}")
        return sm.exponential(values, run, alpha, minimum, carry_of(signal))

    out = {}
    if "ema_20" in smoothed:
        out["ema_20"] = average("price")
    if "rsi_14" in smoothed:
        out["rsi_14"] = sm.relative_strength(average("gain"), average("loss"))
    if "adx_14" in smoothed:
        out["_dx"] = sm.directional_index(
            average("plus_dm"), average("minus_dm"), average("true_range")
        )
    return out


def _arrow_pass(frame, keys, kept, smoothed, medians, signals) -> DataFrame:
    """All recursive features and medians of series that fit one task."""
    inputs = kept + signals
    frame = frame.withColumn("_turnover", F.col("turnover")) if medians else frame
    drop = signals + [_FIRST] + (["_turnover"] if medians else [])
    inputs = inputs + (["_turnover"] if medians else [])

    def compute(table: pa.Table) -> dict[str, np.ndarray]:
        run = _run_of(table)
        out = _smooth(table, run, smoothed)
        if "_dx" in out:
            out["adx_14"] = sm.exponential(out["_dx"], run, *sm.DX_RULE)
        for name in medians:
            out[name] = sm.rolling_median(sm.doubles(table, "_turnover"), run, *_MEDIANS[name])
        return out

    return _map_runs(_sorted_runs(frame, keys, inputs), compute, drop, smoothed + medians)


def _begins_own(w) -> Column:
    """Whether a row is the first of a block's own; copied neighbours lie before them."""
    return ~F.col(HALO) & F.coalesce(F.lag(HALO).over(w), F.lit(True))


def _own(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The rows of blocks without the copied neighbours, and their runs; every block has rows of its own."""
    own = ~table.column(HALO).to_numpy()
    return table.filter(pa.array(own)), _run_of(table)[own]


def _block_rows(frame: DataFrame, states: list[tuple[str, DataFrame]], columns: list[str]) -> DataFrame:
    """Blocks side by side and in order, their first rows with the states of averages before them.

    A task holds the states of its blocks, one row for each, so the rows keep their order.
    """
    for name, state in states:
        frame = frame.join(state.hint("shuffle_hash"), BLOCK).withColumn(name, F.when(F.col(_FIRST), F.col(name)))
    return frame.sortWithinPartitions(BLOCK, *_ORDER).select(*columns, *[name for name, _ in states], _FIRST)


def _summaries(frame: DataFrame, keys, signals: dict[str, float], values_of) -> DataFrame:
    """One row per block: how it moves each exponential average of ``values_of`` its rows."""
    names = [*keys, BLOCK]
    schema = T.StructType(
        [frame.schema[name] for name in names]
        + [T.StructField("summary", T.ArrayType(T.DoubleType()))]
    )

    def apply(batches):
        for table in sm.whole_series(batches, _FIRST):
            starts = np.flatnonzero(table.column(_FIRST).to_numpy())
            bounds, values = np.r_[starts, table.num_rows], values_of(table)
            rows = np.hstack([sm.block_summaries(values[name], bounds, alpha) for name, alpha in signals.items()])
            offsets = np.arange(len(starts) + 1, dtype=np.int32) * rows.shape[1]
            result = table.select(names).take(starts)
            result = result.append_column("summary", pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel())))
            yield from result.to_batches()

    return frame.mapInArrow(apply, schema)


def _entry_states(summaries: DataFrame, keys, alphas: list[float], state: str) -> DataFrame:
    """State of each average before each block: one small row per block, read in order of series and block."""
    series = Window.partitionBy(*keys).orderBy(BLOCK)
    ordered_blocks = (
        summaries.withColumn(_FIRST, F.row_number().over(series) == 1)
        .sortWithinPartitions(*keys, BLOCK)
        .select(BLOCK, "summary", _FIRST)
    )

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = []
        for batch in batches:
            before = []
            for first, summary in zip(batch.column(_FIRST).to_pylist(), batch.column("summary").to_pylist()):
                if first:
                    states = [(np.nan, 0, 0)] * len(alphas)
                before.append([float(x) for entry in states for x in entry])
                states = [
                    sm.advance(entry, tuple(summary[6 * i : 6 * i + 6]), alpha)
                    for i, (entry, alpha) in enumerate(zip(states, alphas))
                ]
            lists = pa.array(before, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(BLOCK), lists], names=[BLOCK, state])

    schema = T.StructType([summaries.schema[BLOCK], T.StructField(state, T.ArrayType(T.DoubleType()))])
    return ordered_blocks.mapInArrow(chain, schema)


def _carry(table: pa.Table, index: int, state: str = _STATE) -> sm.Carry:
    starts = np.flatnonzero(table.column(_FIRST).to_numpy())
    states = table.column(state).take(starts).combine_chunks().flatten().to_numpy().reshape(len(starts), -1)
    value, idle, seen = (states[:, 3 * index + i] for i in range(3))
    return sm.Carry(value, idle, seen)


def _chain_blocks(light, whole, keys, kept, smoothed, medians, signals) -> DataFrame:
    """The same features for series cut into blocks.

    ``light`` has the rows with their signals, ``whole`` with all windows and the copied neighbour rows, which
    the medians see as well. The recursive averages run per block and are chained through one summary row per block, those of the
    directional index on top of the others. Both summaries read one shuffle of the few columns that signals are made of, only
    the last pass one of whole rows.
    """
    alphas = {name: sm.SIGNALS[name[1:]][0] for name in signals}
    order = {name[1:]: i for i, name in enumerate(signals)}

    def smooth(table: pa.Table, own: pa.Table, run: np.ndarray, names) -> dict[str, np.ndarray]:
        return _smooth(own, run, names, lambda signal: _carry(table, order[signal]))

    own_light = light.where(~F.col(HALO))
    passed = [*keys, BLOCK, *signals]
    states = []
    if smoothed:
        summaries = _summaries(
            _block_rows(own_light, [], passed), keys, alphas, lambda table: {name: sm.doubles(table, name) for name in signals}
        )
        states.append((_STATE, _entry_states(summaries, keys, list(alphas.values()), _STATE)))
    if "adx_14" in smoothed:
        summaries = _summaries(
            _block_rows(own_light, states, passed), keys, {"_dx": sm.DX_RULE[0]},
            lambda table: smooth(table, table, _run_of(table), ["adx_14"]),
        )
        states.append((_INDEX_STATE, _entry_states(summaries, keys, [sm.DX_RULE[0]], _INDEX_STATE)))

    def compute(table: pa.Table) -> dict[str, np.ndarray]:
        out, halo = {}, table.column(HALO).to_numpy()
        for name in medians:
            out[name] = sm.rolling_median(sm.doubles(table, "_turnover"), _run_of(table), *_MEDIANS[name])
        if smoothed:
            own, run = _own(table)
            found = smooth(table, own, run, smoothed)
            if "_dx" in found:
                found["adx_14"] = sm.exponential(found["_dx"], run, *sm.DX_RULE, _carry(table, 0, _INDEX_STATE))
            for name in smoothed:
                out[name] = np.full(len(halo), np.nan)
                out[name][~halo] = found[name]
        return out

    if not smoothed and not medians:
        return own_rows(whole).select(*kept)
    turnover = ["_turnover"] if medians else []
    if medians:
        whole = whole.withColumn("_turnover", F.col("turnover"))
    runs = _block_rows(whole, states, [*kept, *signals, *turnover, HALO])
    drop = [*signals, *turnover, HALO, *[name for name, _ in states], _FIRST]
    return _map_runs(runs, compute, drop, smoothed + medians)


def latest_features(features: DataFrame, as_of_dates: DataFrame) -> DataFrame:
    """Feature rows dated exactly at each as-of date."""
    return features.join(as_of_dates.select(F.col("as_of").alias("date")).distinct(), "date")


def breadth(features: DataFrame) -> DataFrame:
    """Per exchange and date: instruments and the share of them above their EMA."""
    return features.groupBy("date", "exchange").agg(
        F.count("*").alias("instruments"),
        F.avg("is_above_ema_20").alias("breadth_above_ema_20"),
    )


def cross_medians(
    features: DataFrame, names: list[str], per: tuple[str, ...] = ("date", "exchange")
) -> DataFrame:
    """Exact median of each feature over the instruments of a date and exchange."""
    return group_medians(features, per, names)


def leadership(features: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Return over a benchmark's return on the same date; ``benchmark``: date, benchmark_ret_20.

    NULL on dates that the benchmark did not trade; no row of ``features`` is lost.
    """
    return features.join(benchmark, "date", "left").withColumn(
        "leadership_20", F.col("ret_20") - F.col("benchmark_ret_20")
    )
