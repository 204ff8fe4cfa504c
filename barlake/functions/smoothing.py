"""Exponential averages and rolling medians inside Arrow tasks.

Recursive averages have no SQL window form that stays exact on long series. Spark
partitions and sorts the rows; these helpers walk each sorted partition one bounded run
of whole series at a time and append result columns. All numbers stay in numpy arrays.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa

EMA_ALPHA = 2 / 21  # span of 20 rows
WILDER_ALPHA = 1 / 14
WILDER_ROWS = 14

# The directly smoothed signals -> (smoothing factor, rows before a value).
SIGNALS = {
    "price": (EMA_ALPHA, 1),
    "gain": (WILDER_ALPHA, WILDER_ROWS),
    "loss": (WILDER_ALPHA, WILDER_ROWS),
    "plus_dm": (WILDER_ALPHA, WILDER_ROWS),
    "minus_dm": (WILDER_ALPHA, WILDER_ROWS),
    "true_range": (WILDER_ALPHA, WILDER_ROWS),
}
# The directional index is smoothed once more, on top of three of the signals.
DX = "dx"
DX_RULE = (WILDER_ALPHA, WILDER_ROWS)
# Rows from which on a run is smoothed by itself, not row by row beside others.
LONG_RUN = 1_000


@dataclass
class Carry:
    """State of one exponential average before the first row of each series run."""

    value: np.ndarray  # last average, NaN when there is none yet
    idle: np.ndarray  # rows without a value since then
    seen: np.ndarray  # values so far


def whole_series(batches: Iterator[pa.RecordBatch], first: str) -> Iterator[pa.Table]:
    """Regroup the sorted batches of a partition so that no series is cut in two.

    ``first`` is a boolean column that is true on the first row of each series.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        starts = np.flatnonzero(batch.column(first).to_numpy(zero_copy_only=False))
        if len(starts) == 0:
            held.append(batch)
            continue
        cut = int(starts[-1])
        if cut > 0:
            held.append(batch.slice(0, cut))
        if held:
            yield pa.Table.from_batches(held)
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def doubles(table: pa.Table, name: str) -> np.ndarray:
    """A numeric column as floats, NULL as NaN."""
    return table.column(name).cast(pa.float64()).to_numpy()


def exponential(
    values: np.ndarray, series: np.ndarray, alpha: float, minimum: int, carry: Carry | None = None
) -> np.ndarray:
    """Recursive average per series; ``series`` numbers the rows' series 0, 1, 2, ..."""
    if carry is None:
        frame = pd.Series(values).groupby(series, sort=False)
        return frame.ewm(alpha=alpha, adjust=False, min_periods=minimum).mean().to_numpy()
    bounds = run_bounds(series)
    averages, _ = _run_averages(values, bounds, alpha, carry.value, carry.idle)
    counted = np.r_[0, np.cumsum(~np.isnan(values))]
    seen = counted[1:] + np.repeat(carry.seen - counted[bounds[:-1]], np.diff(bounds))
    return np.where(seen >= minimum, averages, np.nan)


def run_bounds(series: np.ndarray) -> np.ndarray:
    """Where each run of equal numbers starts, and the end of the last one."""
    return np.r_[np.flatnonzero(np.r_[True, series[1:] != series[:-1]]), len(series)]


def _run_averages(
    values: np.ndarray, bounds: np.ndarray, alpha: float, average: np.ndarray, idle: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Averages of all rows and at the end of each run, from those before it.

    The first rows of all runs are taken together, then their second rows, and so on: many short runs take
    as many steps as the longest one has rows. Long ones are taken by themselves.
    """
    starts, lengths = bounds[:-1], np.diff(bounds)
    out, ends = np.empty(len(values)), np.array(average, dtype=float)
    for run in np.flatnonzero(lengths > LONG_RUN):
        lead = np.full(0, np.nan)
        if not np.isnan(average[run]):
            lead = np.r_[average[run], np.full(int(idle[run]), np.nan)]
        joined = pd.Series(np.r_[lead, values[bounds[run]:bounds[run + 1]]])
        smooth = joined.ewm(alpha=alpha, adjust=False).mean().to_numpy()[len(lead):]
        out[bounds[run]:bounds[run + 1]], ends[run] = smooth, smooth[-1]
    short = np.flatnonzero(lengths <= LONG_RUN)
    short = short[np.argsort(-lengths[short], kind="stable")]
    starts, lengths, now = starts[short], lengths[short], ends[short]
    weight = (1 - alpha) ** np.asarray(idle, dtype=float)[short]
    # Runs that have a row at each step, the longest ones first.
    left = np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), side="left")
    for step, runs in enumerate(left):
        at = starts[:runs] + step
        value, before = values[at], now[:runs]
        known = ~np.isnan(value)
        weight[:runs] *= 1 - alpha
        moved = (weight[:runs] * before + alpha * value) / (weight[:runs] + alpha)
        # A value that equals the average leaves it as it is, to the bit.
        moved = np.where(np.isnan(before) | (before == value), value, moved)
        now[:runs] = out[at] = np.where(known, moved, before)
        weight[:runs][known] = 1.0
    ends[short] = now
    return out, ends


def rolling_median(values: np.ndarray, series: np.ndarray, rows: int, minimum: int) -> np.ndarray:
    grouped = pd.Series(values).groupby(series, sort=False)
    return grouped.rolling(rows, min_periods=minimum).median().to_numpy()


def relative_strength(gain: np.ndarray, loss: np.ndarray) -> np.ndarray:
    """0..100 from smoothed gains and losses; undefined while nothing was ever lost."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return 100 - 100 / (1 + gain / np.where(loss == 0, np.nan, loss))


def directional_index(plus: np.ndarray, minus: np.ndarray, true_range: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        scale = np.where(true_range == 0, np.nan, true_range)
        up, down = 100 * plus / scale, 100 * minus / scale
        total = np.where(up + down == 0, np.nan, up + down)
        return np.abs(up - down) / total * 100


def block_summaries(values: np.ndarray, bounds: np.ndarray, alpha: float) -> np.ndarray:
    """How each block moves an exponential average, whatever it was before.

    With ``a`` the average after the block's first value, the average at its end is
    ``gain * a + shift``. One row per block: values, idle rows before the first, first value,
    gain, shift, idle rows after the last.
    """
    starts, lengths = bounds[:-1], np.diff(bounds)
    known, place = ~np.isnan(values), np.arange(len(values))
    count = np.add.reduceat(known.astype(np.int64), starts)
    first = np.minimum.reduceat(np.where(known, place, len(values)), starts)
    last = np.maximum.reduceat(np.where(known, place, -1), starts)
    some = count > 0
    unit, zero = np.where(known, 0.0, np.nan), values.copy()
    unit[first[some]], zero[first[some]] = 1.0, 0.0
    none = np.full(len(starts), np.nan)
    gain, shift = (_run_averages(x, bounds, alpha, none, np.zeros(len(starts)))[1] for x in (unit, zero))
    summary = np.column_stack([
        count, np.where(some, first - starts, lengths), none, np.where(some, gain, 1.0), np.where(some, shift, 0.0),
        np.where(some, bounds[1:] - 1 - last, 0),
    ])
    summary[some, 2] = values[first[some]]
    return summary


def advance(state: tuple[float, int, int], summary: tuple, alpha: float) -> tuple[float, int, int]:
    """State ``(average, idle rows, values seen)`` after a block, from that before it."""
    average, idle, seen = state
    count, before, first, gain, shift, after = summary
    if count == 0:
        return average, idle + before, seen
    if np.isnan(average):
        entry = first
    else:
        weight = (1 - alpha) ** (idle + before + 1)
        entry = (weight * average + alpha * first) / (weight + alpha)
    return gain * entry + shift, after, seen + count
