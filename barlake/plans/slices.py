"""Point-in-time slices for opaque strategies, from one ordered pass per part of the universe.

As-of dates are gathered into spans of consecutive dates, several look-backs long. The rows of a
part and span pass by in order of date; a buffer holds those of the look-back, and
the strategy is called once all rows of an as-of date have passed. So a row is shipped once, or
twice where the look-back of the next span reaches it, however many dates look back on it.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator
from datetime import date, timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from barlake.schema import ContractError

KEYS = ["date", "exchange", "isin", "symbol", "series"]
# Calendar days of a span, in look-backs.
SPAN_LOOKBACKS = 4
# Rows of a part's largest slice: what a call gets, and a fifth of what a task sorts for a part and span.
PART_ROWS = 50_000
# Rows that one task should sort, if it gets several parts and spans.
TASK_ROWS = 250_000


_SORTED = ["date", "exchange", "symbol"]


def _ordinals(days: Iterable[date]) -> np.ndarray:
    return np.array([day.toordinal() for day in days], dtype=np.int64)


class SliceRuntime:
    """What a black-box strategy may ask for: a point-in-time slice, already in memory.

    ``features`` are a table of their own beside the bars; where a run has none, the
    bars serve as features. Columns that a slice lacks are a contract error. ``days`` are the dates of both as
    ordinals, given if the rows lie by date, exchange and symbol; else they are sorted, once for all requests.
    """

    def __init__(
        self, rows: pd.DataFrame, as_of: date, features: pd.DataFrame | None = None, *,
        days: tuple[np.ndarray, np.ndarray | None] | None = None,
    ) -> None:
        def table(frame, ordinals):
            if ordinals is None:
                frame = frame.sort_values(_SORTED, kind="stable")
                ordinals = _ordinals(frame["date"])
            return frame, ordinals

        own, told = days or (None, None)
        self._rows, self._as_of = table(rows, own), as_of
        self._features = self._rows if features is None else table(features, told)

    def _select(self, table, *, exchange=None, as_of_date=None, start_date=None,
                lookback_days=None, symbols=None, series=None) -> pd.DataFrame:
        rows, days = table
        if lookback_days is not None:
            if as_of_date is None:
                raise ValueError("lookback_days requires as_of_date")
            horizon = as_of_date - timedelta(days=int(lookback_days))
            start_date = horizon if start_date is None else max(start_date, horizon)
        first = 0 if start_date is None else np.searchsorted(days, start_date.toordinal())
        until = len(days) if as_of_date is None else np.searchsorted(days, as_of_date.toordinal(), side="right")
        rows = rows.iloc[first:until]
        wanted = []
        if exchange is not None:
            wanted.append(rows["exchange"] == exchange)
        if symbols:
            wanted.append(rows["symbol"].isin(symbols))
        if series is not None:
            wanted.append(rows["series"] == series if isinstance(series, str) else rows["series"].isin(series))
        keep = np.logical_and.reduce(wanted) if wanted else np.True_
        return rows if keep.all() else rows[keep]

    def _table(self, kind: str, table, columns, filters) -> pd.DataFrame:
        known = table[0].columns
        wanted = list(known) if columns is None else list(columns)
        unknown = [name for name in wanted if name not in known]
        if unknown:
            raise ContractError(f"the slice has no {kind} columns {unknown}")
        found = self._select(table, **filters)[wanted]
        return found.set_axis(pd.RangeIndex(len(found)))

    def market_data(self, *, columns=None, **filters) -> pd.DataFrame:
        return self._table("market data", self._rows, columns, filters)

    def feature_data(self, *, columns=None, **filters) -> pd.DataFrame:
        return self._table("feature", self._features, columns, filters)

    def latest_features(self, *, as_of_date, columns=None, **filters) -> pd.DataFrame:
        dates = {"as_of_date": as_of_date, "start_date": as_of_date}
        return self._table("feature", self._features, columns, {**filters, **dates})

    def trading_dates(self, *, exchange=None, start_date=None, end_date=None) -> list[date]:
        rows = self._select(self._rows, exchange=exchange, as_of_date=end_date, start_date=start_date)
        return sorted(rows["date"].unique())


def largest_slice(counts: dict[date, int], dates: Iterable[date], lookback_days: int) -> int:
    """Rows of the largest look-back slice, from the number of rows of each date."""
    days = sorted(counts)
    passed = [0]
    for day in days:
        passed.append(passed[-1] + counts[day])

    def slice_rows(as_of: date) -> int:
        first = bisect_left(days, as_of - timedelta(days=lookback_days))
        return passed[bisect_right(days, as_of)] - passed[first]

    return max(map(slice_rows, dates), default=0)


def span_plan(dates: Iterable[date], lookback_days: int) -> list[list[date]]:
    """Consecutive as-of dates in spans of some look-backs each."""
    reach = timedelta(days=SPAN_LOOKBACKS * (lookback_days + 1))
    spans: list[list[date]] = []
    for day in sorted(set(dates)):
        if not spans or day - spans[-1][0] >= reach:
            spans.append([])
        spans[-1].append(day)
    return spans


def span_days(spans: list[list[date]], lookback_days: int) -> list[tuple[int, date]]:
    """The calendar days that each span's dates look back on: a day is in two spans at most."""
    found = []
    for number, dates in enumerate(spans):
        upto = date.min
        for as_of in dates:
            day = max(as_of - timedelta(days=lookback_days), upto)
            while day <= as_of:
                found.append((number, day))
                day += timedelta(days=1)
            upto = day
    return found


class _Buffer:
    """Rows of one kind within the look-back, in order of date."""

    def __init__(self, names: list[str]) -> None:
        self.names = names
        self.added: list[tuple[pd.DataFrame, np.ndarray]] = []

    def add(self, rows: pd.DataFrame, days: np.ndarray) -> None:
        self.added.append((rows.set_axis(self.names, axis=1), days))

    def between(self, first: date, last: date) -> tuple[pd.DataFrame, np.ndarray]:
        """The rows of these dates; those before ``first`` are let go when rows were added since."""
        since = first.toordinal()
        if len(self.added) > 1:
            kept = [(rows.iloc[at:], days[at:]) for rows, days in self.added if (at := int(days.searchsorted(since))) < len(days)]
            frames = [rows for rows, _ in kept]
            self.added = [(pd.concat(frames, ignore_index=True), np.concatenate([days for _, days in kept]))] if kept else []
        if not self.added:
            return pd.DataFrame(columns=self.names), np.empty(0, np.int64)
        ((rows, days),) = self.added
        at = slice(int(days.searchsorted(since)), int(days.searchsorted(last.toordinal(), side="right")))
        return rows.iloc[at], days[at]


def _pass(call: Callable, spans: list[list[date]], lookback: timedelta, bar_names: list[str], feature_names: list[str] | None):
    """Calls the strategy over rows sorted by span, part, date and kind."""
    width = len(bar_names)

    def decided(state, until: date | None) -> Iterator[pd.DataFrame]:
        """Results of the as-of dates all of whose rows have passed."""
        while state["waiting"] and (until is None or state["waiting"][0] < until):
            as_of = state["waiting"].pop(0)
            bars, days = state["bars"].between(as_of - lookback, as_of)
            features, told = state["features"].between(as_of - lookback, as_of) if feature_names else (None, None)
            if len(bars):
                yield call(as_of, SliceRuntime(bars, as_of, features, days=(days, told)))

    def over_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, state = None, None
        for batch in batches:
            for key, rows in batch.groupby(["_span", "_part"], sort=False):
                if key != place:
                    if state:
                        yield from decided(state, None)
                    place = key
                    state = {"waiting": list(spans[key[0]]), "bars": _Buffer(bar_names), "features": _Buffer(feature_names or [])}
                days, own = _ordinals(rows["_date"]), rows["_feature"].to_numpy(bool)
                values = rows.drop(columns=["_span", "_part", "_date", "_feature"])
                if not own.all():
                    state["bars"].add(values.iloc[~own, :width], days[~own])
                if own.any():
                    state["features"].add(values.iloc[own, width:], days[own])
                yield from decided(state, rows["_date"].iloc[-1])
        if state:
            yield from decided(state, None)

    return over_all


def _placed(rows: DataFrame, days: DataFrame, parts: int) -> DataFrame:
    part = F.pmod(F.xxhash64("exchange", "symbol"), F.lit(parts)).cast("int")
    return rows.withColumns({"_date": F.col("date"), "_part": part}).join(F.broadcast(days), "_date")


def slide(
    bars: DataFrame, dates: list[date], call: Callable[[date, SliceRuntime], pd.DataFrame], schema: str, *,
    lookback_days: int, parts: int, features: DataFrame | None = None, total: int = 0,
) -> DataFrame:
    """What ``call`` returns for each as-of date and part of the universe that has bars in its look-back.

    Bars and features need the columns of ``KEYS``. The days table is bounded by the calendar. The parts of all spans are
    dealt evenly to tasks, of which there are more the more rows (``total``) there are.
    """
    spark = bars.sparkSession
    spans = span_plan(dates, lookback_days)
    days = spark.createDataFrame(span_days(spans, lookback_days), "_span int, _date date")
    tables = [bars] if features is None else [bars, features]
    for kind, rows in zip(("bars", "features"), tables):
        if missing := [name for name in KEYS if name not in rows.columns]:
            raise ContractError(f"{kind} lack the columns {missing}")
    # Two typed streams in one: each row fills the columns of its own kind.
    typed = [(f"{side}{i}", field) for side, rows in zip("bf", tables) for i, field in enumerate(rows.schema.fields)]
    streams = []
    for side, rows in zip("bf", tables):
        values = [(F.col(f"`{f.name}`") if name[0] == side else F.lit(None).cast(f.dataType)).alias(name) for name, f in typed]
        placed = _placed(rows, days, parts)
        streams.append(placed.select("_span", "_part", "_date", F.lit(side == "f").alias("_feature"), *values))
    rows = streams[0] if len(streams) == 1 else streams[0].unionByName(streams[1])

    def key(name: str):
        """The column of that name of a row's own kind; NULLs come last, as they do in pandas."""
        own = [f"{side}{table.columns.index(name)}" for side, table in zip("bf", tables)]
        return F.coalesce(*own).asc_nulls_last()

    # A row of a span and the next: a quarter more.
    tasks = max(1, min(len(spans) * parts, max(8 * spark.sparkContext.defaultParallelism, -(-total * 5 // (4 * TASK_ROWS)))))
    ordered = (
        rows.repartitionById(tasks, F.col("_span") * parts + F.col("_part"))
        .sortWithinPartitions("_span", "_part", "_date", "_feature", *map(key, ("exchange", "symbol", "series", "isin")))
    )
    names = [[field.name for field in rows.schema.fields] for rows in tables]
    over_all = _pass(call, spans, timedelta(days=lookback_days), names[0], names[1] if features is not None else None)
    return ordered.mapInPandas(over_all, schema)
