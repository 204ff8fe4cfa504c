from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlake.functions import smoothing as sm
from barlake.functions.medians import group_medians
from barlake.operators import features as ft
from barlake.operators.asof import latest_as_of
from barlake.operators.features import FEATURES, feature_frame
from barlake.operators.returns import forward_returns
from barlake.schema import ContractError


def smoothed(values, alpha, minimum):
    """Recursive average by the textbook; a gap lets the old average fade."""
    average, weight, seen, out = None, 1.0, 0, []
    for value in values:
        if average is not None:
            weight *= 1 - alpha
        if value is not None:
            seen += 1
            if average is None:
                average = value
            else:
                average = (weight * average + alpha * value) / (weight + alpha)
            weight = 1.0
        out.append(average if average is not None and seen >= minimum else None)
    return out


def wilder(values):
    return smoothed(values, 1 / 14, 14)


def expected_features(rows):
    """EMA, RSI and ADX of one instrument by plain loops."""
    close = [r["adj_close"] for r in rows]
    gains, losses, plus, minus, ranges = [None], [None], [0.0], [0.0], []
    for i, row in enumerate(rows):
        if i:
            change = close[i] - close[i - 1]
            gains.append(max(change, 0.0))
            losses.append(max(-change, 0.0))
            h, l, ph, pl = row["high"], row["low"], rows[i - 1]["high"], rows[i - 1]["low"]
            known = None not in (h, l, ph, pl)
            up, down = (h - ph, pl - l) if known else (0.0, 0.0)
            plus.append(up if up > down and up > 0 else 0.0)
            minus.append(down if down > up and down > 0 else 0.0)
        spans = []
        if row["high"] is not None and row["low"] is not None:
            spans.append(row["high"] - row["low"])
        for side in ("high", "low"):
            if i and row[side] is not None and rows[i - 1]["close"] is not None:
                spans.append(abs(row[side] - rows[i - 1]["close"]))
        ranges.append(max(spans) if spans else None)
    rsi = [
        None if g is None or not l else 100 - 100 / (1 + g / l)
        for g, l in zip(wilder(gains), wilder(losses))
    ]
    dx = [
        None if p is None or not t or p + m == 0 else abs(p - m) / (p + m) * 100
        for p, m, t in zip(wilder(plus), wilder(minus), wilder(ranges))
    ]
    return smoothed(close, 2 / 21, 1), rsi, wilder(dx)


def random_walk(make_bars, symbols, days, gaps=False, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for symbol in symbols:
        price = 100.0
        for i in range(days):
            price = max(1.0, price + float(rng.normal()))
            extra = {"high": price + float(rng.random()), "low": price - float(rng.random())}
            if gaps and i % 37 in (20, 21):
                extra = {"high": None, "low": None}
            rows.append((date(2020, 1, 1) + timedelta(days=i), symbol, price, extra))
    return make_bars(rows)


def close_to(actual, expected):
    a = np.array([np.nan if v is None else v for v in actual])
    e = np.array([np.nan if v is None else v for v in expected])
    np.testing.assert_allclose(a, e, rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("max_rows", [None, 61, 100])
@pytest.mark.parametrize("gaps", [False, True])
def test_recursive_features_match_plain_loops(make_bars, max_rows, gaps):
    bars = random_walk(make_bars, ["AAA", "BBB"], 230, gaps)
    columns = ["date", "symbol", "adj_close", "high", "low", "close", "ema_20", "rsi_14", "adx_14"]
    rows = feature_frame(bars, columns=columns, max_rows=max_rows).orderBy("date").collect()
    for symbol in ("AAA", "BBB"):
        own = [r.asDict() for r in rows if r.symbol == symbol]
        assert len(own) == 230
        ema, rsi, adx = expected_features(own)
        close_to([r["ema_20"] for r in own], ema)
        close_to([r["rsi_14"] for r in own], rsi)
        close_to([r["adx_14"] for r in own], adx)
        if not gaps:
            assert own[13]["rsi_14"] is None and own[14]["rsi_14"] is not None
            assert own[25]["adx_14"] is None and own[26]["adx_14"] is not None


def test_split_frame_equals_whole_frame_with_one_huge_instrument(make_bars):
    """One symbol holds most rows, several of them on the same dates."""
    hot = random_walk(make_bars, ["HOT"], 300)
    twin = hot.withColumns({"isin": F.lit("INEHOT2"), "adj_close": F.col("adj_close") + 3})
    bars = hot.unionByName(twin).unionByName(random_walk(make_bars, ["AAA", "BBB"], 70, seed=2))
    key = ["date", "symbol", "isin"]
    whole = feature_frame(bars, max_rows=None).orderBy(*key).toPandas()
    split = feature_frame(bars, max_rows=64).orderBy(*key).toPandas()
    assert len(whole) == len(split) == 740
    for name in FEATURES:
        np.testing.assert_allclose(
            whole[name].astype(float), split[name].astype(float), rtol=1e-9, atol=1e-9, err_msg=name
        )


def test_short_blocks_are_smoothed_side_by_side(monkeypatch):
    """Averages of many short blocks equal plain loops over the whole series, without a pass of its own for each."""
    rng = np.random.default_rng(5)
    values = rng.normal(size=6_000) + 100
    values[rng.random(6_000) < 0.3] = np.nan
    values[1_000:1_200] = np.nan
    values[-2_500:] = 50.0
    # Blocks of three rows, then one of several thousand.
    bounds = np.r_[np.arange(0, 3_001, 3), 6_000]
    passes, series = [], sm.pd.Series
    monkeypatch.setattr(sm.pd, "Series", lambda *args, **kwargs: passes.append(1) or series(*args, **kwargs))
    states, state = [], (np.nan, 0, 0)
    for summary in sm.block_summaries(values, bounds, 1 / 14):
        states.append(state)
        state = sm.advance(state, tuple(summary), 1 / 14)
    carry = sm.Carry(*np.array(states, dtype=float).T)
    runs = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    got = sm.exponential(values, runs, 1 / 14, 14, carry)
    close_to(got, wilder([None if np.isnan(v) else v for v in values]))
    assert len(passes) <= 3


def test_flat_prices_have_no_strength(make_bars):
    bars = make_bars([(date(2020, 1, 1) + timedelta(days=i), "AAA", 50.0) for i in range(40)])
    row = feature_frame(bars).orderBy(F.desc("date")).first()
    assert row.rsi_14 is None and row.adx_14 is None
    assert row.ema_20 == 50.0 and row.is_above_ema_20 == 0.0 and row.drawdown_60 == 0.0


def test_only_rising_prices_leave_rsi_undefined(make_bars):
    bars = make_bars([(date(2020, 1, 1) + timedelta(days=i), "AAA", 50.0 + i) for i in range(40)])
    assert feature_frame(bars, columns=["rsi_14"]).where("rsi_14 IS NOT NULL").isEmpty()


def test_unknown_column_is_refused(eight_bars):
    with pytest.raises(ContractError):
        feature_frame(eight_bars, columns=["nope"])


def test_forward_return_crosses_blocks(make_bars):
    bars = random_walk(make_bars, ["HOT"], 50)
    def rows(n):
        return [tuple(r) for r in forward_returns(bars, max_rows=n).orderBy("date").collect()]
    assert rows(7) == rows(None)


def test_splitting_a_series_loses_no_null_rows(make_bars):
    rows = [(date(2026, 1, d), "A", float(d)) for d in range(1, 9)] + [(None, "A", 99.0)]
    rows += [(date(2026, 1, d), "B", float(d), {"isin": None}) for d in range(1, 9)]

    def returns(n):
        found = forward_returns(make_bars(rows), max_rows=n).collect()
        return sorted(((r.date is not None, str(r.date), r.symbol, r.next_adj_close) for r in found), key=str)

    assert returns(3) == returns(None) and len(returns(3)) == 17


def test_leadership_is_null_without_a_benchmark(spark):
    frame = spark.createDataFrame([(date(2026, 1, 1), 0.5), (date(2026, 1, 2), 0.25)], "date date, ret_20 double")
    index = spark.createDataFrame([(date(2026, 1, 1), 0.25)], "date date, benchmark_ret_20 double")
    assert [r.leadership_20 for r in ft.leadership(frame, index).orderBy("date").collect()] == [0.25, None]


def test_forward_return_tie_break_across_series(make_bars):
    day = [date(2026, 1, d) for d in (1, 2)]
    bars = make_bars(
        [(day[0], "AAA", 100.0), (day[0], "AAA", 200.0, {"series": "BL"}), (day[1], "AAA", 110.0)]
    )
    eq = forward_returns(bars).where(F.col("date") == day[0]).collect()
    assert [r.next_adj_close for r in eq] == [110.0]
    mixed = forward_returns(bars, series=None).where(F.col("date") == day[0]).orderBy("series")
    # BL sorts before EQ: on one date the BL row is followed by the EQ row.
    assert [r.next_adj_close for r in mixed.collect()] == [100.0, 110.0]


def test_group_medians_with_ties_and_gaps(spark):
    rng = np.random.default_rng(3)
    rows = [("big", float(v)) for v in rng.integers(0, 40, 3001)] + [("even", v) for v in (1.0, 4.0, 2.0, 9.0)]
    rows += [("one", 5.0), ("none", None), ("tied", 0.0), ("tied", 0.0), ("tied", 0.0), ("tied", 7.0)]
    rows += [("wide", float(v)) for v in rng.normal(size=5000)]
    got = {r.k: r.median_v for r in group_medians(spark.createDataFrame(rows, "k string, v double"), ("k",), ["v"]).collect()}
    for key in {k for k, _ in rows}:
        values = [v for k, v in rows if k == key and v is not None]
        assert got[key] == (float(np.median(values)) if values else None), key


@pytest.mark.parametrize("lookback", [None, 2])
def test_latest_as_of_matches_brute_force(spark, make_bars, lookback):
    rng = np.random.default_rng(4)
    start = date(2026, 1, 1)
    rows = [
        (start + timedelta(days=int(d)), s, float(d))
        for s in ("AAA", "BBB", "CCC") for d in sorted(rng.choice(40, 15, replace=False))
    ]
    as_of = [start + timedelta(days=int(d)) for d in (-3, 0, 5, 6, 20, 39, 60)]
    frame = spark.createDataFrame([(d,) for d in as_of], "as_of date")
    got = latest_as_of(make_bars(rows), frame, lookback_days=lookback)
    expected = set()
    for day in as_of:
        for symbol in ("AAA", "BBB", "CCC"):
            past = [r for r in rows if r[1] == symbol and r[0] <= day]
            if past and (lookback is None or past[-1][0] >= day - timedelta(days=lookback)):
                expected.add((day, symbol, past[-1][0]))
    result = got.select("as_of", "symbol", "date").collect()
    assert len(result) == len(expected) and set(map(tuple, result)) == expected
