from datetime import date, timedelta

import pandas as pd
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from barlake.operators import decisions as dec
from barlake.plans import backtest as bt, slices
from barlake.plans.paper import run_paper
from barlake.schema import DECISIONS, ContractError
from barlake.sources.tables import empty_decisions, scan_decisions, strategy_registry

ROW = (date(2026, 1, 2), "momentum_v1", "NSE", "INE000000000", "ABC", 0.1, 1, 0.87)


def frame(spark, *rows):
    return spark.createDataFrame(rows, DECISIONS)


def changed(**fields):
    return tuple(fields.get(n, v) for n, v in zip(DECISIONS.names, ROW))


def test_contract_accepts_and_adds_score(spark):
    checked = dec.assert_decisions(frame(spark, ROW).drop("score"))
    assert checked.columns == DECISIONS.names and checked.first().score is None


@pytest.mark.parametrize(
    "fields", [dict(date=None), dict(target_weight=None), dict(target_weight=-0.1), dict(rank=None)]
)
def test_contract_refuses_bad_rows(spark, fields):
    with pytest.raises(ContractError):
        dec.assert_decisions(frame(spark, changed(**fields)))


def test_contract_refuses_duplicates_and_columns(spark):
    with pytest.raises(ContractError, match="duplicate"):
        dec.assert_decisions(frame(spark, ROW, ROW))
    with pytest.raises(ContractError, match="unexpected"):
        dec.assert_decisions(frame(spark, ROW).withColumn("note", F.lit(1)))
    with pytest.raises(ContractError, match="missing"):
        dec.assert_decisions(frame(spark, ROW).drop("rank"))


def test_top_one_over_two_days(make_bars):
    days = [date(2026, 1, 1), date(2026, 1, 2)]
    bars = make_bars([(days[0], "AAA", 10.0), (days[0], "BBB", 9.0), (days[1], "AAA", 8.0), (days[1], "BBB", 9.0)])
    got = bt.run_backtest(lambda known, dates: dec.top_n_by_price(known, top_n=1), bars).orderBy("date")
    assert [(r.symbol, r.target_weight, r.rank) for r in got.collect()] == [("AAA", 1.0, 1), ("BBB", 1.0, 1)]


def test_only_series_eq_is_chosen(make_bars):
    day = date(2026, 1, 1)
    bars = make_bars([(day, "AAA", 100.0), (day, "AAA", 120.0, {"series": "BL"})])
    (row,) = dec.top_n_by_price(bars, top_n=2).collect()
    assert (row.score, row.target_weight) == (100.0, 1.0)


def test_null_prices_are_not_ranked_and_empty_days_have_no_rows(make_bars):
    day = date(2026, 1, 1)
    bars = make_bars([(day, "AAA", 100.0, {"adj_close": None})])
    assert dec.top_n_by_price(bars, top_n=2).isEmpty()


def test_backtest_window(eight_bars):
    got = bt.run_backtest(
        lambda known, dates: dec.top_n_by_price(known, top_n=1), eight_bars,
        start=date(2026, 1, 2), end=date(2026, 1, 3),
    )
    assert sorted(r.date.day for r in got.collect()) == [2, 3]


def test_append_is_idempotent(spark):
    today = frame(spark, ROW, changed(symbol="XYZ", isin="INE2"))
    once = dec.append_decisions(empty_decisions(spark), today)
    twice = dec.append_decisions(once, today)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    newer = frame(spark, changed(target_weight=0.3))
    assert {r.symbol: r.target_weight for r in dec.append_decisions(once, newer).collect()} == {
        "ABC": 0.3, "XYZ": 0.1,
    }


def test_payload_ranks_fill_gaps(spark):
    payload = spark.createDataFrame(
        [(date(2026, 1, 2), "NSE", "I1", "A", 0.5, None, 1), (date(2026, 1, 2), "NSE", "I2", "B", 0.5, 7, 2)],
        "date date, exchange string, isin string, symbol string, target_weight double, rank int, position int",
    )
    rows = dec.fill_payload(payload, strategy_id="p").orderBy("symbol").collect()
    assert [(r.rank, r.strategy_id, r.score) for r in rows] == [(1, "p", None), (7, "p", None)]


def test_chunk_plan(spark):
    days = spark.createDataFrame([(date(2026, 1, d),) for d in (1, 2, 3, 4)], "date date")
    rows = bt.chunk_plan(days, chunk_size=2, warmup_days=1).orderBy("chunk_id").collect()
    assert [(r.market_start, r.chunk_end) for r in rows] == [
        (date(2025, 12, 31), date(2026, 1, 2)), (date(2026, 1, 2), date(2026, 1, 4)),
    ]
    assert all(r.market_start is None for r in bt.chunk_plan(days, chunk_size=2, warmup_days=0).collect())
    with pytest.raises(ValueError):
        bt.chunk_plan(days, chunk_size=0, warmup_days=1)


def test_chunks_without_warmup_see_all_history(eight_bars):
    days = eight_bars.select("date").distinct()
    plan = bt.chunk_plan(days, chunk_size=2, warmup_days=0)
    seen = bt.chunked_bars(eight_bars, plan).groupBy("chunk_id").count().orderBy("chunk_id")
    assert [r["count"] for r in seen.collect()] == [4, 8]


def test_blackbox_sees_no_future_and_may_return_none(eight_bars):
    def decide(as_of, runtime):
        assert max(runtime.trading_dates()) <= as_of
        rows = runtime.market_data(as_of_date=as_of, lookback_days=1, symbols=["AAA"])
        if as_of.day == 1:
            return None
        assert len(rows) == 2
        return [dict(exchange="NSE", isin="INEAAA", symbol="AAA", target_weight=1.0)]

    got = bt.blackbox_decisions(
        eight_bars, decide, strategy_id="b", lookback_days=5,
        dates=[date(2026, 1, 1), date(2026, 1, 3)],
    )
    (row,) = got.collect()
    assert (row.date, row.rank, row.score) == (date(2026, 1, 3), 1, None)


def test_blackbox_measures_its_slices(eight_bars):
    args = dict(strategy_id="b", lookback_days=5, max_slice_rows=3)
    with pytest.raises(ContractError, match="8 rows"):
        bt.blackbox_decisions(eight_bars, lambda d, r: None, **args)

    def score(as_of, runtime):
        today = runtime.latest_features(as_of_date=as_of)
        return today[["exchange", "isin", "symbol"]].assign(score=today["adj_close"], target_weight=0.0)

    scored = bt.blackbox_decisions(eight_bars, score, per_instrument=True, **args)
    one = bt.blackbox_decisions(eight_bars, score, per_instrument=True, parts=1, **args)
    ranks = {(r.date, r.symbol): r.rank for r in scored.collect()}
    assert ranks == {(r.date, r.symbol): r.rank for r in one.collect()}
    assert ranks[date(2026, 1, 1), "AAA"] == 1 and ranks[date(2026, 1, 1), "BBB"] == 2
    best = bt.rank_scores(scored, top_n=1).orderBy("date").collect()
    assert [r.symbol for r in best] == ["AAA"] * 4 and all(r.target_weight == 1.0 for r in best)


def test_paper_runs_active_strategies_once_per_day(spark, eight_bars, tmp_path):
    registry = strategy_registry(
        spark.createDataFrame([("007", "1", "active"), ("off", "1", "paused")], "strategy_id string, version string, status string")
    )

    def top(known, dates):
        today = known.join(dates.withColumnRenamed("as_of", "date"), "date", "left_semi")
        return dec.top_n_by_price(today, top_n=1, strategy_id="007")

    path = str(tmp_path / "paper")
    for day in (2, 3, 3):
        run_paper(spark, {"007": top}, registry, eight_bars, date(2026, 1, day), path)
    rows = scan_decisions(spark, path).orderBy("date").collect()
    assert [(r.date.day, r.strategy_id, r.symbol) for r in rows] == [(2, "007", "AAA"), (3, "007", "AAA")]
    with pytest.raises(KeyError):
        run_paper(spark, {}, registry, eight_bars, date(2026, 1, 3), path)


def test_registry_contract(spark):
    with pytest.raises(ContractError, match="missing"):
        strategy_registry(spark.createDataFrame([("a",)], "strategy_id string"))
    with pytest.raises(ContractError, match="null"):
        strategy_registry(
            spark.createDataFrame([(None, "1", "active")], "strategy_id string, version string, status string")
        )


def test_missing_decisions_are_an_empty_table(spark, tmp_path):
    stored = scan_decisions(spark, str(tmp_path / "none"))
    assert stored.columns == DECISIONS.names and stored.isEmpty()


def test_chunks_without_bars_are_refused(spark, eight_bars, tmp_path):
    plan = bt.chunk_plan(eight_bars.select("date"), chunk_size=2, warmup_days=1)
    decided = bt.chunked_backtest(lambda known, dates: dec.top_n_by_price(known, top_n=1), eight_bars, plan, str(tmp_path / "c"))
    assert sorted((r.date.day, r.chunk_id) for r in decided.collect()) == [(1, 0), (2, 0), (3, 1), (4, 1)]
    with pytest.raises(ContractError, match="no bars"):
        bt.chunked_backtest(lambda known, dates: dec.top_n_by_price(known), eight_bars.limit(0), plan, str(tmp_path / "d"))


def test_chunks_of_another_plan_are_never_read(spark, eight_bars, tmp_path):
    path, calls = str(tmp_path / "c"), []

    def top(known, dates):
        calls.append(1)
        return dec.top_n_by_price(known, top_n=1)

    def run(bars, size, version):
        plan = bt.chunk_plan(eight_bars.select("date"), chunk_size=size, warmup_days=1)
        decided = bt.chunked_backtest(top, bars, plan, path, version=version)
        return sorted((r.date.day, r.chunk_id, r.symbol, r.score) for r in decided.collect())

    first = run(eight_bars, 1, "1")
    assert [r[:2] for r in first] == [(1, 0), (2, 1), (3, 2), (4, 3)] and len(calls) == 4
    second = run(eight_bars, 3, "1")
    assert [r[:2] for r in second] == [(1, 0), (2, 0), (3, 0), (4, 1)] and len(calls) == 6
    # Nothing has changed: no chunk is made again.
    assert run(eight_bars.repartition(3), 3, "1") == second and len(calls) == 6
    # The last date's bars change: only the chunk that sees them is made.
    newest = F.when(F.col("date") == date(2026, 1, 4), F.col("adj_close") * 2).otherwise(F.col("adj_close"))
    run(eight_bars.withColumn("adj_close", newest), 3, "1")
    assert len(calls) == 7
    run(eight_bars, 3, "2")
    assert len(calls) == 9
    run(eight_bars, 3, None)
    assert len(calls) == 11


def test_backtests_check_the_contract(spark, eight_bars, tmp_path):
    plan = bt.chunk_plan(eight_bars.select("date"), chunk_size=2, warmup_days=1)

    def twice(known, dates):
        top = dec.top_n_by_price(known, top_n=1)
        return top.unionByName(top)

    with pytest.raises(ContractError, match="duplicate"):
        bt.chunked_backtest(twice, eight_bars, plan, str(tmp_path / "c"), version="1")
    # What was refused is not taken for complete.
    decided = bt.chunked_backtest(lambda known, dates: dec.top_n_by_price(known, top_n=1), eight_bars, plan, str(tmp_path / "c"), version="1")
    assert decided.count() == 4
    for weight in (F.lit(-0.1), F.lit(None).cast("double")):
        wrong = bt.run_backtest(lambda known, dates: dec.top_n_by_price(known).withColumn("target_weight", weight), eight_bars)
        with pytest.raises(Exception, match="break the contract"):
            wrong.collect()


def test_slices_are_those_of_a_plain_search(spark, make_bars, monkeypatch):
    """Every call gets exactly its look-back, whatever the spans, parts and batches."""
    days = [date(2026, 1, 1) + timedelta(days=n) for n in (0, 1, 3, 4, 9, 10, 11, 30, 31, 45)]
    rows = [(day, symbol, 10.0 + i) for i, day in enumerate(days) for symbol in ("A", "B", "C", "D") if (i + ord(symbol)) % 4]
    bars = make_bars(rows)
    features = bars.where("symbol <> 'B'").select(*slices.KEYS, (F.col("adj_close") * 2).alias("twice"))

    def count(as_of, runtime):
        seen, told = runtime.market_data(), runtime.feature_data(columns=["twice"])
        if len(seen):
            return [dict(exchange="NSE", isin="x", symbol=s, target_weight=0.0, score=float(n) + len(told) / 1000) for s, n in seen.groupby("symbol").size().items()]

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        for lookback in (0, 2, 7, 40):
            for given in (None, [days[2], date(2026, 1, 6), days[7]]):
                decided = bt.blackbox_decisions(bars, count, strategy_id="s", lookback_days=lookback, dates=given, features=features)
                got = {(r.date, r.symbol): r.score for r in decided.collect()}
                expected = {}
                for as_of in given or days:
                    since = as_of - timedelta(days=lookback)
                    inside = [s for day, s, _ in rows if since <= day <= as_of]
                    for symbol in set(inside):
                        expected[as_of, symbol] = inside.count(symbol) + sum(s != "B" for s in inside) / 1000
                assert got == pytest.approx(expected)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_row_is_shipped_for_two_spans_at_most():
    days = [date(2026, 1, 1) + timedelta(days=n) for n in range(400)]
    for lookback in (1, 10, 60):
        spans = slices.span_plan(days, lookback)
        shipped = slices.span_days(spans, lookback)
        assert [d for dates in spans for d in dates] == days
        assert len(shipped) == len(set(shipped)) <= 1.25 * (len(days) + lookback) + 1


def test_unknown_columns_are_a_contract_error(eight_bars):
    features = eight_bars.select(*slices.KEYS, F.col("close").alias("rsi_14"))

    def asks(method, columns):
        def decide(as_of, runtime):
            getattr(runtime, method)(as_of_date=as_of, columns=columns)

        return bt.blackbox_decisions(eight_bars, decide, strategy_id="b", lookback_days=3, columns=["close"], features=features).collect()

    assert asks("market_data", ["close", "symbol"]) == asks("feature_data", ["rsi_14"]) == asks("latest_features", ["rsi_14", "isin"]) == []
    for method, columns in (("market_data", ["volume"]), ("feature_data", ["close"]), ("latest_features", ["adx_14"])):
        with pytest.raises(Exception, match="has no"):
            asks(method, columns)
    with pytest.raises(ContractError, match="lack the columns"):
        bt.blackbox_decisions(eight_bars, None, strategy_id="b", lookback_days=3, features=features.drop("series"))


def test_parts_of_spans_are_dealt_evenly_and_grow_in_number(spark, make_bars, monkeypatch):
    """A task gets one part of a span where there are few, and parts are made small enough to stay so."""
    days = [date(2026, 1, 1) + timedelta(days=n) for n in range(60)]
    bars = make_bars([(day, f"S{i}", 10.0) for day in days for i in range(8)])

    def place(as_of, runtime):
        rows = runtime.market_data(as_of_date=as_of)
        task = float(TaskContext.get().partitionId())
        return rows.drop_duplicates("symbol")[["exchange", "isin", "symbol"]].assign(target_weight=len(rows) / 1000, score=task)

    monkeypatch.setattr(bt, "PART_ROWS", 12)
    decided = bt.blackbox_decisions(bars, place, strategy_id="s", lookback_days=2, per_instrument=True, parts=1).collect()
    # The largest slice has 24 rows: two parts. Five spans of twelve days each.
    seen = {}
    for r in decided:
        seen.setdefault(r.score, set()).add(((r.date - days[0]).days // 12))
    assert len(decided) == 480 and len(seen) == 10 and all(len(spans) == 1 for spans in seen.values())


def test_slices_in_order_answer_like_others():
    rows = pd.DataFrame(
        [(date(2026, 1, d), "NSE", f"INE{s}", s, series, float(d)) for d in (3, 1, 2) for s, series in (("B", "EQ"), ("A", "BL"), (None, "EQ"))],
        columns=[*slices.KEYS, "close"],
    )
    ordered = rows.sort_values(["date", "exchange", "symbol"], kind="stable").set_axis(range(100, 109))
    last = date(2026, 1, 3)
    plain = slices.SliceRuntime(rows, last)
    fast = slices.SliceRuntime(ordered, last, days=(slices._ordinals(ordered["date"]), None))
    for asked in (
        {}, dict(series="EQ"), dict(series=["BL"], exchange="NSE"), dict(symbols=["A"], as_of_date=date(2026, 1, 2)),
        dict(as_of_date=last, lookback_days=1), dict(start_date=date(2026, 1, 2), exchange="BSE"), dict(as_of_date=date(2025, 1, 1)),
    ):
        assert plain.market_data(**asked).equals(fast.market_data(**asked))
        keep = pd.Series(True, index=ordered.index)
        for name, wanted in (("series", asked.get("series")), ("exchange", asked.get("exchange")), ("symbol", asked.get("symbols"))):
            if wanted:
                keep &= ordered[name].isin([wanted] if isinstance(wanted, str) else wanted)
        since, until = asked.get("start_date"), asked.get("as_of_date")
        if asked.get("lookback_days"):
            since = until - timedelta(days=1)
        keep &= ordered["date"].map(lambda day: (since is None or since <= day) and (until is None or day <= until))
        assert fast.market_data(**asked).equals(ordered[keep].reset_index(drop=True))
