"""Decisions, returns and performance."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlake.operators import decisions as dec
from barlake.operators.features import feature_frame
from barlake.operators.returns import forward_returns
from barlake.plans import performance as perf
from barlake.plans.backtest import blackbox_decisions, chunk_plan, chunked_backtest as run_chunks, rank_scores, run_backtest
from barlake.plans.slices import KEYS
from barlake.queries import adapter as a
from barlake.queries.features import _FEATURES_SQL
from barlake.session import scratch_dir
from barlake.storage import read_months, write_months


def _topn(rows):
    return dec.top_n_by_price(rows, top_n=5)


def topn_decisions(spark, sf_dir):
    rows = a.bars_multi(spark, sf_dir)
    decided = run_backtest(lambda known, dates: _topn(known), rows)
    return dec.in_decision_order(decided).withColumn("target_weight", F.round("target_weight", 6))


def chunked_backtest(spark, sf_dir):
    """The same decisions, made chunk by chunk from a written table, after those of a plan with other chunks."""
    path = scratch_dir(spark, "bars")
    write_months(a.bars(spark, sf_dir), path)
    table = read_months(spark, path)
    decisions = scratch_dir(spark, "decisions")
    for size in (400, 500):
        plan = chunk_plan(table.select("date"), chunk_size=size, warmup_days=30)
        decided = run_chunks(lambda known, dates: _topn(known), table, plan, decisions, version="1")
    return decided.drop("chunk_id").withColumn("target_weight", F.round("target_weight", 6))


def two_strategies(rows):
    scales = F.array(
        F.struct(F.lit("light_v1").alias("strategy_id"), F.lit(100).alias("scale")),
        F.struct(F.lit("lighter_v1").alias("strategy_id"), F.lit(1000).alias("scale")),
    )
    both = _topn(rows).withColumn("s", F.explode(scales))
    both = both.withColumns(
        {"strategy_id": F.col("s.strategy_id"), "target_weight": F.col("target_weight") / F.col("s.scale")}
    )
    return both.drop("s")


def forward_return(spark, sf_dir):
    # One bar per instrument and date by construction: no series needs splitting.
    rows = forward_returns(a.bars_multi(spark, sf_dir), max_rows=None)
    return rows.withColumn("forward_return", F.round("forward_return", 6)).drop("series")


def forward_return_split(spark, sf_dir):
    """The same returns with every instrument cut into blocks of 50 rows."""
    rows = forward_returns(a.bars_multi(spark, sf_dir), max_rows=50)
    return rows.withColumn("forward_return", F.round("forward_return", 6)).drop("series")


def realized_by_date(spark, sf_dir):
    rows = a.bars(spark, sf_dir)
    daily = perf.realized_by_date(two_strategies(rows), forward_returns(rows, max_rows=None))
    return _rounded(daily, "daily_return", "invested_weight")


def _rounded(frame, *names):
    # A multiple may reach many digits before the point: seven significant ones count.
    return frame.withColumns(
        {
            n: F.col(n).cast("float").cast("double") if n.endswith("_multiple") else F.round(n, 6)
            for n in names
        }
    )


def _rounded_sql(name, value=None):
    value = value or name
    if name.endswith("_multiple"):
        return f"CAST(CAST({value} AS float) AS double) AS {name}"
    return f"round({value}, 6) AS {name}"


def _performance(spark, sf_dir):
    rows = a.bars(spark, sf_dir)
    return perf.strategy_performance(two_strategies(rows), rows, max_rows=None)


_NUMBERS = ("daily_return", "invested_weight", "cash_weight", "cumulative_multiple", "drawdown")


def performance_daily(spark, sf_dir):
    return _rounded(_performance(spark, sf_dir).daily, *_NUMBERS)


def performance_summary(spark, sf_dir):
    return _rounded(_performance(spark, sf_dir).summary, "final_multiple", "max_drawdown")


def _projection(*names):
    def run(spark, sf_dir):
        daily = _performance(spark, sf_dir).daily.select("strategy_id", "date", *names)
        return _rounded(daily, *names)

    sql = ", ".join(map(_rounded_sql, names))
    return run, a.with_sql(a.DECISIONS_SQL, _PERF_SQL, select=f"SELECT strategy_id, date, {sql} FROM curve")


_PERF_SQL = """
nexts AS (
  SELECT date, exchange, isin, symbol, adj_close,
    lead(adj_close) OVER (PARTITION BY exchange, isin ORDER BY date) AS next_adj_close FROM bars
), realized AS (
  SELECT d.strategy_id, d.date, sum(target_weight * (next_adj_close / adj_close - 1)) AS daily_return,
    sum(target_weight) AS invested_weight
  FROM decisions d JOIN nexts n ON d.date = n.date AND d.exchange = n.exchange AND d.isin = n.isin AND d.symbol = n.symbol
  WHERE next_adj_close IS NOT NULL GROUP BY d.strategy_id, d.date
), span AS (
  SELECT r.strategy_id, min(date) AS lo, max(date) AS hi,
    (SELECT min(exchange) FROM decisions d WHERE d.strategy_id = r.strategy_id) AS primary_exchange
  FROM realized r GROUP BY r.strategy_id
), dense AS (
  SELECT s.strategy_id, c.date, coalesce(r.daily_return, 0) AS daily_return,
    coalesce(r.invested_weight, 0) AS invested_weight, r.date IS NOT NULL AS hit, s.primary_exchange
  FROM span s JOIN (SELECT DISTINCT exchange, date FROM bars) c
    ON c.exchange = s.primary_exchange AND c.date BETWEEN lo AND hi
  LEFT JOIN realized r ON r.strategy_id = s.strategy_id AND r.date = c.date
), grown AS (
  SELECT *, greatest(1 - invested_weight, 0) AS cash_weight,
    product(1 + daily_return) OVER (PARTITION BY strategy_id ORDER BY date) AS cumulative_multiple FROM dense
), curve AS (
  SELECT *, cumulative_multiple / greatest(1.0, max(cumulative_multiple) OVER (PARTITION BY strategy_id ORDER BY date)) - 1 AS drawdown
  FROM grown
)"""


def cagr_sharpe(spark, sf_dir):
    return _rounded(perf.growth_statistics(_performance(spark, sf_dir).daily), "cagr", "sharpe")


def portfolio_turnover(spark, sf_dir):
    return _rounded(perf.portfolio_turnover(two_strategies(a.bars(spark, sf_dir))), "turnover")


def _momentum(as_of, runtime):
    """Score each instrument: last close over its mean close in the slice."""
    rows = runtime.market_data(as_of_date=as_of, series="EQ", columns=["exchange", "isin", "symbol", "adj_close"])
    grouped = rows.groupby(["exchange", "symbol"], sort=False)
    mean = grouped["adj_close"].transform("mean")
    best = grouped.tail(1)
    return best[["exchange", "isin", "symbol"]].assign(score=best["adj_close"] / mean[best.index], target_weight=0.0)


def _cross_section(as_of, runtime):
    """The three highest closes on the date itself, a third of the money each."""
    today = runtime.latest_features(as_of_date=as_of, columns=["exchange", "isin", "symbol", "adj_close"])
    best = today.sort_values(["adj_close", "symbol", "exchange"], ascending=[False, True, True]).head(3)
    return best.rename(columns={"adj_close": "score"}).assign(target_weight=1 / 3)


def _written(spark, rows, name):
    """Rows that a run reads more than once: reading them is cheaper than deriving them again."""
    path = scratch_dir(spark, name)
    rows.write.parquet(path)
    return spark.read.parquet(path)


def _closing_prices(spark, sf_dir):
    return _written(spark, a.bars(spark, sf_dir).select(*KEYS, "adj_close"), "bars")


def blackbox_strategy(spark, sf_dir):
    decided = blackbox_decisions(
        _closing_prices(spark, sf_dir), _cross_section, strategy_id="blackbox_v1", lookback_days=10,
        columns=["adj_close"],
    )
    return _rounded(decided, "target_weight")


def blackbox_scores(spark, sf_dir):
    scored = blackbox_decisions(
        _closing_prices(spark, sf_dir), _momentum, strategy_id="momentum_v1", lookback_days=30,
        columns=["adj_close"], per_instrument=True, parts=2,
    )
    return _rounded(rank_scores(scored, top_n=4), "target_weight", "score")


def blackbox_ranks(spark, sf_dir):
    """Ranks that Spark gives the scores of all parts of the universe."""
    scored = blackbox_decisions(
        _closing_prices(spark, sf_dir), _last_close, strategy_id="close_v1", lookback_days=5,
        columns=["adj_close"], per_instrument=True, parts=3,
    )
    return scored.select("date", "exchange", "isin", "symbol", "rank", "score")


def _steady(as_of, runtime):
    """Today's feature over the mean of the slice, for instruments whose last bar closed above its average."""
    told = runtime.feature_data(as_of_date=as_of, series="EQ", columns=["date", "exchange", "symbol", "ema_20"])
    mean = told.groupby(["exchange", "symbol"], sort=False)["ema_20"].mean().rename("mean_ema").reset_index()
    last = runtime.latest_features(as_of_date=as_of, columns=["exchange", "isin", "symbol", "ema_20"])
    closes = runtime.market_data(as_of_date=as_of, lookback_days=0, columns=["exchange", "symbol", "adj_close"])
    rows = last.merge(closes, on=["exchange", "symbol"]).merge(mean, on=["exchange", "symbol"])
    rows = rows[rows["adj_close"] > rows["ema_20"]]
    return rows[["exchange", "isin", "symbol"]].assign(score=rows["ema_20"] / rows["mean_ema"], target_weight=0.0)


def blackbox_features(spark, sf_dir):
    """A strategy that reads bars and features side by side."""
    bars = _closing_prices(spark, sf_dir)
    features = _written(spark, feature_frame(bars, columns=[*KEYS, "ema_20"], max_rows=None), "features")
    scored = blackbox_decisions(
        bars, _steady, strategy_id="steady_v1", lookback_days=20,
        columns=["adj_close"], features=features, per_instrument=True, parts=2,
    )
    return _rounded(scored.select("date", "exchange", "isin", "symbol", "score"), "score")


def _last_close(as_of, runtime):
    today = runtime.latest_features(as_of_date=as_of)
    return today[["exchange", "isin", "symbol"]].assign(score=today["adj_close"], target_weight=0.0)


def fill_payload(spark, sf_dir):
    rows = _topn(a.bars(spark, sf_dir))
    payload = rows.select(
        "date", "exchange", "isin", "symbol", "target_weight",
        F.when(F.col("rank") % 2 == 0, F.col("rank") * 10).alias("rank"),
        F.col("rank").alias("position"),
    )
    return _rounded(dec.fill_payload(payload, strategy_id="payload_v1"), "target_weight")


def append_decisions(spark, sf_dir):
    stored = _topn(a.bars(spark, sf_dir))
    today = stored.where(F.col("rank") <= 3).withColumn("target_weight", F.lit(0.25))
    return _rounded(dec.append_decisions(stored, today), "target_weight")


def decision_violations(spark, sf_dir):
    stored = two_strategies(a.bars(spark, sf_dir))
    r = F.col("rank")
    broken = stored.withColumns(
        {
            "target_weight": F.when(r == 2, -F.col("target_weight")).when(r != 3, F.col("target_weight")),
            "rank": F.when(r != 4, r),
        }
    )
    return dec.decision_violations(broken.unionByName(broken.where(r == 5)))


_TOPN = "date, strategy_id, exchange, isin, symbol, round(target_weight, 6) AS target_weight, rank, score"

STRATEGY_QUERIES = {
    "blackbox_ranks": (blackbox_ranks, a.with_sql(select="""
SELECT date, exchange, isin, symbol,
  row_number() OVER (PARTITION BY date ORDER BY adj_close DESC, symbol, exchange, isin) AS rank, adj_close AS score
FROM bars""")),
    "topn_decisions": (topn_decisions, a.with_sql(a.DECISIONS_SQL, select=f"SELECT {_TOPN} FROM topn")),
    "chunked_backtest": (chunked_backtest, a.with_sql(a.DECISIONS_SQL, select=f"SELECT {_TOPN} FROM topn")),
    "equal_weight": (
        lambda spark, d: _topn(a.bars(spark, d)).groupBy("date").agg(
            F.count("*").alias("holdings"), F.round(F.sum("target_weight"), 6).alias("invested")
        ),
        a.with_sql(a.DECISIONS_SQL, select="""
SELECT date, count(*) AS holdings, round(sum(target_weight), 6) AS invested FROM topn GROUP BY date"""),
    ),
    **{
        name: (run, a.with_sql(a.MULTI_SQL, select="""
SELECT date, exchange, isin, symbol, adj_close, n AS next_adj_close, round(n / adj_close - 1, 6) AS forward_return
FROM (SELECT *, lead(adj_close) OVER (PARTITION BY exchange, isin ORDER BY date) AS n
      FROM bars_multi WHERE series = 'EQ')"""))
        for name, run in (
            ("forward_return", forward_return), ("forward_return_split", forward_return_split),
        )
    },
    "realized_by_date": (realized_by_date, a.with_sql(a.DECISIONS_SQL, _PERF_SQL, select="""
SELECT strategy_id, date, round(daily_return, 6) AS daily_return, round(invested_weight, 6) AS invested_weight
FROM realized""")),
    "calendar_densify": _projection("daily_return", "invested_weight", "cash_weight"),
    "cumulative_multiple": _projection("cumulative_multiple"),
    "drawdown_curve": _projection("drawdown"),
    "performance_daily": (performance_daily, a.with_sql(a.DECISIONS_SQL, _PERF_SQL, select=f"""
SELECT date, strategy_id, 'backtest' AS decision_kind,
  {", ".join(map(_rounded_sql, _NUMBERS))} FROM curve""")),
    "performance_summary": (performance_summary, a.with_sql(a.DECISIONS_SQL, _PERF_SQL, select=f"""
SELECT c.strategy_id, 'backtest' AS decision_kind,
  (SELECT count(*) FROM decisions d WHERE d.strategy_id = c.strategy_id) AS rows,
  count(*) AS realized_dates, count(*) FILTER (WHERE hit) AS n_realized, max(date) AS latest_realized_date,
  {_rounded_sql("final_multiple", "arg_max(cumulative_multiple, date)")}, round(min(drawdown), 6) AS max_drawdown,
  max(primary_exchange) AS primary_exchange
FROM curve c GROUP BY c.strategy_id""")),
    "cagr_sharpe": (cagr_sharpe, a.with_sql(a.DECISIONS_SQL, _PERF_SQL, select="""
SELECT strategy_id,
  round(pow(arg_max(cumulative_multiple, date), 365.25 / (max(date) - min(date))) - 1, 6) AS cagr,
  round(avg(daily_return) / stddev_samp(daily_return) * sqrt(252), 6) AS sharpe
FROM curve GROUP BY strategy_id""")),
    "portfolio_turnover": (portfolio_turnover, a.with_sql(a.DECISIONS_SQL, """
steps AS (
  SELECT strategy_id, date, lead(date) OVER (PARTITION BY strategy_id ORDER BY date) AS nd
  FROM (SELECT DISTINCT strategy_id, date FROM decisions)
), held AS (SELECT d.*, nd FROM decisions d JOIN steps USING (strategy_id, date)),
net AS (
  SELECT strategy_id, date, exchange, isin, symbol, sum(w) AS w FROM (
    SELECT strategy_id, date, exchange, isin, symbol, target_weight AS w FROM held
    UNION ALL SELECT strategy_id, nd, exchange, isin, symbol, -target_weight FROM held WHERE nd IS NOT NULL)
  GROUP BY ALL
)""", select="SELECT strategy_id, date, round(sum(abs(w)), 6) AS turnover FROM net GROUP BY strategy_id, date")),
    "blackbox_strategy": (blackbox_strategy, a.with_sql(select="""
SELECT date, 'blackbox_v1' AS strategy_id, exchange, isin, symbol, round(1.0 / 3, 6) AS target_weight,
  CAST(rn AS bigint) AS rank, adj_close AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY date ORDER BY adj_close DESC, symbol, exchange) AS rn
  FROM bars) WHERE rn <= 3""")),
    "blackbox_scores": (blackbox_scores, a.with_sql("""
as_ofs AS (SELECT DISTINCT date AS as_of FROM bars), scored AS (
  SELECT as_of AS date, exchange, symbol, max(isin) AS isin, arg_max(adj_close, date) / avg(adj_close) AS score
  FROM as_ofs JOIN bars ON date BETWEEN as_of - 30 AND as_of GROUP BY as_of, exchange, symbol
)""", select="""
SELECT date, 'momentum_v1' AS strategy_id, exchange, isin, symbol,
  round(CAST(1 AS double) / count(*) OVER (PARTITION BY date), 6) AS target_weight, CAST(rn AS bigint) AS rank,
  round(score, 6) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY score DESC, symbol, exchange, isin) AS rn FROM scored)
WHERE rn <= 4""")),
    "blackbox_features": (blackbox_features, a.with_sql(_FEATURES_SQL, select="""
SELECT date, exchange, isin, symbol, round(ema_20 / mean_ema, 6) AS score FROM (
  SELECT f.date, f.exchange, b.isin, f.symbol, ema_20, b.adj_close, avg(ema_20) OVER (
    PARTITION BY f.exchange, f.symbol ORDER BY f.date RANGE BETWEEN INTERVAL 20 DAY PRECEDING AND CURRENT ROW) AS mean_ema
  FROM feat f JOIN bars b ON b.date = f.date AND b.exchange = f.exchange AND b.symbol = f.symbol AND b.series = 'EQ')
WHERE adj_close > ema_20""")),
    "fill_payload": (fill_payload, a.with_sql(a.DECISIONS_SQL, select="""
SELECT date, 'payload_v1' AS strategy_id, exchange, isin, symbol, round(target_weight, 6) AS target_weight,
  CASE WHEN rank % 2 = 0 THEN rank * 10 ELSE rank END AS rank, CAST(NULL AS double) AS score FROM topn""")),
    "append_decisions": (append_decisions, a.with_sql(a.DECISIONS_SQL, select="""
SELECT date, strategy_id, exchange, isin, symbol,
  round(CASE WHEN rank <= 3 THEN 0.25 ELSE target_weight END, 6) AS target_weight, rank, score FROM topn""")),
    "decision_violations": (decision_violations, a.with_sql(a.DECISIONS_SQL, select="""
SELECT CAST(0 AS bigint) AS null_date, count(*) FILTER (WHERE rank = 3) AS null_weight,
  count(*) FILTER (WHERE rank = 2) AS negative_weight, count(*) FILTER (WHERE rank = 4) AS null_rank,
  2 * count(*) FILTER (WHERE rank = 5) AS duplicate_rows FROM decisions""")),
}
