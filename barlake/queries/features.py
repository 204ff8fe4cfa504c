"""Technical features."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from barlake.operators import features as ft
from barlake.plans.backtest import chunk_plan, chunked_features
from barlake.queries import adapter as a
from barlake.queries.scans import _MONTH_ENDS, _month_ends
from barlake.schema import BARS
from barlake.session import scratch_dir
from barlake.sources.bars import trading_dates

_KEYS = ["date", "exchange", "symbol"]
# Decimals compared per feature; RSI and ADX run up to 100.
_DIGITS = {name: 4 if name in ("rsi_14", "adx_14") else 6 for name in ft.FEATURES}


def _rounded(frame, names):
    return frame.withColumns({n: _comparable(n) for n in names if n in _DIGITS})


def _comparable(name):
    # An average starts at a price, which may lie exactly between two rounded decimals:
    # it is compared to seven significant digits instead.
    if name == "ema_20":
        return F.col(name).cast("float").cast("double")
    return F.round(name, _DIGITS[name])


def features_sql(source: str, partition: str) -> str:
    """Features in SQL: ``source`` rows, series numbered by ``partition`` columns."""
    return f"""
f0 AS (
  SELECT *, lag(adj_close) OVER s AS pc, lag(high) OVER s AS ph, lag(low) OVER s AS pl,
    lag(adj_close, 5) OVER s AS c5, lag(adj_close, 20) OVER s AS c20, lag(adj_close, 60) OVER s AS c60
  FROM {source} WHERE series = 'EQ'
  WINDOW s AS (PARTITION BY {partition} ORDER BY date)
), f1 AS (
  SELECT *, coalesce(adj_close / pc - 1, 0.0) AS daily_return,
    CASE WHEN pc IS NOT NULL THEN greatest(adj_close - pc, 0) END AS gain,
    CASE WHEN pc IS NOT NULL THEN greatest(pc - adj_close, 0) END AS loss,
    CAST(CASE WHEN high - ph > pl - low AND high - ph > 0 THEN high - ph ELSE 0 END AS double) AS pdm,
    CAST(CASE WHEN pl - low > high - ph AND pl - low > 0 THEN pl - low ELSE 0 END AS double) AS mdm,
    greatest(high - low, abs(high - pc), abs(low - pc)) AS tr
  FROM f0
), f2 AS (
  SELECT *, adj_close / c5 - 1 AS ret_5, adj_close / c20 - 1 AS ret_20, adj_close / c60 - 1 AS ret_60,
    list_reduce(list(adj_close) OVER w, lambda x, v: x * 19.0 / 21 + v * 2.0 / 21) AS ema_20,
    CASE WHEN count(*) OVER w20 >= 5 THEN adj_close / max(adj_close) OVER w20 - 1 END AS drawdown_20,
    CASE WHEN count(*) OVER w60 >= 10 THEN adj_close / max(adj_close) OVER w60 - 1 END AS drawdown_60,
    CASE WHEN count(gain) OVER w >= 14 THEN
      list_reduce(list(gain) FILTER (gain IS NOT NULL) OVER w, lambda x, v: v / 14.0 + x * 13.0 / 14) END AS ag,
    CASE WHEN count(gain) OVER w >= 14 THEN
      list_reduce(list(loss) FILTER (loss IS NOT NULL) OVER w, lambda x, v: v / 14.0 + x * 13.0 / 14) END AS al,
    CASE WHEN count(*) OVER w >= 14 THEN list_reduce(list(pdm) OVER w, lambda x, v: v / 14.0 + x * 13.0 / 14) END AS p,
    CASE WHEN count(*) OVER w >= 14 THEN list_reduce(list(mdm) OVER w, lambda x, v: v / 14.0 + x * 13.0 / 14) END AS m,
    CASE WHEN count(*) OVER w20 >= 5 THEN median(turnover) OVER w20 END AS turnover_median_20,
    CASE WHEN count(*) OVER w60 >= 10 THEN median(turnover) OVER w60 END AS turnover_median_60,
    CASE WHEN count(*) OVER w20 >= 10 THEN stddev_samp(daily_return) OVER w20 END AS realized_vol_20
  FROM f1
  WINDOW w AS (PARTITION BY {partition} ORDER BY date),
    w20 AS (PARTITION BY {partition} ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
    w60 AS (PARTITION BY {partition} ORDER BY date ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)
), f3 AS (
  SELECT *, adj_close / ema_20 - 1 AS ema_trend_20,
    CASE WHEN adj_close > ema_20 THEN 1.0 ELSE 0.0 END AS is_above_ema_20,
    100 - 100 / (1 + ag / nullif(al, 0)) AS rsi_14, abs(p - m) / nullif(p + m, 0) * 100 AS dx
  FROM f2
), feat AS (
  SELECT *, CASE WHEN count(dx) OVER w >= 14 THEN
      list_reduce(list(dx) FILTER (dx IS NOT NULL) OVER w, lambda x, v: v / 14.0 + x * 13.0 / 14) END AS adx_14
  FROM f3 WINDOW w AS (PARTITION BY {partition} ORDER BY date)
)"""


_FEATURES_SQL = features_sql("bars", "exchange, symbol")
_ROUND = {n: f"CAST(round({n}, {d}) AS double) AS {n}" for n, d in _DIGITS.items()}
_ROUND["ema_20"] = "CAST(CAST(ema_20 AS float) AS double) AS ema_20"


def _columns_sql(names):
    return ", ".join(_ROUND.get(n, n) for n in names)


def _query(*names):
    columns = [*_KEYS, *names]

    def run(spark, sf_dir):
        # One bar per instrument and date by construction: no series needs splitting.
        frame = ft.feature_frame(a.bars(spark, sf_dir, by="symbol"), columns=columns, max_rows=None)
        return _rounded(frame, names)

    return run, a.with_sql(_FEATURES_SQL, select=f"SELECT {_columns_sql(columns)} FROM feat")


def feature_frame(spark, sf_dir):
    return _rounded(ft.feature_frame(a.bars(spark, sf_dir, by="symbol")), ft.FEATURES)


def feature_frame_split(spark, sf_dir):
    """The same frame with every instrument cut into blocks of 100 rows."""
    # Sizes, blocks and both passes read bars that are derived once.
    path = scratch_dir(spark, "bars")
    a.bars(spark, sf_dir, by="symbol").write.option("compression", "zstd").parquet(path)
    rows = spark.read.schema(BARS).parquet(path)
    return _rounded(ft.feature_frame(rows, max_rows=100), ft.FEATURES)


_FRAME_SQL = a.with_sql(
    _FEATURES_SQL, select=f"SELECT {_columns_sql([*BARS.names, *ft.FEATURES])} FROM feat"
)


def true_range_dm(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("exchange", "symbol").orderBy("date")
    high, low = F.col("high"), F.col("low")
    plus, minus = ft.directional_moves(high, low, F.lag("high").over(w), F.lag("low").over(w))
    reach = ft.true_range(high, low, F.lag("close").over(w))
    return a.bars(spark, sf_dir).select(
        *_KEYS, reach.alias("tr"), plus.alias("pdm"), minus.alias("mdm")
    )


def exact_date_features(spark, sf_dir):
    names = ["ret_20", "ema_20", "rsi_14"]
    frame = ft.feature_frame(a.bars(spark, sf_dir, by="symbol"), columns=[*_KEYS, *names], max_rows=None)
    return _rounded(ft.latest_features(frame, _month_ends(spark, sf_dir)), names)


def _plan(spark, sf_dir):
    return chunk_plan(trading_dates(a.bars(spark, sf_dir)), chunk_size=252, warmup_days=120)


def chunked(spark, sf_dir):
    names = ["ema_20", "rsi_14", "adx_14", "drawdown_60"]
    frame = chunked_features(
        a.bars(spark, sf_dir), _plan(spark, sf_dir), columns=[*_KEYS, *names],
        max_rows=None,
    )
    return _rounded(frame.select("chunk_id", *_KEYS, *names), names)


_PLAN_SQL = """
numbered AS (
  SELECT date, CAST(floor((row_number() OVER (ORDER BY date) - 1) / 252) AS bigint) AS chunk_id
  FROM (SELECT DISTINCT date FROM bars)
), chunks AS (
  SELECT chunk_id, min(date) AS chunk_start, max(date) AS chunk_end, count(*) AS dates,
    min(date) - 120 AS market_start FROM numbered GROUP BY chunk_id
), chunked AS (
  SELECT bars.*, chunk_id, chunk_start FROM bars JOIN chunks ON date BETWEEN market_start AND chunk_end
)"""


def breadth(spark, sf_dir):
    frame = ft.feature_frame(
        a.bars(spark, sf_dir), columns=[*_KEYS, "is_above_ema_20"], max_rows=None
    )
    wide = ft.breadth(frame)
    return wide.withColumn("breadth_above_ema_20", F.round("breadth_above_ema_20", 6))


def cross_median(spark, sf_dir):
    frame = ft.feature_frame(
        a.bars(spark, sf_dir), columns=[*_KEYS, "ret_20", "rsi_14"], max_rows=None
    )
    medians = ft.cross_medians(frame, ["ret_20", "rsi_14"])
    return medians.withColumns(
        {n: F.round(n, d) for n, d in (("median_ret_20", 6), ("median_rsi_14", 4))}
    )


def leadership(spark, sf_dir):
    frame = ft.feature_frame(a.bars(spark, sf_dir, by="symbol"), columns=[*_KEYS, "ret_20"], max_rows=None)
    index = frame.where((F.col("symbol") == "S00001") & (F.col("exchange") == "NSE")).select(
        "date", F.col("ret_20").alias("benchmark_ret_20")
    )
    led = ft.leadership(frame, index)
    return led.select(*_KEYS, F.round("leadership_20", 6).alias("leadership_20"))


FEATURE_QUERIES = {
    "ret_k": _query("ret_5", "ret_20", "ret_60"),
    "daily_return": _query("daily_return"),
    "ema_20": _query("ema_20"),
    "ema_trend": _query("ema_trend_20", "is_above_ema_20"),
    "rolling_drawdown": _query("drawdown_20", "drawdown_60"),
    "rsi_14": _query("rsi_14"),
    "adx_14": _query("adx_14"),
    "turnover_median": _query("turnover_median_20", "turnover_median_60"),
    "realized_vol": _query("realized_vol_20"),
    "true_range_dm": (true_range_dm, a.with_sql(_FEATURES_SQL, select="""
SELECT date, exchange, symbol, tr, pdm, mdm FROM f1""")),
    "feature_frame": (feature_frame, _FRAME_SQL),
    "feature_frame_split": (feature_frame_split, _FRAME_SQL),
    "exact_date_features": (exact_date_features, a.with_sql(_FEATURES_SQL, _MONTH_ENDS, select=f"""
SELECT {_columns_sql([*_KEYS, "ret_20", "ema_20", "rsi_14"])} FROM feat
WHERE date IN (SELECT as_of FROM month_ends)""")),
    "chunk_plan": (_plan, a.with_sql(_PLAN_SQL, select="SELECT * FROM chunks")),
    "chunked_features": (chunked, a.with_sql(
        _PLAN_SQL, features_sql("chunked", "exchange, symbol, chunk_id"), select=f"""
SELECT chunk_id, {_columns_sql([*_KEYS, "ema_20", "rsi_14", "adx_14", "drawdown_60"])}
FROM feat WHERE date >= chunk_start""")),
    "breadth": (breadth, a.with_sql(_FEATURES_SQL, select="""
SELECT date, exchange, count(*) AS instruments,
  CAST(round(avg(is_above_ema_20), 6) AS double) AS breadth_above_ema_20 FROM feat GROUP BY date, exchange""")),
    "cross_median": (cross_median, a.with_sql(_FEATURES_SQL, select="""
SELECT date, exchange, round(median(ret_20), 6) AS median_ret_20, round(median(rsi_14), 4) AS median_rsi_14
FROM feat GROUP BY date, exchange""")),
    "leadership": (leadership, a.with_sql("""
moved AS (
  SELECT date, exchange, symbol,
    adj_close / lag(adj_close, 20) OVER (PARTITION BY exchange, symbol ORDER BY date) - 1 AS ret_20
  FROM bars WHERE series = 'EQ'
)""", select="""
SELECT date, exchange, symbol, round(ret_20 - max(ret_20) FILTER (symbol = 'S00001' AND exchange = 'NSE')
  OVER (PARTITION BY date), 6) AS leadership_20
FROM moved""")),
}
