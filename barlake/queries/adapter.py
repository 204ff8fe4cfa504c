"""Bars and companion tables derived from the driver's tables, in Spark and in SQL.

One bar per ship date, line status (as exchange) and supplier (as instrument).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from barlake.schema import BARS, conform

BARS_SQL = """
li AS (
  SELECT CAST(l_shipdate AS date) AS date,
         CASE l_linestatus WHEN 'O' THEN 'NSE' ELSE 'BSE' END AS exchange,
         concat('INE', lpad(CAST(l_suppkey AS varchar), 9, '0')) AS isin,
         concat('S', lpad(CAST(l_suppkey AS varchar), 5, '0')) AS symbol,
         l_extendedprice / l_quantity AS price,
         l_quantity, l_extendedprice, l_orderkey, l_linenumber, l_partkey
  FROM lineitem
), seq AS (
  SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY date, exchange, isin) AS cnt
  FROM li
  WINDOW w AS (PARTITION BY date, exchange, isin
               ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity)
), b AS (
  SELECT date, exchange, isin, symbol, 'EQ' AS series,
         max(CASE WHEN rn = 1 THEN price END) AS open, max(price) AS high, min(price) AS low,
         max(CASE WHEN rn = cnt THEN price END) AS close,
         CAST(sum(l_quantity) AS bigint) AS volume,
         CAST(sum(CAST(l_extendedprice AS decimal(18,2))) AS double) AS turnover,
         CAST(count(*) AS bigint) AS trades
  FROM seq GROUP BY date, exchange, isin, symbol
), bars AS (
  SELECT date, exchange, isin, symbol, series, open, high, low, close,
         lag(close) OVER (PARTITION BY exchange, isin ORDER BY date) AS prev_close,
         turnover / volume AS vwap, volume, turnover, trades,
         CASE WHEN volume % 3 = 0 THEN NULL ELSE CAST(floor(volume / 2) AS bigint) END AS deliverable_qty,
         CAST(NULL AS double) AS delivery_pct,
         open AS adj_open, high AS adj_high, low AS adj_low, close AS adj_close,
         CAST(1.0 AS double) AS adj_factor
  FROM b
)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars(spark: SparkSession, sf_dir: str, *, by: str = "isin") -> DataFrame:
    """The ``bars`` view of ``BARS_SQL``.

    An instrument has one bar per date by construction, so the window for the previous
    close is bounded by the calendar; it is pruned where the column is not used. Line items are
    shuffled once, by exchange and ``by`` (``isin`` or ``symbol``, which goes by the isin): bars of a day,
    previous closes and windows over that key follow from this one placement. They are sorted once, too: a day's
    bar is its first row with what windows tell of the others, so no task holds a hash table of its days.
    """
    supplier = F.col("l_suppkey").cast("string")
    names = {
        "isin": F.concat(F.lit("INE"), F.lpad(supplier, 9, "0")),
        "exchange": F.when(F.col("l_linestatus") == "O", "NSE").otherwise("BSE"),
        "symbol": F.concat(F.lit("S"), F.lpad(supplier, 5, "0")),
    }
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("date"), "l_linestatus", "l_suppkey",
        "l_quantity", "l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey",
    )
    # Names and prices follow from what is shuffled, so they are not; the supplier is the instrument.
    key = ["l_suppkey", "exchange", by]
    placed = items.repartition(names["exchange"], names[by]).withColumns(
        {name: names[name] for name in key[1:]} | {"price": F.col("l_extendedprice") / F.col("l_quantity")}
    )
    trades = Window.partitionBy(*key, "date").orderBy(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity"
    )
    whole = trades.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    day, dates = Window.partitionBy(*key, "date"), Window.partitionBy(*key).orderBy("date")
    # From the longest order to the shortest: each follows from the one before, and one that is not used is pruned.
    told = placed.withColumns({"open": F.first("price").over(whole), "close": F.last("price").over(whole)})
    told = told.withColumns(
        {
            "high": F.max("price").over(day),
            "low": F.min("price").over(day),
            "volume": F.sum("l_quantity").over(day).cast("bigint"),
            "turnover": F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).over(day).cast("double"),
            "trades": F.count("*").over(day),
        }
    )
    # The count keeps Spark from moving this window below those of the day, which would sort twice.
    before = F.lag(F.when(F.col("trades") > 0, F.col("date"))).over(dates)
    begins = (F.row_number().over(dates) == 1) | ~before.eqNullSafe(F.col("date"))
    daily = told.withColumn("_begins", begins).where("_begins").withColumns(
        {name: column for name, column in names.items() if name not in key}
    )
    previous = F.lag("close").over(dates)
    half = F.floor(F.col("volume") / 2).cast("bigint")
    return conform(
        daily.withColumns(
            {
                "series": F.lit("EQ"),
                "prev_close": previous,
                "vwap": F.col("turnover") / F.col("volume"),
                "deliverable_qty": F.when(F.col("volume") % 3 != 0, half),
                "delivery_pct": F.lit(None),
                **{f"adj_{n}": F.col(n) for n in ("open", "high", "low", "close")},
                "adj_factor": F.lit(1.0),
            }
        ),
        BARS,
    )


def _with_copies(rows: DataFrame, copied) -> DataFrame:
    """Each row, and once more with ``_copy`` true where ``copied`` holds; the rows are made once."""
    no, yes = F.lit(False), F.lit(True)
    return rows.withColumn("_copy", F.explode(F.when(copied, F.array(no, yes)).otherwise(F.array(no))))


# Every fifth volume also trades in a second series at twice the price.
MULTI_SQL = """
bars_multi AS (
  SELECT * FROM bars
  UNION ALL
  SELECT * REPLACE ('BL' AS series, close * 2 AS close, adj_close * 2 AS adj_close)
  FROM bars WHERE volume % 5 = 0
)"""


def bars_multi(spark, sf_dir):
    both = _with_copies(bars(spark, sf_dir), F.col("volume") % 5 == 0)
    second = {"series": F.lit("BL"), "close": F.col("close") * 2, "adj_close": F.col("adj_close") * 2}
    return both.withColumns({n: F.when(F.col("_copy"), c).otherwise(F.col(n)) for n, c in second.items()}).drop("_copy")


# Bars with defects of every audited kind, and repeated keys.
DIRTY_SQL = """
bars_broken AS (
  SELECT * REPLACE (
    CASE WHEN volume % 7 = 0 THEN low - 1 ELSE high END AS high,
    CASE WHEN volume % 11 = 0 THEN -volume ELSE volume END AS volume,
    CASE WHEN volume % 13 = 0 THEN NULL ELSE isin END AS isin,
    CASE WHEN volume % 17 = 0 THEN -turnover ELSE turnover END AS turnover)
  FROM bars
), bars_dirty AS (
  SELECT * FROM bars_broken
  UNION ALL
  SELECT * FROM bars_broken WHERE volume % 19 = 0
)"""


def bars_dirty(spark, sf_dir):
    v = F.col("volume")
    rows = bars(spark, sf_dir).withColumns(
        {
            "high": F.when(v % 7 == 0, F.col("low") - 1).otherwise(F.col("high")),
            "volume": F.when(v % 11 == 0, -v).otherwise(v),
            "isin": F.when(v % 13 == 0, None).otherwise(F.col("isin")),
            "turnover": F.when(v % 17 == 0, -F.col("turnover")).otherwise(F.col("turnover")),
        }
    )
    return _with_copies(rows, F.col("volume") % 19 == 0).drop("_copy")


# BSE rows doubled under a ``#`` symbol, and rows that exist under ``#`` only.
HASH_SQL = """
bars_hash AS (
  SELECT * REPLACE (CASE WHEN exchange = 'BSE' AND volume % 9 = 0 THEN symbol || '#' ELSE symbol END AS symbol)
  FROM bars
  UNION ALL
  SELECT * REPLACE (symbol || '#' AS symbol)
  FROM bars WHERE exchange = 'BSE' AND volume % 4 = 0 AND volume % 9 <> 0
)"""


def bars_hash(spark, sf_dir):
    bse, v = F.col("exchange") == "BSE", F.col("volume")
    both = _with_copies(bars(spark, sf_dir), bse & (v % 4 == 0) & (v % 9 != 0))
    marked = F.col("_copy") | (bse & (v % 9 == 0))
    symbol = F.when(marked, F.concat("symbol", F.lit("#"))).otherwise(F.col("symbol"))
    return both.withColumn("symbol", symbol).drop("_copy")


# Trading days moved 24 years ahead (leap days stay), to cross the format changes.
DAYS_SQL = """
days AS (
  SELECT DISTINCT exchange, CAST(date + INTERVAL 24 YEAR AS date) AS date FROM bars
)"""


def days(spark, sf_dir):
    shifted = F.add_months("date", 24 * 12)
    return bars(spark, sf_dir).select("exchange", shifted.alias("date")).distinct()


# Fetch manifests of two sources; the second covers the later half of each month.
FETCH_SQL = """
fetch_days AS (SELECT DISTINCT exchange, date FROM bars),
fetch_a AS (
  SELECT exchange, date, exchange || '/' || CAST(date AS varchar) || '.csv' AS local_path,
         CASE dayofyear(date) % 11
           WHEN 0 THEN 'expected' WHEN 1 THEN 'failed' WHEN 2 THEN 'rate_limited'
           WHEN 3 THEN 'validated' WHEN 4 THEN 'skipped_existing' WHEN 5 THEN 'parse_failed'
           WHEN 6 THEN 'corrupt_html' ELSE 'downloaded' END AS status,
         CAST(1 AS bigint) AS attempts
  FROM fetch_days
), fetch_b AS (
  SELECT exchange, date, exchange || '/b/' || CAST(date AS varchar) || '.csv' AS local_path,
         CASE WHEN dayofyear(date) % 2 = 0 THEN 'downloaded' ELSE 'validated' END AS status,
         CAST(2 AS bigint) AS attempts
  FROM fetch_days WHERE day(date) > 15
)"""


def _fetch(frame, folder, status, attempts):
    path = F.concat("exchange", F.lit(folder), F.col("date").cast("string"), F.lit(".csv"))
    return frame.select(
        "exchange", "date", path.alias("local_path"), status.alias("status"),
        F.lit(attempts).cast("bigint").alias("attempts"),
    )


def fetch_manifests(spark, sf_dir):
    dated = bars(spark, sf_dir).select("exchange", "date").distinct()
    codes = [
        "expected", "failed", "rate_limited", "validated", "skipped_existing", "parse_failed",
        "corrupt_html",
    ]
    slot = F.dayofyear("date") % 11
    status = F.coalesce(*[F.when(slot == i, code) for i, code in enumerate(codes)], F.lit("downloaded"))
    later = F.when(F.dayofyear("date") % 2 == 0, "downloaded").otherwise("validated")
    return (
        _fetch(dated, "/", status, 1),
        _fetch(dated.where(F.day("date") > 15), "/b/", later, 2),
    )


# A local partition manifest with stand-in checksums, and a drifted remote inventory.
SYNC_SQL = """
local_parts AS (
  SELECT exchange, CAST(year(date) AS integer) AS year, CAST(month(date) AS integer) AS month,
         'local/' || exchange || '/' || CAST(year(date) * 100 + month(date) AS varchar) AS partition_path,
         CAST(count(*) * 100 AS bigint) AS file_size_bytes,
         md5(exchange || CAST(year(date) * 100 + month(date) AS varchar)) AS md5
  FROM bars GROUP BY exchange, year(date), month(date)
), remote_parts AS (
  SELECT exchange, year, month, 'remote/' || exchange || '/' || CAST(year * 100 + month AS varchar) AS object_key,
         CASE WHEN month % 7 = 0 THEN file_size_bytes + 1 ELSE file_size_bytes END AS size, md5 AS etag
  FROM local_parts WHERE month % 5 <> 0
  UNION ALL
  SELECT exchange, CAST(year + 100 AS integer), month, 'remote/extra/' || exchange || CAST(year * 100 + month AS varchar),
         file_size_bytes, md5
  FROM local_parts WHERE month = 12
)"""


def partition_sides(spark, sf_dir):
    code = (F.col("year") * 100 + F.col("month")).cast("string")
    local = (
        bars(spark, sf_dir)
        .groupBy("exchange", F.year("date").alias("year"), F.month("date").alias("month"))
        .agg((F.count("*") * 100).alias("file_size_bytes"))
        .withColumns(
            {
                "partition_path": F.concat(F.lit("local/"), "exchange", F.lit("/"), code),
                "md5": F.md5(F.concat("exchange", code)),
            }
        )
    )
    size = F.col("file_size_bytes")
    remote = local.where(F.col("month") % 5 != 0).select(
        "exchange", "year", "month",
        F.concat(F.lit("remote/"), "exchange", F.lit("/"), code).alias("object_key"),
        F.when(F.col("month") % 7 == 0, size + 1).otherwise(size).alias("size"),
        F.col("md5").alias("etag"),
    )
    extra = local.where(F.col("month") == 12).select(
        "exchange", (F.col("year") + 100).alias("year"), "month",
        F.concat(F.lit("remote/extra/"), "exchange", code).alias("object_key"),
        size.alias("size"), F.col("md5").alias("etag"),
    )
    return local, remote.unionByName(extra)


# Two strategies: the top five with a hundredth and a thousandth of the money. Prices
# of the derived bars are random, so full weights would leave the range of doubles.
DECISIONS_SQL = """
best AS (
  SELECT date, exchange, isin, symbol, max(adj_close) AS score
  FROM bars WHERE series = 'EQ' AND adj_close IS NOT NULL
  GROUP BY date, exchange, isin, symbol
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY date ORDER BY score DESC, symbol, exchange, isin) AS rank
  FROM best
), topn AS (
  SELECT date, 'top_n_adj_close_v1' AS strategy_id, exchange, isin, symbol,
         CAST(1.0 AS double) / count(*) OVER (PARTITION BY date) AS target_weight, CAST(rank AS bigint) AS rank, score
  FROM ranked WHERE rank <= 5
), decisions AS (
  SELECT * REPLACE ('light_v1' AS strategy_id, target_weight / 100 AS target_weight) FROM topn
  UNION ALL
  SELECT * REPLACE ('lighter_v1' AS strategy_id, target_weight / 1000 AS target_weight) FROM topn
)"""


def with_sql(*parts: str, select: str) -> str:
    """An oracle query from common table expressions and a final SELECT."""
    return "WITH " + ",\n".join(part.strip() for part in (BARS_SQL, *parts)) + "\n" + select.strip()
