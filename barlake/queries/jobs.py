"""Jobs that write: tables, raw ingest, paper runs, publishing and streams."""

from __future__ import annotations

import io
import zipfile
from datetime import date
from functools import reduce

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F

from barlake.plans.contents import incremental_audit
from barlake.plans.history import (
    audit_history,
    build_history,
    ingest_once,
    partition_manifest,
    store_bars,
)
from barlake.plans.paper import run_paper
from barlake.plans.publish import publish_history, publish_status
from barlake.operators.decisions import top_n_by_price
from barlake.queries import adapter as a
from barlake.schema import BAR_KEY, BARS, EXCHANGES
from barlake.session import scratch_dir
from barlake.sources.inventory import list_files, usage_by_prefix
from barlake.sources.tables import scan_decisions
from barlake.storage import delete_path, keep_last, merge_day, read_months, stage_months, upsert_bars, write_months
from barlake.streaming.ingest import append_decision_stream, audit_stream, ingest_bars, stream_files

_COMPARED = [n for n in BARS.names if n not in ("vwap", "delivery_pct")]
_LIST = ", ".join(_COMPARED)


def partition_write(spark, sf_dir):
    path = scratch_dir(spark, "bars")
    write_months(a.bars(spark, sf_dir), path)
    return read_months(spark, path).select(*_COMPARED)


def _refreshed(bars):
    """The last ten days of every month again, for even volumes, one percent dearer."""
    late = (F.day("date") > 20) & (F.col("volume") % 2 == 0)
    return bars.where(late).withColumns(
        {n: F.col(n) * 1.01 for n in ("close", "adj_close")}
    )


def _stored(spark, path):
    """The bars of a written table: reading them is cheaper than deriving them once more."""
    return read_months(spark, path).select(*BARS.names)


def upsert_day(spark, sf_dir):
    rows = a.bars(spark, sf_dir)
    return _closes(merge_day(rows, _refreshed(rows)))


def replace_day(spark, sf_dir):
    rows = a.bars(spark, sf_dir)
    return _closes(merge_day(rows, _refreshed(rows), mode="replace_day"))


def _closes(bars):
    return bars.select("date", "exchange", "isin", "series", "close", "volume")


def upsert_table(spark, sf_dir):
    """The upsert into a written table, run twice: the second run must change nothing."""
    rows = a.bars(spark, sf_dir)
    path = scratch_dir(spark, "bars")
    write_months(rows, path)
    refreshed = scratch_dir(spark, "refreshed")
    _refreshed(_stored(spark, path)).write.parquet(refreshed)
    for _ in range(2):
        upsert_bars(spark, spark.read.parquet(refreshed), path)
    return _closes(read_months(spark, path))


def upsert_duplicates(spark, sf_dir):
    """Refreshed rows that repeat their keys, over files of different size: the later file's last row stays."""
    rows = a.bars(spark, sf_dir)
    path, refreshed = scratch_dir(spark, "bars"), scratch_dir(spark, "refreshed")
    write_months(rows.where(F.year("date") < 1998), path)
    again = _refreshed(rows)

    def close_plus(*added):
        times = F.explode(F.array(*map(F.lit, added)))
        return again.withColumn("_add", times).orderBy(*BAR_KEY, "_add").withColumn("close", F.col("close") + F.col("_add")).drop("_add")

    # The files of the first and the last folder are the smaller ones; those of a folder are in order.
    for name, added in (("1", (7.0,)), ("2", (2.0, 3.0, 4.0)), ("3", (0.5, 1.0))):
        close_plus(*added).write.parquet(f"{refreshed}/{name}")
    files = [f"{refreshed}/{name}" for name in ("2", "3", "1")]
    upsert_bars(spark, spark.read.parquet(*files), path)
    return _closes(read_months(spark, path))


def keep_last_rows(spark, sf_dir):
    rows = a.bars_multi(spark, sf_dir)
    return keep_last(rows, ("date", "exchange", "isin"), ["series"]).select(
        "date", "exchange", "isin", "series", "close"
    )


def only_missing_write(spark, sf_dir):
    """Months 1 to 6 first, then the whole year at a higher price for missing months only."""
    path = scratch_dir(spark, "bars")
    # Both builds read months that are derived and dealt once.
    rows = read_months(spark, stage_months(a.bars(spark, sf_dir), spark, "derived"))
    store_bars(spark, rows.where(F.col("month") <= 6), path, by_month=True)
    store_bars(spark, rows.withColumn("close", F.col("close") + 1), path, mode="only_missing", by_month=True)
    return _closes(read_months(spark, path))


def repaired_write(spark, sf_dir):
    path = scratch_dir(spark, "bars")
    store_bars(spark, a.bars(spark, sf_dir), path)

    def dearer():
        return _stored(spark, path).withColumn("close", F.col("close") + 1)

    store_bars(spark, dearer(), path, mode="repair", partition=("NSE", 1998, 6))
    store_bars(spark, dearer().where(F.year("date") == 1997), path, mode="clean", exchanges=("BSE",))
    return _closes(read_months(spark, path))


_HEADERS = {
    "NSE": ["SYMBOL", "SERIES", "OPEN", "HIGH", "LOW", "CLOSE", "PREVCLOSE", "TOTTRDQTY",
            "TOTTRDVAL", "TIMESTAMP", "TOTALTRADES", "ISIN", "DELIV_QTY"],
    "BSE": ["TckrSymb", "SctySrs", "OpnPric", "HghPric", "LwPric", "ClsPric", "PrvsClsgPric",
            "TtlTradgVol", "TtlTrfVal", "TradDt", "TtlNbOfTxsExctd", "ISIN", "DELIVQTY",
            "BizDt", "Sgmt", "Src", "FinInstrmTp"],
}
_PLACES = ["symbol", "series", "open", "high", "low", "close", "prev_close", "volume", "turnover"]


def write_raw_files(spark, bars, path) -> None:
    """Render bars as exchange files, one per day: NSE as zipped CSV, BSE as CSV."""
    names = {
        "NSE": ("dd-MMM-yyyy", "cm%sbhav.csv.zip", "ddMMMyyyy"),
        "BSE": ("yyyy-MM-dd", "BhavCopy_BSE_CM_0_0_0_%s_F_0000.CSV", "yyyyMMdd"),
    }
    kinds = dict(bars.dtypes)

    def as_open(name):
        return F.col("open").cast(kinds[name])

    def alike(name):
        # Zeros may differ in their sign; text cannot.
        signed = F.lit(True) if kinds[name] == "string" else F.coalesce(F.col(name) != 0, F.lit(True))
        return F.col(name).eqNullSafe(as_open(name)) & signed

    # Rows are dealt by day as they are and rendered after it; prices that repeat the open are not shuffled.
    told = ("high", "low", "close")
    needed = ["date", *_PLACES, "trades", "isin", "deliverable_qty"]
    for exchange, header in _HEADERS.items():
        style, pattern, stamp = names[exchange]
        day = F.upper(F.date_format("date", style))
        fields = [F.col(n).cast("string") for n in _PLACES]
        fields += [day, F.col("trades").cast("string"), F.col("isin")]
        fields.append(F.col("deliverable_qty").cast("string"))
        if exchange == "BSE":
            fields += [day, F.lit("CM"), F.lit("BSE"), F.lit("STK")]
        line = F.concat_ws(",", *[F.coalesce(f, F.lit("")) for f in fields])
        file = F.format_string(pattern, F.upper(F.date_format("date", stamp)))
        thin = bars.where(F.col("exchange") == exchange).select(
            *[n for n in needed if n not in told], *[F.when(~alike(n), F.col(n)).alias(n) for n in told],
            *[alike(n).alias(f"_{n}") for n in told],
        )
        rows = thin.repartition("date").withColumns(
            {n: F.when(F.col(f"_{n}"), as_open(n)).otherwise(F.col(n)) for n in told}
        )
        rows.select("date", file.alias("file"), line.alias("line")).groupBy("date").applyInPandas(
            _file_writer(f"{path}/{exchange}", ",".join(header)), "file string"
        ).count()


def _file_writer(folder, header):
    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        name = pdf["file"].iloc[0]
        content = "\n".join([header, *pdf["line"], ""]).encode()
        if name.endswith(".zip"):
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr(name.removesuffix(".zip"), content)
            content = buffer.getvalue()
        filesystem, base = pafs.FileSystem.from_uri(folder)
        filesystem.create_dir(base, recursive=True)
        with filesystem.open_output_stream(f"{base}/{name}") as out:
            out.write(content)
        return pdf[["file"]].head(1)

    return write


def raw_ingest(spark, sf_dir):
    raw, table = scratch_dir(spark, "raw"), scratch_dir(spark, "bars")
    write_raw_files(spark, a.bars(spark, sf_dir), raw)
    build_history(spark, raw, table)
    return read_months(spark, table).select(*_COMPARED)


def raw_ingest_flat(spark, sf_dir):
    raw, table = scratch_dir(spark, "raw"), scratch_dir(spark, "flat")
    write_raw_files(spark, a.bars(spark, sf_dir), raw)
    summaries = [ingest_once(spark, f"{raw}/{name}", name, f"{table}/{name}") for name in EXCHANGES]
    return reduce(DataFrame.unionByName, summaries).withColumn("exchanges", F.array_join("exchanges", ","))


def built_manifest(spark, sf_dir):
    """The partition manifest of a written table; sizes and checksums exist for each month."""
    path = scratch_dir(spark, "bars")
    write_months(a.bars(spark, sf_dir), path)
    rows = partition_manifest(spark, path)
    return rows.select(
        "exchange", "year", "month", "row_count", "min_date", "max_date", "symbols",
        (F.col("file_size_bytes") > 0).alias("has_size"), F.length("md5").cast("bigint").alias("md5_length"),
    )


def file_inventory(spark, sf_dir):
    """Files and bytes per exchange of a written table, against its own manifest."""
    path = scratch_dir(spark, "bars")
    write_months(a.bars(spark, sf_dir), path)
    files = list_files(spark, path).where(F.col("path").endswith(".parquet"))
    usage = usage_by_prefix(files, path)
    total = partition_manifest(spark, path).groupBy(
        F.concat(F.lit("exchange="), "exchange").alias("prefix")
    ).agg(F.count("*").alias("months"), F.sum("file_size_bytes").alias("manifest_bytes"))
    joined = usage.join(total, "prefix")
    return joined.select(
        "prefix", "months", (F.col("objects") >= F.col("months")).alias("enough_files"),
        (F.col("bytes") == F.col("manifest_bytes")).alias("same_bytes"),
    )


def history_audit(spark, sf_dir):
    """Write, audit and report; the report is read back."""
    path, report = scratch_dir(spark, "bars"), scratch_dir(spark, "audit")
    write_months(a.bars(spark, sf_dir), path)
    _, total = audit_history(spark, path, report)
    stored = spark.read.schema(total.schema).json(f"{report}/global")
    return stored.select("rows", "partitions", "duplicate_key_count", "invalid_ohlc_count", "passed")


def misplaced_rows(spark, sf_dir):
    """A month copied into the folder of the next one fails the audit."""
    rows, path = a.bars(spark, sf_dir), scratch_dir(spark, "bars")
    write_months(rows, path)
    june = (F.col("exchange") == "NSE") & (F.year("date") == 1998) & (F.month("date") == 6)
    names = [n for n in BARS.names if n != "exchange"]
    rows.where(june).select(*names).write.mode("append").parquet(f"{path}/exchange=NSE/year=1998/month=7")
    _, total = audit_history(spark, path)
    return total.select("misplaced_rows", "passed")


def published_months(spark, sf_dir):
    """Publish twice with one month repaired in between; counts what each run wrote."""
    rows = a.bars(spark, sf_dir)
    source, target = scratch_dir(spark, "bars"), scratch_dir(spark, "published")
    states = scratch_dir(spark, "states")
    fetched = spark.createDataFrame([], "exchange string, date date, local_path string, status string")
    store_bars(spark, rows, source)

    def publish():
        manifest = partition_manifest(spark, source)
        # Only months whose files changed are audited again.
        _, total = incremental_audit(spark, source, states)
        return publish_history(
            spark, source, target, audit=total, fetch_manifest=fetched, manifest=manifest
        )

    publish(), publish()
    dearer = _stored(spark, source).withColumn("close", F.col("close") + 1)
    store_bars(spark, dearer, source, mode="repair", partition=("NSE", 1998, 6))
    publish()
    return _closes(read_months(spark, f"{target}/bars"))


def published_status(spark, sf_dir):
    """What the target looks like after it lost one month, had one changed and one added."""
    source, target = scratch_dir(spark, "bars"), scratch_dir(spark, "published")
    store_bars(spark, a.bars(spark, sf_dir), source)
    rows = _stored(spark, source)
    manifest = partition_manifest(spark, source)
    _, total = audit_history(spark, source)
    fetched = rows.select("exchange", "date", F.lit("validated").alias("status"))
    publish_history(spark, source, target, audit=total, fetch_manifest=fetched, manifest=manifest)
    nse = rows.where((F.col("exchange") == "NSE") & (F.year("date") == 1998))
    delete_path(spark, f"{target}/bars/exchange=NSE/year=1998/month=6")
    changed = nse.where(F.month("date") == 7).withColumn("close", F.col("close") + 1)
    added = nse.where(F.month("date") == 8).withColumn("date", F.add_months("date", 32 * 12))
    write_months(changed.unionByName(added), f"{target}/bars")
    return publish_status(spark, target, manifest).select("exchange", "year", "month", "status")


def paper_run(spark, sf_dir):
    """Two paper days, the second one run twice."""
    rows = a.bars(spark, sf_dir)
    registry = spark.createDataFrame(
        [("top_a", "1", "active"), ("top_b", "1", "active"), ("top_c", "1", "retired")],
        "strategy_id string, version string, status string",
    )

    def strategy(name, n):
        return lambda known, dates: top_n_by_price(
            known.join(dates.select(F.col("as_of").alias("date")), "date", "left_semi"),
            top_n=n, strategy_id=name,
        )

    strategies = {"top_a": strategy("top_a", 2), "top_b": strategy("top_b", 4)}
    path = scratch_dir(spark, "paper")
    for day in (date(1998, 6, 29), date(1998, 6, 30), date(1998, 6, 30)):
        run_paper(spark, strategies, registry, rows, day, path)
    return scan_decisions(spark, path).withColumn("target_weight", F.round("target_weight", 6))


def _event_bars(events):
    """Events as bars: one instrument per user and day, the later event wins."""
    price = F.col("value")
    user = F.col("user_id").cast("string")
    values = {
        "date": F.to_date("ts"), "exchange": F.lit("NSE"), "isin": user, "symbol": user,
        "series": F.lit("EQ"), "volume": F.lit(1), "turnover": price, "trades": F.lit(1),
        "adj_factor": F.lit(1.0),
        **{n: price for n in ("open", "high", "low", "close", "adj_open", "adj_high", "adj_low", "adj_close", "vwap")},
        "prev_close": F.lit(None), "deliverable_qty": F.lit(None), "delivery_pct": F.lit(None),
    }
    return events.select(
        *[values[f.name].cast(f.dataType).alias(f.name) for f in BARS.fields], "event_id"
    )


def _event_stream(spark, sf_dir):
    schema = a.table(spark, sf_dir, "events").schema
    return stream_files(spark, f"{sf_dir}/events.parquet*", schema)


def stream_ingest(spark, sf_dir):
    table, checkpoint = scratch_dir(spark, "streamed"), scratch_dir(spark, "offsets")
    stream = _event_bars(_event_stream(spark, sf_dir))
    ingest_bars(stream, table, checkpoint, recency=("event_id",)).awaitTermination()
    return read_months(spark, table).select("date", "exchange", "symbol", "close")


def stream_decisions(spark, sf_dir):
    table, checkpoint = scratch_dir(spark, "decided"), scratch_dir(spark, "offsets")
    events = _event_stream(spark, sf_dir)
    user = F.col("user_id").cast("string")
    decided = events.select(
        F.to_date("ts").alias("date"), F.col("event_type").alias("strategy_id"),
        F.lit("NSE").alias("exchange"), user.alias("isin"),
        F.concat_ws("-", user, F.col("event_id").cast("string")).alias("symbol"),
        F.abs("value").alias("target_weight"), F.col("event_id").alias("rank"),
        F.lit(None).cast("double").alias("score"),
    )
    append_decision_stream(decided, table, checkpoint).awaitTermination()
    return scan_decisions(spark, table).select("date", "strategy_id", "isin", "symbol", "target_weight", "rank")


def stream_audit(spark, sf_dir):
    table, checkpoint = scratch_dir(spark, "audited"), scratch_dir(spark, "offsets")
    stream = _event_bars(_event_stream(spark, sf_dir)).withColumn(
        "volume", F.when(F.col("event_id") % 3 == 0, -1).otherwise(1)
    )
    audit_stream(stream, table, checkpoint).awaitTermination()
    sums = ["rows", "bad_prices", "bad_volume", "bad_turnover", "incomplete"]
    return spark.read.parquet(table).agg(*[F.sum(n).alias(n) for n in sums])


_REFRESHED = """
refreshed AS (
  SELECT * REPLACE (close * 1.01 AS close, adj_close * 1.01 AS adj_close)
  FROM bars WHERE day(date) > 20 AND volume % 2 = 0
)"""
_UPSERTED = a.with_sql(_REFRESHED, select="""
SELECT date, exchange, isin, series, close, volume FROM refreshed
UNION ALL
SELECT date, exchange, isin, series, close, volume FROM bars b WHERE NOT EXISTS (
  SELECT 1 FROM refreshed r WHERE r.date = b.date AND r.exchange = b.exchange AND r.isin = b.isin AND r.series = b.series)""")


def _repaired(condition: str, where: str = "true") -> str:
    return a.with_sql(select=f"""
SELECT date, exchange, isin, series, CASE WHEN {condition} THEN close + 1 ELSE close END AS close, volume
FROM bars WHERE {where}""")


_JUNE = "exchange = 'NSE' AND year(date) = 1998 AND month(date) = 6"

JOB_QUERIES = {
    "partition_write": (partition_write, a.with_sql(select=f"SELECT {_LIST} FROM bars")),
    "upsert_day": (upsert_day, _UPSERTED),
    "replace_day": (replace_day, a.with_sql(_REFRESHED, select="""
SELECT date, exchange, isin, series, close, volume FROM refreshed
UNION ALL
SELECT date, exchange, isin, series, close, volume FROM bars
WHERE (date, exchange) NOT IN (SELECT (date, exchange) FROM refreshed)""")),
    "upsert_table": (upsert_table, _UPSERTED),
    "upsert_duplicates": (upsert_duplicates, a.with_sql(select="""
SELECT date, exchange, isin, series,
  CASE WHEN day(date) > 20 AND volume % 2 = 0 THEN close * 1.01 + 1 ELSE close END AS close, volume
FROM bars WHERE year(date) < 1998 OR (day(date) > 20 AND volume % 2 = 0)""")),
    "keep_last": (keep_last_rows, a.with_sql(a.MULTI_SQL, select="""
SELECT date, exchange, isin, max(series) AS series, arg_max(close, series) AS close
FROM bars_multi GROUP BY date, exchange, isin""")),
    "only_missing_write": (only_missing_write, _repaired("month(date) > 6")),
    "repair_and_clean_write": (repaired_write, _repaired(
        f"{_JUNE} OR exchange = 'BSE'", "exchange = 'NSE' OR year(date) = 1997")),
    "raw_ingest": (raw_ingest, a.with_sql(select=f"SELECT {_LIST} FROM bars")),
    "raw_ingest_flat": (raw_ingest_flat, a.with_sql(select="""
SELECT count(*) AS rows, min(date) AS date_min, max(date) AS date_max, exchange AS exchanges,
  count(DISTINCT symbol) AS symbols, count(*) FILTER (WHERE deliverable_qty IS NULL) AS missing_deliverable_qty,
  count(*) AS missing_delivery_pct FROM bars GROUP BY exchange""")),
    "built_manifest": (built_manifest, a.with_sql(select="""
SELECT exchange, CAST(year(date) AS integer) AS year, CAST(month(date) AS integer) AS month,
  count(*) AS row_count, min(date) AS min_date, max(date) AS max_date, count(DISTINCT symbol) AS symbols,
  true AS has_size, CAST(32 AS bigint) AS md5_length FROM bars GROUP BY exchange, year(date), month(date)""")),
    "file_inventory": (file_inventory, a.with_sql(select="""
SELECT 'exchange=' || exchange AS prefix, count(DISTINCT year(date) * 100 + month(date)) AS months,
  true AS enough_files, true AS same_bytes FROM bars GROUP BY exchange""")),
    "history_audit": (history_audit, a.with_sql(select="""
SELECT count(*) AS rows, count(DISTINCT (exchange, year(date), month(date))) AS partitions,
  CAST(0 AS bigint) AS duplicate_key_count, CAST(0 AS bigint) AS invalid_ohlc_count, true AS passed FROM bars""")),
    "misplaced_rows": (misplaced_rows, a.with_sql(select="""
SELECT CAST(count(*) AS int) AS misplaced_rows, false AS passed FROM bars
WHERE exchange = 'NSE' AND year(date) = 1998 AND month(date) = 6""")),
    "published_months": (published_months, _repaired(_JUNE)),
    "published_status": (published_status, a.with_sql(select="""
SELECT DISTINCT exchange, CAST(year(date) AS int) AS year, CAST(month(date) AS int) AS month,
  CASE WHEN exchange = 'NSE' AND year(date) = 1998 AND month(date) = 6 THEN 'MISSING'
       WHEN exchange = 'NSE' AND year(date) = 1998 AND month(date) = 7 THEN 'STALE' ELSE 'OK' END AS status
FROM bars UNION ALL SELECT 'NSE', NULL, NULL, 'EXTRA'""")),
    "paper_run": (paper_run, a.with_sql(a.DECISIONS_SQL, select="""
SELECT date, strategy_id, exchange, isin, symbol,
  round(CAST(1 AS double) / count(*) OVER (PARTITION BY date, strategy_id), 6) AS target_weight,
  CAST(rank AS bigint) AS rank, score
FROM ranked JOIN (VALUES ('top_a', 2), ('top_b', 4)) s(strategy_id, n) ON rank <= n
WHERE date IN ('1998-06-29', '1998-06-30')""")),
    "stream_ingest": (stream_ingest, """
SELECT CAST(ts AS date) AS date, 'NSE' AS exchange, CAST(user_id AS varchar) AS symbol,
  arg_max(value, event_id) AS close FROM events GROUP BY CAST(ts AS date), user_id"""),
    "stream_decisions": (stream_decisions, """
SELECT CAST(ts AS date) AS date, event_type AS strategy_id, CAST(user_id AS varchar) AS isin,
  CAST(user_id AS varchar) || '-' || CAST(event_id AS varchar) AS symbol, abs(value) AS target_weight,
  event_id AS rank FROM events"""),
    "stream_audit": (stream_audit, """
SELECT count(*) AS rows, count(*) FILTER (WHERE value < 0) AS bad_prices,
  count(*) FILTER (WHERE event_id % 3 = 0) AS bad_volume, count(*) FILTER (WHERE value < 0) AS bad_turnover,
  CAST(count(*) FILTER (WHERE value IS NULL) AS bigint) AS incomplete FROM events"""),
}
