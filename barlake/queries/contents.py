"""Months compared by their rows, and audits that read only what changed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from barlake.plans.contents import compare_contents, incremental_audit, month_contents, refresh_states
from barlake.plans.history import audit_history, partition_manifest, store_bars
from barlake.plans.publish import publish_history, publish_status
from barlake.queries import adapter as a
from barlake.queries.quality import _DUPLICATES, _flat, _verdict
from barlake.schema import MONTH_KEY, add_month_columns
from barlake.session import scratch_dir
from barlake.storage import read_months, stage_months, write_months


def _lay_out_anew(bars, path):
    """The same rows in three files a month or more, in another order; no file holds more than a task should."""
    months, third = add_month_columns(bars), F.pmod(F.xxhash64("isin"), F.lit(3))
    # Keys in another order for each third: Spark joins tasks of a union whose sides are dealt alike.
    dealt = [months.where(third == part).hint("rebalance", *MONTH_KEY[part:], *MONTH_KEY[:part]) for part in range(3)]
    reduce(DataFrame.unionByName, dealt).sortWithinPartitions(*MONTH_KEY, F.desc("volume")).write.mode("overwrite").partitionBy(*MONTH_KEY).parquet(path)


def content_status(spark, sf_dir):
    """A copy laid out anew, with a month lost, some closes changed by a cent and a month added."""
    rows = a.bars(spark, sf_dir)
    source, copy = scratch_dir(spark, "bars"), scratch_dir(spark, "copy")
    store_bars(spark, rows, source)
    nse = (F.col("exchange") == "NSE") & (F.year("date") == 1998)
    july = nse & (F.month("date") == 7) & (F.day("date") <= 10)
    copied = rows.withColumn("close", F.when(july, F.col("close") + 0.01).otherwise(F.col("close")))
    kept = copied.where(~(nse & (F.month("date") == 6)))
    added = rows.where(nse & (F.month("date") == 8)).withColumn("date", F.add_months("date", 32 * 12))
    _lay_out_anew(kept.unionByName(added), copy)
    return compare_contents(*[month_contents(read_months(spark, path)) for path in (source, copy)])


def relaid_status(spark, sf_dir):
    """Published, then the source laid out anew with one month dearer: what must be published again."""
    rows = a.bars(spark, sf_dir)
    source, target = scratch_dir(spark, "bars"), scratch_dir(spark, "published")
    store_bars(spark, rows, source)
    _, total = audit_history(spark, source)
    fetched = rows.select("exchange", "date", F.lit("validated").alias("status"))
    publish_history(spark, source, target, audit=total, fetch_manifest=fetched, manifest=partition_manifest(spark, source))
    july = (F.col("exchange") == "NSE") & (F.year("date") == 1998) & (F.month("date") == 7)
    _lay_out_anew(rows.withColumn("close", F.when(july, F.col("close") + 1).otherwise(F.col("close"))), source)
    return publish_status(spark, target, partition_manifest(spark, source), source).select(*MONTH_KEY, "status")


def incremental_months(spark, sf_dir):
    """The audit of a table of which half the months were audited before, some of them changed since."""
    # Both writes read months that are derived and dealt once.
    rows = read_months(spark, stage_months(a.bars_dirty(spark, sf_dir), spark, "derived"))
    path, store = scratch_dir(spark, "bars"), scratch_dir(spark, "states")
    early, march = rows.where(F.col("month") <= 6), F.col("month") == 3
    write_months(early.withColumn("close", F.when(march, -F.col("close")).otherwise(F.col("close"))), path, by_month=True)
    refresh_states(spark, path, store)
    write_months(rows.where((F.col("month") > 6) | march), path, by_month=True)
    return _flat(incremental_audit(spark, path, store)[0])


_MONTHS = """
SELECT DISTINCT exchange, CAST(year(date) AS int) AS year, CAST(month(date) AS int) AS month,
  CASE {cases} ELSE 'OK' END AS status FROM bars"""
_JUNE = "WHEN exchange = 'NSE' AND year(date) = 1998 AND month(date) = 6 THEN 'MISSING'"
_JULY = "WHEN exchange = 'NSE' AND year(date) = 1998 AND month(date) = 7 THEN 'STALE'"

CONTENT_QUERIES = {
    "content_status": (content_status, a.with_sql(
        select=_MONTHS.format(cases=f"{_JUNE} {_JULY}") + " UNION ALL SELECT 'NSE', 2030, 8, 'EXTRA'"
    )),
    "relaid_status": (relaid_status, a.with_sql(select=_MONTHS.format(cases=_JULY))),
    "incremental_audit": (incremental_months, a.with_sql(a.DIRTY_SQL, _DUPLICATES, select=_verdict("*", "audited"))),
}
