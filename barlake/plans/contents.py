"""What the months of a table hold: digests of their rows and their audits, renewed only where files changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barlake.files import partition_folders
from barlake.journal import prepare, settle
from barlake.operators.normalize import key_tasks
from barlake.operators.quality import global_audit, partition_audit
from barlake.plans.history import audit_history
from barlake.schema import BARS, MONTH_KEY
from barlake.sources.inventory import file_name, list_files, with_partition_identity
from barlake.storage import has_months, only_months, read_months


def _row_hash(seed: int) -> Column:
    # A NULL leaves a hash as it is, so whether a value is there is hashed beside it.
    parts = [part for name in BARS.names for part in (F.col(name), F.col(name).isNull())]
    return F.xxhash64(F.lit(seed), *parts).cast("decimal(20,0)")


def month_contents(table: DataFrame) -> DataFrame:
    """``exchange, year, month, rows, content, misplaced_rows`` of each folder of a monthly table.

    ``content`` tells the rows as a multiset: number and two sums of row hashes, so it does not
    depend on the files, their order or the order of rows, but does on how often a row repeats. Each
    month is one row after partial aggregation. Misplaced are rows whose date belongs to another month.
    """
    here = (F.col("year") == F.year("date")) & (F.col("month") == F.month("date"))
    sums = table.groupBy(*MONTH_KEY).agg(
        F.count("*").alias("rows"), F.sum(_row_hash(0)).alias("_first"), F.sum(_row_hash(1)).alias("_second"),
        F.sum((~F.coalesce(here, F.lit(False))).cast("bigint")).alias("misplaced_rows"),
    )
    content = F.sha2(F.concat_ws(":", *[F.col(n).cast("string") for n in ("rows", "_first", "_second")]), 256)
    return sums.select(*MONTH_KEY, "rows", content.alias("content"), "misplaced_rows")


def compare_contents(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """OK, MISSING, STALE or EXTRA for each month of either side: whether their rows are the same."""
    left = ours.select(*MONTH_KEY, F.col("content").alias("_ours"))
    right = theirs.select(*MONTH_KEY, F.col("content").alias("_theirs"))
    status = (
        F.when(F.col("_ours").isNull(), "EXTRA").when(F.col("_theirs").isNull(), "MISSING")
        .when(F.col("_ours") == F.col("_theirs"), "OK").otherwise("STALE")
    )
    return left.join(right, list(MONTH_KEY), "full").select(*MONTH_KEY, status.alias("status"))


def month_signatures(spark: SparkSession, path: str) -> DataFrame:
    """``exchange, year, month, signature``: names, sizes and times of each month's files, which are not opened."""
    files = with_partition_identity(list_files(spark, path)).where(F.col("path").endswith(".parquet"))
    told = F.concat_ws(":", file_name(F.col("path")), F.col("length").cast("string"), F.unix_micros("modified").cast("string"))
    signature = F.sha2(F.array_join(F.array_sort(F.collect_list(told)), ","), 256)
    return files.where(F.col("month").isNotNull()).groupBy(*MONTH_KEY).agg(signature.alias("signature"))


def _place(month: tuple[str, int, int]) -> str:
    return "exchange={}/year={}/month={}".format(*month)


def _by_month(rows: DataFrame, column: str) -> dict[tuple[str, int, int], str]:
    """At most exchanges x calendar months."""
    return {(r.exchange, r.year, r.month): r[column] for r in rows.select(*MONTH_KEY, column).collect()}


def stored_states(spark: SparkSession, store: str) -> DataFrame | None:
    settle(spark, store)
    if not partition_folders(spark, store):
        return None
    states = spark.read.parquet(store)
    return states.withColumns({n: F.col(n).cast(BARS["exchange"].dataType if n == "exchange" else "int") for n in MONTH_KEY})


def changed_months(spark: SparkSession, path: str, store: str) -> tuple[dict, list]:
    """Signatures of the table's months, and the months whose stored state is missing or of other files."""
    listed = _by_month(month_signatures(spark, path), "signature") if has_months(spark, path) else {}
    states = stored_states(spark, store)
    known = _by_month(states, "signature") if states is not None else {}
    return listed, sorted(month for month, signature in listed.items() if known.get(month) != signature)


def refresh_states(spark: SparkSession, path: str, store: str) -> DataFrame | None:
    """Contents and audit of every month of the table at ``path``, kept at ``store``; None for a table without rows.

    Only months whose files changed since the last call are read, others come from the store; states of months
    that are gone are dropped. Files are listed before they are read, so that a change in between is seen
    by the next call. The store changes as a whole, and one that is lost is made anew.
    """
    settle(spark, path)
    listed, changed = changed_months(spark, path, store)
    current = {_place(m) for m in listed} - {_place(m) for m in changed}

    def write(folder: str) -> None:
        if not changed:
            return
        bars = only_months(read_months(spark, path), changed)
        audit = partition_audit(bars, tasks=key_tasks(bars.count())).drop("rows")
        rows = [(*month, listed[month]) for month in changed]
        signatures = spark.createDataFrame(rows, "exchange string, year int, month int, signature string")
        states = month_contents(bars).join(audit, list(MONTH_KEY), "left").join(F.broadcast(signatures), list(MONTH_KEY))
        states.repartition(1).write.partitionBy(*MONTH_KEY).parquet(folder)

    if changed or set(partition_folders(spark, store)) - current:
        prepare(spark, store, write, lambda folder: None, drop=lambda present, new: set(present) - current)
    return stored_states(spark, store)


def incremental_audit(spark: SparkSession, path: str, store: str) -> tuple[DataFrame, DataFrame]:
    """The monthly and the global audit of a table, as ``audit_history`` gives them, from the states of its months.

    Months whose files are unchanged are not read. As an audit goes by date and a state by folder, a table with
    misplaced rows, which fails its audit anyway, is read whole.
    """
    states = refresh_states(spark, path, store)
    if states is None or states.agg(F.sum("misplaced_rows")).first()[0]:
        return audit_history(spark, path)
    bars = read_months(spark, path)
    partitions = states.select(*partition_audit(bars).columns)
    total = global_audit(partitions, bars).withColumn("misplaced_rows", F.lit(0))
    # In the order of columns of the whole audit.
    return partitions, total.select(*[n for n in total.columns if n != "misplaced_rows"], "misplaced_rows")
