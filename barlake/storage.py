"""Monthly bar tables on any Hadoop file system: write, replace, upsert."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from barlake.files import (  # noqa: F401 (the first ones are also imported from here)
    count_files,
    delete_path,
    move_path,
    path_exists,
    remove_others,
    partition_folders,
)
from barlake.functions.joins import null_safe_join
from barlake.journal import prepare, read_settled, settle
from barlake.operators.normalize import assert_bars
from barlake.schema import BAR_KEY, BAR_ORDER, BARS, MONTH_KEY, add_month_columns, conform
from barlake.session import scratch_dir

# Files of a month from which on an upsert puts them together again.
MONTH_FILES = 16

# Prices that mostly equal another one: a bar of one trade, unadjusted. Each follows from what is before it.
_ALIKE = {"high": "open", "low": "open", "close": "open"} | {f"adj_{name}": name for name in ("open", "high", "low", "close")}


def _alike(name: str, other: Column) -> Column:
    """Whether the value is that of the other column to the bit: zeros may differ in their sign."""
    return F.col(name).eqNullSafe(other) & F.coalesce(F.col(name) != 0, F.lit(True))


def _dealt(months: DataFrame, deal: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows shuffled by ``deal``; prices that repeat another one of their row are put back after it."""
    average = F.try_divide("turnover", "volume")
    told = {name: F.col(other) for name, other in _ALIKE.items()} | {"vwap": average}
    alike = reduce(Column.__add__, [_alike(name, other).cast("int") * 2**i for i, (name, other) in enumerate(told.items())])
    marked = months.withColumn("_alike", alike)

    def is_alike(name: str) -> Column:
        return F.col("_alike").bitwiseAND(2 ** list(told).index(name)) != 0

    thin = deal(marked.withColumns({name: F.when(~is_alike(name), F.col(name)) for name in told}))
    for names in (("high", "low", "close", "vwap"), [name for name in told if name.startswith("adj_")]):
        thin = thin.withColumns({name: F.when(is_alike(name), told[name]).otherwise(F.col(name)) for name in names})
    return thin.drop("_alike")


def _dealt_by_month(months: DataFrame) -> DataFrame:
    """Rows rebalanced by month."""
    return _dealt(months, lambda rows: rows.hint("rebalance", *MONTH_KEY))


def write_months(
    bars: DataFrame, path: str, *, overwrite: str = "dynamic", by_month: bool = False
) -> None:
    """Write bars as ``exchange=/year=/month=`` folders, sorted inside each file.

    The rebalance hint shuffles by month, but lets adaptive execution split a month
    that is too large for one task and merge tiny ones, so a hot exchange or month
    becomes several sorted files instead of one straggler. ``overwrite`` is ``dynamic``
    (replace only the months written) or ``static`` (replace the whole table). Bars that
    were read from a monthly table are ``by_month`` already and need no shuffle.
    """
    months = add_month_columns(conform(bars, BARS))
    placed = months if by_month else _dealt_by_month(months)
    (
        placed.sortWithinPartitions(*MONTH_KEY, *BAR_ORDER)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", overwrite)
        .option("compression", "zstd")
        .partitionBy(*MONTH_KEY)
        .parquet(path)
    )


def stage_months(bars: DataFrame, spark: SparkSession, name: str) -> str:
    """Write bars to a scratch table and return its path."""
    path = scratch_dir(spark, name)
    write_months(bars, path, overwrite="static")
    return path


def _promote(spark: SparkSession, path: str) -> None:
    settle(spark, path)


def read_months(spark: SparkSession, path: str) -> DataFrame:
    """The table with its ``year`` and ``month`` columns, ready for ``date_window``."""
    frame = read_settled(spark, path, lambda: spark.read.parquet(path))
    return frame.select(*[F.col(f.name).cast(f.dataType) for f in BARS.fields], "year", "month")


def keep_last(rows: DataFrame, keys, order) -> DataFrame:
    """One row per key: the last by ``order``, an explicit and unique ordinal.

    Spark limits each key to its first row before the shuffle, so repeated keys do
    not pile up on one task.
    """
    latest = Window.partitionBy(*keys).orderBy(*[F.col(name).desc() for name in order])
    return (
        rows.withColumn("_recency", F.row_number().over(latest))
        .where(F.col("_recency") == 1)
        .drop("_recency")
    )


def swap_months(
    spark: SparkSession,
    bars: DataFrame,
    path: str,
    check: Callable[[DataFrame], object],
    *,
    by_month: bool = False,
    needed: str | None = None,
    drop: Callable[[list[str], list[str]], Iterable[str]] = lambda present, new: (),
) -> list[str]:
    """Write whole months beside a table, check them, and move them into place; returns their folders.

    ``check`` gets the months as written; if it raises, the table stays as it was. ``drop`` gets the
    folders of the table's months and of the new ones and tells which of the former go in the same change. ``needed`` is the
    error when there are no new months at all.
    """

    def written(folder: str) -> None:
        if partition_folders(spark, folder):
            check(spark.read.parquet(folder))
        elif needed:
            raise FileNotFoundError(needed)

    settle(spark, path)
    new = prepare(
        spark, path, lambda folder: write_months(bars, folder, overwrite="static", by_month=by_month), written, drop=drop
    )
    _promote(spark, path)
    return new


def has_months(spark: SparkSession, path: str) -> bool:
    """Whether a table has any month; the folder alone may be that of a job that died."""
    return bool(partition_folders(spark, path))


def last_read(rows: DataFrame, recency: Sequence[str] | None = None) -> DataFrame:
    """One bar per key: of repeated keys the one that comes last.

    What comes last is said by the ``recency`` columns, which are the caller's. Without them, of rows
    read from parquet files the one in the later file by name and the later row of it, however Spark deals
    files to tasks; of other rows, the later one in the DataFrame.
    """
    if recency:
        return keep_last(rows, BAR_KEY, recency)
    try:
        placed = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    except AnalysisException:
        placed = rows.select("*", F.lit("").alias("_file"), F.monotonically_increasing_id().alias("_row"))
    return keep_last(placed, BAR_KEY, ["_file", "_row"]).drop("_file", "_row")


def _last_of_repeated(rows: DataFrame, recency: Sequence[str] | None) -> DataFrame:
    """``last_read`` for rows of which some repeat a key; others are not shuffled for it, only their keys to find out."""
    repeated = rows.groupBy(*BAR_KEY).count().where("count > 1")
    return rows if repeated.isEmpty() else last_read(rows, recency)


def _check_merge(mode: str) -> None:
    if mode not in ("upsert", "replace_day"):
        raise ValueError(f"unknown merge mode: {mode}")


_DAY = ["exchange", "date"]


def _refreshed_days(refreshed: DataFrame) -> DataFrame:
    """At most exchanges x calendar days, small enough for every executor."""
    return F.broadcast(refreshed.select(*_DAY).distinct())


def merge_day(
    existing: DataFrame, refreshed: DataFrame, *, mode: str = "upsert", recency: Sequence[str] | None = None
) -> DataFrame:
    """Existing bars with refreshed ones put in by key.

    ``upsert`` keeps bars of a refreshed day that the new data lacks; ``replace_day``
    drops them. Bars of other days pass through unshuffled; only those of refreshed days
    are compared by key. Of refreshed rows with one key the last one stays, as ``last_read``
    tells it.
    """
    _check_merge(mode)
    days = _refreshed_days(refreshed)
    merged = [existing.join(days, _DAY, "left_anti"), last_read(refreshed, recency)]
    if mode == "upsert":
        keys = refreshed.select(*BAR_KEY).distinct()
        same_day = existing.join(days, _DAY, "left_semi")
        merged.append(null_safe_join(same_day, keys, BAR_KEY, "left_anti"))
    return reduce(DataFrame.unionByName, [conform(rows, BARS) for rows in merged])


def _merge_by_month(
    existing: DataFrame, refreshed: DataFrame, *, mode: str, recency: Sequence[str] | None
) -> DataFrame:
    """What ``merge_day`` gives, as rows that need no shuffle by month.

    Bars of other days stay with the files they were read from. Those of refreshed days are shuffled once,
    by ranges of days, so that a task compares all keys of its days and has days of few months.
    """
    _check_merge(mode)
    days = _refreshed_days(refreshed)
    others = conform(existing.join(days, _DAY, "left_anti"), BARS)
    fresh = conform(_last_of_repeated(refreshed, recency), BARS).withColumn("_new", F.lit(True))
    if mode == "upsert":
        same_day = conform(existing.join(days, _DAY, "left_semi"), BARS)
        fresh = fresh.unionByName(same_day.withColumn("_new", F.lit(False)))
    dealt = _dealt(fresh, lambda rows: rows.repartitionByRange(*_DAY))
    replaced = F.max("_new").over(Window.partitionBy(*BAR_KEY))
    return others.unionByName(dealt.withColumn("_replaced", replaced).where(F.col("_new") | ~F.col("_replaced")).select(*BARS.names))


def touched_months(rows: DataFrame) -> list[tuple[str, int, int]]:
    """The months a batch writes to: at most exchanges x calendar months."""
    months = add_month_columns(rows.select("exchange", "date")).select(*MONTH_KEY).distinct()
    return sorted((r.exchange, r.year, r.month) for r in months.collect())


def only_months(df: DataFrame, months: list[tuple[str, int, int]]) -> DataFrame:
    """Restrict a monthly table to given partitions, as a prunable partition filter."""
    condition = F.lit(False)
    for exchange in sorted({m[0] for m in months}):
        numbers = [year * 100 + month for e, year, month in months if e == exchange]
        condition |= (F.col("exchange") == exchange) & (
            F.col("year") * 100 + F.col("month")
        ).isin(numbers)
    return df.where(condition)


def upsert_bars(
    spark: SparkSession, refreshed: DataFrame, path: str, *, mode: str = "upsert", recency: Sequence[str] | None = None
) -> list[tuple[str, int, int]]:
    """Put refreshed bars into a monthly table, rewriting only the months they touch.

    Bars of other days are not shuffled, unless the months lie in many files by now: then whole months are dealt anew.
    The merged months are written beside the table and checked (no NULL or repeated keys)
    before any month of it is touched. They are then moved into place; what a job that dies on
    the way leaves is finished by the next writer or reader. Of repeated keys the last one stays, by the ``recency`` columns or by file
    name and row. Re-running with the same rows changes nothing.
    """
    months = touched_months(refreshed)
    if not months:
        return []
    settle(spark, path)
    by_month = False
    if has_months(spark, path):
        existing = only_months(read_months(spark, path), months)
        by_month = not _in_many_files(spark, path, months)
        merge = _merge_by_month if by_month else merge_day
        merged = merge(existing, refreshed, mode=mode, recency=recency)
    else:
        merged = conform(last_read(refreshed, recency), BARS)
    swap_months(spark, merged, path, assert_bars, by_month=by_month)
    return months


def _in_many_files(spark: SparkSession, path: str, months: list[tuple[str, int, int]]) -> bool:
    """Whether months lie in many files: each upsert that leaves bars with their files can add one to a month."""
    counts = [count_files(spark, f"{path}/exchange={exchange}/year={year}/month={month}") for exchange, year, month in months]
    return sum(counts) > MONTH_FILES * len(months)
