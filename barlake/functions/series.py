"""Ordered series of one instrument, kept small enough for one task.

Trailing windows, lags and leads need an instrument's rows in order, which Spark does
by gathering them in one task. That is fine for a normal history but not for a key that
holds a large share of the table. ``split_series`` cuts such keys into consecutive
blocks of bounded size and copies the few neighbouring rows a frame reaches back to (or
ahead to) into the next block, so that every window result stays exact.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from barlake.functions.joins import null_safe_join
from barlake.session import scratch_dir

# Rows of one series handled by one task; a century of daily bars is some 26,000.
MAX_SERIES_ROWS = 250_000

BLOCK = "_block"
HALO = "_halo"
# Whether a row is one of the block's own or on the last date before them.
NEAR = "_near"
_FIRST_DAY, _LAST_DAY = -(2**31), 2**31 - 1


def split_series(
    df: DataFrame,
    keys: tuple[str, ...],
    order: tuple[str, ...],
    *,
    back: int = 0,
    ahead: int = 0,
    max_rows: int | None = MAX_SERIES_ROWS,
) -> list[tuple[DataFrame, bool]]:
    """The rows in parts, with ``_block``, ``_halo`` and ``_near``; the flag tells a part is in blocks.

    ``order`` is unique per key and starts with the date. One counting job decides:
    when no key exceeds ``max_rows`` there is one part, nothing is moved and every key
    is block 0. Else the oversized keys form a part that is cut into blocks between two dates, so a
    block has ``max_rows`` rows and those of one more date at most; numbers of blocks are unique and
    rise with the date. Rows learn their blocks from a small table, and are not moved for it.
    ``max_rows=None`` skips the count for input whose keys are bounded by construction.
    NULL keys form series like any others and a NULL date comes first, split or not.
    """
    whole = df.withColumns({BLOCK: F.lit(0).cast("bigint"), HALO: F.lit(False), NEAR: F.lit(True)})
    if max_rows is None:
        return [(whole, False)]
    if max_rows <= max(back, ahead):
        raise ValueError("max_rows must exceed the rows a frame reaches")
    sizes = df.groupBy(*keys).count().agg(
        F.count("*").alias("keys"), F.count(F.when(F.col("count") > max_rows, 1)).alias("oversized")
    ).first()
    if not sizes["oversized"]:
        return [(whole, False)]
    spans = _block_spans(df, keys, order[0], back, ahead, max_rows)
    day, span = _day_number(order[0]), F.col("_span")
    reached = F.filter("_spans", lambda s: (s["lo"] <= day) & (day <= s["hi"]))
    columns = [F.col(name) for name in df.columns]
    # One row per oversized key and an entry per block: some bytes for every ``max_rows`` rows.
    blocks = (
        null_safe_join(df, F.broadcast(spans), keys)
        .select(*columns, F.explode(reached).alias("_span"))
        # Joins by block would add this filter to some uses of the blocks, which then share no shuffle with the others.
        .where(span["block"].isNotNull())
        .select(
            *columns, span["block"].alias(BLOCK), ((day < span["first"]) | (day > span["last"])).alias(HALO),
            day.between(span["near"], span["last"]).alias(NEAR),
        )
    )
    if sizes["oversized"] == sizes["keys"]:
        return [(blocks, True)]
    return [(null_safe_join(whole, F.broadcast(spans.select(*keys)), keys, "left_anti"), False), (blocks, True)]


def _day_number(name: str) -> Column:
    """The date as a number; NULL comes first."""
    return F.coalesce(F.unix_date(name), F.lit(_FIRST_DAY))


def _block_spans(df: DataFrame, keys, day: str, back: int, ahead: int, max_rows: int) -> DataFrame:
    """The blocks of each oversized key: their dates, and those that a frame reaches from them.

    Counts per key and date are aggregated map-side; totals run over one row per date, which the calendar bounds.
    """
    series = Window.partitionBy(*keys)
    dated = df.select(*keys, _day_number(day).alias("_day")).groupBy(*keys, "_day").agg(F.count("*").alias("_n"))
    until = F.sum("_n").over(series.orderBy("_day").rowsBetween(Window.unboundedPreceding, 0))
    dated = dated.withColumns({"_until": until, "_total": F.sum("_n").over(series)}).where(F.col("_total") > max_rows)
    dated = dated.withColumn("_before", F.col("_until") - F.col("_n"))
    earlier = series.orderBy("_before").rangeBetween(Window.unboundedPreceding, -back)
    later = series.orderBy("_until").rangeBetween(ahead, Window.unboundedFollowing)
    dated = dated.withColumns(
        {
            "_lo": F.coalesce(F.max("_day").over(earlier), F.lit(_FIRST_DAY)) if back else F.col("_day"),
            "_hi": F.coalesce(F.min("_day").over(later), F.lit(_LAST_DAY)) if ahead else F.col("_day"),
            "_near": F.coalesce(F.lag("_day").over(series.orderBy("_day")), F.col("_day")),
        }
    )
    spans = dated.groupBy(*keys, F.floor(F.col("_before") / max_rows).alias("_at")).agg(
        F.min("_day").alias("first"), F.max("_day").alias("last"), F.min("_lo").alias("lo"), F.max("_hi").alias("hi"),
        F.min("_near").alias("near"),
    )
    path = scratch_dir(df.sparkSession, "blocks")
    spans.repartition(*keys).sortWithinPartitions(*keys, "_at").withColumn(
        "block", F.monotonically_increasing_id()
    ).write.parquet(path)
    stored = df.sparkSession.read.schema(
        ", ".join([f"`{name}` {df.schema[name].dataType.simpleString()}" for name in keys])
        + ", first int, last int, lo int, hi int, near int, block bigint"
    ).parquet(path)
    return stored.groupBy(*keys).agg(F.collect_list(F.struct("block", "first", "last", "lo", "hi", "near")).alias("_spans"))


def own_rows(df: DataFrame) -> DataFrame:
    """Drop the copied neighbour rows once the windows are computed."""
    return df.where(~F.col(HALO)).drop(HALO, NEAR)


def over_series(
    parts: list[tuple[DataFrame, bool]], compute: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Add window columns to each part and put the parts together again."""
    done = [own_rows(compute(part)) if in_blocks else compute(part).drop(HALO, NEAR) for part, in_blocks in parts]
    return reduce(DataFrame.unionByName, done)


def ordered(keys: tuple[str, ...], order: tuple[str, ...]) -> WindowSpec:
    return Window.partitionBy(*keys, BLOCK).orderBy(*order)


def trailing(window: WindowSpec, rows: int) -> WindowSpec:
    """The current row and the ``rows - 1`` before it."""
    return window.rowsBetween(-(rows - 1), 0)


def after(count: Column, minimum: int, value: Column) -> Column:
    """``value`` once at least ``minimum`` observations are in the frame, else NULL."""
    return F.when(count >= minimum, value)
