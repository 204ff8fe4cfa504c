"""Point-in-time joins between bars and decision dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from barlake.functions.dates import days_between


def lookback_slices(bars: DataFrame, as_of_dates: DataFrame, lookback_days: int) -> DataFrame:
    """Each bar once per as-of date whose look-back window it falls in, with ``as_of``.

    The small date table is expanded to the calendar days it looks back on, which makes
    the range join an equi-join on the date.
    """
    start = F.date_sub("as_of", lookback_days)
    days = as_of_dates.select("as_of").distinct()
    days = days.withColumn("date", F.explode(days_between(start, F.col("as_of"))))
    return bars.join(days, "date")


def latest_as_of(
    bars: DataFrame,
    as_of_dates: DataFrame,
    *,
    keys: tuple[str, ...] = ("exchange", "symbol"),
    tie_break: tuple[str, ...] = ("series", "isin"),
    lookback_days: int | None = None,
) -> DataFrame:
    """The last bar of each instrument on or before each as-of date.

    Bars count for the first as-of date that is not before them. Of the bars of an instrument
    between two as-of dates only the last one matters; they are reduced to it before the
    shuffle, so that an instrument leaves at most one row per as-of date and task. It then
    serves all as-of dates up to that of the instrument's next one.
    """
    # The as-of dates are calendar days: at most a few ten thousand.
    dates = sorted(row.as_of for row in as_of_dates.select("as_of").distinct().collect())
    if not dates:
        return bars.limit(0).withColumn("as_of", F.lit(None).cast("date"))
    spark = bars.sparkSession
    served = F.broadcast(_first_as_of(dates, spark).select(F.col("day").alias("date"), F.col("n").alias("_number")))
    # Days before the first as-of date all start at number 0; they need no table row.
    number = F.when(F.col("date") <= F.lit(dates[0]), 0).otherwise(F.col("_number"))
    known = bars.where(F.col("date") <= F.lit(dates[-1])).join(served, "date", "left")
    last = F.max_by(F.struct(*bars.columns), F.struct("date", *tie_break))
    reduced = known.withColumn("_from", number).groupBy(*keys, "_from").agg(last.alias("_bar"))
    following = F.lead("_from").over(Window.partitionBy(*keys).orderBy("_from"))
    until = F.coalesce(following, F.lit(len(dates))) - 1
    numbered = F.broadcast(spark.createDataFrame(list(enumerate(dates)), "_n int, as_of date"))
    found = (
        reduced.withColumn("_until", until)
        .select("_bar", F.explode(F.sequence(F.col("_from"), F.col("_until"))).alias("_n"))
        .join(numbered, "_n")
        .select("_bar.*", "as_of")
    )
    if lookback_days is None:
        return found
    return found.where(F.col("as_of") <= F.date_add("date", lookback_days))


def _first_as_of(dates: list, spark) -> DataFrame:
    """For each day from the first as-of date on, how many as-of dates lie before it.

    One row per calendar day up to the day after the last as-of date.
    """
    spans = [
        (i, dates[i - 1] if i else dates[0], dates[i] if i < len(dates) else dates[-1])
        for i in range(len(dates) + 1)
    ]
    frame = spark.createDataFrame(spans, "n int, after date, upto date")
    day_after = F.date_add("after", 1)
    days = (
        F.when(F.col("n") == 0, F.array("upto"))
        .when(F.col("n") == len(dates), F.array(day_after))
        .otherwise(days_between(day_after, F.col("upto")))
    )
    return frame.select("n", F.explode(days).alias("day"))
