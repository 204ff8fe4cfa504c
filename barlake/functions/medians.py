"""Exact medians of groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from barlake.functions.joins import null_safe_join

# Rank error of the bracketing sketch is 1/1000 of a group; the bracket is ten times wider.
_ACCURACY = 1_000
_AROUND = (0.49, 0.51)


def group_medians(df: DataFrame, keys: tuple[str, ...], names: list[str]) -> DataFrame:
    """``median_<name>`` per group; the mean of the two middle values of an even group.

    A mergeable sketch brackets each group's middle, rows below the bracket are only
    counted, and the few distinct values inside it are ranked. No task holds a group.
    """
    pairs = F.array(
        *[F.struct(F.lit(n).alias("_name"), F.col(n).cast("double").alias("_value")) for n in names]
    )
    long = df.select(*keys, F.inline(pairs))
    per = [*keys, "_name"]
    bracket = F.percentile_approx("_value", list(_AROUND), _ACCURACY)
    groups = long.groupBy(*per).agg(F.count("_value").alias("_n"), bracket.alias("_b")).select(
        *per, "_n", F.col("_b")[0].alias("_lo"), F.col("_b")[1].alias("_hi")
    )
    # One row per distinct value inside the bracket; all values below it share one row.
    placed = null_safe_join(long.where(F.col("_value").isNotNull()), groups, per)
    counted = (
        placed.where(F.col("_value") <= F.col("_hi"))
        .withColumn("_value", F.when(F.col("_value") >= F.col("_lo"), F.col("_value")))
        .groupBy(*per, "_n", "_value")
        .agg(F.count("*").alias("_c"))
    )
    upwards = Window.partitionBy(*per).orderBy(F.asc_nulls_first("_value"))
    reached = F.sum("_c").over(upwards.rowsBetween(Window.unboundedPreceding, 0))
    ranked = counted.withColumn("_rank", reached)
    lower, upper = F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1
    middle = ranked.groupBy(*per).agg(
        F.min(F.when(F.col("_rank") >= lower, F.col("_value"))).alias("_l"),
        F.min(F.when(F.col("_rank") >= upper, F.col("_value"))).alias("_u"),
    )
    medians = null_safe_join(groups.select(*per), middle, per, "left")
    return medians.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("_name") == n, (F.col("_l") + F.col("_u")) / 2)).alias(f"median_{n}")
            for n in names
        ]
    )
