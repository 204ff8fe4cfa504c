"""Connected components of links, by contraction over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from barlake.llm.common import stored


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b``, integers); the root is one node of each component.

    In a round every node hooks on to its smallest neighbour, follows one more step, and links
    are contracted to what their ends have hooked on to. Chains shrink at least by half, so
    there are as many rounds as the logarithm of the longest one. Hooks only point down, so no
    cycle arises. Every table is written, neither links nor nodes come to the driver.
    """
    left = stored(spark, links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    found = None
    while not left.isEmpty():
        ends = left.select(F.col("a").alias("node"), F.col("b").alias("other")).union(left.select("b", "a"))
        hooks = stored(spark, ends.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("up")), "hooks")
        above = hooks.select(F.col("node").alias("up"), F.col("up").alias("root"))
        hooks = stored(spark, hooks.join(above, "up").select("node", "root"), "hooks")
        if found is None:
            found = hooks
        else:
            more = hooks.select(F.col("node").alias("root"), F.col("root").alias("top"))
            found = found.join(more, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
        ends_a = hooks.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        ends_b = hooks.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        left = left.join(ends_a, "a").join(ends_b, "b").where("ra <> rb")
        left = stored(spark, left.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
    if found is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found
