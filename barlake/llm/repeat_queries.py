"""Passages of ``documents`` that occur earlier."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlake.llm.common import table
from barlake.llm.repeats import drop_repeats


def op3_repeats(spark, sf_dir):
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return drop_repeats(spark, table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


ALL = {"op3_repeats": (op3_repeats, None)}
