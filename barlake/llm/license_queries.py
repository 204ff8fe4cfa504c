"""License text in ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlake.llm.common import LOWER, UPPER, table
from barlake.llm.licenses import license_spans


def op8_licenses(spark, sf_dir):
    def labels(spans):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    both = F.concat("places", "passages")
    return license_spans(spark, table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min(F.transform("places", lambda s: s["start"])).alias("first_word"),
        F.array_max(F.transform("places", lambda s: s["start"])).alias("last_word"),
        labels(F.col("places")).alias("base_labels"),
        labels(both).alias("labels"),
        F.coalesce(F.array_max(F.transform(both, lambda s: s["similarity"])), F.lit(0.0)).alias("score"),
    )


ALL = {"op8_licenses": (op8_licenses, None)}
