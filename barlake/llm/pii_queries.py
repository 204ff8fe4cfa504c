"""Personal data in ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlake.llm.common import table
from barlake.llm.pii import KINDS, pii_spans


def op6_pii(spark, sf_dir):
    def named(kind):
        return F.transform(kind, lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))

    def written(kinds):
        return F.array_join(F.concat(*map(named, kinds)), ",")

    return pii_spans(spark, table(spark, sf_dir, "documents")).select(
        "doc_id",
        *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(written(KINDS), 256).alias("base_sha256"),
        written([*KINDS, "contact"]).alias("spans"),
    )


ALL = {"op6_pii": (op6_pii, None)}
