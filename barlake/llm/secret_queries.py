"""Secrets in ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlake.llm.common import table
from barlake.llm.secrets import KINDS, secret_spans


def op5_secrets(spark, sf_dir):
    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    literal = F.transform(
        "literals",
        lambda s: F.struct(F.lit("literal").alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )
    rank = F.create_map(*[F.lit(x) for pair in zip(KINDS, range(len(KINDS)), strict=True) for x in pair])
    # By start, then kind as listed.
    keyed = F.transform(
        F.concat("base", literal),
        lambda s: F.struct(
            s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["kind"].alias("kind"), s["end"].alias("end")
        ),
    )
    return secret_spans(table(spark, sf_dir, "documents")).select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.array_sort(keyed)).alias("spans"),
    )


ALL = {"op5_secrets": (op5_secrets, None)}
