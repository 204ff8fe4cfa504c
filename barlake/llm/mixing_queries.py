"""``documents`` mixed to target weights."""

from __future__ import annotations

from barlake.llm.common import table
from barlake.llm.mixing import mix


def op10_mixing(spark, sf_dir):
    return mix(spark, table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))


ALL = {"op10_mixing": (op10_mixing, None)}
