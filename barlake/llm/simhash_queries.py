"""Near duplicates of ``documents`` by SimHash."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlake.llm.common import table
from barlake.llm.simhash import near_duplicates


def op7_simhash(spark, sf_dir):
    found = near_duplicates(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


ALL = {"op7_simhash": (op7_simhash, None)}
