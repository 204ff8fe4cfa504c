"""Language of ``documents``."""

from __future__ import annotations

from barlake.llm.common import table
from barlake.llm.language import fit, languages_of


def op1_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return languages_of(docs.drop("lang"), fit(docs))


ALL = {"op1_language": (op1_language, None)}
