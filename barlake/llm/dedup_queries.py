"""Exact duplicates of ``documents``."""

from __future__ import annotations

from barlake.llm.common import LOWER, UPPER, table
from barlake.llm.exact_dedup import exact_groups

COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def op9_exact_dedup(spark, sf_dir):
    return exact_groups(spark, table(spark, sf_dir, "documents")).select(*COLUMNS)


OP9_SQL = f"""
WITH hashed AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256 FROM documents
), grouped AS (
  SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM hashed GROUP BY 1
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM hashed JOIN grouped USING (text_sha256)
"""

ALL = {"op9_exact_dedup": (op9_exact_dedup, OP9_SQL)}
