"""Passages of ``benchmark`` inside ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlake.llm.common import LOWER, UPPER, table
from barlake.llm.decontaminate import contamination


def op4_decontaminate(spark, sf_dir):
    found = contamination(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP4_SQL = f"""
WITH doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS MATERIALIZED (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS s
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM item WHERE len(w) > 0)
),
place AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
        FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)
),
occ AS MATERIALIZED (SELECT doc_id, i, n, item_id FROM place JOIN win USING (n, s)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM occ) GROUP BY 1
),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM occ) GROUP BY 1
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

ALL = {"op4_decontaminate": (op4_decontaminate, OP4_SQL)}
