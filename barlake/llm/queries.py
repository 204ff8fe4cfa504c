"""The queries of these operators, with the SQL they are checked against where SQL can say it."""

from __future__ import annotations

from barlake.llm import (
    alignment_queries, chat_queries, crf_queries, dedup_queries, leak_queries, license_queries, mixing_queries, packing_queries, pii_queries, secret_queries,
    repeat_queries, simhash_queries, spelling_queries,
)

ALL: dict = {}
for module in (
    crf_queries, chat_queries, repeat_queries, leak_queries, secret_queries, pii_queries, simhash_queries, license_queries, dedup_queries,
    mixing_queries, alignment_queries, packing_queries, spelling_queries,
):
    ALL |= module.ALL
