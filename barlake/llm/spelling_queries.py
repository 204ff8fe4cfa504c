"""Spelling variants in ``documents``."""

from __future__ import annotations

from barlake.llm.common import LOWER, UPPER, table
from barlake.llm.spelling import FACTOR, LEAST_COUNT, LEAST_LETTERS, NOISE, RUN, spelling_variants, vocabulary

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def op13_spelling(spark, sf_dir):
    return spelling_variants(spark, vocabulary(table(spark, sf_dir, "documents"))).select(*COLUMNS)


def _crc_table() -> list[int]:
    """What one byte does to the checksum, from its polynomial."""
    found = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        found.append(value)
    return found


#: Code points in documents' runs are below 256: one or two bytes each.
_BYTES = """flatten(list_transform(string_split(said, ''), lambda c:
  CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END))"""
_CRC = f"""xor(list_reduce({_BYTES}, lambda a, b: xor(a >> 8, ({_crc_table()}::BIGINT[])[(xor(a, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT)"""

OP13_SQL = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS name, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{RUN}')) AS run
  FROM documents
), counted AS (
  SELECT name || ':' || run AS said, run, count(*) AS copies FROM runs WHERE length(run) >= {LEAST_LETTERS} GROUP BY 1, 2
), checked AS (
  SELECT run, copies, {_CRC} AS h FROM counted
), garbled AS (
  SELECT CASE WHEN h % {NOISE} = 0 THEN run[: h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, copies FROM checked
), words AS MATERIALIZED (
  SELECT word, sum(copies)::BIGINT AS n FROM garbled WHERE length(word) >= {LEAST_LETTERS} GROUP BY word HAVING sum(copies) >= {LEAST_COUNT}
), places AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS place FROM words
), less AS MATERIALIZED (
  SELECT word, n, place, word[: place - 1] || word[place + 1 :] AS rest FROM places
), near AS MATERIALIZED (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM less a JOIN less b USING (place, rest) WHERE a.word <> b.word
  UNION SELECT less.word, less.n, words.word, words.n FROM less JOIN words ON words.word = rest
  UNION SELECT words.word, words.n, less.word, less.n FROM less JOIN words ON words.word = rest
), best AS (
  SELECT word, n, count(*) AS n_near, max(other_n) AS top, arg_min(other, (-other_n, other)) AS other FROM near GROUP BY word, n
), forms AS MATERIALIZED (
  SELECT word, CASE WHEN top >= {FACTOR} * n THEN other END AS form, n_near, CASE WHEN top >= {FACTOR} * n THEN top END AS form_n FROM best
), followed AS (
  SELECT word, word AS root, 0 AS steps FROM words
  UNION ALL SELECT followed.word, form, steps + 1 FROM followed JOIN forms ON forms.word = root WHERE form IS NOT NULL
), roots AS (
  SELECT word, arg_max(root, steps) AS root FROM followed GROUP BY word
)
SELECT word, form, root, n, coalesce(n_near, 0) AS n_near, form_n FROM words LEFT JOIN forms USING (word) JOIN roots USING (word)
"""

ALL = {"op13_spelling": (op13_spelling, OP13_SQL)}
