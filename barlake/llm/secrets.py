"""Secrets: fixed patterns, and literals that source or configuration text gives to sensitive names.

A lexer turns assignments (``name = "x"``, ``"name": 'x'``, ``export NAME=x``, ``name := a + "b"``)
into pairs of a name and its parts, constants are propagated from name to name within a document,
and each literal is scored by the most sensitive name that it reaches.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from barlake.llm.common import map_rows

#: Fixed patterns: kind, pattern, least length of the match (of group 2 for assignments).
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "literal")
#: Without one of these no assignment matches; a quick test before the pattern.
STEMS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: How sensitive a word of a target name is.
NAME_WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 0.9, "credential": 0.9,
    "credentials": 0.9, "token": 0.8, "apikey": 0.9, "bearer": 0.8, "auth": 0.6, "signature": 0.5,
}
#: Words that make "key" sensitive.
KEY_WORDS = {"api", "access", "private", "signing", "encryption", "master", "service", "account", "secret"}
PLACEHOLDERS = re.compile(r"example|changeme|your[_-]|<|\$\{|x{4,}|\*{3,}|placeholder", re.IGNORECASE)
LEAST_SCORE, LEAST_LENGTH = 0.7, 6

#: A name is taken whole, from the first letter of its run; digits, dots and dashes before it are passed over.
_BODY = r"""[0-9.-]*(?P<name>[A-Za-z_][A-Za-z0-9_.-]*)["']?[ \t]*(?::=|=>|=(?!=)|:(?!//))[ \t]*
        (?P<value>(?:"[^"\n]*"|'[^'\n]*'|[^\s"',;(){}\[\]+]+)(?:[ \t]*\+[ \t]*(?:"[^"\n]*"|'[^'\n]*'|[A-Za-z_]\w*))*)"""
#: A pair is looked for where a run begins, which keeps the search linear, and at the end of the pair before.
_PAIR, _NEXT = re.compile(r"(?<![A-Za-z0-9_.-])" + _BODY, re.VERBOSE), re.compile(_BODY, re.VERBOSE)
_PART = re.compile(r"""(?P<quoted>"[^"\n]*"|'[^'\n]*')|(?P<bare>[^\s"'+]+)""")
_NAME = re.compile(r"\$?\{?([A-Za-z_][A-Za-z0-9_.]*)\}?\Z")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    spans = []
    lowered = text.lower()
    if any(stem in lowered for stem in STEMS):
        spans += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return spans


def name_weight(name: str) -> float:
    words = [w.lower() for w in _WORD.findall(name)]
    best = max((NAME_WEIGHTS.get(w, 0.0) for w in words), default=0.0)
    if "key" in words and KEY_WORDS.intersection(words):
        best = max(best, 0.9)
    return best


def literal_weight(literal: str) -> float:
    """0 to 1 by the entropy of its characters; placeholders weigh nothing."""
    if len(literal) < LEAST_LENGTH or PLACEHOLDERS.search(literal):
        return 0.0
    counts = Counter(literal).values()
    entropy = -sum(n / len(literal) * math.log2(n / len(literal)) for n in counts)
    return min(1.0, entropy / 3.0)


def lex_pairs(text: str):
    """Assignments in order: (name, literal parts as spans, names it refers to)."""
    end_before = 0
    while pair := _NEXT.match(text, end_before) or _PAIR.search(text, end_before):
        end_before = pair.end()
        literals, names = [], []
        offset = pair.start("value")
        for part in _PART.finditer(pair["value"]):
            start, end = offset + part.start(), offset + part.end()
            if part["quoted"]:
                literals.append((start + 1, end - 1))
            elif _NAME.match(part["bare"]):
                # A bare word may be a literal of a configuration file, or the name of a constant.
                names.append((_NAME.match(part["bare"])[1], start, end))
            else:
                literals.append((start, end))
        yield pair["name"], literals, names


def literal_spans(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, most sensitive name, score) of the literals that reach a sensitive name.

    Takes time linear in the text, however many literals a name is built of.
    """
    if "=" not in text and ":" not in text:
        return []
    # Per definition its own literals, the definitions it refers to (all before it), its best weight and name.
    latest: dict[str, int] = {}
    own: list[list[tuple[int, int]]] = []
    refers: list[set[int]] = []
    reached: list[tuple[float, str]] = []
    for name, literals, names in lex_pairs(text):
        spans, before = list(literals), set()
        for referred, start, end in names:
            if referred in latest:
                before.add(latest[referred])
            else:
                spans.append((start, end))
        weight = name_weight(name)
        latest[name] = len(own)
        own.append(spans)
        refers.append(before)
        reached.append((weight, name) if weight else (0.0, ""))
    best: dict[tuple[int, int], tuple[float, str]] = {}
    # A definition is referred to by later ones only: once backwards passes every weight on.
    for at in range(len(own) - 1, -1, -1):
        if reached[at][0]:
            for earlier in refers[at]:
                reached[earlier] = max(reached[earlier], reached[at])
            best.update(dict.fromkeys(own[at], reached[at]))
    found = []
    for (start, end), (weight, name) in best.items():
        score = 0.6 * weight + 0.4 * literal_weight(text[start:end])
        if score >= LEAST_SCORE and literal_weight(text[start:end]) > 0:
            found.append((start, end, name, round(score, 4)))
    return sorted(found)


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_LITERAL = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("score", pa.float64())])
_SCHEMA = (
    "doc_id bigint, base array<struct<kind:string,start:bigint,end:bigint>>, "
    "literals array<struct<start:bigint,end:bigint,name:string,score:double>>"
)


def _scan(batch):
    base, literals = [], []
    for text in batch.column("text").to_pylist():
        spans = sorted(base_spans(text or ""), key=lambda s: (s[1], KINDS.index(s[0])))
        base.append([dict(kind=k, start=s, end=e) for k, s, e in spans])
        starts, reach = [b for _, b, _ in spans], list(accumulate((f for *_, f in spans), max))
        added = [
            dict(start=s, end=e, name=n, score=w)
            for s, e, n, w in literal_spans(text or "")
            # Of the base spans that start no later, none reaches its end.
            if not (before := bisect_right(starts, s)) or reach[before - 1] < e
        ]
        literals.append(added)
    yield pa.record_batch(
        [batch.column("doc_id"), pa.array(base, pa.list_(_SPAN)), pa.array(literals, pa.list_(_LITERAL))],
        ["doc_id", "base", "literals"],
    )


def secret_spans(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, base, literals``, spans in code points with an exclusive end.

    ``base`` holds the matches of the fixed patterns, leftmost and non-overlapping per kind,
    ordered by start, then kind. ``literals`` holds literals outside those that an assignment
    gives, directly or through constants, to a sensitive name. Null and empty texts have none.
    Repeated rows and null doc_ids are rows like any other; an empty table gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_rows(texts, _scan, _SCHEMA)
