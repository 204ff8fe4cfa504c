"""Spelling variants against a plain search."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from barlake.llm import spelling
from barlake.llm.spelling import last_forms, near_pairs, near_words, spelling_variants, vocabulary
from barlake.llm.spelling_queries import op13_spelling
from tests.llm.conftest import SMALL, rows


def plain_words(documents, least_count=5):
    counts = Counter()
    for doc_id, text in documents:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({i: i + 32 for i in range(65, 91)})
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                cut = h % len(run)
                run = run[:cut] + run[cut + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= least_count}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
    found = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        found.add((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return found


def test_query_matches_plain_search(spark, documents):
    expected = plain_variants(plain_words((r.doc_id, r.text) for r in documents.collect()))
    assert {tuple(r) for r in op13_spelling(spark, SMALL).collect()} == expected
    assert any(form for _, form, *_ in expected)


def test_index_finds_all_pairs_one_edit_apart():
    chance = random.Random(3)
    words = list({"".join(chance.choice("abà") for _ in range(chance.randint(1, 7))) for _ in range(400)})
    left, right = near_pairs(words)
    found = list(zip(left.tolist(), right.tolist(), strict=True))
    assert len(set(found)) == len(found)
    assert set(found) == {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if one_edit(a, b)}


def test_searches_in_parts_find_the_same(monkeypatch):
    words = [f"{'ab' * 4}{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    whole = set(zip(*map(np.ndarray.tolist, near_pairs(words)), strict=True))
    monkeypatch.setattr(spelling, "_HELD", 1)
    assert set(zip(*map(np.ndarray.tolist, near_pairs(words)), strict=True)) == whole
    assert len(whole) == 400 * 38


@pytest.mark.parametrize("block_words", [4, 50, 8192])
def test_shared_halves_are_spread_without_losing_pairs(spark, block_words):
    chance = random.Random(5)
    words = {"common" + "".join(chance.choice("xyz") for _ in range(chance.randint(3, 5))) for _ in range(120)} | {"ab", "abc", "b" * 3000, "b" * 3001}
    table = spark.createDataFrame([(w, len(w)) for w in words], "word string, n bigint")
    got = [(r["word"], r["near"]) for r in rows(near_words(spark, table, block_words=block_words))]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for a in words for b in words if one_edit(a, b)}


def test_long_chains_of_forms(spark):
    table = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(9)], "word string, form string")
    assert {r["root"] for r in rows(last_forms(spark, table))} == {"w9"}


def test_ties_take_the_smallest_word(spark):
    table = spark.createDataFrame([("letterz", 5), ("letters", 25), ("lettera", 25), ("lettero", 24)], "word string, n bigint")
    got = {r["word"]: r for r in rows(spelling_variants(spark, table))}
    assert (got["letterz"]["form"], got["letterz"]["form_n"], got["letterz"]["n_near"]) == ("lettera", 25, 3)
    assert got["lettero"]["form"] is None and got["letters"]["root"] == "letters"


def test_vocabulary_of_odd_rows(spark, make_docs, odd_docs, odd_rows, no_docs):
    assert {r["word"]: r["n"] for r in rows(vocabulary(odd_docs, least_count=1))} == plain_words(odd_rows, 1)
    given = [(None, "Éclairs ÉCLAIRS straße×x " * 3), (7, None), (7, ""), (7, "éclairs a×b÷cdef")]
    assert {r["word"]: r["n"] for r in rows(vocabulary(make_docs(given), least_count=1))} == plain_words(given, 1)
    assert vocabulary(no_docs).count() == 0
    assert spelling_variants(spark, vocabulary(no_docs)).count() == 0
