"""Alignment of two tokenizers against a plain merge."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from barlake.llm import alignment
from barlake.llm.alignment import align, alignment_totals, cut_merge, diagonal, groups, overlaps
from barlake.llm.alignment_queries import op11_alignment
from tests.llm.conftest import LONG, SMALL, by_id, rows


class Plain:
    """Tokens with their bytes, one at a time."""

    def __init__(self):
        self.a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        letters = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
        self.byte = {chr(b): b for b in letters} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(letters)))}

    def tokens(self, text):
        if not text:
            return [], []
        a = self.a.encode(" " + text, add_special_tokens=False)
        of_a = [(i, bytes(self.byte[c] for c in t)) for i, t in zip(a.ids, a.tokens, strict=True)]
        of_b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            of_b.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        said = (" " + text).encode()
        same = all(b"".join(part for _, part in found) == said for found in (of_a, of_b))
        return (of_a, of_b) if same else ([], [])

    def groups(self, text):
        """Lists of A and B ids between offsets where both end, by walking."""
        of_a, of_b = self.tokens(text)
        found, group, at_a, at_b = [], ([], []), 0, 0
        while of_a or of_b:
            if at_a <= at_b:
                i, part = of_a.pop(0)
                group[0].append(i)
                at_a += len(part)
            else:
                i, part = of_b.pop(0)
                group[1].append(i)
                at_b += len(part)
            if at_a == at_b:
                found.append(group)
                group = ([], [])
        return found


@pytest.fixture(scope="module")
def plain():
    return Plain()


def expected_rows(given, plain):
    told = {i: plain.groups(t) for i, t in given}
    counts = Counter((a[-1], b[-1]) for found in told.values() for a, b in found)
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    for i, found in told.items():
        links = [(a[-1], b[-1]) for a, b in found]
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in found)
        yield {
            "doc_id": i, "n_a": sum(len(a) for a, _ in found), "n_b": sum(len(b) for _, b in found), "n_groups": len(found),
            "n_links": len(links), "n_best": sum(counts[k] == best[k[1]] for k in links), "count_sum": sum(counts[k] for k in links),
            "groups_sha256": hashlib.sha256(said.encode()).hexdigest() if said else "",
        }


def by_doc(found):
    return sorted(found, key=lambda r: (r["doc_id"] is None, r["doc_id"]))


def test_query_matches_plain_merge(spark, documents, plain):
    given = [(r.doc_id, r.text) for r in documents.collect()]
    assert by_doc(rows(op11_alignment(spark, SMALL))) == by_doc(expected_rows(given, plain))


ODD = [
    (1, "한국어 éè <|endoftext|> <s> a▁b"), (2, None), (3, ""), (4, " "), (5, "a  b\n\tc"), (6, "\x00\x1f ﬁ ½"), (7, LONG),
    (8, "😀😀 wörd"), (9, "same text"), (10, "same text"), (11, "x" * 3000),
]


@pytest.mark.parametrize("common", [1e-4, 2.0])
def test_odd_rows_with_and_without_common_pairs(spark, make_docs, plain, monkeypatch, common):
    monkeypatch.setattr(alignment, "COMMON", common)
    found = rows(alignment_totals(spark, make_docs(ODD), piece=7))
    assert by_doc(found) == by_doc(expected_rows(ODD, plain))
    assert {r["n_links"] for r in found if r["doc_id"] in (2, 3)} == {0}


def test_repeated_rows_and_rows_without_doc_id(spark, make_docs, odd_docs, odd_rows, no_docs):
    assert len(rows(alignment_totals(spark, odd_docs))) == len(odd_rows)
    twice = rows(alignment_totals(spark, make_docs([(2, "the same text"), (2, "the same text"), (None, "the same text")])))
    assert [r["count_sum"] for r in twice] == [3 * r["n_links"] for r in twice] and len(twice) == 3
    assert alignment_totals(spark, no_docs).count() == 0


def test_groups_hold_all_tokens(spark, make_docs, plain):
    got = by_id(align(make_docs(ODD), piece=16))
    for i, text in ODD:
        a_ids, b_ids = iter(got[i]["a_ids"]), iter(got[i]["b_ids"])
        found = [([next(a_ids) for _ in range(m)], [next(b_ids) for _ in range(n)]) for m, n in zip(got[i]["a_sizes"], got[i]["b_sizes"], strict=True)]
        assert found == plain.groups(text) and not [*a_ids, *b_ids]


def random_ends(chance):
    size = chance.randint(1, 60)
    inner = [sorted(chance.sample(range(1, size), chance.randint(0, size - 1))) for _ in range(2)]
    return [np.array([*cuts, size]) for cuts in inner]


def test_pieces_do_equal_work_and_join_to_the_whole():
    chance = random.Random(2)
    for _ in range(300):
        a, b = random_ends(chance)
        merged = sorted([(e, 0) for e in a.tolist()] + [(e, 1) for e in b.tolist()])
        for d in range(len(merged) + 1):
            assert diagonal(a, b, d) == sum(side == 0 for _, side in merged[:d])
        size = chance.randint(1, 9)
        cut = cut_merge(a, b, size)
        assert all((a1 - a0) + (b1 - b0) == size for a0, a1, b0, b1 in cut[:-1])
        found = [t for piece in cut for t in zip(*(x.tolist() for x in overlaps(a, b, piece)), strict=True)]
        expected = []
        for i, end in enumerate(a.tolist()):
            for j, other in enumerate(b.tolist()):
                start = max(a[i - 1] if i else 0, b[j - 1] if j else 0)
                if start < min(end, other):
                    expected.append((i, j, end == other))
        assert found == expected
        assert [x.tolist() for x in groups(a, b, size)] == [x.tolist() for x in groups(a, b)]
