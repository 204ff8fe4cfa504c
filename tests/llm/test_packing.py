"""Packing: valid sequences, whole documents, few sequences."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from barlake.llm import tokens
from barlake.llm.packing import Packing, crossover, evolve, first_population, mutate, pack, pack_lengths, piece_starts, pieces, sequences
from barlake.llm.packing_queries import COLUMNS, op12_packing
from tests.llm.conftest import LONG, SMALL, rows


@pytest.fixture(scope="module")
def plain_ids():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def check_packing(found, capacity=2048):
    """Sequences without gaps; returns their number."""
    members = defaultdict(list)
    for r in found:
        members[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in members.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= capacity
    return len(members)


def test_query_packs_every_piece_of_every_document(spark, documents, plain_ids):
    found = rows(op12_packing(spark, SMALL))
    assert set(found[0]) == set(COLUMNS)
    by_doc = defaultdict(dict)
    for r in found:
        assert r["piece"] not in by_doc[r["doc_id"]]
        by_doc[r["doc_id"]][r["piece"]] = r
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert by_doc.keys() == texts.keys()
    for doc_id, text in texts.items():
        ids = plain_ids(text)
        parts = [by_doc[doc_id][k] for k in range(len(by_doc[doc_id]))]
        assert len(parts) == -(-len(ids) // 2048)
        assert sum(r["length"] for r in parts) == len(ids) and all(r["length"] == 2048 for r in parts[1:])
        for r in parts:
            part = ids[r["start"] : r["start"] + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
    least = -(-sum(r["length"] for r in found) // 2048)
    assert least <= check_packing(found) <= least + 1


def test_whole_sequences_read_back(spark, make_docs, odd_rows, plain_ids):
    packed = pack(spark, make_docs(odd_rows), with_ids=True)
    read = rows(sequences(packed))
    assert sum(len(r["ids"]) for r in read) == sum(len(plain_ids(t)) for _, t in odd_rows)
    said = defaultdict(list)
    for r in read:
        for doc_id, start, end in zip(r["doc_ids"], r["starts"], [*r["starts"][1:], len(r["ids"])], strict=True):
            said[doc_id].append(tuple(r["ids"][start:end]))
    assert sorted(said[2]) == [tuple(plain_ids("the SAME text."))] * 2
    assert said[3] == said[4] == [(0,)]
    assert len(said[5]) > 1 and sum(map(len, said[5])) == len(plain_ids(LONG))


def test_no_documents(spark, no_docs):
    assert pack(spark, no_docs).count() == 0 and sequences(pack(spark, no_docs, with_ids=True)).count() == 0


def test_pieces_of_odd_rows(make_docs, plain_ids):
    given = [(1, "<|endoftext|> a"), (2, None), (3, "x y " * 5000)]
    got = rows(pieces(make_docs(given)))
    assert [r["length"] for r in got if r["doc_id"] == 1] == [len(plain_ids("<|endoftext|> a"))]
    assert [(r["length"], r["ids_crc32"]) for r in got if r["doc_id"] == 2] == [(1, zlib.crc32(bytes(4)))]
    assert piece_starts(1, 10) == [0] and piece_starts(10, 10) == [0] and piece_starts(11, 10) == [0, 1] and piece_starts(30, 10) == [0, 10, 20]


TEXTS = [
    "a b  c\n d <|endoftext|>  é 12 's x" * 40, "nospace" * 50, "", " ", "  ", " lead and trail ", "a \n b", "a\n \nb", "한국어 é\u00a0x <s> ▁ a▁b",
    "\u2003x y\u3000 z", "tab\t x 's 't", "a\u0301 \u0301b ﬁ ½ x", "\x00 \x1f \x85 x", "😀 😀😀 \u200b x",
]


def test_ids_are_those_of_the_library(plain_ids, documents):
    slow = tokens.byte_bpe(tokens.BYTE_BPE, True)
    for text in TEXTS + ["x" * 5000 + " y", "xy" * 3000] + [r.text for r in documents.collect()]:
        assert tokens.byte_encoder(plain=False)(text).tolist() == plain_ids(text)[:-1], text[:50]
        assert tokens.byte_encoder()(text).tolist() == slow.encode(text, add_special_tokens=False).ids


def test_many_problems_and_levels_lose_nothing(spark):
    chance = random.Random(1)
    given = [(i, chance.choice([1, 2, 3, 40, 700, 1100, 1500, 2048, chance.randint(1, 2047)])) for i in range(900)]
    lengths = spark.createDataFrame(given, "row bigint, length bigint")
    found = {r["row"]: r for r in rows(pack_lengths(spark, lengths, problem=100))}
    assert len(found) == 900
    used = check_packing([found[i] | {"length": n} for i, n in given])
    sizes = [n for _, n in given]
    plain = Packing([], []).best_fit(sorted(range(900), key=sizes.__getitem__, reverse=True), sizes, 2048)
    assert used <= 1.02 * len(plain.bins)


def test_pieces_over_half_each_take_a_sequence(spark):
    lengths = spark.createDataFrame([(i, 1100) for i in range(300)], "row bigint, length bigint")
    found = rows(pack_lengths(spark, lengths, problem=50))
    assert len(found) == len({r["sequence_id"] for r in found}) == 300


def test_children_hold_each_piece_once():
    chance = random.Random(7)
    lengths = [chance.randint(150, 700) for _ in range(60)]
    population = first_population(lengths, 1000, chance, 6)
    for packing in (*population, crossover(population[0], population[1], lengths, 1000, chance), mutate(population[2], lengths, 1000, chance)):
        assert sorted(i for members in packing.bins for i in members) == list(range(60))
        assert packing.rooms == [1000 - sum(lengths[i] for i in members) for members in packing.bins]


def test_search_beats_best_fit():
    won = 0
    for seed in range(12):
        chance = random.Random(seed)
        lengths = [chance.randint(100, 700) for _ in range(90)]
        best = evolve(first_population(lengths, 1000, chance, 6), lengths, 1000, chance, 300)[0]
        falling = sorted(range(90), key=lengths.__getitem__, reverse=True)
        plain = Packing([], []).best_fit(falling, lengths, 1000)
        assert -(-sum(lengths) // 1000) <= len(best.bins) <= len(plain.bins)
        won += len(plain.bins) - len(best.bins)
    assert won >= 1
