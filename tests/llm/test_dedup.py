"""Exact duplicates, near duplicates, components."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from barlake.llm import exact_dedup, simhash
from barlake.llm.components import components
from barlake.llm.exact_dedup import drop_copies, exact_groups
from barlake.llm.simhash import drop_near_copies, near_duplicates
from tests.llm.conftest import by_id, rows


def lower(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def test_exact_groups_match_plain_grouping(spark, documents):
    texts = {r.doc_id: lower(r.text) for r in documents.collect()}
    counts, last = Counter(texts.values()), {}
    for i, t in sorted(texts.items()):
        last[t] = i
    got = by_id(exact_groups(spark, documents))
    assert len(got) == len(texts)
    for i, t in texts.items():
        digest = hashlib.sha256(t.encode()).hexdigest()
        assert (got[i]["keep_id"], got[i]["group_size"], got[i]["text_sha256"]) == (last[t], counts[t], digest)
        assert got[i]["kept"] == (i == last[t])


def test_exact_groups_of_odd_rows(spark, odd_docs, odd_rows, no_docs):
    got = rows(exact_groups(spark, odd_docs))
    assert len(got) == len(odd_rows)
    kept = Counter(r["text_sha256"] for r in got if r["kept"])
    assert set(kept.values()) == {1} and len(kept) == len({lower(t) for _, t in odd_rows})
    assert {r["keep_id"] for r in got if r["doc_id"] in (3, 4)} == {4}
    assert exact_groups(spark, no_docs).count() == 0
    stays = drop_copies(spark, odd_docs)
    assert stays.columns == odd_docs.columns and stays.count() == len({lower(t) for _, t in odd_rows})
    assert drop_copies(spark, odd_docs, keep="smallest").where("doc_id = 1").count() == 1
    with pytest.raises(ValueError):
        exact_groups(spark, odd_docs, keep="any")


def test_large_group_has_one_row_per_run(spark, make_docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "RUNS", 16)
    monkeypatch.setattr(exact_dedup, "FAN_IN", 4)
    got = rows(exact_groups(spark, make_docs([(i, "copy") for i in range(300)] + [(500, "own")])))
    assert {r["keep_id"] for r in got if r["doc_id"] < 300} == {299}
    assert sum(r["kept"] for r in got) == 2 and {r["group_size"] for r in got} == {300, 1}


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest doc_id of each component, by comparing all pairs."""
    up = {i: i for i in prints}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 4:
                low, high = sorted((find(a), find(b)))
                up[high] = low
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("group_rows", [50_000, 4])
def test_near_duplicates_match_all_pairs(spark, documents, group_rows):
    prints = {r.doc_id: plain_fingerprint(r.text) for r in documents.collect()}
    expected = plain_components(prints)
    got = by_id(near_duplicates(spark, documents, group_rows=group_rows))
    assert {i: r["fingerprint"] % 2**64 for i, r in got.items()} == prints
    assert {i: r["component_id"] for i, r in got.items()} == expected


def test_anchors_meet_for_every_pair_within_two_bits():
    random = np.random.default_rng(1)
    for _ in range(300):
        a = int(random.integers(2**32))
        b = a
        for bit in random.choice(32, int(random.integers(3)), replace=False):
            b ^= 1 << int(bit)
        owner, found = simhash.anchors(np.array([a, b], np.uint32))
        assert set(found[owner == 0].tolist()) & set(found[owner == 1].tolist())
        assert all((int(f) ^ a).bit_count() <= 2 for f in found[owner == 0])
        assert np.bincount(owner).max() <= 17


@pytest.mark.parametrize("group_rows", [1_000_000, 30])
def test_near_links_connect_what_all_pairs_connect(spark, group_rows):
    random = np.random.default_rng(2)
    values = set()
    for _ in range(12):
        seed = int(random.integers(2**63))
        for _ in range(40):
            near = seed
            for bit in random.choice(64, 3, replace=False):
                near ^= 1 << int(bit)
            values.add(near % 2**63)
    nodes = spark.createDataFrame([(v,) for v in sorted(values)], "fingerprint bigint")
    links = simhash.near_links(spark, nodes, group_rows=group_rows)
    assert all((r.a ^ r.b).bit_count() <= 4 for r in links.collect())
    found = {r.node: r.root for r in components(spark, links).collect()}
    expected = plain_components({v: v for v in values})
    groups = defaultdict(set)
    for v in values:
        groups[found.get(v, v)].add(expected[v])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(expected.values()))


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(50)] + [(1000, i) for i in range(1001, 1100)] + [(7, 7), (3000, 2999)]
    found = {r.node: r.root for r in components(spark, spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert len({found[i] for i in range(51)}) == 1 and len({found[i] for i in range(1000, 1100)}) == 1
    assert len(set(found.values())) == 3
    assert components(spark, spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_near_duplicates_of_odd_rows(spark, odd_docs, odd_rows, no_docs):
    got = rows(near_duplicates(spark, odd_docs))
    assert len(got) == len(odd_rows)
    assert {r["component_id"] for r in got if r["fingerprint"] == 0} == {3}
    assert near_duplicates(spark, no_docs).count() == 0
    stays = drop_near_copies(spark, odd_docs)
    assert stays.columns == odd_docs.columns
    texts = [r.text for r in stays.collect()]
    assert texts.count("The same text.") == 1 and "the SAME text." not in texts and len(texts) == 7
