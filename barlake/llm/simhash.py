"""Near duplicates: SimHash fingerprints, linked by anchor-point covering.

Two 64-bit fingerprints that differ in at most 4 bits differ in at most 2 within one 32-bit half.
A half is covered by the Hamming code of length 31 and a free bit: every point is within radius 1
of an anchor. Some point between two such halves is at most 1 (half of that threshold) from
either, and its anchor is at most 1 further on. So a fingerprint is replicated to the anchors
within covering radius plus threshold (1 + 1), at most 17 a half, and linked fingerprints meet at
one. There each pair is compared over all 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from barlake.llm.common import keep_rows, stored, text_hash
from barlake.llm.components import components

SHINGLE, SEED, BITS = 4, 42, 4
#: Larger groups of an anchor are split into pairs of parts over several tasks.
GROUP_ROWS = 50_000
_SMALL = 16
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes | None) -> int:
    """SimHash of the word shingles, repeats included; 0 without words."""
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(SHINGLE, len(words))
    digest = xxhash.xxh64_intdigest
    count = len(words) - width + 1
    total = np.zeros(64, np.int64)
    for at in range(0, count, 16384):
        until = min(count, at + 16384)
        bounds = zip(starts[at:until].tolist(), ends[at + width - 1 : until + width - 1].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in bounds], np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.uint16)
    return int(np.packbits(2 * total > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, fingerprint`` (a signed number) of every row; a null text has no words."""

    def over_all(batches):
        for batch in batches:
            found = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64)
            columns = [batch.column("doc_id"), batch.column("text_hash"), pa.array(found.view(np.int64))]
            yield pa.record_batch(columns, ["doc_id", "text_hash", "fingerprint"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_hash(), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(over_all, "doc_id bigint, text_hash bigint, fingerprint bigint")


def anchors(half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) of every anchor within distance 2 of 32-bit values."""
    half = half.astype(np.uint32)
    free, code = half & np.uint32(1 << 31), half & np.uint32((1 << 31) - 1)
    syndrome = np.zeros(len(half), np.uint32)
    for bit in range(5):
        checked = sum(1 << (i - 1) for i in range(1, 32) if i >> bit & 1)
        syndrome |= (np.bitwise_count(code & np.uint32(checked)) & 1).astype(np.uint32) << np.uint32(bit)
    flip = np.where(syndrome > 0, np.uint32(1) << (np.maximum(syndrome, 1) - 1), np.uint32(0)).astype(np.uint32)
    home = code ^ flip
    every = np.arange(len(half))
    rows, found = [every, every], [home | free, home | (free ^ np.uint32(1 << 31))]
    for i in range(1, 32):
        # Flipping places i and j leads to an anchor if i XOR j is the syndrome.
        other = np.uint32(i) ^ syndrome
        near = np.flatnonzero((syndrome > 0) & (other > i))
        rows.append(near)
        pair = np.uint32(1 << (i - 1)) | (np.uint32(1) << (other[near] - 1))
        found.append((code[near] ^ pair.astype(np.uint32)) | free[near])
    return np.concatenate(rows), np.concatenate(found)


def _replicas(batches):
    for batch in batches:
        prints = batch.column("fingerprint").to_numpy(zero_copy_only=False)
        for start in range(0, len(prints), 4096):
            part = prints[start : start + 4096]
            for side in (0, 1):
                rows, found = anchors(part.view(np.uint64) >> np.uint64(32 * side) & np.uint64(0xFFFFFFFF))
                keys = found.astype(np.int64) | np.int64(side << 32)
                yield pa.record_batch([pa.array(keys), pa.array(part[rows])], ["anchor", "fingerprint"])


def spanning_links(prints: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what all links within a group connect, at most one per member."""
    waiting = np.unique(prints)
    links = []
    while len(waiting):
        reached, waiting = [waiting[0]], waiting[1:]
        while reached and len(waiting):
            current = reached.pop()
            near = np.bitwise_count(waiting.view(np.uint64) ^ np.uint64(int(current) & (2**64 - 1))) <= BITS
            if near.any():
                linked = waiting[near]
                links.append((np.full(len(linked), current), linked))
                reached += linked.tolist()
                waiting = waiting[~near]
    return links


def group_links(keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within groups of equal keys; keys are sorted."""
    bounds = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
    sizes = np.diff(bounds)
    left, right = [], []
    large = sizes > _SMALL
    small = ~np.repeat(large, sizes)
    keys_s, prints_s = keys[small], prints[small]
    for step in range(1, min(_SMALL, len(keys_s))):
        together = np.flatnonzero(keys_s[step:] == keys_s[:-step])
        if not len(together):
            break
        a, b = prints_s[together], prints_s[together + step]
        near = np.bitwise_count((a ^ b).view(np.uint64)) <= BITS
        left.append(a[near])
        right.append(b[near])
    for group in np.flatnonzero(large):
        for a, b in spanning_links(prints[bounds[group] : bounds[group + 1]]):
            left.append(a)
            right.append(b)
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def _compare(limit: int | None):
    """Compares groups of a partition sorted by anchor; rows of a group over the limit are handed on."""

    def rows(a, b, over):
        return pa.record_batch([pa.array(a), pa.array(b), pa.array(np.full(len(a), over))], ["a", "b", "over"])

    def over_all(batches):
        keys, prints = np.empty(0, np.int64), np.empty(0, np.int64)
        handed_on = None
        for batch in batches:
            new = batch.column("anchor").to_numpy(zero_copy_only=False)
            keys = np.concatenate([keys, new])
            prints = np.concatenate([prints, batch.column("fingerprint").to_numpy(zero_copy_only=False)])
            if handed_on is not None:
                same = np.searchsorted(keys, handed_on, "right")
                yield rows(keys[:same], prints[:same], True)
                keys, prints = keys[same:], prints[same:]
            if not len(keys):
                continue
            last = np.searchsorted(keys, keys[-1])
            yield rows(*group_links(keys[:last], prints[:last]), False)
            keys, prints = keys[last:], prints[last:]
            if limit and len(keys) > limit:
                handed_on = keys[-1]
                yield rows(keys, prints, True)
                keys, prints = keys[:0], prints[:0]
        yield rows(*group_links(keys, prints), False)

    return over_all


def _grouped(rows: DataFrame, limit: int | None) -> DataFrame:
    return rows.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_compare(limit), "a bigint, b bigint, over boolean")


def near_links(spark: SparkSession, nodes: DataFrame, *, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``a, b``: links between different fingerprints that connect all that are within ``BITS``."""
    replicas = nodes.select("fingerprint").mapInArrow(_replicas, "anchor bigint, fingerprint bigint")
    compared = stored(spark, _grouped(replicas, group_rows), "compared")
    links = compared.where("not over").select("a", "b").distinct()
    over = compared.where("over").select(F.col("a").alias("anchor"), F.col("b").alias("fingerprint"))
    if over.isEmpty():
        return links
    # Every pair of parts of a large group meets in a group of its own.
    parts = over.groupBy("anchor").agg(F.ceil(F.count("*") * 2 / group_rows).cast("int").alias("parts"))
    dealt = over.join(parts, "anchor").withColumn("part", F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int"))
    paired = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pair = F.xxhash64("anchor", F.least("part", "other"), F.greatest("part", "other"))
    rest = _grouped(paired.select(pair.alias("anchor"), "fingerprint"), None)
    return links.union(rest.select("a", "b")).distinct()


def near_duplicates(spark: SparkSession, docs: DataFrame, *, group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per document: ``doc_id, text_hash, fingerprint, component_id, root``.

    ``component_id`` is the smallest doc_id reachable, ``root`` a fingerprint that names the component.

    Equal fingerprints are one node, so copies never multiply. Null and empty texts have the
    fingerprint 0, linked like any other. Rows are kept as they are, repeated ones too; a null
    doc_id takes part but never names a component unless all of it are null.
    """
    prints = stored(spark, fingerprints(docs), "fingerprints")
    nodes = stored(spark, prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "nodes")
    found = components(spark, near_links(spark, nodes, group_rows=group_rows))
    roots = nodes.join(found.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )
    roots = stored(spark, roots, "roots")
    firsts = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stored(spark, roots.join(firsts, "root").select("fingerprint", "component_id", "root"), "named")
    return prints.join(named, "fingerprint").select("doc_id", "text_hash", "fingerprint", "component_id", "root")


def drop_near_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents, with all their columns, less all but the first of each component."""
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    first = near_duplicates(spark, docs).groupBy("root").agg(F.min(rank).alias("first"))
    return keep_rows(docs, first.select("first.doc_id", "first.text_hash"))
