"""Alignment of the tokens of two tokenizers, by merge-path partitioning.

The ends of A's and B's tokens, as byte offsets of the same text, are two sorted lists. A diagonal d of their merge is the
point where d ends have been passed; a binary search finds how many of them are A's. Diagonals at
equal distances divide the merge into pieces of equal work that need nothing of each other. A piece
emits the overlaps of A's and B's tokens in its range; a group is complete where both end together,
and what a piece leaves open is stitched to the piece behind it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from barlake.llm.common import stored
from barlake.llm.tokens import BYTE_BPE, PIECE_BPE, byte_encoder, byte_table, piece_encoder, piece_table

#: Ends merged by one piece.
PIECE = 1 << 16
#: A pair with at least this share of all links is common; so there are at most 10,000 of them.
COMMON = 1e-4


def diagonal(ends_a: np.ndarray, ends_b: np.ndarray, d: int) -> int:
    """How many of the first ``d`` merged ends are A's; of equal ends A's comes first."""
    low, high = max(0, d - len(ends_b)), min(d, len(ends_a))
    while low < high:
        middle = (low + high) // 2
        if ends_a[middle] <= ends_b[d - middle - 1]:
            low = middle + 1
        else:
            high = middle
    return low


def cut_merge(ends_a: np.ndarray, ends_b: np.ndarray, size: int = PIECE) -> list[tuple[int, int, int, int]]:
    """Ranges ``a0, a1, b0, b1`` of pieces of ``size`` ends each, in order."""
    total = len(ends_a) + len(ends_b)
    cuts = [(diagonal(ends_a, ends_b, d), d) for d in [*range(0, total, size), total]]
    return [(a0, a1, d0 - a0, d1 - a1) for (a0, d0), (a1, d1) in zip(cuts[:-1], cuts[1:], strict=True)]


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray, piece: tuple[int, int, int, int]):
    """Token numbers ``a, b`` of each overlap that ends in the piece, and whether both end there.

    Only ends of the piece are read, and the ends around it where a token reaches beyond.
    """
    a0, a1, b0, b1 = piece
    own_a, own_b = ends_a[a0:a1], ends_b[b0:b1]
    ends = np.union1d(own_a, own_b)
    # An A end that closes the piece before has its equal B end first in this one: no new overlap.
    if a0 and b1 > b0 and len(ends) and ends[0] == ends_a[a0 - 1]:
        ends = ends[1:]
    a = a0 + np.searchsorted(own_a, ends)
    b = b0 + np.searchsorted(own_b, ends)
    # Past the piece's own ends the token is the next one; its end may be the same.
    both = (ends_a[np.minimum(a, len(ends_a) - 1)] == ends) & (ends_b[np.minimum(b, len(ends_b) - 1)] == ends)
    return a, b, both


def groups(ends_a: np.ndarray, ends_b: np.ndarray, size: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """For each group its number of A and of B tokens, stitched over all pieces."""
    last_a, last_b = [np.array([-1])], [np.array([-1])]
    for piece in cut_merge(ends_a, ends_b, size):
        a, b, both = overlaps(ends_a, ends_b, piece)
        last_a.append(a[both])
        last_b.append(b[both])
    return np.diff(np.concatenate(last_a)), np.diff(np.concatenate(last_b))


def token_pair(text: str | None, a: str, b: str):
    """Ids and ends of both tokenizers over a blank and the text; none unless both give its bytes back."""
    none = np.empty(0, np.uint32), np.empty(0, np.int64)
    if not text:
        return *none, *none
    ids_a, ids_b = byte_encoder(a)(" " + text), piece_encoder(b)(text)
    said = (" " + text).encode()
    (bytes_a, sizes_a), (bytes_b, sizes_b) = byte_table(a), piece_table(b)
    for ids, entries in ((ids_a, bytes_a), (ids_b, bytes_b)):
        if b"".join(map(entries.__getitem__, ids.tolist())) != said:
            return *none, *none
    return ids_a, np.cumsum(sizes_a[ids_a]), ids_b, np.cumsum(sizes_b[ids_b])


def aligned(text: str | None, a: str, b: str, piece: int = PIECE):
    """Ids of both tokenizers and the numbers of tokens of each group."""
    ids_a, ends_a, ids_b, ends_b = token_pair(text, a, b)
    return ids_a, ids_b, *groups(ends_a, ends_b, piece)


def written_groups(ids_a: np.ndarray, ids_b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray, marks: list[str]) -> str:
    """``a1,a2|b1;a3|b2,b3``: the ids of each group, B's behind A's."""
    if not len(sizes_a):
        return ""
    ends_a, ends_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
    order = np.empty(len(ids_a) + len(ids_b), np.int64)
    # Three marks an id: inside a list, at the end of A's, at the end of a group.
    signed_a, signed_b = ids_a.astype(np.int64) * 3, ids_b.astype(np.int64) * 3
    signed_a[ends_a - 1] += 1
    signed_b[ends_b - 1] += 2
    order[np.arange(len(ids_a)) + np.repeat(ends_b - sizes_b, sizes_a)] = signed_a
    order[np.arange(len(ids_b)) + np.repeat(ends_a, sizes_b)] = signed_b
    return "".join(map(marks.__getitem__, order.tolist()))[:-1]


_ALIGNED = "doc_id bigint, a_ids array<int>, b_ids array<int>, a_sizes array<int>, b_sizes array<int>"


def align(docs: DataFrame, *, a: str = BYTE_BPE, b: str = PIECE_BPE, piece: int = PIECE) -> DataFrame:
    """One row per document: both token lists and how many of each make up every group.

    A blank stands before the text in both. Null and empty texts, and those whose bytes a tokenizer does not
    give back, have no tokens. Rows are kept as they are, repeated ones and those without a doc_id
    too; an empty table gives no rows. No shuffle.
    """

    def over_all(batches):
        for batch in batches:
            # Documents leave one by one, so that the tokens of a batch are not held together.
            for number, text in enumerate(batch.column("text")):
                lists = [pa.array([v.astype(np.int32)], pa.list_(pa.int32())) for v in aligned(text.as_py(), a, b, piece)]
                yield pa.record_batch([batch.column("doc_id").slice(number, 1), *lists], ["doc_id", "a_ids", "b_ids", "a_sizes", "b_sizes"])

    return _texts(docs).mapInArrow(over_all, _ALIGNED)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


_LINKED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, pairs array<bigint>, times array<bigint>"


def link_pairs(docs: DataFrame, *, a: str = BYTE_BPE, b: str = PIECE_BPE, piece: int = PIECE) -> DataFrame:
    """What ``align`` finds as counts and a digest, and each document's linked id pairs (A's in the upper 32 bits)
    with how often each occurs. Tokens stay in the task."""

    def rows(doc_ids, texts, marks):
        found: tuple[list, ...] = ([], [], [], [], [], [])
        for text in texts:
            ids_a, ids_b, sizes_a, sizes_b = aligned(text.as_py(), a, b, piece)
            said = written_groups(ids_a, ids_b, sizes_a, sizes_b, marks)
            # The last tokens of a group are those that end together.
            linked_a, linked_b = (ids[np.cumsum(sizes) - 1].astype(np.int64) for ids, sizes in ((ids_a, sizes_a), (ids_b, sizes_b)))
            pairs, times = np.unique(linked_a << 32 | linked_b, return_counts=True)
            digest = hashlib.sha256(said.encode()).hexdigest() if said else ""
            for column, value in zip(found, (len(ids_a), len(ids_b), len(sizes_a), digest, pairs, times), strict=True):
                column.append(value)
        kinds = [pa.int64()] * 3 + [pa.string()] + [pa.list_(pa.int64())] * 2
        columns = [pa.array(c, k) for c, k in zip(found, kinds, strict=True)]
        return pa.record_batch([doc_ids, *columns], ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"])

    def over_all(batches):
        most = max(len(byte_table(a)[0]), len(piece_table(b)[0]))
        marks = [f"{i}{mark}" for i in range(most) for mark in ",|;"]
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield rows(part.column("doc_id"), part.column("text"), marks)

    return _texts(docs).mapInArrow(over_all, _LINKED)


def pair_counts(spark: SparkSession, linked: DataFrame) -> DataFrame:
    """``pair, count, best``: links of each pair over all documents, and whether no pair of its B id has more."""
    each = linked.select(F.explode(F.arrays_zip("pairs", "times")).alias("at"))
    counted = each.groupBy(F.col("at.pairs").alias("pair")).agg(F.sum("at.times").alias("count"))
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(0xFFFFFFFF))
    return stored(spark, counted.withColumn("best", F.col("count") == F.max("count").over(of_b)), "pairs")


def alignment_totals(spark: SparkSession, docs: DataFrame, *, a: str = BYTE_BPE, b: str = PIECE_BPE, piece: int = PIECE) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    Rows are treated as by ``align``. A pair that makes up a ten-thousandth of all links is looked up where the
    document lies: there can be no more than 10,000 of those. Any other is in few documents, so
    the shuffle by pair has no hot key.
    """
    linked = link_pairs(docs, a=a, b=b, piece=piece).withColumn("row", F.monotonically_increasing_id())
    linked = stored(spark, linked, "linked")
    counts = pair_counts(spark, linked)
    total = counts.agg(F.sum("count").alias("total")).first()["total"] or 0
    common = F.col("count") >= total * COMMON
    each = linked.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("at")).select("row", F.col("at.pairs").alias("pair"), F.col("at.times").alias("times"))
    near = each.join(F.broadcast(counts.where(common)), "pair", "left")

    def per_document(found: DataFrame) -> DataFrame:
        best = F.when(F.col("best"), F.col("times")).otherwise(0)
        return found.groupBy("row").agg(F.sum("times").alias("n_links"), F.sum(best).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))

    rare = near.where("count IS NULL").select("row", "pair", "times").join(counts.where(~common), "pair")
    sums = per_document(near.where("count IS NOT NULL")).unionByName(per_document(rare)).groupBy("row").agg(*(F.sum(c).alias(c) for c in ("n_links", "n_best", "count_sum")))
    told = linked.select("row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256").join(sums, "row", "left")
    return told.select(
        "doc_id", "n_a", "n_b", "n_groups", *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_links", "n_best", "count_sum")), "groups_sha256"
    )
