"""Spelling variants of a vocabulary, by a bit-sliced position index.

The index holds, for each position and letter, the set of words with that letter there, as bits. A word
is searched letter by letter: one set of words agrees so far, three more agree but for one
replaced, one additional or one missing letter, each found from the sets of the shifted position.
All words of a block are tracked at once, 64 to a machine word.

A block need not hold the whole vocabulary. Two words one edit apart agree in one half: with h = l // 2 for the
shorter word's length l, an edit behind the first h letters leaves these as they are, any other
leaves the last l - h. Words are dealt by half, so that near words meet in a block of bounded size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barlake.llm.common import ascii_lower, stored

#: Letters of a word, once A-Z are lower-cased.
RUN = "[a-zÀ-ÿ]+"
NOISE, LEAST_LETTERS, LEAST_COUNT, FACTOR = 199, 6, 5, 5
#: Words in a block; a half that more words share is spread over pairs of parts.
BLOCK_WORDS = 8192
#: Set words held per intermediate of a search.
_HELD = 1 << 17


def garbled(doc: Column, run: Column) -> Column:
    """The run, less one letter where the checksum of document and run is a multiple of ``NOISE``."""
    check = F.crc32(F.concat(doc, F.lit(":"), run))
    at = (check % F.length(run)).cast("int") + 1
    return F.when(check % NOISE == 0, F.overlay(run, F.lit(""), at, F.lit(1))).otherwise(run)


def vocabulary(docs: DataFrame, *, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of the words of all texts that are long and frequent enough.

    A null text has no words; a null doc_id counts as empty; repeated rows count again. Occurrences are
    added up per task before the shuffle, so a word that is everywhere is one row per task.
    """
    text = ascii_lower(F.coalesce("text", F.lit("")))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    runs = docs.select(name.alias("name"), F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run"))
    long = runs.where(F.length("run") >= least_letters)
    words = long.select(garbled(F.col("name"), F.col("run")).alias("word")).where(F.length("word") >= least_letters)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


class PositionIndex:
    """Words that have a given letter at a given place, as sets of bits."""

    def __init__(self, words: list[str]) -> None:
        self.codes, self.lengths, self.starts = letters(words)
        owner = np.repeat(np.arange(len(words)), self.lengths)
        place = np.arange(len(self.codes)) - np.repeat(self.starts, self.lengths)
        self.keys, slot = np.unique(place << 21 | self.codes, return_inverse=True)
        self.width = len(words) + 63 >> 6
        # The last set is empty: no word has such a letter there.
        self.sets = np.zeros((len(self.keys) + 1, self.width), np.uint64)
        np.bitwise_or.at(self.sets, (slot, owner >> 6), np.uint64(1) << (owner & 63).astype(np.uint64))

    def at(self, place: int, codes: np.ndarray) -> np.ndarray:
        """For each letter the words that have it at this place."""
        wanted = np.int64(place) << 21 | codes
        slot = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return self.sets[np.where(self.keys[slot] == wanted, slot, len(self.keys))] if place >= 0 else np.zeros((len(codes), self.width), np.uint64)

    def of_length(self, length: int) -> np.ndarray:
        found = np.zeros(self.width * 64, np.uint8)
        found[: len(self.lengths)] = self.lengths == length
        return np.packbits(found, bitorder="little").view(np.uint64)

    def near(self, codes: np.ndarray) -> np.ndarray:
        """Sets of the words one edit away from each row, words of one length."""
        count, length = codes.shape
        same = np.full((count, self.width), ~np.uint64(0))
        replaced, longer, shorter = (np.zeros_like(same) for _ in range(3))
        behind, here = self.at(-1, codes[:, 0]), self.at(0, codes[:, 0])
        for i in range(length):
            ahead = self.at(i + 1, codes[:, i])
            longer = (longer | same) & ahead
            shorter = (shorter & behind) | same
            replaced = (replaced & here) | (same & ~here)
            same &= here
            if i + 1 < length:
                behind, here = self.at(i, codes[:, i + 1]), self.at(i + 1, codes[:, i + 1])
        return replaced & self.of_length(length) | (longer | same) & self.of_length(length + 1) | shorter & self.of_length(length - 1)


def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words end to end, their numbers and starts."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    return codes, lengths, np.cumsum(lengths) - lengths


def near_pairs(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs one edit apart, in both directions; words are distinct and not empty."""
    index = PositionIndex(words)
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    step = max(1, _HELD // index.width)
    for length in np.unique(index.lengths).tolist():
        asked = np.flatnonzero(index.lengths == length)
        for at in range(0, len(asked), step):
            part = asked[at : at + step]
            found = index.near(index.codes[index.starts[part, None] + np.arange(length)])
            row, word = np.nonzero(found)
            hit, bit = np.nonzero(np.unpackbits(found[row, word].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            left.append(part[row[hit]])
            right.append(word[hit] * 64 + bit)
    return np.concatenate(left), np.concatenate(right)


def _search(batches):
    """Near pairs within each block of a partition sorted by block; a word may come several times."""
    block, held = None, {}

    def found():
        words = list(held)
        left, right = near_pairs(words) if len(words) > 1 else (np.empty(0, np.int64),) * 2
        names, counts = pa.array(words, pa.string()), pa.array(list(held.values()), pa.int64())
        for at in range(0, len(left), 50_000):
            a, b = pa.array(left[at : at + 50_000]), pa.array(right[at : at + 50_000])
            columns = [names.take(a), counts.take(a), names.take(b), counts.take(b)]
            yield pa.record_batch(columns, ["word", "n", "near", "near_n"])

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("block", "word", "n"))
        for number, word, n in zip(*columns, strict=True):
            if number != block:
                yield from found()
                block, held = number, {}
            held[word] = n
    yield from found()


def near_words(spark: SparkSession, words: DataFrame, *, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``word, n, near, near_n``: all pairs of ``word, n`` one edit apart, in both directions, once each.

    Words are distinct and have at least two letters. A half that over ``block_words`` words
    share is cut into parts, and each pair of parts meets in a block, so a task never holds more
    than some blocks' worth of words, and none is left out.
    """
    size = F.length("word")
    halves = []
    for shorter in (size - 1, size):
        front = F.floor(shorter / 2).cast("int")
        halves.append(F.xxhash64(F.lit("front"), shorter, F.substring("word", F.lit(1), front)))
        halves.append(F.xxhash64(F.lit("back"), shorter, F.right("word", shorter - front)))
    dealt = words.select("word", "n", F.explode(F.array(*halves)).alias("half"))
    shared = dealt.groupBy("half").agg(F.count("*").alias("words")).where("words > 1")
    parts = F.when(F.col("words") <= block_words, 1).otherwise(F.ceil(F.col("words") * 2 / block_words)).cast("int")
    placed = dealt.join(shared.select("half", parts.alias("parts")), "half")
    part = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    paired = placed.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cell = F.xxhash64("half", F.least("part", "other"), F.greatest("part", "other"))
    members = stored(spark, paired.select(cell.alias("cell"), "word", "n"), "halves")
    blocks = max(1, -(-members.count() // block_words))
    ordered = members.select(F.pmod("cell", F.lit(blocks)).alias("block"), "word", "n").repartition("block").sortWithinPartitions("block")
    return ordered.mapInArrow(_search, "word string, n bigint, near string, near_n bigint").distinct()


def last_forms(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """``word, root``: where following ``word, form`` ends. Each round doubles the steps taken."""
    reached = stored(spark, forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = reached.join(further, "root", "left")
        reached = stored(
            spark, moved.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "forms"
        )
        if reached.where("moved").isEmpty():
            return reached.select("word", "root")


def spelling_variants(
    spark: SparkSession, words: DataFrame, *, factor: int = FACTOR, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """One row per word of ``word, n``: ``word, form, root, n, n_near, form_n``.

    ``form`` is the near word of largest count (of equal ones the smallest) if that is at least
    ``factor`` times the word's, ``root`` where following forms ends, the word itself if it has none. As counts grow
    at each step, forms never turn in a circle. An empty table gives no rows.
    """
    words = stored(spark, words.select("word", "n"), "words")
    links = near_words(spark, words, block_words=block_words)
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near").alias("word")))
    found = links.groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    large = -F.col("best.rank") >= F.col("n") * factor
    near = stored(
        spark,
        found.select("word", "n_near", F.when(large, F.col("best.word")).alias("form"), F.when(large, -F.col("best.rank")).alias("form_n")),
        "near",
    )
    roots = last_forms(spark, near.where("form IS NOT NULL"))
    return words.join(near, "word", "left").join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n"
    )
